"""Scores by hand, held-out folds, and models that do not depend on how rows are dealt."""

import random
import zlib

import numpy as np
import pytest

from chatterloom.llm import op03_quality_classifier as op3
from chatterloom.llm import op09_toxicity as op9

AT = "/root/testdata/sf0.01"


def test_discriminant_is_the_difference_of_log_densities():
    rng = np.random.default_rng(4)
    x = np.abs(np.concatenate([rng.normal(3, 1, (300, 5)), rng.normal(4, 2, (200, 5))]))
    y = np.repeat([0, 1], [300, 200])
    m = op3.fit(x, y)
    z = op3.standard(x, m.centre, m.scale)
    logs = []
    for k in (0, 1):
        cov = m.factors[k] @ m.factors[k].T
        d = z - z[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
        own = np.cov(z[y == k], rowvar=False, bias=True)
        assert np.abs(cov - own).max() < 0.5 * np.abs(own).max() and (np.linalg.eigvalsh(cov) > 0).all()
    assert m.margin(z) == pytest.approx(logs[1] - logs[0] + np.log(200 / 300))
    assert ((m.score(x) >= 0.5) == (m.slope * m.margin(z) + m.offset >= 0)).all()


def test_composed_grammar_is_its_parts_run_side_by_side():
    parts = [op9.insults(), op9.threats(), op9.targets(), op9.negations(), op9.reports()]
    to, now, later = op9.composed()
    rng = random.Random(6)
    for _ in range(300):
        states, state = [0] * 5, 0
        for c in rng.choices(list(op9.CLASSES), k=12):
            each = [p[s, c] for p, s in zip(parts, states)]
            assert now[state, c] == pytest.approx(np.prod([e[1] for e in each]))
            assert later[state, c] == pytest.approx((each[0][2] + each[1][2]) * each[2][2] * each[3][2] * each[4][2])
            states, state = [e[0] for e in each], to[state, c]


def test_clauses_weigh_more_than_words():
    import pyarrow as pa

    lexicon = op9.base_lexicon()
    keys = np.array(sorted(lexicon), np.uint64)
    g = op9.Grammar(keys, np.array([lexicon[int(k)][0] for k in keys]), np.array([lexicon[int(k)][1] for k in keys], np.int8), np.array([2.0, 1.0, 1.0, 0.0, -4.0]), *op9.composed())
    texts = ["idiot", "you idiot", "idiot, you", "never an idiot", "she said idiot", "kill", "i will kill", "i will kill you", "you idiot moron", "a plain text", "", None]
    s = dict(zip(texts, g.signals(pa.array(texts))[:, 0]))
    weight = lambda t: np.expm1(s[t])
    assert weight("idiot") == pytest.approx(3 * 0.8) and weight("you idiot") == pytest.approx(3 * 1.1) and weight("idiot, you") == pytest.approx(3 * (0.8 + 0.3))
    assert weight("never an idiot") == pytest.approx(3 * 0.8 * 0.25) and weight("she said idiot") == pytest.approx(3 * 1.1 * 0.4)
    assert weight("kill") == pytest.approx(3 * 0.3) and weight("i will kill") == pytest.approx(3 * 0.7) and weight("i will kill you") == pytest.approx(3 * (0.7 + 0.6))
    assert weight("you idiot moron") == pytest.approx(3 * 1.1 + 3 * 1.1 * 1.1) and s["a plain text"] == s[""] == s[None] == 0


@pytest.mark.parametrize("op, query, label, folds, held, least", [(op3, op3.op3_quality_classifier, "quality", 5, 0, 0.95), (op9, op9.op9_toxicity, "toxic", 3, 1, 0.93)])
def test_held_out_rows(spark, op, query, label, folds, held, least):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{AT}/labels.parquet").collect()}
    rows = query(spark, AT).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in rows)
    told = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert len(told) > 30 and np.mean([a == b for a, b in told]) >= least


def test_toxicity_however_rows_are_dealt(spark):
    docs, labels = (spark.read.parquet(f"{AT}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    first = None
    for parts in (1, 7, 40):
        m = op9.train(docs.repartition(parts), labels.repartition(parts))
        got = [m.keys.tolist(), m.weights.tolist(), m.coef.tolist()]
        assert first in (None, got)
        first = got
    # what is labelled in the held-out fold changes nothing
    from pyspark.sql import functions as F

    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    m = op9.train(docs, labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert [m.keys.tolist(), m.weights.tolist(), m.coef.tolist()] == first
