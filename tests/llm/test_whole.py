"""Cases in which an operator once did less than the whole job."""

import random

import numpy as np
from pyspark.sql import functions as F

from chatterloom.llm import common
from chatterloom.llm import op09_toxicity as op9
from chatterloom.llm import op10_minhash_dedup as op10


def test_op9_trains_on_texts_that_share_words(spark):
    random.seed(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so") for b in ("ba", "do", "fi", "gu")]
    apart = [" ".join(random.choices(words, k=40)) for _ in range(60)]
    copies = [(0, apart[0]), (0, apart[0].title()), (0, apart[1] + " end"), (1, apart[2])]
    rows = spark.createDataFrame([(0, t) for t in apart] + copies + [(0, None), (0, "")], "y int, text string")
    for parts in (1, 5):
        got = [tuple(r) for r in op9.one_of_each(rows.repartition(parts)).collect()]
        assert sum(y == 0 for y, _ in got) == 61 and [t for y, t in got if y == 1] == [apart[2]]  # one empty text
        assert set(apart[2:]) < {t for _, t in got}
        assert parts == 1 or sorted(got) == first
        first = sorted(got)


def test_pipeline_links_from_080(spark):
    import corpus_pipeline

    rows = []
    for i in range(8):
        w = [f"w{i}x{k}" for k in range(100)]
        near = [x + "y" if k in (30, 60) else x for k, x in enumerate(w)]  # 86 of 106 shingles in common: 0.811
        far = [x + "z" if k in (20, 50, 80) else x for k, x in enumerate(w)]  # 81 of 111: 0.730, and less with near
        rows += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(near)), (3 * i + 2, " ".join(far))]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i % 3 != 1}


def compared(spark, frames, ours, sql):
    """Both results as sorted rows; sql runs on the frames as tables."""
    import duckdb

    con = duckdb.connect()
    for name, rows in frames.items():
        con.register(name, rows)
    got = con.sql(sql)
    cols = sorted(got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted((tuple(r[c] for c in cols) for r in ours.collect()), key=key), sorted(got.project(", ".join(cols)).fetchall(), key=key)


def test_op5_runs_of_sentences(spark):
    import pandas as pd

    from chatterloom.llm import op05_line_dedup as op5

    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abdeginorstuéß", k=rng.randint(2, 7)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + rng.choice(".!?")
    passages = [" ".join(sentence(rng.randint(4, 14)) for _ in range(8)) for _ in range(4)]
    phrase = sentence(9)
    texts, holds = [], []
    for i in range(120):
        lines = [" ".join(sentence(rng.randint(1, 12)) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 6))]
        lines.append(phrase)  # in every text, but too short to go
        k = i % 6
        if k < 4:
            p = "".join(c.upper() if c.isascii() else c for c in passages[k]) if i % 5 == 0 else passages[k]
            lines.insert(rng.randint(0, len(lines)), f"{sentence(6)} {p}  {sentence(3)}" if i % 2 else p.replace(" ", "\t ", 2))
        holds.append(k < 4 and i >= 6)
        texts.append("\n".join(lines))
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, ""), (1001, None), (1002, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 7):
        docs.repartition(parts).write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/op5-{parts}/documents.parquet")
        ours, theirs = compared(spark, {"documents": pd.DataFrame(rows, columns=["doc_id", "text"])}, op5.op5_line_dedup(spark, f"{spark.conf.get('spark.checkpoint.dir')}/op5-{parts}"), op5.ORACLE_SQL)
        assert ours == theirs
    got = {r["doc_id"]: r for r in op5.dedup_lines(docs).collect()}
    assert [got[i]["n_removed"] > 0 for i in range(120)] == holds
    for i, r in got.items():
        if i < 120:
            assert all(s["start"] >= 0 and s["start"] + s["length"] <= len(texts[i]) for s in r["spans"])
            assert len(texts[i]) - sum(s["length"] for s in r["spans"]) == r["kept_chars"]


def test_op2_does_not_depend_on_partitions(spark):
    from chatterloom.llm import op02_suffix_dedup as op2

    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = [text(180) for _ in range(40)]
    rows = [(i if i < 30 else None, text(60) + shared[i] + end) for i in range(40) for end in (" x", " y")] + [(2**63 - 1, shared[0] + "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in ("1", "4", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(sorted(map(str, op2.dedup(docs.repartition(int(parts)), op2.digests, op2.DIGESTS).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] == found[2]
    assert any(f"doc_id={2**63 - 1}" in x for x in found[0])


def test_pipeline_takes_any_column_and_row(spark):
    import corpus_pipeline

    names = ["row_key", "gone_key", "new_text", "score", "Score_", "__quality", "a.b", "component_id", "part", "y"]
    text = "Some words of a plain text that goes on. " * 8
    rows = [(1, text), (1, "another text under the same id, with other words in it"), (None, text), (None, "no id here but a text"), (None, None), (2, ""), (2, ""), (3, "a b c " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in names:
        docs = docs.withColumn(n, F.lit("z"))
    at = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, at)
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, docs.where("doc_id > 99"), at).count() == 0
        kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.select("doc_id", "text").collect()) if name != "packing" else None
        if name == "minhash_dedup":
            assert len(kept) == 7 and (True, 0, text) not in kept and sum(k[1] == 1 for k in kept) == 2
        if name == "suffix_dedup":
            assert len(kept) == 8 and (True, 0, "") in kept


def test_op2_op8_many_copies(spark):
    """A text that a third of the rows hold, with and without ids of their own."""
    from chatterloom.llm import op02_suffix_dedup as op2
    from chatterloom.llm import op08_katz as op8

    hot = "the same words again and again in a text that very many rows hold, " * 3
    rows = [(i, hot) for i in range(5, 605)] + [(7, hot)] * 40 + [(None, hot)] * 30 + [(i, f"other text {i}") for i in range(1000, 1900)] + [(5, "short"), (6, "short"), (None, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in op2.dedup(docs, op2.digests, op2.DIGESTS).collect()]
    assert len(got) == len(rows)
    n = len(hot.encode())
    mine = [r for r in got if r[1] == n]
    assert sorted((r[0] is None, r[0] or 0) for r in mine if r[2] < n) == [(False, 5)] and sum(r[2] == n for r in mine) == 669
    assert all(r[2] == 0 for r in got if r[1] == 5)
    got = op8.score(docs).collect()
    assert len(got) == len(rows) and len({r["score"] for r in got if r["n_tokens"] == len(hot.split()) + 1}) == 1
    import zlib

    train = sum(len(t.split()) + 1 for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10)
    assert {r["train_tokens"] for r in got} == {train}
    assert {r["doc_id"] for r in got if r["held_out"]} == {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0}


def test_op4_cells_of_a_label(spark):
    import numpy as np

    from chatterloom.llm import op04_embedding_dedup as op4

    rng = np.random.default_rng(5)
    centre = rng.normal(size=(24, 32)) * 3
    x = (centre[rng.integers(0, 24, 3000)] + rng.normal(size=(3000, 32)) * rng.choice([0.02, 0.5, 1.0], size=(3000, 1))).astype(np.float32)
    label = rng.choice(3, 3000, p=[0.9, 0.08, 0.02])
    u = op4.unit_rows(x.astype(float))
    assert len(op4.fitted(u[label == 0], 1000.0, 0.93, 100).c) > 4
    docs = spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(3000)], "vec_id long, embedding array<float>, label int")
    near = (u @ u.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    first = None
    for block, sample in ((100, 20_000), (4096, 150), (37, 900)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op4.link(docs, block=block, sample=sample).collect()}
        assert [got[i][0] for i in range(3000)] == near.sum(1).tolist()
        assert first in (None, got)
        first = got
    seen = set()
    for i in range(3000):  # components by search
        if i not in seen:
            todo, part = [i], {i}
            while todo:
                for k in np.flatnonzero(near[todo.pop()]).tolist():
                    if k not in part:
                        part.add(k)
                        todo.append(k)
            seen |= part
            assert {first[k][1] for k in part} == {i}


def test_katz_tables_of_three_orders(spark):
    """Against a recursion over dictionaries, and sums of probabilities; at two orders the same as op8's query."""
    from collections import Counter, defaultdict
    from math import log10

    import numpy as np
    import pytest

    from chatterloom.llm import ngram_tables as tables
    from chatterloom.llm import op08_katz as op8

    rng = random.Random(8)
    words = [f"W{k}" for k in range(25)]
    texts = [" ".join(rng.choices(words, weights=[30 // (k + 1) + 1 for k in range(25)], k=rng.randint(0, 14))) for _ in range(300)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = [[w.lower() for w in (t or "").split()] + ["</s>"] for t in texts]
    grams = {n: defaultdict(Counter) for n in (1, 2, 3)}
    for ws in tokens:
        padded = ["<s>", "<s>", *ws]
        for i, w in enumerate(ws):
            for n in (1, 2, 3):
                grams[n][tuple(padded[i + 3 - n : i + 2])][w] += 1
    d = {n: op8.discounts(np.array([sum(v == r for c in g.values() for v in c.values()) for r in range(7)])) for n, g in grams.items()}
    cut = lambda n, c: c * (d[n][c] if c <= 5 else 1)

    def p(ctx, w):
        n = len(ctx) + 1
        c = grams[n].get(ctx)
        if c is None:
            return p(ctx[1:], w)
        total = sum(c.values())
        left, scale = 1 - sum(cut(n, v) for v in c.values()) / total, 1.0
        if left <= 1e-15:
            left, scale = 1 / (total + 1), total / (total + 1)
        if w in c:
            return scale * cut(n, c[w]) / total
        return left / (1 - sum(p(ctx[1:], v) for v in c)) * p(ctx[1:], w) if ctx else left

    known = list(grams[1][()])
    for ctx in list(grams[3])[:40]:
        assert sum(p(ctx, w) for w in known) + p(ctx, "?") == pytest.approx(1)
    new = [(1000, "w0 W1 unseen w2 w1"), (1001, "w24 w24 w24 w23"), (None, "w3")]
    both = docs.unionByName(spark.createDataFrame(new, "doc_id long, text string"))
    m = tables.model(tables.counts(docs))
    got = {r["doc_id"]: r["score"] for r in tables.scored(both, m).collect()}
    for i, t in [*enumerate(texts), *new]:
        ws = [w.lower() for w in (t or "").split()] + ["</s>"]
        padded = ["<s>", "<s>", *ws]
        assert got[i] == pytest.approx(sum(log10(p(tuple(padded[k : k + 2]), w)) for k, w in enumerate(ws)), rel=1e-9)
    two = {r["doc_id"]: r["score"] for r in tables.scored(docs, tables.model(tables.counts(docs, 2), 2)).collect()}
    assert all(two[r["doc_id"]] == pytest.approx(r["score"], rel=1e-6) for r in op8.score(docs, 0).collect())
    nothing = tables.model(tables.counts(docs.where("false")))
    assert {r["score"] for r in tables.scored(docs, nothing).collect()} == {0.0}


def test_components_of_few_links_take_two_tables(spark, monkeypatch):
    random.seed(6)
    way = random.sample(range(500), 200)  # one component, far from end to end
    pairs = [*zip(way, way[1:]), (600, 601), (601, 601), (None, 602), (603, None), (601, 700), (700, 600)]
    made, put = [], common.written
    monkeypatch.setattr(common, "written", lambda *a, **k: made.append(put(*a, **k)) or made[-1])
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in common.connected_components(links).collect()}
    assert got == {n: min(way) for n in way} | {600: 600, 601: 600, 700: 600}
    assert len(made) == 2  # a table a round costs a file for each partition, and local files cost processes
    assert {r["node"]: r["component"] for r in common.connected_components(links, local=0).collect()} == got  # by rounds
    assert common.connected_components(links.where("a = 601 and b = 601")).count() == 0


def test_op10_writes_as_many_files_as_rows_call_for(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(map(tuple, op10.groups(docs, 85, 42).collect()))
    assert any(i != c for i, _, c in want)
    assert sorted(map(tuple, op10.groups(docs, 85, 42, block=2).collect())) == want  # many block pairs
    files, put = [], common.written

    def written(*a, **k):
        out = put(*a, **k)
        files.extend(out.inputFiles())
        return out

    for module in (common, op10):
        monkeypatch.setattr(module, "written", written)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, op10.groups(docs, 85, 42).collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files) < 60  # before: as many as partitions that have rows, for each of over ten tables


def test_op10_holds_a_few_rows_of_large_components():
    texts = [b" ".join(b"w%d" % (k * (d + 3)) for k in range(300)) for d in range(4)]
    h, at = op10.shingles(texts)
    ids, component, blocks = np.arange(4), np.zeros(4, int), np.full(4, 500)
    batches = list(op10.dealt(ids, component, blocks, op10.signatures(h, at), h, at, most=50_000))
    assert sum(b.num_rows for b in batches) == 4 * 500  # each document meets each block once
    assert max(b.nbytes for b in batches) < 60_000
    rows = [r for b in batches for r in b.to_pylist()]
    assert {(r["doc_id"], r["i"] + r["j"] - r["own"]) for r in rows} == {(d, o) for d in range(4) for o in range(500)}
    assert all(r["set"] == h[at[r["doc_id"]] : at[r["doc_id"] + 1]].tobytes() for r in rows)
