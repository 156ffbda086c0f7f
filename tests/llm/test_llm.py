"""The training-data operators: brute force on small tables, and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterloom.llm import homes
from chatterloom.llm import op01_quality_rules as op1
from chatterloom.llm import op02_suffix_dedup as op2
from chatterloom.llm import op03_quality_classifier as op3
from chatterloom.llm import op04_embedding_dedup as op4
from chatterloom.llm import op05_line_dedup as op5
from chatterloom.llm import op06_packing as op6
from chatterloom.llm import op07_bpe as op7
from chatterloom.llm import op08_katz as op8
from chatterloom.llm import op09_toxicity as op9
from chatterloom.llm import op10_minhash_dedup as op10
from chatterloom.llm.common import connected_components, local_components

AT = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "a b c d e f " * 40), (6, "a b c d e f " * 40), (None, "free text"), (8, "é😀 ß\x00 tail"), (9, "long " * 30_000), (10, "x" * 5000), (11, "one\ntwo\none"), (12, "<|endoftext|> q")]


def vocab():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    d = spark.createDataFrame(ODD + [ODD[4]], "doc_id long, text string")
    return d.selectExpr("doc_id", "text", "1 as score", "2 as kept", "'z' as a0", "3 as component_id", "'u' as lang")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id > 1000")


def union(n, pairs):
    p = list(range(n))

    def top(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        p[b] = a
    return [top(x) for x in range(n)]


def lower_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))


def test_components(spark):
    random.seed(4)
    pairs = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union(450, pairs)
    assert got == {n: want[n] for a, b in pairs if a != b for n in (a, b)}


def test_local_components():
    r = np.random.default_rng(0)
    for n in range(1, 60):
        for _ in range(20):
            a, b = r.integers(0, n, (2, n + n // 4))
            assert local_components(a, b, n).tolist() == union(n, zip(a.tolist(), b.tolist()))


def test_op1(spark, odd, none):
    labels = spark.createDataFrame([(5, 0), (6, 0), (9, 1), (11, 1), (99, 1), (8, None)], "doc_id long, quality int")
    weights = op1.fit(odd.select("doc_id", "text"), labels)
    rows = {r["doc_id"]: r for r in op1.judge(odd.select("doc_id", "text"), weights).collect()}
    assert rows[1]["n_words"] == rows[2]["n_words"] == rows[3]["n_words"] == 0 and not rows[1]["kept"]
    assert (rows[5]["n_words"], rows[5]["n_repeat_words"], rows[5]["base_failed"]) == (240, 240, True)
    assert rows[11]["n_dup_lines"] == 1
    assert op1.judge(none.select("doc_id", "text"), op1.fit(none.select("doc_id", "text"), labels)).count() == 0
    a, b, c = (np.array(x, np.uint64) for x in ([1, 2, 2], [1, 3], [1, 4]))
    assert [y.tolist() for y in op1.line_labels([a, b, c], [True, True, False])] == [[0, 1, 1], [0, 1], [0, 0]]
    e, t, doc = np.random.default_rng(1).normal(size=(7, 2)), np.array([[0.5, -0.2], [-0.3, 0.4]]), np.array([0, 0, 0, 0, 1, 1, 1])
    best = lambda lo, hi: max(np.ndindex(*[2] * (hi - lo)), key=lambda y: sum(e[lo + k, v] for k, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:])))
    assert op1.viterbi(doc, e, t).tolist() == [*best(0, 4), *best(4, 7)]


def brute_repeats(docs, width):
    seen, out = set(), {}
    for i, x in docs:
        m = np.zeros(len(x), bool)
        for p in range(len(x) - width + 1):
            if x[p : p + width] in seen:
                m[p : p + width] = True
            seen.add(x[p : p + width])
        out[i] = (i, *op2.digests(x, m))
    return out


def test_op2(spark, odd, none):
    random.seed(1)
    for _ in range(60):
        strings = [bytes(random.choices(b"ab", k=random.randint(3, 12))) for _ in range(random.randint(1, 8))]
        s, o, run = op2.sorted_suffixes(strings, 3)
        got = [strings[a][b:] for a, b in zip(s, o)]
        assert got == sorted(x[k:] for x in strings for k in range(len(x) - 2))
        assert [a == b for a, b in zip(run, run[1:])] == [a[:3] == b[:3] for a, b in zip(got, got[1:])]
    base = "".join(random.choices("abcdé ", k=3000))
    rows = []
    for i in range(120):
        a = random.randint(0, 2900)
        x = base[a : a + random.randint(0, 300)] + "".join(random.choices("abcdefghij ", k=random.randint(0, 200))) + base[: random.randint(0, 200)]
        rows.append((i, "xyz" * 50 if i % 17 == 0 else rows[-1][1] if i % 29 == 5 else x))
    got = op2.dedup(spark.createDataFrame(rows, "doc_id long, text string"), op2.digests, op2.DIGESTS).collect()
    assert {r["doc_id"]: tuple(r) for r in got} == brute_repeats([(i, x.encode()) for i, x in rows], 100)
    rows = {r["doc_id"]: r for r in op2.dedup(odd, op2.digests, op2.DIGESTS).collect()}
    assert rows[1]["n_bytes"] == 0 and rows[6]["n_removed"] == 480 and len(rows) == 12 and op2.dedup(odd, op2.digests, op2.DIGESTS).count() == 13
    assert op2.dedup(none, op2.digests, op2.DIGESTS).count() == 0


def test_op2_sorts_only_what_can_share(monkeypatch):
    """Of 300 texts around one phrase, shorter than a string, few share a string; all that do are found."""
    rng = random.Random(6)
    text = lambda n: bytes(rng.choices(range(97, 123), k=n))
    phrase, long = text(80), text(130)
    texts = {text(rng.randint(0, 150)) + phrase + text(rng.randint(80, 150)): (0, i, 1, 1) for i in range(300)}
    texts |= {text(20) + long[rng.randint(0, 30) :] + text(20): (0, i, 1, 1) for i in range(300, 310)}
    h = op2.Home(homes.Texts(homes._blob(texts)), 100)
    anchors = {0: dict(op2.answer_anchors([(0, b) for _, b in h.ask_anchors(1)]))[0]}
    some = h.read_anchors(anchors, 1)
    asks, sorted_, plain = [(0, b) for _, b in h.ask_segments(some, 0, 1)], [], op2.repeated
    monkeypatch.setattr(op2, "repeated", lambda strings, *a: sorted_.extend(strings) or plain(strings, *a))
    masks = op2.removed(h, some, {0: dict(op2.answer_segments(asks, 100))[0]}, 1)
    got = {int(i): (int(i), *op2.digests(x, m)) for i, x, m in zip(h.t.least, h.t.texts, masks)}
    assert got == brute_repeats(sorted(((v[1], x) for x, v in texts.items()), key=lambda r: r[0]), 100)
    assert 0 < len(sorted_) < 60


@pytest.mark.parametrize("op, label, train, apply", [(op3, "quality", op3.train, op3.classify), (op9, "toxic", op9.train, op9.detect)])
def test_op3_op9(spark, odd, none, op, label, train, apply):
    docs, labels = spark.read.parquet(f"{AT}/documents.parquet"), spark.read.parquet(f"{AT}/labels.parquet")
    model = train(docs, labels, None)
    rows = apply(docs, model).join(labels, "doc_id").select("score", label).collect()
    good = np.mean([(r["score"] >= 0.5) == (r[label] == 1) for r in rows])
    assert good > 0.85
    out = apply(odd.drop("score"), model).collect()
    assert len(out) == 13 and all(0 <= r["score"] <= 1 for r in out)
    assert apply(none.drop("score"), train(none, labels)).count() == 0
    assert len(apply(odd.drop("score"), train(odd, labels.where("false"))).collect()) == 13


def test_op4(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [(i, (base[i % 60] + rng.normal(size=16) * (0.0 if i % 7 == 0 else 0.12)).tolist(), i % 3) for i in range(240)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None], 1), (904, base[0].tolist(), None), (905, [], 2), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1)]
    got = {r["vec_id"]: r for r in op4.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=40).collect()}
    x = np.array([r[1] for r in rows[:240]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & (np.arange(240)[:, None] % 3 == np.arange(240) % 3)
    np.fill_diagonal(near, False)
    assert near.sum() > 100
    comp = union(240, zip(*np.nonzero(near)))
    assert all((got[i]["n_links"], got[i]["component_id"]) == (near[i].sum(), comp[i]) for i in range(240))
    assert [got[i]["n_links"] for i in range(900, 908)] == [0] * 6 + [1, 1]
    assert op4.link(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_op5(spark, odd, none):
    rows = {r["doc_id"]: r for r in op5.dedup_lines(odd, sentences=False, least=1, run=1).collect()}
    assert (rows[11]["n_units"], rows[11]["n_removed"], [tuple(s) for s in rows[11]["spans"]]) == (3, 1, [(8, 3)])
    assert rows[6]["n_removed"] == 1 and rows[1]["n_units"] == 0 and rows[None]["n_units"] == 1
    assert op5.dedup_lines(none).count() == 0


def test_op6(spark, odd, none):
    for seed in range(20):
        random.seed(seed)
        sizes = [random.choice([1, 2, random.randint(1, 300), random.randint(1, 6000)]) for _ in range(random.choice([0, 1, 5, 300]))]
        docs, seqs = defaultdict(list), defaultdict(list)
        for d, s, n, q, o in op6.plan(sizes):
            docs[d].append((s, n))
            seqs[q].append((o, n))
        for parts in (*docs.values(), *seqs.values()):
            at = 0
            for s, n in sorted(parts):
                assert s == at and n > 0
                at += n
        assert all(sum(n for _, n in docs[d]) == z for d, z in enumerate(sizes))
        assert all((t := sum(n for _, n in p)) <= 2048 and t & (t - 1) == 0 or t == 2048 for p in seqs.values())
    rows = op6.pieces(odd.select("doc_id", "text"), vocab()).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows}[1] == 1
    assert op6.pieces(none.select("doc_id", "text"), vocab()).count() == 0


def test_op7(spark, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab())
    rows = {r["doc_id"]: r for r in op7.encoded(odd.select("doc_id", "text"), vocab()).collect()}
    for i, x in ODD:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want = (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(rows[i])[1:] == want
    assert op7.encoded(none.select("doc_id", "text"), vocab()).count() == 0


def test_op8(spark, odd, none, monkeypatch):
    monkeypatch.setattr(op8, "HOT", 50)
    docs = spark.read.parquet(f"{AT}/documents.parquet")
    uni, bi = Counter(), defaultdict(Counter)
    texts = [(r["doc_id"], lower_words(r["text"]) + [None]) for r in docs.collect()]
    for i, ws in texts:
        if zlib.crc32(str(i).encode()) % 10:
            uni.update(ws)
            for a, b in zip(["<s> ", *ws], ws):
                bi[a][b] += 1
    total = sum(uni.values())
    counts = lambda c: np.array([sum(v == k for v in c) for k in range(7)])
    du, db = op8.discounts(counts(uni.values())), op8.discounts(counts([v for c in bi.values() for v in c.values()]))
    d = lambda t, c: t[c] * c if c <= 5 else c
    free = 1 - sum(d(du, c) for c in uni.values()) / total
    pu = lambda w: d(du, uni[w]) / total if w in uni else free
    assert sum(map(pu, uni)) + free == pytest.approx(1)
    rows = {r["doc_id"]: r for r in op8.score(docs).collect()}
    for i, ws in texts[:80]:
        s = 0.0
        for a, b in zip(["<s> ", *ws], ws):
            if a not in bi:
                s += np.log10(pu(b))
                continue
            c = bi[a]
            n, left = sum(c.values()), 1 - sum(d(db, k) for k in c.values()) / sum(c.values())
            scale = 1.0
            if left <= 1e-15:
                scale, left = n / (n + 1), 1 / (n + 1)
            s += np.log10(scale * d(db, c[b]) / n if b in c else left * pu(b) / (1 - sum(map(pu, c))))
        assert rows[i]["score"] == pytest.approx(s, rel=1e-6)
        assert (rows[i]["n_tokens"], rows[i]["n_known"], rows[i]["train_tokens"]) == (len(ws), sum(w in uni for w in ws), total)
    assert op8.score(odd).count() == 13
    assert op8.score(none).count() == 0


def test_op10(spark, odd, none):
    docs = spark.read.parquet(f"{AT}/documents.parquet")
    rows = sorted(op10.groups(docs, 85, 42).collect(), key=lambda r: r["doc_id"])
    sets = []
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        w = lower_words(r["text"])
        sets.append(set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(a, b) for b in range(len(sets)) for a in range(b) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert [r["n_shingles"] for r in rows] == list(map(len, sets))
    assert [r["component_id"] for r in rows] == union(len(sets), links)
    got = {r["doc_id"]: r for r in op10.groups(odd).collect()}
    assert got[6]["component_id"] == 5 and got[1]["n_shingles"] == 0 and got[2]["component_id"] == 2 and len(got) == 12
    assert op10.groups(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{AT}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, AT)
        assert kept.columns == docs.columns
        n = kept.count()
        assert 0 < n <= docs.count()
        docs = corpus_pipeline.written(kept)
    packed = corpus_pipeline.packing(spark, docs, AT)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
    odd = spark.createDataFrame(ODD + [ODD[4]], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn("lang", F.lit("x"))
    assert corpus_pipeline.near_duplicates(spark, odd, AT).count() == 11
    assert corpus_pipeline.repeated_strings(spark, odd, AT).count() == 13  # each row is a document
