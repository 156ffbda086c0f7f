"""MinHash near-dedup by a signature-coordinate inverted join.

A document's set is its distinct 5-word shingles. Equal sets are one class, whose representative (the smallest
doc_id) stands for it from there on. Its signature's (coordinate, value) pairs are the terms of an inverted index.
Two signatures of K coordinates that agree in T or more share one of the K - T + 1 rarest terms of either, in one
global order by rarity; the longer posting lists are skipped. Terms that one class holds cannot collide and are
counted off first. Classes that meet in a posting list are gathered (by connected components of stars, one per
list) and compared in blocks: collisions are counted over all coordinates, and pairs of T or more are confirmed on
full sets. A block pair returns a spanning forest of its links, never pairs.

With K = 64 a pair of similarity 0.80 is missed at T = 38 with a probability of 4e-5, one of 0.85 at T = 42 with 1e-5.

Defined results: null, empty and wordless texts have no shingles and are their own components. A text of fewer words
than a shingle has them all as one. Rows that repeat a doc_id count once, with the largest set. Null doc_ids are
reported as one row, linked with nothing. Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, connected_components, hot_join, id_text, lean, local_components, mix, tasks_for, text_steps, written

K = 64
#: Similarity in per cent from which documents link, and least equal coordinates of such pairs; and those of the query's contract.
NEAR, NEAR_MATCHES = 80, 38
CONTRACT, MATCHES = 85, 42
WIDTH = 5
BLOCK = 256
#: Bytes of sets that a batch of documents dealt to blocks holds.
SENT_BYTES = 4 << 20
_A = mix(np.arange(1, K + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_B = mix(np.arange(101, K + 101, dtype=U64) * U64(0x9E3779B97F4A7C15))


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and where each begins (and the end)."""
    w = Words(texts, lower=True)
    n = len(w.hash)
    h = np.zeros(0, U64)
    doc = np.zeros(0, np.int64)
    if n >= width:
        h = np.zeros(n - width + 1, U64)
        for k in range(width):
            h = mix(h * U64(3) + w.hash[k : n - width + 1 + k])
        whole = w.doc[: n - width + 1] == w.doc[width - 1 :]
        h, doc = h[whole], w.doc[: n - width + 1][whole]
    few = np.flatnonzero((w.n > 0) & (w.n < width))
    if len(few):
        one = [np.bitwise_xor.reduce(mix(w.hash[w.first[d] : w.last[d]] + U64(7) * np.arange(1, w.n[d] + 1, dtype=U64))) for d in few]
        h, doc = np.concatenate([h, mix(np.array(one, U64))]), np.concatenate([doc, few])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text that has shingles, K least values, mixed: all 64 bits count, so that texts without a common shingle
    share none by chance however many there are."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, K), U64)
    if len(full):
        for k in range(K):
            out[full, k] = mix(np.minimum.reduceat(h * _A[k] + _B[k], at[full]))
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set, signature."""
    schema = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"

    @lean
    def rows(batches):
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, some in text_steps(b.column("text")):
                h, at = shingles(some)
                sums = [np.concatenate(([U64(0)], np.cumsum(x, dtype=U64))) for x in (mix(h + U64(1)), mix(h ^ U64(0x5555555555555555)))]
                d1, d2 = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
                sig = signatures(h, at)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(d1), pa.array(d2), pa.array([x.tobytes() for x in sig], pa.binary())], names=[c.split()[0] for c in schema.split(", ")])

    return docs.mapInArrow(rows, schema)


def candidates(reps: DataFrame, matches: int = MATCHES, rows: int | None = None) -> DataFrame:
    """(node, component): classes that may hold pairs of `matches` or more equal coordinates, gathered. rows: about how
    many classes there are."""

    @lean
    def exploded(batches):
        coordinate = mix(np.arange(1, K + 1, dtype=U64))
        for b in batches:
            if b.num_rows:
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), U64).reshape(-1, K)
                yield pa.RecordBatch.from_arrays([pa.array(mix(coordinate + sig).ravel().view(np.int64)), pa.array(np.repeat(b.column("cls").to_numpy(), K))], names=["term", "cls"])

    terms = reps.mapInArrow(exploded, "term long, cls long")
    shared = terms.groupBy("term").agg(F.count("*").alias("f")).where("f > 1")
    lists = terms.join(shared, "term").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("f", "term"))).alias("terms"))
    prefix = F.expr(f"slice(terms, 1, size(terms) - {matches - 1})")
    postings = written(lists.where(F.size("terms") >= matches).select("cls", F.explode(prefix).alias("t")).select("cls", F.col("t.term").alias("term")), rows=rows)
    least = postings.groupBy("term").agg(F.min("cls").alias("leader"))
    stars = postings.join(least, "term").where("cls <> leader").select("cls", "leader").distinct()
    return connected_components(stars, "cls", "leader", rows=postings.count())


def dealt(ids: np.ndarray, component: np.ndarray, blocks: np.ndarray, sig: np.ndarray, h: np.ndarray, at: np.ndarray, most: int = SENT_BYTES) -> Iterator[pa.RecordBatch]:
    """A row for each block pair in which a document is compared, as many as there are blocks. Of documents of large
    components that is many times the text: no more than `most` bytes are held, and the row that goes beyond."""
    names, kinds = ["doc_id", "component", "i", "j", "own", "sig", "set"], [pa.int64()] * 5 + [pa.binary()] * 2
    mine = (mix(ids.astype(U64)) % blocks.astype(U64)).astype(np.int64)
    rows: list[tuple] = []
    held = 0
    for d in range(len(ids)):
        head, tail = (ids[d], component[d]), (mine[d], sig[d].astype(np.uint32).tobytes(), h[at[d] : at[d + 1]].tobytes())
        for o in range(blocks[d]):
            rows.append((*head, min(mine[d], o), max(mine[d], o), *tail))
            held += len(tail[1]) + len(tail[2])
            if held >= most:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def compare(sig_a, n_a, set_a, sig_b, n_b, set_b, same: bool, num: int, matches: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row of a, row of b): collisions counted coordinate by coordinate, then confirmed on full sets."""
    hits = np.zeros((len(n_a), len(n_b)), np.uint8)
    for k in range(K):
        hits += sig_a[:, k, None] == sig_b[None, :, k]
    low, high = np.minimum(n_a[:, None], n_b[None]), np.maximum(n_a[:, None], n_b[None])
    near = (hits >= matches) & (100 * low >= num * high)
    if same:
        near &= np.arange(len(n_a))[:, None] < np.arange(len(n_b))[None]
    a, b = np.nonzero(near)
    if not len(a):
        return a, b
    ra, ia = np.unique(a, return_inverse=True)
    rb, ib = np.unique(b, return_inverse=True)
    total = sum(len(set_a[i]) for i in ra) + sum(len(set_b[i]) for i in rb)
    if len(a) * 400 > total:
        u, inv = np.unique(np.concatenate([*(set_a[i] for i in ra), *(set_b[i] for i in rb)]), return_inverse=True)
        row = np.repeat(np.arange(len(ra) + len(rb)), [*(len(set_a[i]) for i in ra), *(len(set_b[i]) for i in rb)])
        order = np.argsort(inv, kind="stable")
        inv, row = inv[order], row[order]
        common = np.zeros((len(ra), len(rb)))
        for lo in range(0, len(u), 8192):
            p, q = np.searchsorted(inv, (lo, lo + 8192))
            part = np.zeros((len(ra) + len(rb), 8192), np.float32)
            part[row[p:q], inv[p:q] - lo] = 1
            common += part[: len(ra)] @ part[len(ra) :].T
        common = common[ia, ib].round().astype(np.int64)
    else:
        common = np.array([len(np.intersect1d(set_a[i], set_b[j], assume_unique=True)) for i, j in zip(a, b)])
    ok = 100 * common >= num * (n_a[a] + n_b[b] - common)
    return a[ok], b[ok]


def groups(docs: DataFrame, per_cent: int = NEAR, matches: int = NEAR_MATCHES, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for each doc_id."""
    docs = id_text(docs)
    seen = written(described(docs))
    docs_seen = seen.count()
    seen = seen.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "d1", "d2", "sig")).alias("s")).select("doc_id", "s.*")
    seen = written(seen, rows=docs_seen)
    n = seen.count()
    full = seen.where("doc_id is not null and n_shingles > 0")
    classes = written(full.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("cls"), F.count("*").alias("copies")), rows=n)
    reps = seen.join(classes.select(F.col("cls").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("cls"), "sig")
    gathered = candidates(reps, matches, n)
    size = gathered.groupBy("component").agg(F.count("*").alias("size"))
    members = gathered.join(size, "component").select(F.col("node").alias("doc_id"), "component", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = written(members, rows=gathered.count())

    @lean
    def sets(batches):
        for b in batches:
            for lo, hi, some in text_steps(b.column("text")):
                h, at = shingles(some)
                yield from dealt(*(np.asarray(b.column(c))[lo:hi] for c in ("doc_id", "component", "blocks")), signatures(h, at), h, at)

    def linked(t: pa.Table) -> pa.Table:
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        own, ids = t["own"].to_numpy(), t["doc_id"].to_numpy()
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint32).reshape(-1, K)  # pairs that meet here are told apart by 32 bits
        full = [np.frombuffer(x, U64) for x in t["set"].to_pylist()]
        n = np.array([len(x) for x in full])
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        p, q = compare(sig[a], n[a], [full[k] for k in a], sig[b], n[b], [full[k] for k in b], i == j, per_cent, matches)
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        label = local_components(place[a[p]], place[b[q]], len(ids))
        far = np.flatnonzero(label != np.arange(len(ids)))
        s = ids[order]
        return pa.table({"a": s[far], "b": s[label[far]]})

    whole = docs.join(members, "doc_id").mapInArrow(sets, "doc_id long, component long, i long, j long, own long, sig binary, set binary")
    links = whole.groupBy("component", "i", "j").applyInArrow(linked, "a long, b long")
    found = connected_components(links, rows=members.count()).select(F.col("node").alias("cls"), "component")
    # components of classes first, so that documents meet their class once
    known = written(classes.join(found, "cls", "left").select("n_shingles", "d1", "d2", "copies", F.coalesce("component", "cls").alias("component_id")), rows=n)
    of_class = hot_join(full.select("doc_id", "n_shingles", "d1", "d2"), known, ["n_shingles", "d1", "d2"], "copies").select("doc_id", "n_shingles", "component_id")
    alone = seen.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.lit(None)).otherwise(F.col("doc_id")).cast("long").alias("component_id"))
    return of_class.unionByName(alone).coalesce(tasks_for(n))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), CONTRACT, MATCHES)  # the query's contract
    return out.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
