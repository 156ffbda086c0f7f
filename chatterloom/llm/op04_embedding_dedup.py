"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one representative a group.

Each label has cells of its own. Centroids are fitted on at most SAMPLE vectors, the first by a hash of their ids; how
many a label gets is the number that the sample says is cheapest, up to about the square root of its vectors: more cells
mean fewer products where vectors gather, and only more copies where they don't. Every vector lives in its nearest
centroid's cell and asks in every later cell that can hold a partner of it: with home cell i and a distance of
tau = sqrt(2 - 2 threshold) at most, a partner's home j has x.(c_i - c_j) <= tau |c_i - c_j|. So no link is lost at any
threshold, and each is met once. Cells are compared by blocks of about BLOCK vectors (as many as the sample makes
expect), a few rows at a time; a block pair returns link counts and a spanning forest of its links, never the pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and vectors with a null
label or id, link with nothing. Vectors link only with those of the same label and dimension. Rows that repeat a
vec_id are one vector, the largest by (label, embedding). Equal vectors link. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, lean, local_components, written

SAMPLE = 20_000
BLOCK = 4096
#: Rows of a product that are held at a time.
STEP = 256
#: What a multiplication and a byte sent cost, in like units (about 4 G/s of the one, 100 M/s of the other).
PRODUCT, BYTE = 1.0, 40.0


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision, without overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """At most k unit centroids of unit rows. The rows' order sets the start."""
    k = min(k, len(x))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        for j in range(k):
            s = x[near == j].sum(0)
            if (n := np.linalg.norm(s)) > 1e-9:
                c[j] = s / n
    return np.unique(c, axis=0)


def cells_of(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and which later cells it must ask in."""
    s = x @ c.T
    home = s.argmax(1)
    gap = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
    ask = s[np.arange(len(x)), home][:, None] - s <= np.sqrt(2 - 2 * threshold) * gap[home] + 1e-9
    return home, ask & (np.arange(len(c)) > home[:, None])


def usable(b: pa.RecordBatch) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Row numbers and matrix by dimension, of rows that can link."""
    rows: dict[int, list[tuple[int, np.ndarray]]] = {}
    e, label, vec = b.column("embedding"), b.column("label"), b.column("vec_id")
    for i in range(b.num_rows):
        if e[i].is_valid and label[i].is_valid and vec[i].is_valid:
            v = e[i].values
            if len(v) and v.null_count == 0:
                x = v.to_numpy(zero_copy_only=False).astype(float)
                if np.isfinite(x).all() and x.any():
                    rows.setdefault(len(x), []).append((i, x))
    return {d: (np.array([i for i, _ in r]), np.array([x for _, x in r])) for d, r in rows.items()}


@dataclass(frozen=True)
class Cells:
    """A label's centroids, and blocks of vectors that live and that ask in each cell."""

    c: np.ndarray
    live: np.ndarray
    ask: np.ndarray


def blocks(n: np.ndarray, block: int) -> np.ndarray:
    return np.ceil(n / block).astype(int)


def fitted(x: np.ndarray, scale: float, threshold: float, block: int) -> Cells:
    """The cheapest cells for `scale` times as many vectors as x, unit rows of a sample."""
    n, width = len(x), x.shape[1]
    best = None
    k = 1
    while k <= max(1, min(n // 8, int(2 * np.sqrt(n * scale)))):
        c = spherical_kmeans(x, k)
        home, ask = cells_of(x, c, threshold)
        live, asks = np.bincount(home, minlength=len(c)) * scale, ask.sum(0) * scale
        own, other = np.maximum(1, blocks(live, block)), blocks(asks, block)
        copies = (live * (own + other)).sum() + (asks * own).sum()
        cost = PRODUCT * width * (live * live / 2 + live * asks).sum() + BYTE * 4 * width * copies
        if best is None or cost < best[0]:
            best = cost, Cells(c, own, other)
        k *= 2
    return best[1]


def fit(vectors: DataFrame, sample: int, threshold: float, block: int) -> dict[tuple[str, int], Cells]:
    """Cells of each label and dimension that the sample holds."""
    there = vectors.where("vec_id is not null and embedding is not null and label is not null")
    got = there.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    scale = max(1.0, there.count() / max(1, got.num_rows))
    out: dict[tuple[str, int], list[np.ndarray]] = {}
    for b in got.to_batches():
        labels = np.array(b.column("label").to_pylist(), object)
        for d, (rows, x) in usable(b).items():
            for label in sorted(set(labels[rows])):
                out.setdefault((label, d), []).append(unit_rows(x[labels[rows] == label]))
    return {k: fitted(np.concatenate(x), scale, threshold, block) for k, x in out.items()}


def link(vectors: DataFrame, threshold: float = 0.93, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id for each vec_id."""
    narrow = dict(vectors.dtypes)["embedding"] == "array<float>"  # sent as it is: half the bytes
    kind = np.float32 if narrow else np.float64
    one = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("string").alias("label"), vectors["embedding"].cast("array<float>" if narrow else "array<double>").alias("embedding"))
    one = written(one.groupBy("vec_id").agg(F.max(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding"))
    cells = fit(one, sample, threshold, block)
    schema = "label string, dim int, cell int, asks boolean, i int, j int, left boolean, vec_id long, x binary"

    @lean
    def dealt(batches):
        """A row for each block pair that a vector is compared in: cells whose vectors live there (i <= j), and vectors
        that ask (block i, left) with those that live there (block j)."""
        for b in batches:
            labels = np.array(b.column("label").to_pylist(), object)
            ids = b.column("vec_id").fill_null(0).to_numpy()
            for d, (rows, x) in usable(b).items():
                for label in sorted(set(labels[rows])):
                    mine = np.flatnonzero(labels[rows] == label)
                    part = unit_rows(x[mine])
                    known = cells.get((label, d)) or Cells(part[:1] * 0, np.ones(1, int), np.zeros(1, int))
                    salt = (ids[rows[mine]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64)
                    home, ask = cells_of(part, known.c, threshold)
                    out: list[tuple] = []  # vector, cell, asks, i, j, left
                    for k, (h, q) in enumerate(zip(home.tolist(), salt.tolist())):
                        own = q % int(known.live[h])
                        out += [(k, h, False, min(own, o), max(own, o), own <= o) for o in range(known.live[h])]
                        out += [(k, h, True, o, own, False) for o in range(known.ask[h])]
                    for k, c in zip(*(v.tolist() for v in np.nonzero(ask))):
                        own = int(salt[k]) % max(1, int(known.ask[c]))
                        # cells in which the sample had none that ask have one block of them
                        out += [(k, c, True, own, o, True) for o in range(known.live[c])]
                    if (known.ask == 0).any():
                        out += [(k, h, True, 0, int(salt[k]) % int(known.live[h]), False) for k, h in enumerate(home.tolist()) if known.ask[h] == 0 and h > 0]
                    raw = [v.astype(kind).tobytes() for v in x[mine]]
                    at, cell, asks, i, j, left = (list(c) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * len(at)), pa.array([d] * len(at), pa.int32()), pa.array(cell, pa.int32()), pa.array(asks), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(left), pa.array(ids[rows[mine[at]]]), pa.array([raw[k] for k in at], pa.binary())],
                        names=[c.split()[0] for c in schema.split(", ")],
                    )

    def compared(t: pa.Table) -> pa.Table:
        ids, left = t["vec_id"].to_numpy(), t["left"].to_numpy(zero_copy_only=False)
        x = unit_rows(np.frombuffer(b"".join(t["x"].to_pylist()), kind).reshape(len(ids), -1).astype(float))
        same = not t["asks"][0].as_py() and t["i"][0].as_py() == t["j"][0].as_py()
        a, b = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
        count, forest = np.zeros(len(ids), np.int64), []
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        for lo in range(0, len(a), STEP):
            near = x[a[lo : lo + STEP]] @ x[b].T >= threshold
            if same:
                near &= np.arange(lo, lo + len(near))[:, None] < np.arange(len(b))
            count[a[lo : lo + STEP]] += near.sum(1)
            count[b] += near.sum(0)
            p, q = np.nonzero(near)
            if len(p):
                label = local_components(place[a[lo + p]], place[b[q]], len(ids))
                far = np.flatnonzero(label != np.arange(len(ids)))
                forest.append((far, label[far]))
        label = np.arange(len(ids))
        if forest:
            label = local_components(*(np.concatenate(c) for c in zip(*forest)), len(ids))
        linked = np.flatnonzero(count)
        return pa.table({"vec_id": ids[linked], "n": count[linked], "rep": ids[order][label[place[linked]]]})

    found = written(one.mapInArrow(dealt, schema).groupBy("label", "dim", "cell", "asks", "i", "j").applyInArrow(compared, "vec_id long, n long, rep long"))
    number = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    group = connected_components(found, "vec_id", "rep").withColumnRenamed("node", "vec_id")
    out = one.select("vec_id").join(number, "vec_id", "left").join(group, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


ORACLE_SQL = None  # its links are found by SQL in n_links only; the recursion for components is too slow on whole tables
