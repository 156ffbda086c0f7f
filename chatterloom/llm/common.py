"""Shared plumbing of the training-data operators: shared folders, tables written there, vectorised word
scanning and distributed connected components."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Text bytes that one vectorised step holds at a time.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Set here only if unset, as in tests."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        set_to = "file://" + os.path.join(tempfile.gettempdir(), "chatterloom-shared")
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


#: Rows that a task writes at least, where their number is known.
TASK_ROWS = 5000


def tasks_for(rows: int) -> int:
    """How many tasks write so many rows at most. In a local folder each file costs the executor processes (Hadoop starts
    chmod for it and its checksums), so hundreds for a few rows are dear."""
    return max(1, -(-rows // TASK_ROWS))


def written(df: DataFrame, *parts: str, rows: int | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts lineage and survives lost executors. rows: about how many, for tasks_for."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(tasks_for(rows))
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(*parts) if parts else out).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def forget(table: DataFrame) -> None:
    """Removes what `written` wrote, once all that was read from it has been written itself."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Keys that a join treats as hot at most.
HOT = 1000


def hot_join(rows: DataFrame, small: DataFrame, on: list[str], n: str) -> DataFrame:
    """rows joined with small (written; one row for each key, n: how many rows have it). Keys that over a HOT-th of all
    have are HOT at most: they are broadcast, and their rows are not shuffled; the others meet in a shuffled join."""
    bound = (small.agg(F.sum(n)).first()[0] or 0) / HOT
    hot = F.broadcast(small.where(F.col(n) > bound).drop(n))
    cold = small.where(F.col(n) <= bound).drop(n)
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(cold, on))


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as string, whatever other columns there are."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each lengthened until no column (whatever its case) bears it."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def lean(f):
    """A function over batches that, when it ends, gives the memory that it took back to the system: workers are
    used again, and a stage must not pay for what those before it held."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            _POW.clear()
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return run


def with_score(docs: DataFrame, f: Callable[[pa.Array], np.ndarray], score: str, text: str) -> DataFrame:
    """docs with a double column `score`, made of the column `text`. Columns of any name pass through."""
    names = docs.columns
    at = names.index(text)
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    schema = plain.select("*", F.lit(0.0).alias("score")).schema

    @lean
    def scored(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(f(b.column(at)), pa.float64())], names=[*b.schema.names, "score"])

    return plain.mapInArrow(scored, schema).toDF(*names, score)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def text_steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of a column of texts as `steps`, each with its UTF-8 (null is empty), a range at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    lo = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and size + n > most:
            yield lo, i, text_bytes(column.slice(lo, i - lo))
            lo, size = i, 0
        size += n + 1
    if lo < len(sizes):
        yield lo, len(sizes), text_bytes(column.slice(lo))


def steps(texts: list[bytes], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes; a longer text stands alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h ^= h >> U64(27)
    h *= U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Whether a byte is not of a letter run (ASCII letters and all of other scripts).
_LETTER_APART = np.ones(256, bool)
_LETTER_APART[[*range(65, 91), *range(97, 123), *range(128, 256), 0x27]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("up", ())) < n:
        size = (n | 0x3FFFF) + 1  # a little more, so that it is seldom built anew
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, U64)
            x[0] = 1
            _POW[name] = np.cumprod(x, dtype=U64)
    return _POW["up"], _POW["down"]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts, as arrays: document, start, end and 64-bit hash of each."""

    def __init__(self, texts: list[bytes], lower: bool = False, hashed: bool = True, apart: np.ndarray = _SPACE):
        """apart: for each byte, whether it parts words."""
        joined = b"\n".join(texts) + b"\n"
        self.buf = np.frombuffer(joined, np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.doc_end = np.cumsum(sizes)
        self.doc_start = self.doc_end - sizes
        inside = np.concatenate(([False], ~apart[self.buf], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.doc_start)
        self.last = np.searchsorted(self.start, self.doc_end)
        self.n = self.last - self.first
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        self.hash = self.spans(self.start, self.end) if hashed else None

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges."""
        up, down = powers(len(self.buf) + 1)
        if not hasattr(self, "_sum"):
            self._sum = np.concatenate(([U64(0)], np.cumsum((self.buf.astype(U64) + U64(1)) * up[: len(self.buf)], dtype=U64)))
        return mix((self._sum[end] - self._sum[start]) * down[start] + (end - start).astype(U64) * U64(0xA0761D6478BD642F))

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value of each word by document."""
        c = np.concatenate(([0], np.cumsum(values)))
        return c[self.last] - c[self.first]

    def bytes_per_doc(self, flags: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return c[self.doc_end] - c[self.doc_start]


def local_components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of n nodes reaches by the links a-b."""
    label = np.arange(n)
    while True:
        a, b = label[a], label[b]  # roots: a tree moves as a whole, by its root alone
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


#: Links that one task turns into components at once; more are contracted by rounds first.
LOCAL_LINKS = 1 << 18


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, rows: int | None = None, local: int = LOCAL_LINKS) -> DataFrame:
    """Rows (node, component): the smallest node that each node of the links can reach.

    `local` links or fewer are worked on by one task, in a few MB. More go through rounds that alternate large-star and
    small-star contraction, each a group-by and a join on the node, and that are written to the shared folder, from
    where those before are removed. A hub is met as a minimum over its links (pre-aggregated), never as a list. Null
    ends and self-links are dropped. Raises if it has not settled after `most_rounds`. rows: about how many links there are.
    """
    links = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    now = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), rows=rows)

    @lean
    def at_once(batches):
        ends = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
        if ends:
            a, b = (np.concatenate(x) for x in zip(*ends))
            nodes = np.unique(np.concatenate([a, b]))
            label = local_components(np.searchsorted(nodes, a), np.searchsorted(nodes, b), len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])

    for _ in range(most_rounds):
        n = now.count()
        if n <= local:
            out = written(now.coalesce(1).mapInArrow(at_once, "node long, component long"))
            forget(now)
            return out
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = written(large.distinct(), rows=n)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        small = written(small.distinct(), rows=n)
        forget(large)
        forget(now)
        check = small.groupBy("a").count().where("count > 1").isEmpty()
        roots_only = small.select(F.col("b").alias("a")).distinct().join(small.select("a").distinct(), "a", "left_semi").isEmpty()
        now = small
        if check and roots_only:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
