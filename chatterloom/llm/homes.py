"""Texts dealt to home buckets, and questions sent from homes to other buckets and answered in order.

A home bucket holds its texts, each once whatever its number of copies, in a fixed order; so what a home asks can be
worked out again when the answers are read, and answers need not repeat the questions. Blocks of arrays travel as
compressed binaries; a home and a bucket exchange one only where the home has a key of that bucket, so there are never
more than distinct keys. What is found of a text goes back to its rows by a join on its digest (see `digest`), in which
much copied texts are broadcast. All tables lie in the shared folder or the warehouse.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, lean, parts, shared_dir, text_steps, written

def packed(*arrays: np.ndarray | bytes) -> bytes:
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(raw), *map(len, raw)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(raw))


def unpacked(blob: bytes) -> list[memoryview]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    n = int(np.frombuffer(raw[:8], "<i8")[0])
    sizes = np.frombuffer(raw[8 : 8 + 8 * n], "<i8")
    at = 8 + 8 * n + np.concatenate(([0], np.cumsum(sizes)))
    return [raw[a:b] for a, b in zip(at, at[1:])]


def text_hash(t: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(t)


def digest(t: bytes) -> tuple[int, int]:
    """128 bits of a text as two longs; `digested` gives the same."""
    import xxhash

    one = xxhash.xxh64_intdigest(t, 42)
    two = xxhash.xxh64_intdigest(t, one)
    return tuple(x - (1 << 64) if x >> 63 else x for x in (one, two))


def digested(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as doc_id, d1, d2."""
    t = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(t).alias("d1"), F.xxhash64(t, t).alias("d2"))


class Texts:
    """The texts of a bucket, ordered by their least id (null last: none) and then by a hash; copies: rows that hold a
    text; weight: the sum of what they weigh."""

    def __init__(self, blob: bytes):
        sizes, none, least, copies, weight, joined = unpacked(blob)
        sizes, self.least, self.copies, self.weight = (np.frombuffer(x, "<i8") for x in (sizes, least, copies, weight))
        self.none = np.frombuffer(none, np.uint8)
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.texts = [bytes(joined[a:b]) for a, b in zip(at, at[1:])]


def _blob(texts: dict[bytes, tuple[int, int, int, int]]) -> bytes:
    """texts: (none, least, copies, weight) of each."""
    each = sorted(texts.items(), key=lambda x: (x[1][0], x[1][1], text_hash(x[0])))
    none, least, copies, weight = zip(*(v for _, v in each)) if each else ((),) * 4
    return packed(np.array([len(t) for t, _ in each], "<i8"), np.array(none, np.uint8), *(np.array(x, "<i8") for x in (least, copies, weight)), b"".join(t for t, _ in each))


def _met(texts: dict, t: bytes, v: tuple[int, int, int, int]) -> None:
    had = texts.get(t)
    texts[t] = v if had is None else (*min(had[:2], v[:2]), had[2] + v[2], had[3] + v[3])


def buckets_for(docs: DataFrame, each: int = 8 << 20) -> int:
    """Buckets of about `each` bytes of text: homes and buckets meet in pairs, so their number follows the data, not
    the partitions. Where there are few data, as many as partitions, but 64 at most."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(-(-size // each), min(parts(docs.sparkSession), 64))


def settle(docs: DataFrame, buckets: int, weigh: Callable[[int | None], int] = lambda _: 1) -> DataFrame:
    """A table (dst, texts) of a row for each bucket that holds texts, bucketed by dst. docs: doc_id, text. weigh: what a
    row of an id weighs."""

    @lean
    def dealt(batches):
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for lo, _, some in text_steps(b.column("text"), 4 << 20):
                by: dict[int, dict[bytes, tuple]] = {}
                for i, t in zip(ids[lo:], some):
                    _met(by.setdefault(text_hash(t) % buckets, {}), t, (int(i is None), i or 0, 1, weigh(i)))
                yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.int32()), pa.array([_blob(x) for x in by.values()], pa.binary())], names=["dst", "texts"])

    @lean
    def joined(batches):
        """Blobs of a bucket come together, in any order; they are sorted when they are merged."""
        for d, blobs in grouped((d, x) for b in batches for d, x in zip(b.column("dst").to_pylist(), b.column("texts"))):
            texts: dict[bytes, tuple] = {}
            for x in blobs:
                got = Texts(x.as_py())
                for t, *v in zip(got.texts, *(y.tolist() for y in (got.none, got.least, got.copies, got.weight))):
                    _met(texts, t, tuple(v))
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([_blob(texts)], pa.binary())], names=["dst", "texts"])

    spark = docs.sparkSession
    name = f"homes_{uuid.uuid4().hex}"
    table = docs.mapInArrow(dealt, "dst int, texts binary").repartition(min(buckets, parts(spark)), "dst").sortWithinPartitions("dst").mapInArrow(joined, "dst int, texts binary")
    # one file for each bucket's task; the table is laid out by dst, so that answers come to the texts, not they to them
    table.repartition(buckets, "dst").write.bucketBy(buckets, "dst").option("compression", "none").option("path", f"{shared_dir(spark)}/{name}").format("parquet").saveAsTable(name)
    homes = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # from the catalog; the files are in the shared folder, and the plan above has been resolved
    return homes


def asked(homes: DataFrame, ask: Callable[[int, Texts, dict[int, list]], Iterator[tuple[int, bytes]]], *answers: DataFrame) -> DataFrame:
    """(dst, src, blob): what each home asks of each bucket. ask: gets the home's number, its texts and, for each
    table of answers, what came back by bucket."""
    table = with_answers(homes, *answers)
    n = len(answers)

    @lean
    def rows(batches):
        for b in batches:
            for r in range(b.num_rows):
                src = b.column("dst")[r].as_py()
                got = [{x["src"]: x["blob"] for x in b.column(f"a{k}")[r].as_py() or []} for k in range(n)]
                out = list(ask(src, Texts(b.column("texts")[r].as_py()), *got))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int32()), pa.array([src] * len(out), pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["dst", "src", "blob"])

    return table.mapInArrow(rows, "dst int, src int, blob binary")


def with_answers(homes: DataFrame, *answers: DataFrame) -> DataFrame:
    for k, a in enumerate(answers):
        homes = homes.join(a.where("src >= 0").groupBy("dst").agg(F.collect_list(F.struct("src", "blob")).alias(f"a{k}")), "dst", "left")
    return homes


def answered(asks: DataFrame, answer: Callable[[list[tuple[int, bytes]]], Iterator[tuple[int, bytes]]], width: int) -> DataFrame:
    """(dst, src, blob), written: for each bucket, what it answers to each home that asked (src: the bucket), and
    rows of src -1 for what the bucket reports of itself."""

    @lean
    def rows(batches):
        for d, asked in grouped((d, (s, x)) for b in batches for d, s, x in zip(*(c.to_pylist() for c in b.columns[:2]), b.column("blob"))):
            out = list(answer([(s, x.as_py()) for s, x in sorted(asked, key=lambda a: a[0])]))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([d if s >= 0 else -1 for s, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], names=["dst", "src", "blob"])

    return written(asks.repartition(width, "dst").sortWithinPartitions("dst").mapInArrow(rows, "dst int, src int, blob binary"))


def grouped(rows: Iterator[tuple[int, object]]) -> Iterator[tuple[int, list]]:
    """Values of each run of equal keys: a task holds one bucket at a time, however many its partition has."""
    for key, run in groupby(rows, key=lambda r: r[0]):
        yield key, [x for _, x in run]


def bucket_slices(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of an ascending array."""
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
    for a, b in zip(at, [*at[1:], len(bucket)]):
        yield int(bucket[a]), slice(int(a), int(b))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U64(33)) % U64(buckets)).astype(np.int32)
