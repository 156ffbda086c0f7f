"""Counts of n-grams by scope, and of terms in texts, as numbers within tasks: rows are made of what is counted, not of
each place where it stands."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import tokens

#: Text bytes whose uses are added up before they are given on.
STEP_BYTES = 1 << 23
#: Tokens that are counted at a time; a message is never cut.
SLICE = 1 << 19
#: Buckets of hashes that bound how often an n-gram stands, in blocks that travel as rows.
BITS, BLOCK = 20, 1 << 15
#: Counts below this, in a slice or as a bound, are not worth a row.
FEW = 4


_TOKEN, _TOLD = re.compile(r"[一-鿿]|[A-Za-z0-9]+(?:\.[0-9]+)?%?").findall, re.compile("[A-Za-z一-鿿]").search


def tokenized(column: pa.Array) -> tuple[np.ndarray, list[str | None], np.ndarray]:
    """Numbers of tokens, the tokens of these numbers, and how many each row has. Texts are cut as `text.tokens` does, each
    different token looked at once; lists of tokens are taken as they are."""
    if pa.types.is_list(column.type):
        coded = column.flatten().dictionary_encode(null_encoding="encode")
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), column.value_lengths().to_numpy()
    found = [_TOKEN(x.decode("utf-8", "replace")) for x in column.to_pylist()]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    coded = pa.array([x for xs in found for x in xs], pa.string()).dictionary_encode()
    number: dict[str, int] = {}
    known = np.array([number.setdefault(x.lower(), len(number)) if _TOLD(x) else -1 for x in coded.dictionary.to_pylist()], np.int64)
    ids = known[coded.indices.to_numpy()]
    kept = ids >= 0
    return ids[kept], list(number), np.bincount(np.repeat(np.arange(len(found)), sizes)[kept], minlength=len(found))


class Slice:
    """The n-grams of some messages in the order of seq. key: exact within the slice, for a scope and an n-gram."""

    def __init__(self, b: pa.RecordBatch, scope: list[str], n: int):
        self.rows = b.take(pc.sort_indices(b.column("seq")))  # nulls are last
        self.ids, self.words, lengths = tokenized(self.rows.column("t"))
        self.row = np.repeat(np.arange(len(b)), lengths)
        self.n, ends = n, max(0, len(self.row) - n + 1)
        self.at = np.flatnonzero(self.row[n - 1 :][:ends] == self.row[:ends])
        codes = np.zeros(len(b), np.int64)
        for c in scope:
            one = self.rows.column(c).dictionary_encode(null_encoding="encode")
            codes = np.unique(codes * len(one.dictionary) + one.indices.to_numpy(), return_inverse=True)[1]
        self.scope = codes
        self.starts = np.concatenate([[0], np.cumsum(lengths)])

    def buckets(self) -> np.ndarray:
        told = np.array([zlib.crc32((w or "").encode()) for w in self.words], np.uint64)
        h = self.rows.column("h").to_numpy().astype(np.uint64)[self.row[self.at]]
        for k in range(self.n):
            h = (h ^ told[self.ids[self.at + k]]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64)

    def counted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the n-grams that begin at `at` (ascending), each one's first place and count."""
        if not len(at):
            return at, at
        key = self.scope[self.row[at]]
        most = int(self.scope.max()) + 1
        for k in range(self.n):
            if most > (1 << 62) // len(self.words):
                found, key = np.unique(key, return_inverse=True)
                most = len(found)
            key, most = key * len(self.words) + self.ids[at + k], most * len(self.words)
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        return at[first], count

    def terms(self, at: np.ndarray) -> list[str | None]:
        """As text.ngrams joins tokens."""
        w, out = self.words, []
        if self.n == 1:
            return [w[i] for i in self.ids[at].tolist()]
        for p in self.ids[at[:, None] + np.arange(self.n)].tolist():
            parts = [w[i] for i in p]
            out.append(("" if None not in parts and all(x >= "一" for x in parts) else " ").join(x for x in parts if x is not None))
        return out


def slices(batches: Iterator[pa.RecordBatch], scope: list[str], n: int) -> Iterator[Slice]:
    for b in batches:
        c, i = b.column("t"), 0
        sizes, most = (c.value_lengths(), SLICE) if pa.types.is_list(c.type) else (pc.binary_length(c), 6 * SLICE)
        ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(), dtype=np.int64)])
        while i < len(b):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
            yield Slice(b.slice(i, j - i), scope, n)
            i = j


def batch(columns: dict[str, pa.Array | list | np.ndarray], **types: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, types.get(c)) for c, x in columns.items()], names=list(columns))


def bounds(words: DataFrame, scope: list[str], n: int, top: int) -> tuple[np.ndarray, DataFrame]:
    """How often all n-grams of a bucket stand, and for each scope (if any is worth it) a count `least` that `top` of its
    n-grams reach, by the exact counts of slices."""
    spark, kinds = words.sparkSession, [words.schema[c] for c in scope]

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, none = np.zeros(1 << BITS, np.int64), None
        for s in slices(batches, scope, n):
            none = [s.rows.column(c).type for c in scope]
            at = s.buckets()
            own = np.bincount(at, minlength=1 << BITS)
            total += own
            first, count = s.counted(s.at[own[at] >= FEW])  # rarer ones bound nothing
            order = np.lexsort((-count, s.scope[s.row[first]]))
            of = s.scope[s.row[first[order]]]
            kept = order[np.arange(len(of)) - np.searchsorted(of, of) < 4 * top]
            rows = pa.array(s.row[first[kept]])
            yield batch({c: s.rows.column(c).take(rows) for c in scope} | {"term": s.terms(first[kept]), "n": count[kept], "block": [None] * len(kept), "data": [None] * len(kept)}, term=pa.string(), n=pa.int64(), block=pa.int32(), data=pa.binary())
        if none is None:  # a task without messages
            return
        held = [k for k in range((1 << BITS) // BLOCK) if total[k * BLOCK : (k + 1) * BLOCK].any()]
        yield batch({c: pa.nulls(len(held), t) for c, t in zip(scope, none)} | {"term": [None] * len(held), "n": [None] * len(held), "block": held, "data": [zlib.compress(total[k * BLOCK : (k + 1) * BLOCK].tobytes(), 1) for k in held]}, term=pa.string(), n=pa.int64(), block=pa.int32(), data=pa.binary()) if held else batch({c: pa.nulls(0, t) for c, t in zip(scope, none)} | {"term": [], "n": [], "block": [], "data": []}, term=pa.string(), n=pa.int64(), block=pa.int32(), data=pa.binary())

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("data").to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(x), np.int64)
        yield batch({"block": list(total), "data": [x.tobytes() for x in total.values()]}, block=pa.int32(), data=pa.binary())

    own = [StructField("term", StringType()), StructField("n", LongType()), StructField("block", IntegerType()), StructField("data", BinaryType())]
    found = words.mapInArrow(bounded, StructType([*kinds, *own])).persist(StorageLevel.DISK_ONLY)
    try:
        blocks = (1 << BITS) // BLOCK
        got = found.where("block is not null").select("block", "data").repartition(blocks, "block").mapInArrow(added, "block int, data binary").toArrow()
        total = np.zeros(1 << BITS, np.int64)
        for k, x in zip(got["block"].to_pylist(), got["data"].to_pylist()):
            total[k * BLOCK : (k + 1) * BLOCK] = np.frombuffer(x, np.int64)
        sums = found.where("block is null").groupBy(*scope, "term").agg(F.sum("n").alias("n"))
        ranked = sums.withColumn("r", F.row_number().over(Window.partitionBy(*scope).orderBy(F.desc("n")))).where(F.col("r") <= top)
        least = ranked.groupBy(*scope).agg(F.min("n").alias("least"), F.count("*").alias("k")).where((F.col("k") == top) & (F.col("least") >= FEW)).select(*scope, "least")
        return total, spark.createDataFrame(least.toArrow(), least.schema)
    finally:
        found.unpersist()


def parts_of(text: Column, cut: Callable[[Column], Column]) -> Column:
    """The column t of `counts`: the library's own tokens are cut where they are counted."""
    return text.cast("binary") if cut is tokens else cut(text)


def counts(m: DataFrame, scope: list[str], n: int, top: int) -> DataFrame:
    """scope, term, count, seq, pos: counts of n-grams of messages (scope, seq, t: tokens, or a text as binary that is cut
    as `text.tokens` does), a row for each part of the messages, with the first place there. For n over 1 only n-grams are counted that can be among the scope's `top`
    most frequent ones: others fall into buckets that, all together, stand less often than `top` n-grams do."""
    words = m.select(*scope, F.col("seq").cast("decimal(20,0)").alias("seq"), (F.xxhash64(*scope) if scope else F.lit(0).cast("long")).alias("h"), "t").where("t is not null")
    total = None
    if n > 1:
        total, least = bounds(words, scope, n, top)
        words = words.join(F.broadcast(least), scope, "left") if scope else words.join(F.broadcast(least), how="left")
        total = m.sparkSession.sparkContext.broadcast(total)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, scope, n):
            at = s.at
            if total is not None:
                at = at[total.value[s.buckets()] >= s.rows.column("least").fill_null(0).to_numpy()[s.row[at]]]
            first, count = s.counted(at)
            rows = pa.array(s.row[first])
            yield batch({c: s.rows.column(c).take(rows) for c in scope} | {"term": s.terms(first), "count": count, "seq": s.rows.column("seq").take(rows), "pos": first - s.starts[s.row[first]]}, term=pa.string(), count=pa.int64(), pos=pa.int64())

    own = [StructField("term", StringType()), StructField("count", LongType()), words.schema["seq"], StructField("pos", LongType())]
    return words.mapInArrow(counted, StructType([*(words.schema[c] for c in scope), *own]))


def totalled(parts: DataFrame, scope: list[str]) -> DataFrame:
    """scope, term, count, seen: sums of `counts`. The first place of a term is one number, so that the aggregate is by
    hash; decimals hold any seq and pos."""
    place = F.col("seq") * F.lit(10**10).cast("decimal(11,0)") + F.col("pos")
    return parts.groupBy(*scope, "term").agg(F.sum("count").alias("count"), F.min(place).alias("seen"))


#: Bytes of a term by which places in a text are sought, most first, and how many such signs tasks hold.
SIGN_BYTES, MOST_SIGNS = (8, 4, 2, 1), 20_000


def uses(texts: DataFrame, terms: DataFrame, by: str) -> DataFrame:
    """by, term, count: how often the texts (by, text) of each group hold its terms (by, term; not empty), from the left and
    without overlaps. A text is read once, whatever the number of terms: where it has a term's first bytes, it gives what
    stands there in the lengths of terms that begin so, and this meets the terms by equality, counted."""
    for size in SIGN_BYTES:
        sign = F.substring(F.col("term").cast("binary"), 1, size)
        got = terms.groupBy(sign.alias("sign")).agg(F.collect_set(F.octet_length("term")).alias("lengths")).limit(MOST_SIGNS + 1).toArrow()
        if len(got) <= MOST_SIGNS:  # as those of one byte always are
            break
    lengths = dict(zip(got["sign"].to_pylist(), got["lengths"].to_pylist()))
    if not lengths:
        return terms.select(by, "term", F.lit(0).cast("long").alias("count"))
    sizes = sorted({len(x) for x in lengths})
    second: dict[bytes, set[bytes]] = {}
    for x in lengths:
        second.setdefault(x[:1], set()).add(x[1:2])
    one = lambda x: b"\\x%02x" % x[0]
    pattern = b"|".join(one(a) + (b"" if b"" in xs else b"[" + b"".join(map(one, sorted(xs))) + b"]") for a, xs in sorted(second.items()))
    schema = StructType([texts.schema[by], StructField("term", BinaryType()), StructField("count", LongType())])

    def found(text: bytes, search) -> Counter:
        out, free, at = Counter(), {}, 0
        while m := search(text, at):
            at = m.start()
            for size in sizes:
                for length in lengths.get(text[at : at + size], ()) if at + size <= len(text) else ():
                    if at + length <= len(text) and at >= free.get(term := text[at : at + length], 0):
                        out[term] += 1
                        free[term] = at + length
            at += 1
        return out

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = re.compile(pattern, re.DOTALL).search
        for b in batches:
            codes = b.column(by).dictionary_encode(null_encoding="encode")
            sums: dict[int, Counter] = {}
            held = 0
            for k, text in zip(codes.indices.to_pylist(), b.column("text").to_pylist()):
                sums.setdefault(k, Counter()).update(found(text, search))
                held += len(text)
                if held > STEP_BYTES:
                    yield told(codes.dictionary, sums)
                    sums, held = {}, 0
            yield told(codes.dictionary, sums)

    def told(groups: pa.Array, sums: dict[int, Counter]) -> pa.RecordBatch:
        rows = [k for k, c in sums.items() for _ in c]
        return batch({by: groups.take(pa.array(rows, pa.int32())), "term": [t for c in sums.values() for t in c], "count": [n for c in sums.values() for n in c.values()]}, term=pa.binary(), count=pa.int64())

    got = texts.select(by, F.col("text").cast("binary").alias("text")).mapInArrow(counted, schema).groupBy(by, "term").agg(F.sum("count").alias("count"))
    return terms.join(got.withColumn("term", F.col("term").cast("string")), [by, "term"])
