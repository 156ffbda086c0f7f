"""Substring dedup by line hashing.

A unit is a sentence of a line: lines end at the separator, sentences at a space after one of `.!?`. Units are
normalised (A-Z lower-cased, white space between words to one space) and digested to 128 bits. Digests are grouped
globally; the earliest unit by (doc_id, place) stands, the others are repeats. Units of under LEAST words are no
evidence and have no digest; they belong to the run that they lie in. A maximal run of repeats goes, with its offsets
in the original text (in code points), if it holds RUN words or more: so a passage goes whether it is lines of its own
or lies within one, and a short phrase or heading that many texts share stays.

Units are written once, so that no text is read twice and each row of docs has a fixed number. Digests met by
over a thousandth of all repeats are a thousand rows at most: they are broadcast, the others meet in a join.
Only repeats are then sorted by document.

Defined results: null and empty texts have no units. Rows that repeat a doc_id are documents of their own, ranked by a
hash of their text, then by their place. Null doc_ids rank last. Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Words, hot_join, id_text, lean, mix, powers, text_steps, written
from .homes import text_hash

#: Least words of a unit that counts as evidence, and of a run that goes.
LEAST, RUN = 3, 25
UNITS = "row long, doc_id long, text long, seq int, first int, last int, before int, after int, d1 long, d2 long"
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?"]] = True


def units_of(texts: list[bytes], separator: str = "\n", sentences: bool = True):
    """Of each unit that holds a word: document, start and end (bytes of the joined texts), words before it and after
    it (in its document) and digests. Also the words' scan."""
    w = Words(texts, lower=True)
    cut = np.zeros(len(w.buf), bool)
    sep = separator.encode()
    cut[w.doc_end - 1] = True
    if len(sep) == 1:
        cut |= w.buf == sep[0]
    else:  # each place where the whole separator stands, found from the left without overlaps
        joined, at = w.buf.tobytes(), 0
        while (at := joined.find(sep, at)) >= 0:
            cut[at : at + len(sep)] = True
            at += len(sep)
    if sentences:
        cut[1:] |= (w.buf[1:] == 32) & _STOPS[w.buf[:-1]]
    number = np.cumsum(cut)[w.start]
    a = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else number
    b = np.append(a[1:], len(number))
    cuts = np.flatnonzero(cut)
    k = np.searchsorted(cuts, w.start[a])
    start = np.where(k > 0, cuts[np.maximum(k - 1, 0)] + 1, 0)
    end = cuts[np.minimum(k, len(cuts) - 1)] if len(cuts) else start
    doc = w.doc[a]
    up, down = powers(len(w.hash) + 1)
    digests = []
    for salt in (U64(0x9FB21C651E98DF25), U64(0xC13FA9A902A6328F)):
        s = np.concatenate(([U64(0)], np.cumsum(mix(w.hash + salt) * up[: len(w.hash)], dtype=U64)))
        digests.append(mix((s[b] - s[a]) * down[a] + (b - a).astype(U64) * salt))
    return w, doc, start, end, a - w.first[doc], b - w.first[doc], digests


def units(docs: DataFrame, separator: str = "\n", sentences: bool = True, least: int = LEAST) -> DataFrame:
    """A row for each unit of `least` words or more: its document's row number, id and hash of text, its number among
    these, first and last code point (exclusive), words before and after it, digests. Besides, a row of seq -1 for
    each document, with its units (first) and code points (last)."""

    @lean
    def found(batches):
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            base = b.column("part")[0].as_py() << 36
            ids = b.column("doc_id")
            for lo, _, some in text_steps(b.column("text")):
                w, doc, start, end, before, after, (d1, d2) = units_of(some, separator, sentences)
                point = np.concatenate(([0], np.cumsum((w.buf & 0xC0) != 0x80)))
                zero = point[w.doc_start]
                m = len(some)
                every = np.bincount(doc, minlength=m)
                keep = after - before >= least
                doc, start, end, before, after, d1, d2 = (x[keep] for x in (doc, start, end, before, after, d1, d2))
                seq = np.arange(len(doc)) - np.searchsorted(doc, doc)
                at = np.concatenate([doc, np.arange(m)])
                none = np.zeros(m, np.int64)
                hashes = np.array([text_hash(t) for t in some], U64).view(np.int64)
                columns = (
                    (base + n + at), None, hashes[at], np.concatenate([seq, none - 1]), np.concatenate([point[start] - zero[doc], every]), np.concatenate([point[end] - zero[doc], point[w.doc_end - 1] - zero]),
                    np.concatenate([before, none]), np.concatenate([after, none]), np.concatenate([d1.view(np.int64), none]), np.concatenate([d2.view(np.int64), none]),
                )
                kinds = [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([ids.slice(lo, m).take(pa.array(at)) if c is None else pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in UNITS.split(", ")])
                n += m

    return docs.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(found, UNITS)


def repeats(all_units: DataFrame) -> DataFrame:
    """The units that equal an earlier one."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text", "row", "seq")
    first = written(all_units.groupBy("d1", "d2").agg(F.min(rank).alias("s"), F.count("*").alias("n")).where("n > 1").select("d1", "d2", F.col("s.row").alias("r0"), F.col("s.seq").alias("s0"), "n"))
    mine = all_units.select("row", "seq", "first", "last", "before", "after", "d1", "d2")
    return hot_join(mine, first, ["d1", "d2"], "n").where("row <> r0 or seq <> s0").select("row", "seq", "first", "last", "before", "after")


def removed_runs(repeated: DataFrame, run: int = RUN) -> DataFrame:
    """For each row of docs with runs of `run` words or more: units of at least LEAST words in them, and their spans."""
    island = F.col("seq") - F.row_number().over(Window.partitionBy("row").orderBy("seq"))
    runs = repeated.withColumn("island", island).groupBy("row", "island").agg(F.count("*").alias("units"), F.min("first").alias("start"), F.max("last").alias("stop"), (F.max("after") - F.min("before")).alias("words"))
    span = F.struct(F.col("start").cast("long").alias("start"), (F.col("stop") - F.col("start")).cast("long").alias("length"))
    return runs.where(F.col("words") >= run).groupBy("row").agg(F.sum("units").alias("n_removed"), F.sum(F.col("stop") - F.col("start")).alias("removed_chars"), F.array_sort(F.collect_list(span)).alias("spans"))


def dedup_lines(docs: DataFrame, separator: str = "\n", sentences: bool = True, least: int = LEAST, run: int = RUN) -> DataFrame:
    """For each row of docs: units, removed units (of `least` words or more), characters of removed runs, and their spans in order."""
    found = written(units(id_text(docs), separator, sentences, least))
    gone = removed_runs(repeats(found.where("seq >= 0")), run)
    each = found.where("seq < 0").select("row", "doc_id", F.col("first").cast("long").alias("n_units"), F.col("last").cast("long").alias("n_chars"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    none = F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")
    return each.join(gone, "row", "left").select("doc_id", "n_units", zero("n_removed").alias("n_removed"), zero("removed_chars").alias("removed_chars"), (F.col("n_chars") - zero("removed_chars")).alias("kept_chars"), F.coalesce("spans", none).alias("spans"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    at = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), ",")
    return out.select("doc_id", "n_units", "n_removed", "removed_chars", "kept_chars", at.alias("removed_at"))


ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS parts FROM documents
), pieces AS (
  SELECT doc_id, unnest(parts) AS piece, generate_subscripts(parts, 1) AS unit FROM split
), placed AS (
  SELECT doc_id, unit, piece, length(piece) AS length,
         coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         translate(trim(regexp_replace(piece, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM pieces
), counted AS (
  SELECT *, length(norm) - length(replace(norm, ' ', '')) + 1 AS words FROM placed WHERE norm <> ''
), summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY unit) AS after FROM counted
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS seq, row_number() OVER (PARTITION BY norm ORDER BY doc_id, unit) AS rank
  FROM summed WHERE words >= 3
), islands AS (
  SELECT *, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM ranked WHERE rank > 1
), runs AS (
  SELECT doc_id, island, count(*) AS units, min(start) AS start, max(start + length) - min(start) AS length
  FROM islands GROUP BY doc_id, island HAVING max(after) - min(after - words) >= 25
), gone AS (
  SELECT doc_id, sum(units)::BIGINT AS n_removed, sum(length)::BIGINT AS removed_chars, string_agg(start || '+' || length, ',' ORDER BY start) AS removed_at FROM runs GROUP BY doc_id
), units AS (
  SELECT doc_id, count(*) AS n_units FROM counted GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_chars, 0)::BIGINT AS removed_chars,
       (length(coalesce(text, '')) - coalesce(removed_chars, 0))::BIGINT AS kept_chars, coalesce(removed_at, '') AS removed_at
FROM documents d LEFT JOIN units u ON d.doc_id = u.doc_id LEFT JOIN gone g ON d.doc_id = g.doc_id
"""
