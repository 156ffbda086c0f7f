"""Suffix-array dedup of repeated byte strings by column-wise multi-document construction.

A byte goes where a WIDTH-byte string covers it that also starts earlier: in a text of smaller id, or before in the
same. The suffixes of the whole collection that agree in WIDTH bytes are found in parts that cannot share a match:

1. Each WIDTH-byte string has an anchor, its least k-byte hash (the first of equals), so equal strings have equal
   anchors at equal distance. Anchors are counted over the collection; one that occurs once ends there.
2. Around each other anchor a segment holds the strings that it anchors. Equal segments are one (the earliest stands;
   in the others all strings go): first within a home of texts, then in the bucket of the anchor.
3. Of the different segments of an anchor, those that agree with another in enough bytes around it to hold an equal
   string are the documents of a collection whose Burrows-Wheeler transform is built column by column: each round
   inserts the next symbol (from the end) of every segment by the last-to-first mapping, and updates the common
   prefixes of neighbouring suffixes. Neighbours with a common prefix of WIDTH or more hold equal strings; of each
   such run the earliest place stays.
4. Homes read which strings go, and cut the bytes they cover. A text is worked on once, however many rows hold it; its
   rows take the result by its digest.

A round over all texts at once would need as many rounds as the longest text has bytes, each over all of the data;
segments bound both. Questions and answers travel through tables in the shared folder (see homes).

Defined results: null and empty texts have no bytes. Different texts of one doc_id (or without one) rank by a 64-bit
hash of the text, however rows are dealt; equal texts of equal or different id rank by id, and only the first stays.
Null doc_ids rank last. Very long texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, hot_join, id_text, lean, mix, steps, written
from .homes import Texts, answered, asked, bucket_of, bucket_slices, buckets_for, digest, digested, packed, settle, text_hash, unpacked, with_answers

WIDTH = 100
#: Segments that one transform holds at most (but for the segments of one anchor).
CHUNK = 512
#: Text bytes whose anchors are found at a time: their hashes stay in a core's cache.
STEP = 1 << 17
_C = U64(0xD6E8FEB86659FD93)


def gram_length(width: int) -> int:
    """A power of two, about a third of the string."""
    return 1 << max(0, (max(width, 3) // 3).bit_length() - 1)


def slide(f, a: np.ndarray, width: int) -> np.ndarray:
    """f over each run of `width` values, by doubling."""
    m = 1
    while m * 2 <= width:
        a = f(a[:-m], a[m:])
        m *= 2
    return f(a[: len(a) - (width - m)], a[width - m :]) if width > m else a


class Segments:
    """The anchored segments of some texts: text, first string's start, strings, anchor's place in the segment."""

    def __init__(self, texts: list[bytes], width: int = WIDTH):
        k = gram_length(width)
        span = width - k + 1
        text, start, count, left, anchor = [], [], [], [], []
        for lo, hi in steps(texts, STEP):
            sizes = np.array([len(t) for t in texts[lo:hi]])
            if not (sizes >= width).any():
                continue
            buf = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
            end = np.cumsum(sizes)
            h = mix(buf.astype(U64) + U64(1))
            m, c = 1, _C
            while m < k:
                h = h[:-m] * c + h[m:]
                m *= 2
                c = U64(int(c) * int(c) & 0xFFFFFFFFFFFFFFFF)
            h = mix(h)
            low = slide(np.minimum, h, span)  # of the string that starts there
            owner = np.repeat(np.arange(hi - lo), sizes)[: len(low)]
            valid = np.arange(len(low)) + width <= end[owner]
            none = np.zeros(span - 1, U64)
            is_anchor = slide(np.maximum, np.concatenate([none, np.where(valid, low, U64(0)), none]), span) == h
            places = np.flatnonzero(is_anchor)
            starts = np.flatnonzero(valid)
            at = (np.cumsum(is_anchor) - is_anchor)[starts]  # the first anchor from there on
            want = low[starts]
            wrong = np.flatnonzero(h[places[at]] != want)
            while len(wrong):
                at[wrong] += 1
                wrong = wrong[h[places[at[wrong]]] != want[wrong]]
            new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
            first = starts[new]
            own = owner[first]
            text.append(own + lo)
            start.append(first - (end - sizes)[own])
            count.append(np.diff(np.append(new, len(at))))
            left.append(places[at[new]] - first)
            anchor.append(want[new])
        empty = np.zeros(0, np.int64)
        self.text, self.start, self.count, self.left = (np.concatenate(x) if x else empty for x in (text, start, count, left))
        self.anchor = np.concatenate(anchor) if anchor else np.zeros(0, U64)


class Home:
    """What a bucket's texts ask: anchors first, then the segments of those anchors that occur again."""

    def __init__(self, t: Texts, width: int):
        self.t, self.width = t, width
        self.s = Segments(t.texts, width)
        self.anchors, self.of = np.unique(self.s.anchor, return_inverse=True)
        self.times = np.bincount(self.of, minlength=len(self.anchors))

    def by_anchor(self, buckets: int):
        b = bucket_of(mix(self.anchors), buckets)
        order = np.argsort(b, kind="stable")
        return order, b[order]

    def ask_anchors(self, buckets: int):
        order, b = self.by_anchor(buckets)
        for k, s in bucket_slices(b):
            h = np.ascontiguousarray(self.anchors[order[s]]).view(np.uint8).reshape(-1, 8)[:, :6]
            yield k, packed(h)

    def read_anchors(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        """The segments whose anchors occur again, anywhere."""
        again = self.times > 1
        order, b = self.by_anchor(buckets)
        for k, s in bucket_slices(b):
            n = s.stop - s.start
            again[order[s]] |= np.unpackbits(np.frombuffer(unpacked(got[k])[0], np.uint8), count=n).astype(bool)
        return np.flatnonzero(again[self.of])

    def distinct(self, some: np.ndarray, buckets: int):
        """Of some segments: the earliest of each that is equal within this home, in the order in which they are
        asked, their digests and buckets; and the others, all of whose strings go."""
        s, seen = self.s, {}
        digest = np.zeros((len(some), 2), U64)
        import xxhash

        for r, i in enumerate(some.tolist()):
            a = int(s.start[i])
            x = xxhash.xxh3_128_intdigest(self.t.texts[s.text[i]][a : a + int(s.count[i]) + self.width - 1])
            digest[r] = x & 0xFFFFFFFFFFFFFFFF, x >> 64
        key = mix(digest[:, 0] + mix(digest[:, 1]) + s.anchor[some] * U64(3))
        _, first = np.unique(key, return_index=True)  # segments come by text and start, so the first is the earliest
        copies = np.ones(len(some), bool)
        copies[first] = False
        where = bucket_of(mix(s.anchor[some[first]] + U64(9)), buckets)
        order = np.lexsort((s.anchor[some[first]], where))
        first, where = first[order], where[order]
        return some[first], digest[first], where, some[copies]

    def ask_segments(self, some: np.ndarray, src: int, buckets: int):
        s, t = self.s, self.t
        rep, digest, where, _ = self.distinct(some, buckets)
        hashes = np.array([text_hash(x) for x in t.texts], U64)
        for k, sl in bucket_slices(where):
            r = rep[sl]
            size = s.count[r] + self.width - 1
            joined = b"".join([t.texts[d][a : a + n] for d, a, n in zip(s.text[r].tolist(), s.start[r].tolist(), size.tolist())])
            of = s.text[r]
            yield k, packed(s.anchor[r], digest[sl], t.least[of].astype("<i8"), t.none[of], hashes[of], s.start[r].astype("<i8"), s.left[r].astype("<i4"), size.astype("<i4"), joined)


def answer_anchors(asks: list[tuple[int, bytes]]):
    got = [np.frombuffer(unpacked(b)[0], np.uint8).reshape(-1, 6) for _, b in asks]
    all_ = np.zeros((sum(map(len, got)), 8), np.uint8)
    all_[:, :6] = np.concatenate(got)
    h = all_.view(U64).ravel()
    _, inv, times = np.unique(h, return_inverse=True, return_counts=True)  # each home asks once for an anchor
    again = times[inv] > 1
    at = np.cumsum([0, *map(len, got)])
    for k, (src, _) in enumerate(asks):
        yield src, packed(np.packbits(again[at[k] : at[k + 1]]))


def least_between(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(a[lo:hi]) for each of some ranges, none empty, all ending before the last of a."""
    out = np.empty(len(lo), a.dtype)
    if len(lo):
        order = np.argsort(lo)  # so that what lies between two ranges, which is read too, is no more than a
        out[order] = np.minimum.reduceat(a, np.column_stack((lo[order], hi[order])).ravel())[::2]
    return out


def sorted_suffixes(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, offset and run of each suffix of at least `least` bytes, in the order of the suffixes of the collection
    (equal ones by string); those of a run agree in `least` bytes.

    Builds the collection's transform and its common prefixes by columns: in each round every string not yet used up
    inserts its next symbol from the end. A new suffix's neighbours among those of its first symbol are the rows whose
    symbol it is, next before and after; its common prefix with either is one more than the least between their rows."""
    n = len(strings)
    sizes = np.array([len(x) for x in strings])
    width = int(sizes.max())
    text = np.zeros((n, width + 1), np.uint8)  # from the end; symbols are bytes + 1 but 255, which bytes of UTF-8 are not
    for i, x in enumerate(strings):
        text[i, : len(x)] = np.frombuffer(x, np.uint8)[::-1] + 1
    bwt = text[:, 0].copy()  # rows of the empty suffixes
    common = np.zeros(n + 1, np.uint8 if least < 255 else np.int32)  # of each row with the one before, up to `least`; and one more
    live, at = np.arange(n), np.arange(n)  # strings by the rows of their longest suffixes so far, and these rows

    for j in range(1, width + 1):
        order = np.argsort(bwt, kind="stable")  # the last-to-first mapping goes from order[k] to k + shift
        shift = n - len(bwt) + np.count_nonzero(bwt)
        more = sizes[live] >= j
        live, at = live[more], at[more]
        asked = np.zeros(len(bwt), bool)
        asked[at] = True
        rank = np.flatnonzero(asked[order])
        rows = order[rank]
        live, at = live[np.searchsorted(at, rows)], rows
        symbol = bwt[at]
        before, after = order[np.maximum(rank - 1, 0)], order[np.minimum(rank + 1, len(order) - 1)]
        has = (rank > 0) & (bwt[before] == symbol)
        has_next = (rank < len(order) - 1) & (bwt[after] == symbol)
        low = least_between(common, before[has] + 1, at[has] + 1)
        high = least_between(common, at[has_next] + 1, after[has_next] + 1)
        at = rank + shift
        new, prefix = np.empty(len(bwt) + len(at), bwt.dtype), np.empty(len(common) + len(at), common.dtype)
        old = np.ones(len(prefix), bool)
        old[at] = False
        new[old[:-1]], prefix[old] = bwt, common
        new[at], prefix[at] = text[live, j], 0
        prefix[at[has_next] + 1] = np.minimum(high + 1, least)
        prefix[at[has]] = np.minimum(low + 1, least)
        bwt, common = new, prefix
    order = np.argsort(bwt, kind="stable")
    shift = n - len(bwt) + np.count_nonzero(bwt)
    to = np.empty(len(bwt), np.int64)
    to[order] = np.arange(len(bwt)) + shift
    where = np.full(len(bwt), -1)
    at, of = np.arange(n), np.arange(n)
    offset = np.zeros(len(bwt), np.int32)
    for j in range(1, width + 1):
        keep = sizes[of] >= j
        at, of = at[keep], of[keep]
        at = to[at]
        if j >= least:
            where[at] = of
            offset[at] = sizes[of] - j
    rows = np.flatnonzero(where >= 0)
    return where[rows], offset[rows], np.cumsum(common[:-1] < least)[rows]


def repeated(strings: list[bytes], doc: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """String and offset of each `width`-byte string that an earlier one (by doc, then place) equals."""
    s, o, run = sorted_suffixes(strings, width)
    order = np.lexsort((start[s] + o, doc[s], run))
    first = np.concatenate(([True], run[order][1:] != run[order][:-1]))
    late = order[~first]
    return s[late], o[late]


#: Ranges of the anchor's place in a string by which segments are told apart before they are sorted.
CELLS = 4


def may_share(group: list[tuple[bytes, int]], width: int) -> list[int]:
    """Which segments (bytes, anchor's place) of an anchor may hold a string that another of them holds: in equal strings
    the anchor stands at the same place, so segments with one agree in the bytes that all strings have which hold the
    anchor in the same range of places."""
    places = width - gram_length(width) + 1
    step = -(-places // CELLS)
    found: dict[tuple[int, bytes], list[int]] = {}
    for i, (x, left) in enumerate(group):
        for lo in range(0, places, step):
            a, b = left - lo, left - min(lo + step, places) + 1 + width
            if a >= 0 and b <= len(x):
                found.setdefault((lo, x[a:b]), []).append(i)
    return sorted({i for some in found.values() if len(some) > 1 for i in some})


def answer_segments(asks: list[tuple[int, bytes]], width: int):
    anchor, digest, ids, none, text, start, left, size, strings = [], [], [], [], [], [], [], [], []
    for _, b in asks:
        a, d, i, o, t, p, f, z, joined = unpacked(b)
        anchor.append(np.frombuffer(a, U64)), digest.append(np.frombuffer(d, U64).reshape(-1, 2)), ids.append(np.frombuffer(i, "<i8"))
        none.append(np.frombuffer(o, np.uint8)), text.append(np.frombuffer(t, U64)), start.append(np.frombuffer(p, "<i8"))
        left.append(np.frombuffer(f, "<i4"))
        z = np.frombuffer(z, "<i4").astype(np.int64)
        size.append(z)
        end = np.cumsum(z)
        strings.append((joined, end - z))
    counts = [len(x) for x in anchor]
    base = np.cumsum([0, *counts])
    anchor, digest, ids, none, text, start, left, size = (np.concatenate(x) for x in (anchor, digest, ids, none, text, start, left, size))
    # texts in order: by least id (null last), of equal ids by the text's hash, wherever they lie; homes hold different texts
    rank = np.lexsort((start, text, ids, none))
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    doc_new = np.concatenate(([True], (none[rank][1:] != none[rank][:-1]) | (ids[rank][1:] != ids[rank][:-1]) | (text[rank][1:] != text[rank][:-1])))
    doc = np.empty(len(rank), np.int64)
    doc[rank] = np.cumsum(doc_new)
    order = np.lexsort((place, digest[:, 1], digest[:, 0], anchor))
    a, d0, d1 = anchor[order], digest[order, 0], digest[order, 1]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (d0[1:] != d0[:-1]) | (d1[1:] != d1[:-1])))
    whole = np.zeros(len(order), bool)
    whole[order[~new]] = True  # an earlier equal segment
    rep = order[new]
    ra = anchor[rep]
    at = np.flatnonzero(np.concatenate(([True], ra[1:] != ra[:-1])))
    groups = [rep[x:y] for x, y in zip(at, [*at[1:], len(rep)]) if y - x > 1]
    home_of = np.searchsorted(base, np.arange(len(anchor)), side="right") - 1

    def bytes_of(i: int) -> bytes:
        joined, begin = strings[home_of[i]]
        b = int(begin[i - base[home_of[i]]])
        return bytes(joined[b : b + int(size[i])])

    found_s, found_o = [], []

    def solve(part: list[np.ndarray]) -> None:
        r = np.concatenate(part)
        s, o = repeated([bytes_of(i) for i in r.tolist()], doc[r], start[r], width)
        found_s.append(r[s])
        found_o.append(o)

    part: list[np.ndarray] = []
    held = 0
    for g in groups:
        g = g[may_share([(bytes_of(i), int(left[i])) for i in g.tolist()], width)]
        if not len(g):
            continue
        if part and held + len(g) > CHUNK:
            solve(part)
            part, held = [], 0
        part.append(g)
        held += len(g)
    if part:
        solve(part)
    s = np.concatenate(found_s) if found_s else np.zeros(0, np.int64)
    o = np.concatenate(found_o).astype(np.int64) if found_o else np.zeros(0, np.int64)
    by = np.argsort(s, kind="stable")
    s, o = s[by], o[by]
    for k, (home, _) in enumerate(asks):
        mine = slice(*np.searchsorted(s, (base[k], base[k + 1])))
        yield home, packed(np.packbits(whole[base[k] : base[k + 1]]), (s[mine] - base[k]).astype("<i4"), o[mine].astype("<i4"))


def removed(h: Home, some: np.ndarray, got: dict[int, bytes], buckets: int) -> list[np.ndarray]:
    """For each text, which of its bytes go (of a text's first copy)."""
    s, width = h.s, h.width
    rep, _, where, copies = h.distinct(some, buckets)
    runs = [(s.text[copies], s.start[copies], s.count[copies])]
    for k, sl in bucket_slices(where):
        whole, seg, off = unpacked(got[k])
        r = rep[sl]
        w = r[np.unpackbits(np.frombuffer(whole, np.uint8), count=len(r)).astype(bool)]
        runs.append((s.text[w], s.start[w], s.count[w]))
        seg = r[np.frombuffer(seg, "<i4")]
        runs.append((s.text[seg], s.start[seg] + np.frombuffer(off, "<i4"), np.ones(len(seg), np.int64)))
    text, start, count = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(text, kind="stable")
    text, start, count = text[order], start[order], count[order]
    at = np.searchsorted(text, np.arange(len(h.t.texts) + 1))
    out = []
    for d, x in enumerate(h.t.texts):
        a, n = start[at[d] : at[d + 1]], count[at[d] : at[d + 1]]
        c = np.zeros(len(x) + 1, np.int64)
        np.add.at(c, a, 1)
        np.subtract.at(c, a + n + width - 1, 1)
        out.append(np.cumsum(c)[:-1] > 0)
    return out


def dedup(docs: DataFrame, emit, schema: str, width: int = WIDTH) -> DataFrame:
    """doc_id and what `emit(text, mask of removed bytes)` makes of each row of docs, as schema says."""
    docs = id_text(docs)
    buckets = buckets_for(docs)
    homes = settle(docs, buckets)
    one = answered(asked(homes, lambda src, t: Home(t, width).ask_anchors(buckets)), answer_anchors, buckets)

    def ask_segments(src, t, anchors):
        h = Home(t, width)
        return h.ask_segments(h.read_anchors(anchors, buckets), src, buckets)

    two = answered(asked(homes, ask_segments, one), lambda asks: answer_segments(asks, width), buckets)
    names = [c.split()[0] for c in schema.split(", ")]
    told = f"d1 long, d2 long, none boolean, least long, copies long, first struct<{schema.replace(' ', ':').replace(',:', ',')}>, other struct<{schema.replace(' ', ':').replace(',:', ',')}>"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(told))

    @lean
    def cut(batches):
        """A row for each text: what its first row is made, and what the others are: all of it is there before them, but for
        texts too short to hold a string."""
        for b in batches:
            for r in range(b.num_rows):
                t = Texts(b.column("texts")[r].as_py())
                anchors, segments = ({x["src"]: x["blob"] for x in b.column(c)[r].as_py() or []} for c in ("a0", "a1"))
                h = Home(t, width)
                masks = removed(h, h.read_anchors(anchors, buckets), segments, buckets)
                rows = []
                for k, (x, mask) in enumerate(zip(t.texts, masks)):
                    first = dict(zip(names, emit(x, mask)))
                    other = first if len(x) < width or t.copies[k] == 1 else dict(zip(names, emit(x, np.ones(len(x), bool))))
                    rows.append((*digest(x), bool(t.none[k]), int(t.least[k]), int(t.copies[k]), first, other))
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], names=arrow.names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], names=arrow.names)

    found = written(with_answers(homes, one, two).mapInArrow(cut, told))
    rows = hot_join(digested(docs).groupBy("doc_id", "d1", "d2").agg(F.count("*").alias("k")), found, ["d1", "d2"], "copies")
    first = F.coalesce(F.when(F.col("none"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("least")), F.lit(False))
    rows = rows.select("doc_id", first.alias("is_first"), "first", "other", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))).alias("n"))
    return rows.select("doc_id", F.when(F.col("is_first") & (F.col("n") == 1), F.col("first")).otherwise(F.col("other")).alias("v")).select("doc_id", "v.*")


def kept_bytes(x: bytes, mask: np.ndarray) -> bytes:
    return x if not mask.any() else np.frombuffer(x, np.uint8)[~mask].tobytes()


DIGESTS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
KEPT = "text string, n_removed long"


def digests(x: bytes, mask: np.ndarray):
    spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0
    return len(x), int(mask.sum()), spans, sha256(kept_bytes(x, mask)).hexdigest()


def texts_kept(x: bytes, mask: np.ndarray):
    """The text without its removed bytes; a character that a cut leaves in part goes whole."""
    return kept_bytes(x, mask).decode("utf-8", "ignore"), int(mask.sum())


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digests, DIGESTS)
