"""LM scoring by Katz backoff.

Bigrams over words with a start context and an end token; Good-Turing discounts for counts up to 5, at both orders;
the mass they free goes to unseen words, backed off to unigrams with exactly normalised weights, and of unigrams to
one unknown word. Counts are kept in buckets by word and by context (that of a frequent context by its following
word too, so that no bucket holds one whole), written as partitioned tables; homes of texts ask them and sum.

Defined results: null and empty texts are the end token alone. Rows that repeat a doc_id each get their row and each
count in training; null doc_ids count as training rows. Without training rows all probability is the unknown word's,
and scores are 0. Very long texts are scored whole. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, hot_join, id_text, lean, mix, steps, written
from .homes import Texts, answered, asked, bucket_of, bucket_slices, buckets_for, digest, digested, packed, settle, unpacked, with_answers

TOP = 5
END, START = U64(1), U64(2)
#: A context seen more often than this is dealt to SPLIT buckets by the word that follows.
HOT, SPLIT = 50_000, 32


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing discounts d[0..TOP] from n[r], how many events were seen r times (r to TOP + 1). Where they
    leave (0, 1), an absolute discount from n[1] and n[2]."""
    d = np.ones(TOP + 1)
    n1 = max(float(n[1]), 1e-9)
    cut = (TOP + 1) * n[TOP + 1] / n1
    absolute = n1 / (n1 + 2 * n[2]) if n[1] and n[2] else 0.5
    for r in range(1, TOP + 1):
        star = (r + 1) * n[r + 1] / n[r] if n[r] else 0
        v = (star / r - cut) / (1 - cut) if cut < 1 else 0
        d[r] = v if 0 < v < 1 else 1 - absolute / r
    return d


@dataclass(frozen=True)
class Unigrams:
    total: int
    distinct: int
    docs: int
    d: np.ndarray
    n: np.ndarray

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word seen c times; c = 0: of the unknown word."""
        if not self.total:
            return np.ones(len(c))
        low = np.minimum(c, TOP + 1)
        rate = np.append(self.d, 1.0)
        free = sum((1 - self.d[r]) * r * self.n[r] for r in range(1, TOP + 1)) / self.total
        scale = 1.0
        if free <= 0:
            scale, free = self.total / (self.total + 1), 1 / (self.total + 1)
        return np.where(c > 0, scale * rate[low] * c / self.total, free)


class Home:
    """The tokens of a bucket's texts as numbers of its distinct words."""

    def __init__(self, t: Texts):
        hashes, docs = [], []
        for lo, hi in steps(t.texts):
            w = Words(t.texts[lo:hi], lower=True)
            at = np.insert(w.hash, w.last, END)
            hashes.append(at)
            docs.append(np.insert(w.doc, w.last, np.arange(hi - lo)) + lo)
        h = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.words, self.token = np.unique(h, return_inverse=True)
        self.weight = t.weight[self.doc]
        self.first = np.ones(len(h), bool)
        self.first[1:] = self.doc[1:] != self.doc[:-1]

    def by_word(self, buckets: int):
        order = np.argsort(bucket_of(self.words, buckets), kind="stable")
        return order, bucket_of(self.words[order], buckets)

    def ask_words(self, buckets: int):
        count = np.bincount(self.token, self.weight, len(self.words)).astype(np.int64)
        order, b = self.by_word(buckets)
        for k, s in bucket_slices(b):
            yield k, packed(self.words[order[s]], count[order[s]].astype("<u4") if count.max(initial=0) < 2**32 else count[order[s]])

    def read_words(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        """Training count of each word of this home."""
        out = np.zeros(len(self.words), np.int64)
        order, b = self.by_word(buckets)
        for k, s in bucket_slices(b):
            out[order[s]] = np.frombuffer(unpacked(got[k])[0], "<i8")
        return out

    def pairs(self, c: np.ndarray, u: Unigrams, buckets: int):
        """Sets, of the distinct (context, word) pairs whose context was seen, in the order in which they are asked:
        contexts and words as numbers, bucket, count; and of each token, its pair or -1."""
        n = len(self.words)
        seen = np.append(c, u.docs)
        context = np.where(self.first, n, np.roll(self.token, 1))
        known = np.flatnonzero(seen[context] > 0)
        key = context[known] * (n + 1) + self.token[known]
        key, inv = np.unique(key, return_inverse=True)
        count = np.bincount(inv, self.weight[known], len(key)).astype(np.int64)
        v, w = key // (n + 1), key % (n + 1)
        hot = np.flatnonzero(seen > HOT)
        # a hot context is asked of in each of its buckets, if only for its sums: word n stands for none
        v2, w2 = np.repeat(hot, SPLIT), np.full(len(hot) * SPLIT, n)
        part = np.concatenate([(self.words[w] % U64(SPLIT)), np.tile(np.arange(SPLIT, dtype=U64), len(hot))])
        v, w, count = np.concatenate([v, v2]), np.concatenate([w, w2]), np.concatenate([count, np.zeros(len(v2), np.int64)])
        names = np.append(self.words, START)
        where = bucket_of(mix(names[v] + np.where(seen[v] > HOT, part + U64(1), U64(0)) * U64(0x9E3779B97F4A7C15)), buckets)
        order = np.lexsort((w, part, v, where))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pair = np.full(len(self.token), -1)
        pair[known] = place[inv]
        return v[order], w[order], where[order], count[order], pair, names, seen

    def ask_pairs(self, c: np.ndarray, u: Unigrams, buckets: int):
        v, w, where, count, _, names, _ = self.pairs(c, u, buckets)
        n = len(self.words)
        follow, of_word = np.append(self.words, U64(0)), np.append(c, 0)
        for k, s in bucket_slices(where):
            vs, ws = v[s], w[s]
            at = np.flatnonzero(np.concatenate(([True], vs[1:] != vs[:-1])))
            size = np.diff(np.append(at, len(vs)))
            six = np.ascontiguousarray(follow[ws]).view(np.uint8).reshape(-1, 8)[:, :6]
            yield k, packed(names[vs[at]], size.astype("<u4"), six, count[s].astype("<u4"), np.where(ws == n, 0, of_word[ws]).astype("<i8"), np.packbits(ws == n))


def answer_words(asks: list[tuple[int, bytes]]):
    got = [unpacked(b) for _, b in asks]
    words = [np.frombuffer(g[0], U64) for g in got]
    counts = [np.frombuffer(g[1], "<u4" if len(g[1]) == 4 * len(w) else "<i8").astype(np.int64) for g, w in zip(got, words)]
    all_words, inv = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(inv, np.concatenate(counts), len(all_words)).astype(np.int64)
    at = np.cumsum([0, *map(len, words)])
    for k, (src, _) in enumerate(asks):
        yield src, packed(total[inv[at[k] : at[k + 1]]].astype("<i8"))
    i = np.searchsorted(all_words, END)
    docs = total[i] if i < len(all_words) and all_words[i] == END else 0
    yield -1, packed(np.array([total.sum(), (total > 0).sum(), docs, *np.bincount(np.minimum(total, TOP + 2), minlength=TOP + 3)[: TOP + 2]], "<i8"))


def answer_pairs(asks: list[tuple[int, bytes]], u: Unigrams):
    v, w, count, of_word, none, number = [], [], [], [], [], []
    for _, b in asks:
        vh, size, six, ct, cw, bits = unpacked(b)
        size = np.frombuffer(size, "<u4")
        n = int(size.sum())
        v.append(np.repeat(np.frombuffer(vh, U64), size))
        x = np.zeros((n, 8), np.uint8)
        x[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
        w.append(x.view(U64).ravel())
        count.append(np.frombuffer(ct, "<u4"))
        of_word.append(np.frombuffer(cw, "<i8"))
        none.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool))
        number.append(size)
    sizes = [len(x) for x in v]
    v, w, count, of_word, none = (np.concatenate(x) for x in (v, w, count, of_word, none))
    _, at, inv = np.unique(mix(v + mix(w * U64(2) + none.astype(U64))), return_index=True, return_inverse=True)
    total = np.bincount(inv, count, len(at)).astype(np.int64)
    contexts, of = np.unique(v[at], return_inverse=True)
    low = np.minimum(total, TOP + 1)
    table = np.bincount(of * (TOP + 2) + low, minlength=len(contexts) * (TOP + 2)).reshape(-1, TOP + 2)
    seen = np.bincount(of, np.where(total > 0, u.p(of_word[at]), 0.0), len(contexts))
    lo = 0
    for (src, _), n, size in zip(asks, sizes, number):
        mine = slice(lo, lo + n)
        first = lo + np.cumsum(np.append(0, size[:-1])).astype(np.int64)
        rows = np.searchsorted(contexts, v[first])
        yield src, packed(total[inv[mine]].astype("<u4"), np.ascontiguousarray(table[rows, 1 : TOP + 1].T).astype("<u4"), seen[rows].astype("<f8"))
        lo += n
    yield -1, packed(np.bincount(np.minimum(total, TOP + 2), minlength=TOP + 3)[: TOP + 2].astype("<i8"))


def totals(table: DataFrame, width: int) -> np.ndarray:
    """Sums of what the buckets report of themselves: a few numbers of each, added on the executors."""

    def added(batches):
        s = np.zeros(width, np.int64)
        for b in batches:
            for x in b.column("blob").to_pylist():
                s += np.frombuffer(unpacked(x)[0], "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(s)], names=["k", "v"])

    got = table.where("src = -1").select("blob").mapInArrow(added, "k long, v long").groupBy("k").sum("v").collect()
    out = np.zeros(width, np.int64)
    for k, v in got:
        out[k] = v
    return out


def score(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Rows whose crc32(doc_id as text) mod
    folds is `held` are not learnt from; folds 0: all are."""
    docs = id_text(docs)
    buckets = buckets_for(docs, 5 << 20)  # a home holds its pairs of words as arrays, some 40 bytes a byte of text
    homes = settle(docs, buckets, lambda i: int(i is None or folds <= 0 or zlib.crc32(str(i).encode()) % folds != held))
    one = answered(asked(homes, lambda src, t: Home(t).ask_words(buckets)), answer_words, buckets)
    s = totals(one, TOP + 5)
    u = Unigrams(int(s[0]), int(s[1]), int(s[2]), discounts(s[3:]), s[3:])

    def ask_pairs(src, t, words):
        h = Home(t)
        return h.ask_pairs(h.read_words(words, buckets), u, buckets)

    two = answered(asked(homes, ask_pairs, one), lambda asks: answer_pairs(asks, u), buckets)
    d = discounts(totals(two, TOP + 2))

    @lean
    def scored(batches):
        for b in batches:
            for r in range(b.num_rows):
                t = Texts(b.column("texts")[r].as_py())
                words, pairs = ({x["src"]: x["blob"] for x in b.column(c)[r].as_py() or []} for c in ("a0", "a1"))
                h = Home(t)
                c = h.read_words(words, buckets)
                v, w, where, _, pair, names, seen = h.pairs(c, u, buckets)
                hits = np.zeros(len(v), np.int64)
                free, back = np.zeros((TOP, len(names))), np.zeros(len(names))
                for k, sl in bucket_slices(where):
                    got = unpacked(pairs[k])
                    hits[sl] = np.frombuffer(got[0], "<u4")
                    vs = v[sl]
                    vs = vs[np.concatenate(([True], vs[1:] != vs[:-1]))]
                    np.add.at(free, (slice(None), vs), np.frombuffer(got[1], "<u4").reshape(TOP, -1))
                    np.add.at(back, vs, np.frombuffer(got[2], "<f8"))
                total = np.maximum(seen, 1).astype(float)
                left = sum((1 - d[k]) * k * free[k - 1] for k in range(1, TOP + 1)) / total
                scale = np.ones(len(names))
                bare = left <= 0
                scale[bare] = total[bare] / (total[bare] + 1)
                left[bare] = 1 / (total[bare] + 1)
                alpha = np.where(seen > 0, left / np.maximum(1 - back, 1e-300), 1.0)
                pw = u.p(c)
                context = np.where(h.first, len(h.words), np.roll(h.token, 1))
                found = np.where(pair >= 0, hits[np.maximum(pair, 0)], 0) if len(hits) else np.zeros(len(pair), np.int64)
                rate = np.append(d, 1.0)[np.minimum(found, TOP + 1)]
                p = np.where(found > 0, scale[context] * rate * found / total[context], alpha[context] * pw[h.token])
                m = len(t.texts)
                log = np.bincount(h.doc, np.log10(np.maximum(p, 1e-300)), m)
                base = np.bincount(h.doc, np.log10((c[h.token] + 0.1) / (u.total + 0.1 * (u.distinct + 1))), m)
                n, known = np.bincount(h.doc, minlength=m), np.bincount(h.doc, c[h.token] > 0, m).astype(np.int64)
                d1, d2 = (np.array(x, np.int64) for x in zip(*map(digest, t.texts)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (d1, d2, t.copies, n, known, np.full(m, u.total), base, log)], names=["d1", "d2", "copies", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    found = written(with_answers(homes, one, two).mapInArrow(scored, "d1 long, d2 long, copies long, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(False)) if folds > 0 else F.lit(False)
    rows = hot_join(digested(docs), found, ["d1", "d2"], "copies")
    return rows.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
