"""Packing by non-negative least squares.

Documents (their ids and a closing id 1) are cut into full windows and a rest. The rests' histogram, in bins, is met
by shallow combinations of at most DEPTH bins that fill a window: how often to use each is a non-negative least
squares problem, solved by an active set and rounded, as far as there are rests. What the combinations leave of a window is filled with
cuts from rests that no combination took; those are then packed greedily. A last part of a window is cut into
sequences whose sizes are powers of two, so that no padding is left.

Packing goes by chunks of at most CHUNK tokens of a scan's partition, in its order: no shuffle, bounded memory, and
the same rows when a lost task is run again. Sequence ids are the partition's number and a count.

Defined results: null and empty texts are the closing id alone; repeated rows are packed as documents of their own;
null doc_ids stay null. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import END, vocabulary
from .common import id_text, lean

WINDOW = 2048
BINS = 32
DEPTH = 4
CHUNK = 2_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def combinations(bins: int = BINS, depth: int = DEPTH) -> np.ndarray:
    """A column for each multiset of at most `depth` of the sizes 1..bins that sums to `bins`."""

    def of(total: int, least: int, left: int) -> Iterator[tuple[int, ...]]:
        if total == 0:
            yield ()
        elif left:
            for k in range(least, total + 1):
                if k == total or k * 2 <= total:
                    for rest in of(total - k, k, left - 1):
                        yield (k, *rest)

    cols = list(of(bins, 1, depth))
    a = np.zeros((bins, len(cols)))
    for j, c in enumerate(cols):
        for k in c:
            a[k - 1, j] += 1
    return a


def nnls(a: np.ndarray, b: np.ndarray, most: int = 300) -> np.ndarray:
    """x >= 0 with least |a x - b|, by Lawson and Hanson's active set."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    for _ in range(most):
        grad = a.T @ (b - a @ x)
        grad[passive] = -np.inf
        j = int(grad.argmax())
        if grad[j] <= 1e-8 * max(1, abs(b).max()):
            break
        passive[j] = True
        while True:
            z = np.zeros(n)
            z[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            low = passive & (z <= 1e-12)
            if not low.any():
                x = z
                break
            step = (x[low] / np.maximum(x[low] - z[low], 1e-300)).min()
            x = x + step * (z - x)
            passive &= x > 1e-12
            x[~passive] = 0
            if not passive.any():
                break
    return x


_COMBINATIONS: list[np.ndarray] = []


def plan(sizes: list[int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given sizes. All windows are full but
    for a few last sequences, whose sizes are powers of two."""
    if not _COMBINATIONS:
        _COMBINATIONS.append(combinations())
    combos = _COMBINATIONS[0]
    width = window // BINS
    out: list[tuple[int, int, int, int, int]] = []
    seq = 0
    bins: list[list[tuple[int, int, int]]] = [[] for _ in range(BINS + 1)]
    for d, n in enumerate(sizes):
        full = n // window
        for k in range(full):
            out.append((d, k * window, window, seq, 0))
            seq += 1
        if rest := n - full * window:
            bins[-(-rest // width)].append((d, full * window, rest))
    times = np.rint(nnls(combos, np.array([len(x) for x in bins[1:]], float))).astype(int)
    open_: list[list[tuple[int, int, int]]] = []
    for j in np.flatnonzero(times):
        need = [(k + 1, int(c)) for k, c in enumerate(combos[:, j]) if c]
        for _ in range(min(times[j], *(len(bins[k]) // c for k, c in need))):
            open_.append([bins[k].pop() for k, c in need for _ in range(c)])
    # the longest residuals start windows, the rest is cut into whatever gaps there are
    rest = [x for b in bins for x in b]
    rest.reverse()

    def fill(gap: int) -> list[tuple[int, int, int]]:
        got = []
        while gap and rest:
            d, s, n = rest.pop()
            if n > gap:
                rest.append((d, s + gap, n - gap))
                n = gap
            got.append((d, s, n))
            gap -= n
        return got

    for parts in open_:
        if not rest:  # a window given up fills the others
            continue
        parts.extend(fill(window - sum(p[2] for p in parts)))
    short = [p for p in open_ if sum(x[2] for x in p) < window]
    while short:
        parts = short.pop()
        if not rest:
            if not short:
                rest.extend(parts)
                open_ = [p for p in open_ if p is not parts]
                break
            given = short.pop(0)
            open_ = [p for p in open_ if p is not given]
            rest.extend(given)
        parts.extend(fill(window - sum(p[2] for p in parts)))
        if sum(p[2] for p in parts) < window:
            short.append(parts)
    while sum(x[2] for x in rest) >= window:
        open_.append(fill(window))
    left = sum(x[2] for x in rest)
    for k in range(left.bit_length() - 1, -1, -1):
        if left >> k & 1:
            open_.append(fill(1 << k))
    for parts in open_:
        at = 0
        for d, s, n in parts:
            out.append((d, s, n, seq, at))
            at += n
        seq += 1
    return out


class WordIds(dict):
    """Ids (as bytes) of pre-split words, by the tokenizers library. Emptied beyond `most` words."""

    def __init__(self, path: str, most: int = 300_000, group: int = 1000):
        super().__init__()
        self.tokenizer, self.closes = loaded(path)
        self.special, self.most, self.group = vocabulary(path).special, most, group

    def learn(self, need: set[str]) -> None:
        """Makes sure that all of `need` are held. Words are encoded many at a time, parted by spaces: each ends in a
        token that closes a word. Where the count of these is another one, each word is encoded alone."""
        new = need - self.keys()
        if new and len(self) > self.most:
            self.clear()
            new = need
        special = [w for w in new if w in self.special]
        plain = [w for w in new if w not in self.special]
        for lo in range(0, len(plain), self.group):
            some = plain[lo : lo + self.group]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) != len(some):
                special.extend(some)
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(some, ends.tolist()):
                self[w] = raw[at:end]
                at = end
        for w in special:
            self[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()


_LOADED: dict[str, tuple] = {}


def loaded(path: str) -> tuple:
    """The tokenizer, read once for each Python process, and which tokens close a word. No word is kept with it."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _LOADED[path] = tokenizer, np.array([t.endswith(END) for t in vocabulary(path).tokens])
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """A row for each piece of each document, as SCHEMA."""

    @lean
    def packed(batches):
        vocab, cache = vocabulary(path), WordIds(path)  # each task learns its words anew
        held: list[tuple[int | None, bytes]] = []
        size = seq = 0
        base = None
        end = np.array([1], "<u4").tobytes()

        def flush():
            nonlocal seq
            found = plan([len(x) // 4 for _, x in held], window)
            rows = [(held[d][0], s, n, zlib.crc32(held[d][1][4 * s : 4 * (s + n)]), len(held[d][1]) // 4, base + seq + q, o) for d, s, n, q, o in found]
            seq += 1 + max(p[3] for p in found)
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            if b.num_rows == 0:
                continue
            if base is None:
                base = b.column("part")[0].as_py() << 36
            ids = b.column("doc_id")
            for lo in range(0, b.num_rows, 500):
                words = [vocab.words(t.as_py() or "") for t in b.column("text").slice(lo, 500)]
                cache.learn(set(itertools.chain.from_iterable(words)))
                for k, ws in enumerate(words):
                    x = b"".join(map(cache.__getitem__, ws)) + end
                    held.append((ids[lo + k].as_py(), x))
                    size += len(x) // 4
                    if size >= CHUNK:
                        yield flush()
                        held.clear()
                        size = 0
        if held:
            yield flush()

    return docs.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(packed, SCHEMA)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces(id_text(spark.read.parquet(f"{sf_dir}/documents.parquet")), public_tokenizers.path("word_bpe_49k.json"))
