"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate, decoded by
Viterbi; the share of words in content lines decides retention.

Base rules count words, symbols, repeated lines and repeated 3-word windows. The field is trained (forward-backward
gradients) on lines of at most MAX_TRAIN labelled documents, chosen by a hash of their ids, and of at most MAX_CHARS
characters of each. Lines have no labels of their own; theirs come from outside of the text they stand in, and so from
none of the features: a line is boilerplate if its document is labelled as bad, or if SHARED documents of the sample or
more hold it; all others are content.

Defined results: null and empty texts have no words and fail the base rules; a text without lines that hold words
has content share 0. Rows with a null doc_id or repeated rows each get their row. Texts are read whole. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, id_text, lean, text_steps
from .text_stats import _DIGIT, _LETTER, _STOP, _UPPER, SYMBOLS, dup_lines, lines, of_sorted, repeated_words

MAX_TRAIN, MAX_CHARS = 400, 20_000
#: Documents that hold a line of boilerplate at least.
SHARED = 3
#: Least share of a kept text's words that lie in content lines.
CONTENT_SHARE = 0.5
LICENCE_WORDS = ("license", "license.", "licensed", "copyright", "rights", "reserved", "reserved.", "spdx-license-identifier:", "cookies", "subscribe", "login", "sitemap")
FEATURES = ("bias", "symbols", "capitals", "bars", "licence", "seen_before", "looping", "short", "long", "stopped", "digits", "first", "last", "marks")


def line_features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and words of each line that holds a word, and a row of FEATURES (0 or 1) for it."""
    doc, start, end, full = lines(w)
    doc, start, end = doc[full], start[full], end[full]
    if not len(doc):
        return doc, doc, np.zeros((0, len(FEATURES)))
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    n = b - a

    def within(flags: np.ndarray) -> np.ndarray:
        c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return c[end] - c[start]

    order, at, size = of_sorted(doc, w.spans(start, end))
    seen = np.ones(len(doc), bool)
    seen[np.minimum.reduceat(order, at)] = False  # all but the earliest of equal lines
    licence = np.isin(w.hash, licence_hashes())
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    cl, cs = (np.concatenate(([0], np.cumsum(x))) for x in (licence, same))
    letters = np.maximum(within(_LETTER[w.buf]), 1)
    caps = within(_UPPER[w.buf]) / letters
    x = np.zeros((len(doc), len(FEATURES)))
    x[:, 0] = 1
    x[:, 1] = within(SYMBOLS[w.buf]) >= 0.4 * n
    x[:, 2] = (caps > 0.6) & (n > 1)
    x[:, 3] = within(w.buf == 124) * 3 >= n
    x[:, 4] = (cl[b] - cl[a]) * 8 >= n
    x[:, 4] *= cl[b] > cl[a]
    x[:, 5] = seen
    x[:, 6] = (cs[b] - cs[a]) * 2 >= n
    x[:, 7] = n <= 3
    x[:, 8] = n >= 20
    x[:, 9] = _STOP[w.buf[np.maximum(w.end[b - 1] - 1, 0)]]
    x[:, 10] = within(_DIGIT[w.buf]) * 3 >= letters
    x[:, 11] = np.concatenate(([True], doc[1:] != doc[:-1]))
    x[:, 12] = np.concatenate((doc[1:] != doc[:-1], [True]))
    x[:, 13] = within(w.buf == 33) * 2 >= n
    return doc, n, x


_LICENCE: list[np.ndarray] = []


def licence_hashes() -> np.ndarray:
    if not _LICENCE:
        words = [f.encode() for f in LICENCE_WORDS] + [f.capitalize().encode() for f in LICENCE_WORDS] + [f.upper().encode() for f in LICENCE_WORDS]
        _LICENCE.append(np.unique(Words(words).hash))
    return _LICENCE[0]


def line_labels(sequences: list[np.ndarray], good: list[bool], shared: int = SHARED) -> list[np.ndarray]:
    """1 (content) or 0 for each line. sequences: hashes of the lines of each document; good: the document's label."""
    every, documents = np.unique(np.concatenate([np.unique(h) for h in sequences]), return_counts=True)
    common = every[documents >= shared]
    return [(~np.isin(h, common)).astype(int) if ok else np.zeros(len(h), int) for h, ok in zip(sequences, good)]


def train(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.2, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (features, 2) and transition weights (2, 2) of a linear-chain CRF from (features, labels)."""
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    step = 0
    for _ in range(epochs):
        for x, y in sequences:
            step += 1
            e = x @ w
            n = len(e)
            fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
            fwd[0] = e[0]
            for i in range(1, n):
                fwd[i] = e[i] + np.logaddexp(fwd[i - 1, 0] + t[0], fwd[i - 1, 1] + t[1])
            for i in range(n - 2, -1, -1):
                v = e[i + 1] + bwd[i + 1]
                bwd[i] = np.logaddexp(t[:, 0] + v[0], t[:, 1] + v[1])
            z = np.logaddexp(*fwd[-1])
            p = np.exp(fwd + bwd - z)
            eta = rate / (1 + step / 2000) / np.sqrt(n)
            w += eta * (x.T @ (np.eye(2)[y] - p)) - eta * ridge * w
            if n > 1:
                pair = np.exp(fwd[:-1, :, None] + t + (e[1:] + bwd[1:])[:, None, :] - z).sum(0)
                seen = np.zeros((2, 2))
                np.add.at(seen, (y[:-1], y[1:]), 1)
                t += eta * (seen - pair) - eta * ridge * t
    return w, t


def viterbi(doc: np.ndarray, e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best labels of all lines; doc: each line's document, ascending. All documents go on a line at a time."""
    if not len(doc):
        return np.zeros(0, int)
    at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    n = np.diff(np.append(at, len(doc)))
    order = np.argsort(-n, kind="stable")
    at, n = at[order], n[order]
    best, back = np.zeros_like(e), np.zeros(e.shape, np.int8)
    best[at] = e[at]
    for k in range(1, n[0]):
        i = at[: np.searchsorted(-n, -k)] + k  # documents of more than k lines
        ways = best[i - 1][:, :, None] + t
        back[i] = ways.argmax(1)
        best[i] = e[i] + ways.max(1)
    out = np.zeros(len(doc), int)
    ends = at + n - 1
    out[ends] = best[ends].argmax(1)
    for k in range(n[0] - 1, 0, -1):
        i = at[: np.searchsorted(-n, -k)] + k
        out[i - 1] = back[i, out[i]]
    return out


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_chars: int = MAX_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Weights from at most max_train documents that are labelled, the first by a hash of their ids."""
    told = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = docs.select("doc_id").distinct()
    chosen = told.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", F.substring("text", 1, max_chars).alias("text"))
    rows = rows.orderBy("doc_id", "text").limit(max_train).collect()  # max_train texts of max_chars
    hashes, good, features = [], [], []
    for r in rows:
        w = Words([r["text"].encode()])
        _, _, x = line_features(w)
        if len(x):
            doc, start, end, full = lines(w)
            hashes.append(w.spans(start[full], end[full])), good.append(r["y"] == 1), features.append(x)
    return train(list(zip(features, line_labels(hashes, good))) if features else [])


def judge(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], share: float = CONTENT_SHARE) -> DataFrame:
    """A row of base counts, line counts and the verdict for each text."""
    w_e, w_t = weights
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"

    @lean
    def judged(batches):
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, some in text_steps(b.column("text")):
                w = Words(some)
                n = w.n
                code = np.concatenate(([0], np.cumsum((w.buf & 0xC0) != 0x80)))
                chars = w.per_doc(code[w.end] - code[w.start])
                repeat = repeated_words(w)
                doc, size, x = line_features(w)
                y = viterbi(doc, x @ w_e, w_t)
                m = len(n)
                all_lines, good = np.bincount(doc, minlength=m), np.bincount(doc, y, minlength=m)
                part = np.bincount(doc, y * size, minlength=m) / np.maximum(n, 1)
                failed = (n < 50) | (100 * repeat > 50 * n)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), *(pa.array(np.asarray(c, np.int64)) for c in (n, chars, w.bytes_per_doc(SYMBOLS[w.buf]), dup_lines(w), repeat)), pa.array(failed), pa.array(~failed & (part >= share)), pa.array(all_lines.astype(np.int64)), pa.array(good.astype(np.int64)), pa.array(part)],
                    names=[c.split()[0] for c in schema.split(", ")],
                )

    return docs.mapInArrow(judged, schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judge(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
