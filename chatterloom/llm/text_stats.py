"""Statistics of whole texts, for many texts at once."""

from __future__ import annotations

import numpy as np

from .common import U64, Words, mix

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:"]] = True

NAMES = ("log_words", "word_chars", "word_chars_sd", "upper", "symbols", "marks", "stops", "digits", "not_ascii", "distinct", "runs", "repeated", "dup_lines", "line_words", "capital", "short_words")


def of_sorted(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal pairs of a document and a 64-bit key together, and the starts and sizes of their runs."""
    pair = mix(key + doc.astype(U64) * U64(0x9FB21C651E98DF25))
    order = np.argsort(pair)
    p = pair[order]
    new = np.ones(len(order), bool)
    new[1:] = p[1:] != p[:-1]
    at = np.flatnonzero(new)
    return order, at, np.diff(np.append(at, len(order)))


def repeated_words(w: Words) -> np.ndarray:
    """For each text, its words in 3-word windows that it holds twice or more, the first included."""
    n = len(w.hash)
    if n < 3:
        return np.zeros(len(w.n), np.int64)
    win = mix(w.hash[:-2] * U64(3) + mix(w.hash[1:-1] * U64(5) + mix(w.hash[2:] * U64(7))))
    whole = np.flatnonzero(w.doc[:-2] == w.doc[2:])
    order, at, size = of_sorted(w.doc[whole], win[whole])
    twice = whole[order[np.repeat(size > 1, size)]]
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[twice + k] = True
    return w.per_doc(hit)


def lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """\\n-split lines: document, start, end, and whether the line holds a word."""
    end = np.flatnonzero(w.buf == 10)
    start = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
    doc = np.searchsorted(w.doc_end, end, side="right")
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    return doc, start, end, words > 0


def dup_lines(w: Words) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier line."""
    doc, start, end, full = lines(w)
    out = np.zeros(len(w.n), np.int64)
    doc, start, end = doc[full], start[full], end[full]
    if len(doc):
        order, at, size = of_sorted(doc, w.spans(start, end))
        np.add.at(out, doc[order][at], size - 1)
    return out


def features(texts: list[bytes]) -> np.ndarray:
    """A row of NAMES for each text, all bounded or logarithmic; an empty text has zeros."""
    w = Words(texts)
    n = np.maximum(w.n, 1).astype(float)
    size = (w.end - w.start).astype(float)
    code = (w.buf & 0xC0) != 0x80
    chars = w.bytes_per_doc(code).astype(float)
    letters = np.maximum(w.bytes_per_doc(_LETTER[w.buf]), 1)
    mean = w.per_doc(size) / n
    f = np.zeros((len(texts), len(NAMES)))
    f[:, 0] = np.log1p(w.n)
    f[:, 1] = np.log1p(mean)
    f[:, 2] = np.log1p(np.sqrt(np.maximum(0, w.per_doc(size**2) / n - mean**2)))
    f[:, 3] = w.bytes_per_doc(_UPPER[w.buf]) / letters
    f[:, 4] = np.log1p(w.bytes_per_doc(SYMBOLS[w.buf]) / n)
    f[:, 5] = np.log1p(w.bytes_per_doc(_MARK[w.buf]) / n)
    f[:, 6] = np.log1p(w.bytes_per_doc(_STOP[w.buf]) / n)
    f[:, 7] = w.bytes_per_doc(_DIGIT[w.buf]) / np.maximum(chars, 1)
    f[:, 8] = w.bytes_per_doc(w.buf >= 128) / letters
    if len(w.hash):
        order, at, _ = of_sorted(w.doc, w.hash)
        distinct = np.bincount(w.doc[order][at], minlength=len(texts))
        f[:, 9] = np.log1p(distinct) / np.log1p(n)
        same = np.zeros(len(w.hash), bool)
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        f[:, 10] = w.per_doc(same) / n
    f[:, 11] = repeated_words(w) / n
    doc, _, _, full = lines(w)
    with_words = np.bincount(doc[full], minlength=len(texts))
    f[:, 12] = dup_lines(w) / np.maximum(with_words, 1)
    f[:, 13] = np.log1p(w.n / np.maximum(with_words, 1))
    f[:, 14] = w.per_doc(_UPPER[w.buf[w.start]]) / n
    f[:, 15] = w.per_doc(size <= 3) / n
    f[w.n == 0] = 0
    return f
