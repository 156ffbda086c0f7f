"""Han text cut into words by a dictionary: of all ways to cut a run of Han characters, the one of the highest product
of word frequencies; a character that begins no word of the dictionary stands alone.

A dictionary is (word, count) pairs. It goes to the executors with the function, so its size is checked. Without one of
the caller's, the fixed words of this library (topics, swear words) are known, and all other characters stand alone."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from math import log

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of all words of a dictionary, which is held by each task.
MOST_CHARACTERS = 20_000_000
_PIECE = re.compile(r"[一-鿿]+|[A-Za-z0-9]+(?:\.[0-9]+)?%?")
_TOLD = re.compile(r"[A-Za-z一-鿿]")
_HAN = re.compile(r"[一-鿿]")


class Dictionary:
    def __init__(self, counts: Mapping[str, int]):
        if (size := sum(map(len, counts))) > MOST_CHARACTERS:
            raise ValueError(f"a dictionary of {size} characters is more than tasks can hold ({MOST_CHARACTERS})")
        total = sum(counts.values()) or 1
        self.weight = {w: log(max(n, 1) / total) for w, n in counts.items() if w}
        self.longest = max(map(len, self.weight), default=1)
        self.alone = -log(total) - 1.0  # of a character that is no word

    def cut(self, run: str) -> list[str]:
        """The words of a run, from the best sums of its ends; of equal sums the longer first word."""
        n = len(run)
        best, size = [0.0] * (n + 1), [1] * n
        for i in range(n - 1, -1, -1):
            best[i] = -float("inf")
            for k in range(1, min(self.longest, n - i) + 1):
                w = self.weight.get(run[i : i + k], self.alone if k == 1 else None)
                if w is not None and w + best[i + k] >= best[i]:
                    best[i], size[i] = w + best[i + k], k
        out, i = [], 0
        while i < n:
            out.append(run[i : i + size[i]])
            i += size[i]
        return out

    def tokens(self, text: str) -> Iterator[str]:
        for m in _PIECE.finditer(text):
            if _HAN.match(m[0]):
                yield from self.cut(m[0])
            elif _TOLD.search(m[0]):
                yield m[0].lower()


def segmented(text: Column, counts: Mapping[str, int] | None = None) -> Column:
    """Tokens of a text: as `text.tokens`, but Han words by the dictionary. Texts without Han characters don't need it."""
    from .text import HAN, tokens

    known = Dictionary(own_words() if counts is None else counts)

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(known.tokens(t)))

    return F.when(text.rlike(HAN), cut(F.when(text.rlike(HAN), text))).otherwise(tokens(text))


def own_words() -> dict[str, int]:
    """The library's fixed Han words, all as frequent."""
    from ..operators.sampling import TOPIC_OF

    return {w: 1 for w in TOPIC_OF if _HAN.match(w)} | {w: 1 for w in ("卧槽", "妈的", "尼玛", "傻逼", "垃圾")}
