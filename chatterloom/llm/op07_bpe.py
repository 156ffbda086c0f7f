"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled once in each Python worker; pre-split words are encoded by its table, decoding emits the
labels of the arcs read. A task keeps its words in a bounded cache.

Defined results: null and empty texts have no tokens and decode to the empty text. Special tokens' strings in a text
are those tokens. Repeated rows each get their row; other columns are not read. Very long texts are read whole, and
a very long word is encoded in time linear in it but for dead ends.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import WordCache, automaton, vocabulary
from .common import id_text, lean


class Coder:
    def __init__(self, path: str):
        self.vocab, self.machine = vocabulary(path), automaton(path)
        self.cache = WordCache(self._made)

    def _made(self, word: str) -> tuple[str, str, int]:
        ids = [self.vocab.special[word]] if word in self.vocab.special else self.machine.encode(word)
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by one space: the vocabulary names no decoder."""
        return " ".join([self.vocab.tokens[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return [int(i) for w in self.vocab.words(text) for i in self.cache[w][0].split()]


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""

    @lean
    def rows(batches):
        c = coder(path)
        c.cache.clear()  # each task learns its words anew
        for b in batches:
            n, h1, h2 = [], [], []
            for text in b.column("text"):
                got = list(map(c.cache.__getitem__, c.vocab.words(text.as_py() or "")))
                n.append(sum([x[2] for x in got]))
                h1.append(sha256(" ".join([x[0] for x in got]).encode()).hexdigest())
                h2.append(sha256(" ".join([x[1] for x in got]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1), pa.array(h2)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded text themselves."""

    def rows(batches):
        c = coder(path)
        for b in batches:
            ids = [c.encode(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(x) for x in ids])], names=["doc_id", "ids", "decoded"])

    return docs.mapInArrow(rows, "doc_id long, ids array<int>, decoded string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(id_text(spark.read.parquet(f"{sf_dir}/documents.parquet")), public_tokenizers.path("word_bpe_49k.json"))
