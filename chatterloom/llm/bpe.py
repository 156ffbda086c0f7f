"""A byte-pair vocabulary compiled to a deterministic automaton, and text splitting as the vocabulary file asks."""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import regex

#: White space as Unicode has it.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
END = "</w>"
#: The usual split for texts of Latin-1 alone, where plain classes do.
_NARROW = re.compile(rf"[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^{_WS}a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_WIDE = re.compile(r"[^\x00-\xff]")
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> str:
    """The printable character of each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


class Vocabulary:
    """A vocabulary file of the kind: NFC, white space dropped, lower case; byte-level symbols; words end in END.

    Raises ValueError on a file whose settings ask for something else."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        kinds = [x["type"] for x in d["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or d["model"]["end_of_word_suffix"] != END or d["decoder"] or d["post_processor"]:
            raise ValueError(f"{path}: not the expected kind of vocabulary")
        self.ids: dict[str, int] = d["model"]["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in d["model"]["merges"]]
        self.special = {x["content"]: x["id"] for x in d["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = t
        self._symbols = dict(enumerate(byte_symbols()))
        pattern = d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if pattern != USUAL:
            raise ValueError(f"{path}: another way to split texts")
        self.split = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_WS}\p{{L}}\p{{N}}]"))
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """The pre-split words of a text; those that are special tokens stand for themselves."""
        if self.parts and "<|" in text:
            out = []
            for p in self.parts.split(text):
                out.extend([p] if p in self.special else self.plain(p))
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # no final sigma
        text = text.lower()
        return (self.split if _WIDE.search(text) else _NARROW).findall(text)

    def symbols(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self._symbols)


class Automaton:
    """Accepts exactly the token sequences that byte-pair merging makes of words.

    There is a state for each token that may stand inside a word (the one read last) and one start state, from which
    every live token can be read. `table` has a bit for each state and token: whether the token can be read from it. Merges are
    compiled one by one: merging u, v takes v away from u's state, gives the new token uv the successors of v, and
    lets uv be read wherever u can be.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        ids = vocab.ids
        inner = [t for t in ids if not t.endswith(END)]
        self.state = {ids[t]: i for i, t in enumerate(inner)}
        state = np.full(len(vocab.tokens), -1)
        for t, i in self.state.items():
            state[t] = i
        table = np.zeros(((len(inner) + 8) // 8, len(vocab.tokens)), np.uint8)  # states by eights, so that a state's bits of all tokens are near each other
        made = {u + v for u, v in vocab.merges}
        base = [i for t, i in ids.items() if t not in made]
        live = np.zeros(len(vocab.tokens), bool)
        live[base] = True
        for s in (state[i] for i in base if state[i] >= 0):
            table[s >> 3, base] |= np.uint8(1 << (s & 7))
        for a, b in vocab.merges:
            u, v, w = ids[a], ids[b], ids[a + b]
            su, sv, sw = state[u], state[v], state[w]
            if not (live[u] and live[v] and table[su >> 3, v] >> (su & 7) & 1):
                continue  # no word holds u before v
            if sw >= 0:  # uv is followed as v is
                table[sw >> 3] |= (table[sv >> 3] >> np.uint8(sv & 7) & np.uint8(1)) << np.uint8(sw & 7)
            table[su >> 3, v] &= np.uint8(255 ^ 1 << (su & 7))
            table[:, w] |= table[:, u]
            live[w] = True
        self.table, self.live = table, live
        self.longest = max(len(t.removesuffix(END)) for t in ids)

    def encode(self, word: str) -> list[int]:
        """Token ids of one pre-split word. The accepted path is unique; dead ends are noted and not tried again."""
        s = self.vocab.symbols(word)
        n, get, table, live, state, longest = len(s), self.vocab.ids.get, self.table, self.live, self.state, self.longest
        whole = get(s + END)
        if whole is not None and live[whole]:
            return [whole]
        path: list[int] = []
        ends = [0]
        tries = [min(n, longest)]
        dead: set[tuple[int, int]] = set()
        while True:
            at, last = ends[-1], path[-1] if path else -1
            size = tries[-1]
            found = -1
            if (at, last) not in dead:
                q = state[last] if path else 0
                byte, bit = q >> 3, q & 7
                while size:
                    t = get(s[at : at + size] + END if at + size == n else s[at : at + size])
                    if t is not None and live[t] and (not path or table[byte, t] >> bit & 1) and (at + size, t) not in dead:
                        found = t
                        break
                    size -= 1
            if found < 0:
                dead.add((at, last))
                if not path:
                    raise ValueError(f"no path for {word!r}")
                path.pop(), ends.pop(), tries.pop()
                tries[-1] -= 1
                continue
            tries[-1] = size
            path.append(found)
            if at + size == n:
                return path
            ends.append(at + size)
            tries.append(min(n - at - size, longest))


_BUILT: dict[str, object] = {}


def vocabulary(path: str) -> Vocabulary:
    """Read once for each Python process."""
    if ("v", path) not in _BUILT:
        _BUILT["v", path] = Vocabulary(path)
    return _BUILT["v", path]


def automaton(path: str) -> Automaton:
    if ("a", path) not in _BUILT:
        _BUILT["a", path] = Automaton(vocabulary(path))
    return _BUILT["a", path]


class WordCache(dict):
    """Results by word; emptied when it holds `most`, so that memory stays bounded."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        self[word] = out = self.make(word)
        return out
