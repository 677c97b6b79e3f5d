"""Byte-level BPE ids of many texts at once.

A text is cut into words by the tokenizer's own rule, done on arrays, and each
distinct word goes through ``tokenizers`` once; BPE never crosses a word.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
from tokenizers import Tokenizer
from tokenizers.models import BPE

from annalist.llm.arrays import distinct_spans, joined_points

#: Code points that the rule's \s matches.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Endings that form a word with an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_GAP, _SPACE, _LETTER, _NUMBER, _OTHER = range(5)
_tables: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    if not _tables:
        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))[0]
            if kind == "L":
                table[code] = _LETTER
            elif kind == "N":
                table[code] = _NUMBER
        table[SPACES] = _SPACE
        _tables.append(table)
    return _tables[0]


def word_spans(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie in ``codes`` with one code after each.

    A word is a run of letters, of digits or of others, with the one space before
    it; an apostrophe with one of ENDINGS; or what is left of a run of blanks.
    """
    kind = _kinds()[codes]
    kind[starts[1:] - 1] = _GAP
    size = len(codes)
    cut = np.zeros(size + 1, dtype=bool)
    cut[:size] = np.diff(kind, prepend=255) != 0
    # Two gaps in a row, of an empty text, are two runs.
    cut[starts] = True
    first = np.flatnonzero(cut[:size])
    ends = np.append(first[1:], size)
    follows = np.append(kind, _GAP)[ends]
    # The last blank of a run before a word stands apart, and joins the word if it is a space.
    blank = (kind[first] == _SPACE) & (follows != _GAP)
    last = ends[blank] - 1
    cut[last] = True
    cut[last[codes[last] == 0x20] + 1] = False
    # Contractions: an apostrophe alone, no space before it, letters behind it.
    alone = (codes[first] == 0x27) & (ends - first == 1) & (follows == _LETTER)
    for at in first[alone].tolist():
        if not cut[at]:
            continue
        tail = "".join(map(chr, codes[at + 1 : at + 3].tolist()))
        found = next((e for e in ENDINGS if tail.startswith(e)), None)
        if found and kind[at + 1 : at + 1 + len(found)].tolist() == [_LETTER] * len(found):
            cut[at + 1] = False
            cut[at + 1 + len(found)] = True
    place = np.flatnonzero(cut[:size])
    stop = np.append(place[1:], size)
    real = kind[place] != _GAP
    return place[real], stop[real]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {byte: chr(byte if byte in prints else next(others)) for byte in range(256)}


class Encoder:
    """Ids by ``tokenizers``, with the ids of words seen before kept (at most ``most`` words).

    ``specials``: whether the string of a special token inside a text gives that
    token, as the library does; else it is text like any other.
    """

    def __init__(self, path: str, most: int = 400_000, specials: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        # The word model alone, without the cache that words seen once would only churn.
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = BPE(vocab=model["vocab"], merges=pairs, cache_capacity=0)
        self.letters = byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if specials else []
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, words: list[str]) -> None:
        spelled = [w.encode().decode("latin-1").translate(self.letters) for w in words]
        lists = [[token.id for token in self.words.tokenize(w)] for w in spelled]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special ones. ``texts`` should be a slice of bounded size."""
        # A special token's own string is cut out before words are: left to the library.
        odd = {i: t for i, t in enumerate(texts) if any(s in t for s in self.special)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)]
        codes, starts = joined_points(plain)
        start, end = word_spans(codes, starts)
        at, which = distinct_spans(codes, start, end)
        if len(self.slots) + len(at) > self.most:
            self._forget()
        owner = np.searchsorted(starts, start[at], side="right") - 1
        begin, finish = (start[at] - starts[owner]).tolist(), (end[at] - starts[owner]).tolist()
        words = [plain[o][a:b] for o, a, b in zip(owner.tolist(), begin, finish, strict=True)]
        new = [w for w in words if w not in self.slots]
        if new:
            self.slots.update(zip(new, range(len(self.first), len(self.first) + len(new)), strict=True))
            self._learn(new)
        slots = [self.slots[w] for w in words]
        slot = np.array(slots, dtype=np.int64)[which]
        sizes = self.size[slot]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(self.first[slot] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[np.searchsorted(start, starts)]
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i, text in odd.items():
            out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
