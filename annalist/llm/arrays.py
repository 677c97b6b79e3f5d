"""Texts of an Arrow batch as flat numpy arrays, and hashes and comparisons of any span in them.

Helpers for code inside tasks. A batch is cut into slices of bounded size (one
text may exceed it), so that memory follows the slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        # Kept at slice size; the rare larger text gets an array of its own.
        factors = np.full(max(size, SLICE + 1024), base, dtype=np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if len(known) <= 4 * SLICE:
            _powers[name] = known
    return known[:size]


class SpanHashes:
    """64-bit hashes of spans [start, end) of one array of codes.

    Equal spans hash alike wherever they stand. Unequal spans seldom do, but some
    regular ones must, as the sums are taken modulo 2^64 (Thue-Morse words of
    1,024 codes): where a hash would stand for a content, compare the content
    too (:func:`distinct_spans`) or use :class:`PrimeHashes`.
    """

    def __init__(self, codes: np.ndarray, seed: int = 0):
        size = len(codes)
        terms = mix(codes.astype(np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019 + 0x1F83D9AB) % 2**64))
        terms *= _power("up", _BASE, size)
        self.sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.down = _power("down", _BASE_INVERSE, size + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def get(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


_PRIME = np.uint64((1 << 31) - 1)
#: Two bases below the prime and what sets the codes under each apart.
_BASES = ((0x5D1B3F4A, 0x9AE16A3B2F90404F), (0x2F6E2B1C, 0xC3A5C85C97CB3127))


def _folded(x: np.ndarray) -> np.ndarray:
    """Modulo the prime 2^31 - 1, which may be left for 0; values are below 2^62."""
    for _ in range(2):
        x = (x & _PRIME) + (x >> np.uint64(31))
    return x


def _prime_power(base: int, size: int) -> np.ndarray:
    name = f"prime {base}"
    known = _powers.get(name)
    if known is None or len(known) < size:
        known = np.ones(1, dtype=np.uint64)
        # Grown to what slices ask for, as four of these stay with each worker.
        while len(known) < size:
            known = np.concatenate([known, _folded(known * np.uint64(pow(base, len(known), int(_PRIME))))])
        if len(known) <= 4 * SLICE:
            _powers[name] = known
    return known[:size]


class PrimeHashes:
    """As :class:`SpanHashes`, by two polynomials modulo a prime with bases of their own.

    A polynomial of degree ``n`` has at most ``n`` roots, so two unequal spans of
    ``n`` codes collide with a chance of at most ``(n / 2^31)^2`` over the choice
    of bases. For sets of spans, whose contents are not at hand when compared.
    """

    def __init__(self, codes: np.ndarray, seed: int = 0):
        self.parts = []
        for base, salt in _BASES:
            terms = _folded(mix(codes.astype(np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019 + salt) % 2**64)) >> np.uint64(2))
            terms = _folded(terms * _prime_power(base, len(codes)))
            sums = np.zeros(len(codes) + 1, dtype=np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.parts.append((sums, _prime_power(pow(base, -1, int(_PRIME)), len(codes) + 1)))

    def get(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = np.zeros(len(start), dtype=np.uint64)
        for sums, down in self.parts:
            part = _folded(_folded(sums[end] - sums[start]) * down[start])
            part[part == _PRIME] = 0
            found = (found << np.uint64(31)) | part
        return mix(found ^ ((end - start).astype(np.uint64) * _BASE))


def slices(sizes: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes sum to at most ``limit``, or hold one row."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def byte_texts(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, list[bytes]]]:
    """Slices of a text column as UTF-8 bytes; null counts as empty."""
    binary = column.cast(pa.binary())
    sizes = np.array(pc.fill_null(pc.binary_length(binary), 0), dtype=np.int64)
    for start, stop in slices(sizes, limit):
        yield start, stop, [v or b"" for v in binary.slice(start, stop - start).to_pylist()]


def string_texts(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, list[str]]]:
    """Slices of a text column as strings; null counts as empty."""
    sizes = np.array(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    for start, stop in slices(sizes, limit):
        yield start, stop, [v or "" for v in column.slice(start, stop - start).to_pylist()]


def joined_bytes(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """One byte array with ``gap`` after each text, and the start of each text (one more at the end)."""
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return np.frombuffer(gap.join(texts) + gap if texts else b"", dtype=np.uint8), starts


def joined_points(texts: list[str], gap: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """As :func:`joined_bytes`, by code point."""
    sizes = np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    blob = (gap.join(texts) + gap).encode("utf-32-le", "surrogatepass") if texts else b""
    return np.frombuffer(blob, dtype=np.uint32), starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point the code of its lower case if it is a letter, else 0."""
    if not _letters:
        table = np.zeros(0x110000, dtype=np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                lower = char.lower()
                table[code] = ord(lower) if len(lower) == 1 else code
        _letters.append(table)
    return _letters[0]


def sorted_set(values: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] + values.dtype.type(1)) != 0] if len(values) else values


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and for each value its index among them."""
    order = np.argsort(values)
    sorted_values = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    index = np.empty(len(values), dtype=np.int64)
    index[order] = np.cumsum(new) - 1
    return sorted_values[new], order[new], index


def spans_equal(codes: np.ndarray, start: np.ndarray, size: np.ndarray, other: np.ndarray, other_start: np.ndarray) -> np.ndarray:
    """Whether each span of ``codes`` holds what the span of ``other`` of the same size holds."""
    ends = np.cumsum(size)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    wrong = np.flatnonzero(codes[np.repeat(start, size) + inside] != other[np.repeat(other_start, size) + inside])
    equal = np.ones(len(start), dtype=bool)
    equal[np.searchsorted(ends, wrong, side="right")] = False
    return equal


def distinct_spans(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An example of each distinct span and for each span the index of its example, by content.

    Hashes bring spans together; each is then compared with its example, code by
    code, and those that only share its hash are told apart by their bytes.
    """
    _, example, which = distinct(SpanHashes(codes).get(start, end))
    size, lead = end - start, example[which]
    wrong = size != size[lead]
    alike = np.flatnonzero(~wrong)
    wrong[alike] = ~spans_equal(codes, start[alike], size[alike], codes, start[lead[alike]])
    known: dict[bytes, int] = {}
    more = []
    for i in np.flatnonzero(wrong).tolist():
        content = codes[start[i] : end[i]].tobytes()
        if content not in known:
            known[content] = len(example) + len(more)
            more.append(i)
        which[i] = known[content]
    return np.append(example, np.array(more, dtype=example.dtype)), which
