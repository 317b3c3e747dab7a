"""Hashes of substrings of one text, all at once in numpy: prefix sums of polynomials, mixed at the end."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# One random value per byte.
BYTES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Tables of powers up to this size are kept per process, some 25 MB in all; longer texts have theirs made anew.
KEPT = 1 << 19
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 at least of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for base in (BASE, INVERSE):
            row = np.full(size, base)
            row[0] = U(1)
            made.append(np.multiply.accumulate(row))
        if size > KEPT:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer: every input bit moves every output bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


# A prime below which products of two residues stay within 64 bits.
PRIME = U((1 << 31) - 1)
# Fixed random bases of the two sums that tell spans apart.
BASES = (1_316_048_543, 774_921_587)
_residues: list[tuple[np.ndarray, np.ndarray]] = []


def folded(v: np.ndarray) -> np.ndarray:
    """The same residue, smaller: below 2^34 for any value, below 2^32 for a product of residues."""
    return (v & PRIME) + (v >> U(31))


def residue(v: np.ndarray) -> np.ndarray:
    """The residue itself, from 0 to PRIME - 1."""
    v = folded(folded(folded(v)))
    return np.where(v >= PRIME, v - PRIME, v)


def residue_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0..n-1 at least of each base and of its inverse modulo PRIME."""
    if _residues and len(_residues[0][0]) >= n:
        return _residues
    size = max(1 << 16, 1 << (n - 1).bit_length())
    made = []
    for base in BASES:
        rows = []
        for x in (base, pow(base, -1, int(PRIME))):
            row = np.ones(1, np.uint64)
            while len(row) < size:
                row = np.concatenate([row, residue(row * U(pow(x, len(row), int(PRIME))))])
            rows.append(row)
        made.append((rows[0], rows[1]))
    if size <= KEPT:
        _residues[:] = made
    return made


class Spans:
    """Hashes of any spans of a sequence of well-mixed 64-bit symbols.

    ``hash`` names a span by two polynomials modulo a prime, in independent bases, over different halves of the symbols:
    different spans of n symbols share a name by a chance of at most ``(n / 2^31)^2``, whatever their pattern. ``rolling``
    works modulo 2^64, which is cheaper but lets long patterns of two symbols meet: for short spans, or where equal values
    need only gather what is compared later.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.symbols = symbols
        self._sums: np.ndarray | None = None
        self._residues: list[tuple[np.ndarray, np.ndarray]] = []

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(self.symbols)
        if not self._residues:
            for (up, down), shift in zip(residue_powers(n + 1), (U(0), U(31)), strict=True):
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(folded(((self.symbols >> shift) & PRIME) * up[:n]), out=sums[1:])
                self._residues.append((sums, down))
        one, two = (residue(residue(sums[ends] - sums[starts]) * down[starts]) for sums, down in self._residues)
        return mix((one << U(31) | two) ^ mix((ends - starts).astype(np.uint64)))

    def rolling(self, width: int, mixed: bool = True) -> np.ndarray:
        """Hashes of all spans of a width, shorter than the sequence; unmixed ones have poor low bits."""
        if self._sums is None:
            up, self.down = powers(len(self.symbols) + 1)
            self._sums = np.zeros(len(self.symbols) + 1, np.uint64)
            np.cumsum(self.symbols * up[: len(self.symbols)], out=self._sums[1:])
        n = len(self._sums) - width
        plain = (self._sums[width:] - self._sums[:n]) * self.down[:n]
        return mix(plain + U(width)) if mixed else plain


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], SPACE[data], [True]])))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word."""
    starts, ends = word_spans(data)
    return Spans(BYTES[data]).hash(starts, ends), starts, ends


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
