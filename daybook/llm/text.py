"""Words and hashes of many texts at once, on their bytes, with numpy.

A word is a run of bytes other than the six ASCII white space bytes. All hashes are 64-bit sums of random byte values
times powers of an odd number, so the hash of any span comes from two prefix sums; sums wrap around, which is wanted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = U64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` for i below ``n``, modulo 2 ** 64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(21, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            column = np.ones(size, dtype=U64)
            filled = 1
            while filled < size:  # doubling: base ** (filled + i) = base ** filled * base ** i
                column[filled : 2 * filled] = column[:filled] * U64(pow(base, filled, 1 << 64))
                filled *= 2
            _powers[name] = column
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Texts:
    """Bytes of some texts in a row; ``at`` has each text's first byte, and the end of the last."""

    data: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(values: pa.Array, first: int, end: int) -> Texts:
        """Rows ``first`` to ``end`` of an Arrow string column; null is an empty text."""
        part = pc.fill_null(values.slice(first, end - first), "").cast(pa.large_string())
        _, offsets, data = part.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        return Texts(raw, at - at[0])

    def __len__(self) -> int:
        return len(self.at) - 1

    def lowered(self) -> Texts:
        """A-Z in lower case."""
        return Texts(LOWER[self.data], self.at)

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte of every word, and the byte behind it."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        space = SPACE[self.data]
        opens, closes = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        opens[1:] = space[:-1]
        closes[:-1] = space[1:]
        opens[self.at[:-1][self.at[:-1] < n]] = True
        closes[self.at[1:][self.at[1:] > 0] - 1] = True
        return np.flatnonzero(opens & ~space), np.flatnonzero(closes & ~space) + 1

    @cached_property
    def word_at(self) -> np.ndarray:
        """Number of words before each text, and in all."""
        return np.searchsorted(self.spans[0], self.at)

    @cached_property
    def word_counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    @cached_property
    def word_text(self) -> np.ndarray:
        """Which text each word is of."""
        return np.repeat(np.arange(len(self)), self.word_counts)

    @cached_property
    def sums(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUES[self.data] * powers(len(self.data))[0], out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span's bytes; equal for equal bytes wherever they stand."""
        _, down = powers(len(self.data) + 1)
        return mix((self.sums[ends] - self.sums[starts]) * down[starts] + (ends - starts).astype(U64))

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(*self.spans)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``n`` words inside a text, and the number of its first word."""
        words = self.word_hashes
        if len(words) < n:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        run = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            run = run * _STEP + words[k : len(words) - n + 1 + k]
        inside = np.arange(len(run)) + n <= self.word_at[1:][self.word_text[: len(run)]]
        return mix(run[inside]), np.flatnonzero(inside)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        out = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype != np.float64 else np.float64)
        np.cumsum(values, out=out[1:])
        return np.diff(out[self.at])


def shingle_sets(texts: Texts, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles; of all its words as one when there are fewer."""
    hashes, first = texts.windows(n)
    begin = np.searchsorted(first, texts.word_at)
    out = []
    for i, words in enumerate(texts.word_counts):
        if words >= n:
            out.append(np.unique(hashes[begin[i] : begin[i + 1]]))
        elif words:
            whole = U64(words)
            with np.errstate(over="ignore"):
                for word in texts.word_hashes[texts.word_at[i] : texts.word_at[i + 1]]:
                    whole = whole * _STEP + word
            out.append(mix(np.array([whole], dtype=U64)))
        else:
            out.append(np.zeros(0, U64))
    return out
