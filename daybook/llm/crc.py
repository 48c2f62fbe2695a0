"""CRC-32 of many byte spans at once, by a table of what a byte adds at each distance from its span's end.

CRC-32 is linear but for its start value: a span's checksum is the exclusive or of one contribution per byte, which
depends on the byte and on how many bytes follow it, and of a constant that depends on the length alone. A span longer
than ``BLOCK`` is folded block by block: what its blocks so far have given moves on by ``BLOCK`` zero bytes, then the
next block joins.
"""

from __future__ import annotations

import numpy as np

# The reversed polynomial of CRC-32, its start value and final mask.
POLYNOMIAL = 0xEDB88320
MASK = np.uint32(0xFFFFFFFF)

BLOCK = 256

U32 = np.uint32


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=U32)
    for _ in range(8):
        table = np.where(table & U32(1), (table >> U32(1)) ^ U32(POLYNOMIAL), table >> U32(1))
    return table


_BYTES = _byte_table()


def _zero_byte(register: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return (register >> U32(8)) ^ _BYTES[register & U32(255)]


def _positions() -> np.ndarray:
    """``BLOCK`` x 256: what a byte adds with so many bytes behind it."""
    table = np.empty((BLOCK, 256), dtype=U32)
    table[0] = _BYTES
    for distance in range(1, BLOCK):
        table[distance] = _zero_byte(table[distance - 1])
    return table


def _lengths() -> np.ndarray:
    """The start value after 0 to ``BLOCK`` zero bytes."""
    table = np.empty(BLOCK + 1, dtype=U32)
    table[0] = MASK
    for length in range(1, BLOCK + 1):
        table[length] = _zero_byte(table[length - 1])
    return table


def _shifts() -> np.ndarray:
    """4 x 256: a register after ``BLOCK`` zero bytes, by each of its bytes."""
    table = np.arange(256, dtype=U32)[None, :] << (U32(8) * np.arange(4, dtype=U32))[:, None]
    for _ in range(BLOCK):
        table = _zero_byte(table)
    return table


_AT, _START, _BLOCK_ON = _positions(), _lengths(), _shifts()
_AT_FLAT = _AT.reshape(-1)


def _moved(register: np.ndarray) -> np.ndarray:
    out = _BLOCK_ON[0][register & U32(255)]
    for k in range(1, 4):
        out = out ^ _BLOCK_ON[k][(register >> U32(8 * k)) & U32(255)]
    return out


def _linear(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exclusive or of the contributions of each span; all spans have 1 to ``BLOCK`` bytes."""
    if not len(starts):
        return np.zeros(0, dtype=U32)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    behind = np.repeat(lengths, lengths) - 1 - inside
    given = _AT_FLAT[behind * 256 + data[inside + np.repeat(starts, lengths)]]
    return np.bitwise_xor.reduceat(given, first)


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[starts[i]:ends[i]]``, unsigned; an empty span gives 0."""
    starts, lengths = np.asarray(starts, dtype=np.int64), np.asarray(ends, dtype=np.int64) - starts
    out = np.zeros(len(starts), dtype=U32)
    short = np.flatnonzero((lengths > 0) & (lengths <= BLOCK))
    out[short] = _linear(data, starts[short], lengths[short]) ^ _START[lengths[short]] ^ MASK

    long = np.flatnonzero(lengths > BLOCK)
    if len(long):
        # The first block takes what whole blocks leave over, so that all later ones are whole.
        at = starts[long]
        head = (lengths[long] - 1) % BLOCK + 1
        register = _linear(data, at, head) ^ _START[head]
        at = at + head
        stop = starts[long] + lengths[long]
        going = np.arange(len(long))
        while len(going):
            block = _linear(data, at[going], np.full(len(going), BLOCK))
            register[going] = _moved(register[going]) ^ block
            at[going] += BLOCK
            going = going[at[going] < stop[going]]
        out[long] = register ^ MASK
    return out
