"""CRC-32 of many byte strings at once, and of their concatenations.

The checksum is linear over GF(2): the CRC of ``a + b`` is the CRC of ``a``
moved over ``len(b)`` zero bytes, xor the CRC of ``b``.  So words are hashed
once, byte position by byte position over all words together, and n-grams are
put together from the words' values without touching a byte again.
"""

from __future__ import annotations

import zlib

import numpy as np

U32 = np.uint32
#: Words of more bytes are rare and hashed one at a time.
LONG = 48


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=U32)
    for _ in range(8):
        table = np.where(table & U32(1), (table >> U32(1)) ^ U32(0xEDB88320), table >> U32(1))
    return table


BYTE = _byte_table()


def _zeros(register: np.ndarray, count: int) -> np.ndarray:
    """The register after ``count`` zero bytes."""
    for _ in range(count):
        register = (register >> U32(8)) ^ BYTE[register & U32(255)]
    return register


def _lookup(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (tables[0][x & U32(255)] ^ tables[1][(x >> U32(8)) & U32(255)]
            ^ tables[2][(x >> U32(16)) & U32(255)] ^ tables[3][x >> U32(24)])


def _shift_tables(bits: int) -> list[np.ndarray]:
    """For 1, 2, 4 ... zero bytes: four tables, one per byte of the register."""
    parts = np.arange(256, dtype=U32)
    tables = [np.stack([_zeros(parts << U32(8 * k), 1) for k in range(4)])]
    for _ in range(bits - 1):
        last = tables[-1]
        tables.append(np.stack([_lookup(last, last[k]) for k in range(4)]))
    return tables


SHIFTS = _shift_tables(40)


def moved(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs moved over ``lengths`` zero bytes each."""
    out, lengths = crc.copy(), np.asarray(lengths, np.int64)
    bit = 0
    while len(lengths) and int(lengths.max()) >> bit:
        hit = np.flatnonzero((lengths >> bit) & 1)
        out[hit] = _lookup(SHIFTS[bit], out[hit])
        bit += 1
    return out


def joined(first: np.ndarray, second: np.ndarray, second_bytes: np.ndarray) -> np.ndarray:
    """CRC of first + second from the CRCs of both."""
    return moved(first, second_bytes) ^ second


def crc32_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``raw[starts[i]:ends[i]]`` for every i."""
    sizes = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, U32)
    order = np.argsort(-sizes, kind="stable")
    by_size = -sizes[order]  # ascending, so that the words with a byte at a position come first
    register, begin = out[order], starts[order]
    short = int(np.searchsorted(by_size, -LONG, "left"))
    for at in range(LONG):
        live = slice(short, int(np.searchsorted(by_size, -at, "left")))
        if live.start >= live.stop:
            break
        x = register[live]
        register[live] = (x >> U32(8)) ^ BYTE[(x ^ raw[begin[live] + at]) & U32(255)]
    register ^= U32(0xFFFFFFFF)
    for k in range(short):
        register[k] = zlib.crc32(raw[begin[k]: begin[k] - by_size[k]].tobytes())
    out[order] = register
    return out
