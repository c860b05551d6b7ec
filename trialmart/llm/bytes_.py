"""Vectorised text primitives for Arrow batches: byte views, tokens, hashes.

Every helper works on one bounded slice of an Arrow batch (see :func:`slices`)
and returns numpy arrays, so no per-character Python code runs in a task.
Hashes are 64-bit polynomial hashes modulo 2**64, finished with an avalanche
step; they depend on the bytes only, never on the batch or the executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20

U64 = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: ASCII white space as in the contracts: space and 0x09 to 0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: ASCII letters, digits and every byte of a multi-byte character.
WORD_BYTE = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
        column = column.fill_null(b"") if column.null_count else column
    else:
        column = column.cast(pa.large_string())
        column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = text_view(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def _power(n: int, base: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            step = np.full(size, base, U64)
            step[0] = 1
            have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Avalanche step on uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ U64(seed)) * U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(32)
        x *= U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(29)
        return x


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running sum from which :func:`span_hash` takes the hash of any span."""
    out = np.zeros(len(raw) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum((raw.astype(U64) + U64(1)) * _power(len(raw), _R), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (prefix[ends] - prefix[starts]) * _power(len(prefix), _R_INV)[starts]
    return mix(h ^ (ends - starts).astype(U64))


def tokens(raw: np.ndarray, offs: np.ndarray,
           inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, counts per text) of maximal runs of bytes with ``inside[b]``; runs never cross texts."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs) - 1, np.int64)
    mask = inside[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    at = np.searchsorted(starts, offs)
    return starts, ends, np.diff(at)


def ngrams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive tokens and the index of their first token; never across texts."""
    total = len(hashes)
    if total < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = hashes[: total - n + 1].copy()
        for t in range(1, n):
            g *= U64(_R)
            g += hashes[t: total - n + 1 + t]
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(total)
    first = np.flatnonzero(left[: total - n + 1] >= n)
    return mix(g[first]), first


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i]+1, ... of all pieces one after the other."""
    total = int(lengths.sum())
    out = np.arange(total, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    out += np.repeat(np.asarray(starts, np.int64) - before, lengths)
    return out
