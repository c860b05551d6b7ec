"""Suffix-array dedup by difference-cover blockwise construction.

Removes every byte of a document that a 50-byte string covers which also starts
in a document with a smaller id.  Runs of windows that share a minimiser are
sent to buckets of bounded text (see :mod:`repeats`); a bucket's distinct
strings form one text, whose suffixes are put in order blockwise:

* Positions whose residue modulo ``PERIOD`` is in a difference cover are
  ranked first, by their first 32 bytes and then, by one doubling step, by 64.
* The suffixes are dealt into blocks by their first two bytes and one block at
  a time is sorted by the first 32 bytes, so the keys of one block at most are
  in memory.
* Suffixes that still tie have some offset below ``PERIOD`` at which both stand
  on the cover; the precomputed ranks there decide.

Neighbours in the order that agree in 50 bytes are one class of windows.  The
strings stand one after another, so a suffix may run into the next string; that
changes the order only beyond its 50 bytes.

Defined cases: a null text is empty; a text under 50 bytes keeps all; a null id
is never smaller or larger than another, so its text is kept and removes
nothing; rows that repeat id and text are one document and get equal results;
texts under the same id do not remove from each other; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bytes_ import U64, ragged
from .repeats import WINDOW, find_repeats

GRAM = 20
PERIOD = 32
#: Suffixes sorted at once, unless more share their first two bytes.
BLOCK = 1 << 17


def difference_cover(period: int) -> list[int]:
    """Residues whose differences give every residue: greedily the one that adds most differences."""
    cover, have = [0], {0}
    while len(have) < period:
        new = lambda x: {(x - c) % period for c in cover} | {(c - x) % period for c in cover}
        best = max((x for x in range(period) if x not in cover), key=lambda x: (len(new(x) - have), -x))
        have |= new(best)
        cover.append(best)
    return sorted(cover)


COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Least offset at which residues a and b both stand on the cover.
_SHIFT = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD])
                    for b in range(PERIOD)] for a in range(PERIOD)], np.int64)


class Order:
    """Suffix order of a text, to a depth of more than ``WINDOW`` bytes."""

    def __init__(self, raw: np.ndarray):
        self.n = len(raw)
        text = np.zeros(self.n + 3 * PERIOD + 16, np.uint8)
        text[: self.n] = raw
        self.word = np.zeros(len(text) - 8, U64)  # eight bytes from every position, the first one highest
        for k in range(8):
            self.word |= text[k: len(text) - 8 + k].astype(U64) << U64(56 - 8 * k)
        self.rank = np.zeros(self.n + 2 * PERIOD, np.int32)  # of cover positions; 0 beyond the end
        sample = np.flatnonzero(_IN_COVER[np.arange(self.n) % PERIOD])
        if not len(sample):
            return
        order, head = self._sorted(sample)
        self.rank[order] = np.cumsum(head)
        ahead = self.rank[np.minimum(sample + PERIOD, self.n + PERIOD)]
        key = self.rank[sample].astype(np.int64) * (len(sample) + 2) + ahead
        _, rank = np.unique(key, return_inverse=True)
        self.rank[sample] = rank + 1

    def _sorted(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions by their first 32 bytes, and where a new value begins."""
        keys = [self.word[at + 8 * k] for k in range(4)]
        by = np.lexsort(keys[::-1])
        head = np.ones(len(by), bool)
        head[1:] = np.logical_or.reduce([k[by][1:] != k[by][:-1] for k in keys])
        return at[by], head

    def sort(self, at: np.ndarray) -> np.ndarray:
        """Positions in suffix order."""
        order, head = self._sorted(at)
        place = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))  # first place of the own tie
        size = np.diff(np.append(np.flatnonzero(head), len(order)))
        open_ = np.repeat(size > 1, size)
        where = np.flatnonzero(open_)
        while len(where):  # split every tie around one of its suffixes, by ranks on the cover
            pos, tie = order[where], place[where]
            edge = np.flatnonzero(np.append(True, tie[1:] != tie[:-1]))
            many = np.diff(np.append(edge, len(where)))
            pivot = np.repeat(pos[edge + many // 2], many)
            shift = _SHIFT[pos % PERIOD, pivot % PERIOD]
            side = np.sign(self.rank[pos + shift].astype(np.int64) - self.rank[pivot + shift])
            by = np.lexsort((side, tie))
            order[where], side = pos[by], side[by]
            head = np.ones(len(where), bool)
            head[1:] = (tie[1:] != tie[:-1]) | (side[1:] != side[:-1])
            first = np.flatnonzero(head)
            size = np.diff(np.append(first, len(where)))
            place[where] = np.repeat(where[first], size)
            where = where[np.repeat(size > 1, size) & (side != 0)]
        return order

    def classes(self, at: np.ndarray) -> np.ndarray:
        """Class of the ``WINDOW`` bytes from every position: equal strings, equal classes."""
        out = np.empty(len(at), np.int64)
        lead = (self.word[at] >> U64(48)).astype(np.uint16)
        by = np.argsort(lead, kind="stable")
        border = np.flatnonzero(np.append(True, lead[by][1:] != lead[by][:-1]))
        back = np.empty(self.n, np.int64)
        back[at] = np.arange(len(at))
        begin, base = 0, 0
        for end in np.append(border[1:], len(by)):
            if end - begin < BLOCK and end < len(by):
                continue
            order = self.sort(at[by[begin:end]])
            head = np.ones(len(order), bool)
            same = np.ones(len(order) - 1, bool)
            for k in (*range(0, WINDOW - 7, 8), WINDOW - 8):
                same &= self.word[order[1:] + k] == self.word[order[:-1] + k]
            head[1:] = ~same
            out[back[order]] = base + np.cumsum(head) - 1
            begin, base = end, base + int(head.sum())
        return out


def byte_classes(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows per string, class of each window) for strings of at least ``WINDOW`` bytes."""
    windows = sizes - WINDOW + 1
    return windows, Order(raw).classes(ragged(np.cumsum(sizes) - sizes, windows))


def _finish(with_text: bool):
    def finish(text: bytes, covered: np.ndarray | None) -> tuple:
        n = len(text)
        if covered is None:
            covered = np.array([[0, n]] if n >= WINDOW else [], np.int64).reshape(-1, 2)
        kept, at, gone = [], 0, 0
        for a, b in covered.tolist():
            kept.append(text[at:a])
            at, gone = b, gone + b - a
        rest = b"".join([*kept, text[at:]])
        return (n, gone, len(covered), hashlib.sha256(rest).hexdigest(),
                *([rest.decode("utf-8", "ignore")] if with_text else []))
    return finish


def remove_repeated_bytes(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text",
                          with_text: bool = False) -> DataFrame:
    """``keep`` columns of every row with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and,
    ``with_text``, ``kept_text`` (bytes of characters that were cut apart are left out of it)."""
    out = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    if with_text:
        out = out.add("kept_text", "string")
    return find_repeats(docs, kind="byte", gram=GRAM, classes=byte_classes, finish=_finish(with_text), out=out,
                        id_col=id_col, text_col=text_col, keep=keep)
