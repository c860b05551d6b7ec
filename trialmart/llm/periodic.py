"""Runs of words that repeat with a period, by internal pattern matching.

A run is a maximal stretch of words with smallest period q and a length of at
least ``max(6, 4 q)``.  Per batch of whole texts:

1.  Words become numbers, and the blocks of 2, 4, 8 ... words that a text holds
    more than once become classes: a block's class is made from the classes of
    its halves, so each level only looks at blocks that repeated on the level
    before.  The levels sort the suffixes as deep as any block needs; a class is
    an interval of that suffix array, its members lie in one text.
2.  A wavelet tree over the suffix array answers "the first occurrence of this
    block after position p" (range successor) for all blocks of a level at once.
3.  Blocks of b words stand at every b/2-th word.  Every run with a period in
    (b/2, b] holds such a block followed by its next occurrence one period on:
    within a run the occurrences of a block of at least one period form a
    progression whose difference is the smallest period.  So a next occurrence
    in the neighbouring window, more than b/2 and at most b words on, gives a
    candidate (position, period).
4.  A candidate is extended to both sides by comparing blocks of falling size
    by their classes, exactly, and kept if the stretch is long enough.  Its
    period is the smallest one: with a smaller period the block's next
    occurrence would have been nearer.

Rows are independent: nothing is shuffled, and a worker holds one slice of a
batch, at most ``BATCH_BYTES`` of text or one longer text, with 12 bytes for
every repeated block of a level beside some 100 bytes for a word.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null or blank text has no
words, no runs and an empty remainder; a text of fewer than six words has no
runs; rows that repeat an id or a text get equal results; ids may be null, they
are only carried; an empty table gives no rows; a kept column that is named
like a result gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytes_ import NOT_SPACE, ragged, slices, text_view, tokens

BATCH_BYTES = 2 << 20
LEAST_LENGTH = 6
LEAST_PERIODS = 4

RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
RESULTS = T.StructType().add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed_text", "string")


class WaveletTree:
    """Rank and quantile queries over a sequence of numbers, many at a time."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1 == 1
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at [low, high) are smaller than ``bound``."""
        count = np.zeros(len(low), np.int64)
        for depth, bit in enumerate(reversed(range(self.bits))):
            a, b = self.ones[depth][low].astype(np.int64), self.ones[depth][high].astype(np.int64)
            one = (bound >> bit) & 1 == 1
            count += np.where(one, (high - b) - (low - a), 0)
            low = np.where(one, self.zeros[depth] + a, low - a)
            high = np.where(one, self.zeros[depth] + b, high - b)
        return count

    def quantile(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at [low, high), which must have as many."""
        value = np.zeros(len(low), np.int64)
        for depth, bit in enumerate(reversed(range(self.bits))):
            a, b = self.ones[depth][low].astype(np.int64), self.ones[depth][high].astype(np.int64)
            zeros = (high - b) - (low - a)
            one = k >= zeros
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - zeros, k)
            low = np.where(one, self.zeros[depth] + a, low - a)
            high = np.where(one, self.zeros[depth] + b, high - b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The smallest value above ``after`` at [low, high), -1 if there is none; values stay below 2**bits."""
        k = self.below(low, high, np.minimum(after + 1, (1 << self.bits) - 1))
        k += (after + 1 >> self.bits > 0) * (high - low)  # the bound lies above all values
        out = np.full(len(low), -1, np.int64)
        have = k < high - low
        out[have] = self.quantile(low[have], high[have], k[have])
        return out


def _groups(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first member, members) of groups of neighbours; ``fresh`` marks the first ones."""
    first = np.flatnonzero(fresh)
    return first, np.diff(np.append(first, len(fresh)))


class Blocks:
    """The repeated blocks of 2**level words of a batch: places, first suffix array slot and size of their class."""

    def __init__(self, words: np.ndarray, owner: np.ndarray, longest_period: int):
        self.words, self.owner = words, owner
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = np.flatnonzero(owner[1:] == owner[:-1])
        kinds, texts = (int(x.max()) + 1 if len(x) else 1 for x in (words, owner))
        if kinds * kinds * texts < 1 << 62:
            key = (owner[at] * kinds + words[at]) * kinds + words[at + 1]
            order = np.argsort(key)
            at, key = at[order], key[order]
            fresh = np.append(True, key[1:] != key[:-1])[: len(at)]
        else:
            at = at[np.lexsort((words[at + 1], words[at], owner[at]))]
            a, b = at[:-1], at[1:]
            fresh = np.append(True, (words[a] != words[b]) | (words[a + 1] != words[b + 1]) | (owner[a] != owner[b]))[: len(at)]
        _, many = _groups(fresh)
        at = at[np.repeat(many, many) > 1]
        many = many[many > 1]
        low, size = np.repeat(np.cumsum(many) - many, many), np.repeat(many, many)
        self.suffixes = at.copy()
        length = 2
        while True:
            order = np.argsort(at)
            self.levels.append(tuple(x[order].astype(np.int32) for x in (at, low, size)))
            if not len(at) or length + 1 > longest_period:
                break
            # Members without a repeated second half come last in their class and leave.
            none = len(self.suffixes)
            second = self._class(len(self.levels), at + length)
            second[second < 0] = none
            order = np.lexsort((second, low))
            at, low, second = at[order], low[order], second[order]
            first, many = _groups(np.append(True, low[1:] != low[:-1]))
            slot = low + np.arange(len(low)) - np.repeat(first, many)
            self.suffixes[slot] = at
            stay = second < none
            at, low, second, slot = at[stay], low[stay], second[stay], slot[stay]
            first, many = _groups(np.append(True, (low[1:] != low[:-1]) | (second[1:] != second[:-1]))[: len(at)])
            low, size = np.repeat(slot[first], many), np.repeat(many, many)
            at, low, size = at[size > 1], low[size > 1], size[size > 1]
            length *= 2

    def _class(self, level: int, place: np.ndarray) -> np.ndarray:
        """Class of the blocks of 2**level words at ``place``; -1 if they don't repeat, or leave their text."""
        at, low, _ = self.levels[level - 1]
        if not len(at):
            return np.full(len(place), -1, np.int64)
        k = np.minimum(np.searchsorted(at, place), len(at) - 1)
        return np.where(at[k] == place, low[k], -1).astype(np.int64)

    def _same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are the blocks of 2**level words at ``a`` and ``b`` equal, each within one text?"""
        if level:
            first = self._class(level, a)
            return (first >= 0) & (first == self._class(level, b))
        inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(self.words))
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        return inside & (self.words[a] == self.words[b]) & (self.owner[a] == self.owner[b])

    def reach(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``a`` and ``b`` on agree, to the right (step 1) or, from before them, to the left (-1)."""
        total = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels) + 1)):
            width, live = 1 << level, np.arange(len(a))
            while len(live):
                move = total[live] if step > 0 else -total[live] - width
                live = live[self._same(level, a[live] + move, b[live] + move)]
                total[live] += width
                if level < len(self.levels):
                    break  # two in a row would have been one block of the level above
        return total


def find_runs(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; ``words`` are numbers, ``owner`` ascends."""
    counts = np.bincount(owner) if len(owner) else np.zeros(1, np.int64)
    blocks = Blocks(words, owner, int(counts.max()) // LEAST_PERIODS)
    tree = WaveletTree(blocks.suffixes)
    places, periods = [], []
    for level, (at, low, size) in enumerate(blocks.levels, 1):
        width = 1 << level
        half = width // 2 if level > 1 else 0  # the shortest blocks serve the periods 1 and 2
        grid = at % max(1, half) == 0
        at, low, size = (x[grid].astype(np.int64) for x in (at, low, size))
        following = tree.successor(low, low + size, at)
        gap = following - at
        near = (following >= 0) & (gap > half) & (gap <= width)
        places.append(at[near])
        periods.append(gap[near])
    at, period = np.concatenate(places), np.concatenate(periods)
    left, right = blocks.reach(at, at + period, -1), blocks.reach(at, at + period, 1)
    start, length = at - left, left + right + period
    long = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
    runs = np.unique(np.stack([start[long], period[long], length[long]], 1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _batch(column: pa.Array) -> list[pa.Array]:
    raw, offs = text_view(column)
    starts, ends, counts = tokens(raw, offs, NOT_SPACE)
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts),
                                               [None, pa.py_buffer(offsets), pa.py_buffer(raw[NOT_SPACE[raw]])])
    words = spelled.dictionary_encode().indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    start, length, period = find_runs(words, owner)
    whose = owner[start] if len(start) else start
    n_runs = np.bincount(whose, minlength=len(counts))
    runs = pa.StructArray.from_arrays([pa.array(start - first[whose]), pa.array(length), pa.array(period)], names=RUN.names)
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32)), runs)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    # The kept words with one blank after each; a text's last blank goes.
    many = np.bincount(owner[kept], minlength=len(counts))
    size = sizes[kept]
    at = np.cumsum(size + 1) - size - 1
    text = np.full(int((size + 1).sum()), 0x20, np.uint8)
    text[ragged(at, size)] = raw[ragged(starts[kept], size)]
    edge = np.concatenate([[0], np.cumsum(size + 1)])[np.concatenate([[0], np.cumsum(many)])]
    data = text.tobytes()
    rest = [data[a: max(a, b - 1)].decode("utf-8") for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    return [pa.array(counts, pa.int64()), runs, pa.array(rest, pa.string())]


def periodic_runs(docs: DataFrame, keep: Sequence[str], *, text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``n_words``, ``runs`` (by start, then period) and ``collapsed_text``.

    ``collapsed_text`` has the words that no run holds after its first period,
    joined by one blank.
    """
    keep = [c for c in keep if c not in RESULTS.names]
    rows = docs.select(F.col(text_col).alias("_text"), F.struct(*keep).alias("_row"))
    schema = T.StructType([rows.schema["_row"], *RESULTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([part.column(1), *_batch(part.column(0))], names=schema.names)

    return rows.mapInArrow(run, schema).select("_row.*", *RESULTS.names)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties to the smallest start, then period."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    return F.aggregate(runs, F.get(runs, 0), lambda best, r: F.when(more(r, best), r).otherwise(best))
