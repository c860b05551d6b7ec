"""Benchmark decontamination by greedy string tiling.

Texts become tokens (runs of letters, digits and multi-byte characters, ASCII
lower-cased; every character of a script without blanks is a token of its own,
and full-width punctuation parts tokens).  Windows of ``min_match`` tokens, hashed in one Karp-Rabin pass,
are the seeds: a document window that is also a window of a test item joins the
two.  For each joined (document, item) the longest run of seeds on one diagonal
is the longest common passage; it is marked as a tile in both texts, seeds that
touch marked tokens go, and the next longest follows until none is left.  The
tiles do not overlap and may stand in any order, so reordered passages count in
full.  A document is contaminated if the tiles cover at least ``threshold`` of
an item's tokens.

The item windows are broadcast.  Their size is measured first; a test set
beyond ``max_items_bytes`` is split by a hash of the item id into blocks, one of
which at a time is read by the driver, broadcast, compared with all documents and
dropped again; the blocks' verdicts, one narrow row per document, meet at the end.
Seeds of a slice are expanded for ``MAX_SEEDS`` at a time; a document that alone
has more (both texts repeat themselves) is tiled pair by pair, token by token, in
memory that grows with the texts and not with their product.

Defined cases: null and empty texts have no tokens and are clean; items of
fewer than ``min_match`` tokens count as covered in full where all their tokens
stand in a row, if they have ``LEAST_SHORT`` tokens or more, and else only where
they are the whole document; items without tokens are ignored; repeated items
count once each and the smallest id wins ties; an empty test set finds nothing;
every row of the documents is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import LOWER, U64, WORD_BYTE, ngrams, prefix_hash, ragged, slices, span_hash, text_view, tokens
from .spark_ import stored

MIN_MATCH = 5
THRESHOLD = 0.5
MAX_ITEMS_BYTES = 32 << 20
_BITS = 22
#: Items of fewer tokens are too common to be found inside a text.
LEAST_SHORT = 3
#: Seeds (document window, item window) that a task expands at once.
MAX_SEEDS = 1 << 20


#: Scripts written without blanks, as (first, last) code points of three UTF-8 bytes: Thai, Lao, Tibetan, Myanmar, Khmer,
#: iteration marks, kana, bopomofo, Han, Yi, compatibility Han, half-width kana; above U+20000 all are Han.
_ALONE = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
          (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F))
#: Full-width punctuation.
_PARTS = ((0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_CLASS = np.ones(1 << 16, np.uint8)
for _kind, _spans in ((2, _ALONE), (0, _PARTS)):
    for _first, _last in _spans:
        _CLASS[_first: _last + 1] = _kind


def token_spans(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, counts per text) of the tokens."""
    lead = np.flatnonzero(raw[: max(len(raw) - 2, 0)] >= 0xE0)
    if not len(lead):
        return tokens(raw, offs, WORD_BYTE)
    kind, first = WORD_BYTE[raw].astype(np.uint8), np.zeros(len(raw), bool)  # 0 parts tokens, 1 in a run, 2 a token alone
    three, four = lead[raw[lead] < 0xF0], lead[(raw[lead] >= 0xF0) & (raw[lead + 1] >= 0xA0)]
    b0, b1, b2 = (raw[three + k].astype(np.int64) for k in range(3))
    of = _CLASS[((b0 & 15) << 12) | ((b1 & 63) << 6) | (b2 & 63)]
    for k in range(3):
        kind[three + k] = of
    four = four[four + 3 < len(raw)]
    for k in range(4):
        kind[four + k] = 2
    first[three[of == 2]] = first[four] = True
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True
    fresh = np.append(True, kind[1:] != kind[:-1]) | first | edge[:-1]
    starts = np.flatnonzero((kind > 0) & fresh)
    ends = np.flatnonzero((kind > 0) & np.append(fresh[1:], True)) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens per row)."""
    raw, offs = text_view(column)
    raw = LOWER[raw]
    starts, ends, counts = token_spans(raw, offs)
    return span_hash(prefix_hash(raw), starts, ends), counts


def tile(doc: np.ndarray, item: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (doc start, item start, tokens) from seed windows of ``width`` tokens.

    Longest first; equal lengths by document, then item position.
    """
    tiles: list[tuple[int, int, int]] = []
    base = int(doc.min()) if len(doc) else 0
    doc = doc - base
    doc_marked = np.zeros((int(doc.max()) if len(doc) else 0) + width + 1, bool)
    item_marked = np.zeros((int(item.max()) if len(item) else 0) + width + 1, bool)
    while len(doc):
        order = np.lexsort((doc, doc - item))
        doc, item = doc[order], item[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (np.diff(doc) != 1) | (np.diff(item) != 1)
        first = np.flatnonzero(fresh)
        run = np.diff(np.append(first, len(doc)))
        longest = int(run.max())
        size = longest + width - 1
        best = first[run == longest]
        for k in best[np.lexsort((item[best], doc[best]))]:
            d, i = int(doc[k]), int(item[k])
            if not doc_marked[d: d + size].any() and not item_marked[i: i + size].any():
                doc_marked[d: d + size] = item_marked[i: i + size] = True
                tiles.append((d + base, i, size))
        doc_sum, item_sum = (np.concatenate([[0], np.cumsum(m)]) for m in (doc_marked, item_marked))
        keep = (doc_sum[doc + width] == doc_sum[doc]) & (item_sum[item + width] == item_sum[item])
        doc, item = doc[keep], item[keep]
    return tiles


def tile_dense(doc: np.ndarray, item: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """The tiles of :func:`tile` from the tokens themselves, one row of matches at a time."""
    tiles: list[tuple[int, int, int]] = []
    doc_free, item_free = np.ones(len(doc), bool), np.ones(len(item), bool)

    def runs() -> Iterator[tuple[int, np.ndarray]]:  # reads doc_free and item_free as they are at its start
        """For every document token: the lengths of the matches that end there, per item token."""
        length, last = np.zeros(len(item) + 1, np.int64), -1
        for d in np.flatnonzero(np.isin(doc, item) & doc_free).tolist():
            if d - 1 != last:
                length[:] = 0
            last = d
            length[1:] = np.where((item == doc[d]) & item_free, length[:-1] + 1, 0)
            yield d, length[1:]

    while True:
        longest = max((int(n.max()) for _, n in runs()), default=0)
        if longest < width:
            return tiles
        doc_now, item_now = doc_free.copy(), item_free.copy()  # runs() goes on with what was free before
        for d, n in runs():
            for i in np.flatnonzero(n == longest).tolist():
                a, b = slice(d - longest + 1, d + 1), slice(i - longest + 1, i + 1)
                if doc_now[a].all() and item_now[b].all():
                    doc_now[a] = item_now[b] = False
                    tiles.append((a.start, b.start, longest))
        doc_free, item_free = doc_now, item_now


class Items:
    """Seed windows of the test items: sorted hashes with their postings."""

    def __init__(self, ids: list[int], texts: list[str], width: int):
        order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
        hashes, counts = token_hashes(pa.array([texts[k] for k in order], pa.string()))
        self.ids = np.array([ids[k] for k in order], np.int64)
        self.tokens, self.width = counts, width
        gram, first = ngrams(hashes, counts, width)
        begin = np.cumsum(counts) - counts
        self.hashes, self.begin = hashes, begin
        owner = np.repeat(np.arange(len(counts)), counts)[first]
        self.short = []  # (tokens, sorted hashes, items) of the items that are shorter than a window
        for n in np.unique(counts[(counts > 0) & (counts < width)]).tolist():
            whole, at = ngrams(hashes, counts, n)
            of = np.repeat(np.arange(len(counts)), counts)[at]
            whole, of = whole[counts[of] == n], of[counts[of] == n]
            by = np.argsort(whole, kind="stable")
            self.short.append((n, whole[by], of[by]))
        by = np.argsort(gram, kind="stable")
        self.grams, start = np.unique(gram[by], return_index=True)
        self.start = np.append(start, len(gram)).astype(np.int64)
        self.owner, self.at = owner[by], (first - begin[owner])[by]
        self.hint = np.zeros(1 << _BITS, bool)
        self.hint[(self.grams & U64((1 << _BITS) - 1)).astype(np.int64)] = True

    def coverage(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, covered share) for every joined pair."""
        hashes, counts = token_hashes(column)
        gram, first = ngrams(hashes, counts, self.width)
        near = self.hint[(gram & U64((1 << _BITS) - 1)).astype(np.int64)]
        gram, first = gram[near], first[near]
        at = np.minimum(np.searchsorted(self.grams, gram), max(len(self.grams) - 1, 0))
        hit = self.grams[at] == gram if len(self.grams) else np.zeros(len(gram), bool)
        at, first = at[hit], first[hit]
        of_token = np.repeat(np.arange(len(counts)), counts)
        seeds = np.concatenate([[0], np.cumsum(self.start[at + 1] - self.start[at])])
        edge = np.flatnonzero(np.append(True, of_token[first][1:] != of_token[first][:-1])) if len(first) else np.zeros(0, np.int64)
        out, a = [], 0
        ends = np.append(edge[1:], len(first))
        while a < len(edge):  # whole rows, MAX_SEEDS at a time
            b = max(int(np.searchsorted(seeds[ends], seeds[edge[a]] + MAX_SEEDS, "right")), a + 1)
            part = slice(edge[a], ends[b - 1])
            if seeds[part.stop] - seeds[part.start] > MAX_SEEDS:
                out += self._dense(int(of_token[first[part.start]]), hashes, counts, at[part])
            else:
                out += self._sparse(of_token, at[part], first[part])
            a = b
        for n, whole, of in self.short:
            gram, first = ngrams(hashes, counts, n)
            if n < LEAST_SHORT:
                alone = counts[of_token[first]] == n
                gram, first = gram[alone], first[alone]
            begin = np.searchsorted(whole, gram)
            many = np.searchsorted(whole, gram, "right") - begin
            pairs = np.stack([np.repeat(of_token[first], many), of[ragged(begin, many)]])
            out += [(r, i, 1.0) for r, i in np.unique(pairs, axis=1).T]
        rows, items, share = zip(*out) if out else ((), (), ())
        return np.array(rows, np.int64), np.array(items, np.int64), np.array(share, np.float64)

    def _sparse(self, of_token: np.ndarray, at: np.ndarray, first: np.ndarray) -> list[tuple]:
        """Pairs of several rows from their expanded seeds."""
        many = self.start[at + 1] - self.start[at]
        post = ragged(self.start[at], many)
        token = np.repeat(first, many)
        row, item, where = of_token[token], self.owner[post], self.at[post]
        order = np.lexsort((token, item, row))
        row, item, token, where = row[order], item[order], token[order], where[order]
        pair = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])))
        out = []
        for a, b in zip(pair, [*pair[1:], len(row)]):
            covered = sum(n for _, _, n in tile(token[a:b], where[a:b], self.width))
            out.append((row[a], item[a], covered / self.tokens[item[a]]))
        return out

    def _dense(self, row: int, hashes: np.ndarray, counts: np.ndarray, at: np.ndarray) -> list[tuple]:
        """Pairs of one row that repeats what items repeat."""
        stop = int(np.cumsum(counts)[row])
        doc = hashes[stop - counts[row]: stop]
        seen = np.unique(at)
        items = np.unique(self.owner[ragged(self.start[seen], self.start[seen + 1] - self.start[seen])])
        out = []
        for k in items.tolist():
            item = self.hashes[self.begin[k]: self.begin[k] + self.tokens[k]]
            out.append((row, k, sum(n for _, _, n in tile_dense(doc, item, self.width)) / self.tokens[k]))
        return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], *, text_col: str = "text",
                  min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                  max_items_bytes: int = MAX_ITEMS_BYTES) -> DataFrame:
    """``keep`` columns of every row with its verdict.

    ``contaminated`` (0/1), ``n_items`` (items covered to the threshold),
    ``item_id`` and ``coverage`` of the item covered best (null and 0.0 if none
    shares a window).
    """
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // max_items_bytes))
    rows = docs.select(F.col(text_col).alias("_text"), F.struct(*keep).alias("_row"))

    def block_of(k: int) -> Items:
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        return Items([r.item_id for r in part], [r.text for r in part], min_match)

    if blocks == 1:
        out = _judged(rows, "_row", block_of(0), threshold)[0]
    else:
        rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()))
        parts = []
        for k in range(blocks):
            judged, shared = _judged(rows, "_at", block_of(k), threshold)
            parts.append(stored(judged))
            shared.destroy()  # the next block takes its place
        met = reduce(DataFrame.unionByName, parts).groupBy("_at").agg(
            F.sum("_n").cast("int").alias("_n"), F.min(F.struct((-F.col("_share")).alias("s"), F.coalesce("_item", F.lit(2 ** 63 - 1)).alias("i"), "_item")).alias("_b"))
        out = rows.select("_at", "_row").join(met, "_at").select("_row", "_n", "_b._item", (-F.col("_b.s")).alias("_share"))
    return out.select("_row.*", (F.col("_n") > 0).cast("int").alias("contaminated"), F.col("_n").alias("n_items"),
                      F.col("_item").alias("item_id"), (F.col("_share") + F.lit(0.0)).alias("coverage"))


def _judged(rows: DataFrame, carried: str, items: Items, threshold: float) -> tuple[DataFrame, Broadcast]:
    """(``carried``, items covered to the threshold, best item, its share) of every row for one block, and the block's broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    schema = rows.select(carried).schema.add("_n", "integer").add("_item", "long").add("_share", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for part in slices(batches, "_text"):
            n, share = np.zeros(part.num_rows, np.int32), np.zeros(part.num_rows)
            best: list[int | None] = [None] * part.num_rows
            for row, item, cover in zip(*items.coverage(part.column(0))):
                n[row] += cover >= threshold
                if cover > share[row] or (cover == share[row] and best[row] is not None and items.ids[item] < best[row]):
                    share[row], best[row] = cover, int(items.ids[item])
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(n), pa.array(best, pa.int64()), pa.array(share)], names=schema.names)

    return rows.select("_text", carried).mapInArrow(judge, schema), shared
