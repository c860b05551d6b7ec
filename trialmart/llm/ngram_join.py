"""N-gram Jaccard join by MinHash banding.

A document is the set of its word n-grams (words between white space, taken as
they are; fewer than ``n`` words make one n-gram).  Equal texts are one class
from the start and only their first id travels on.  Rows per band and bands are
chosen for the target recall at the threshold; representatives meet on band
hashes.  Band mates are linked to the smallest id of their bucket only, so a
bucket of m gives m rows, never m squared; the connected groups of these stars
hold every pair that any band joins.  A group is dealt into blocks of bounded
bytes by a hash of the id, and each pair of blocks is one unit of work that
verifies *all* its pairs on the full n-gram sets with blocked set products, so
a group of any size is split over many tasks and nothing is capped.  A unit
returns one row per linked document (its links and a root), never pairs.

Defined cases: a null or blank text has no n-grams and links with nothing;
null ids pass through as their own class; rows that repeat id and text are
copies like any other; an id with several texts is one vertex, which links its
texts' classes; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import NOT_SPACE, U64, mix, ngrams, prefix_hash, slices, span_hash, text_view, tokens
from .spark_ import components, cut

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
#: Text bytes of one block of a candidate group; a unit of work holds two blocks.
BLOCK_BYTES = 2 << 20
#: Most documents of a block, on average (a unit holds a matrix over the documents of two blocks).
BLOCK_ROWS = 1024


def banding(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest rows, so the fewest chance candidates, that reach the recall within ``most`` hashes."""
    for rows in range(most, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** rows)))
        if bands * rows <= most:
            return bands, rows
    return most, 1


def gram_hashes(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes of all rows, number per row), with repeats."""
    raw, offs = text_view(column)
    starts, ends, counts = tokens(raw, offs, NOT_SPACE)
    words = span_hash(prefix_hash(raw), starts, ends)
    gram, first = ngrams(words, counts, n)
    many = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        begin = np.cumsum(counts) - counts
        one = np.full(len(short), n, U64)
        with np.errstate(over="ignore"):
            for t in range(n - 1):
                more = counts[short] > t
                one[more] = mix(one[more] * U64(31) + words[begin[short[more]] + t])
        at = (np.cumsum(many) - many)[short]
        gram = np.insert(gram, at, one)
        many[short] = 1
    return gram, many


def signatures(gram: np.ndarray, many: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(rows of the batch, bands) hashes; rows without n-grams get arbitrary values."""
    out = np.zeros((len(many), bands), U64)
    full = np.flatnonzero(many > 0)
    if not len(full):
        return out
    at = (np.cumsum(many) - many)[full]
    low = gram.astype(np.uint32) ^ (gram >> U64(32)).astype(np.uint32)
    rng = np.random.default_rng(20240229)
    step = rng.integers(1, 1 << 32, (bands, rows), dtype=np.uint32) | np.uint32(1)
    add = rng.integers(0, 1 << 32, (bands, rows), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(full), b + 1, U64)
            for r in range(rows):
                x = low * step[b, r] + add[b, r]
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                h = mix(h * U64(0x100000001B3) + np.minimum.reduceat(x, at).astype(U64))
            out[full, b] = h
    return out


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


class _Unit:
    """All pairs between the documents of side 0 and side 1 (or within side 0) of one unit."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, side: np.ndarray, texts: pa.Array, n: int, threshold: float):
        gram, many = gram_hashes(texts, n)
        owner = np.repeat(np.arange(len(ids)), many)
        order = np.lexsort((gram, owner))
        gram, owner = gram[order], owner[order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner = gram[fresh], owner[fresh]
        size = np.bincount(owner, minlength=len(ids))
        _, column, df = np.unique(gram, return_inverse=True, return_counts=True)
        total = len(ids)
        shared = np.zeros((total, total), np.float32)
        rare = (df[column] > 1) & (df[column] <= 16)
        by = np.argsort(column[rare], kind="stable")
        col, own = column[rare][by], owner[rare][by]
        for lag in range(1, 16):  # rare n-grams: their few holders, pair by pair
            same = np.flatnonzero(col[lag:] == col[:-lag])
            if not len(same):
                break
            np.add.at(shared, (own[same], own[same + lag]), np.float32(1))
            np.add.at(shared, (own[same + lag], own[same]), np.float32(1))
        common = df > 16
        number = np.cumsum(common) - 1
        entry = common[column]
        col, own = number[column[entry]], owner[entry]
        for at in range(0, int(common.sum()), 1024):  # common n-grams: products of 0/1 blocks
            pick = (col >= at) & (col < at + 1024)
            x = np.zeros((total, min(1024, int(common.sum()) - at)), np.float32)
            x[own[pick], col[pick] - at] = 1
            shared += x @ x.T
        union = (size[:, None] + size[None, :]).astype(np.float32) - shared
        ratio = Fraction(threshold).limit_denominator(10_000)  # whole numbers, so the border itself counts
        close = (shared * np.float32(ratio.denominator) >= union * np.float32(ratio.numerator)) & (union > 0)
        np.fill_diagonal(close, False)
        if (side == 1).any():
            close &= side[:, None] != side[None, :]
        self.ids, self.links = ids, close @ copies
        self.root = ids.copy()
        while True:
            near = np.where(close, self.root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
            low = np.minimum(self.root, near)
            if (low == self.root).all():
                break
            self.root = low


def jaccard_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                 threshold: float = THRESHOLD, recall: float = RECALL, block_bytes: int = BLOCK_BYTES,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (id, class_id, n_links) per row of ``docs``.

    ``class_id`` is the smallest id reachable by links, ``n_links`` the number
    of other rows with a similarity of ``threshold`` or more.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    bands, per = banding(threshold, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            gram, many = gram_hashes(part.column(1), n)
            sig = signatures(gram, many, bands, per).view(np.int64)
            raw, offs = text_view(part.column(1))
            data = raw.tobytes()
            digest = [_digest(data[a:b]) for a, b in zip(offs, offs[1:])]
            offsets = pa.array(np.arange(0, sig.size + 1, bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(digest, pa.binary()), pa.array(many > 0), pa.array(np.diff(offs)),
                 pa.ListArray.from_arrays(offsets, pa.array(sig.ravel()))],
                names=["_id", "_digest", "_full", "_bytes", "_bands"])

    signed = cut(rows.mapInArrow(sign, "_id long, _digest binary, _full boolean, _bytes long, _bands array<long>"))
    usable = signed.where("_full and _id is not null")
    reps = usable.groupBy("_digest").agg(F.min("_id").alias("_rep"), F.count("*").alias("_copies"),
                                         F.min_by(F.struct("_bytes", "_bands"), "_id").alias("_s"))
    banded = reps.select("_rep", F.explode("_s._bands").alias("_band"))
    hubs = (banded.groupBy("_band").agg(F.min("_rep").alias("_hub"), F.count("*").alias("_m"))
            .where("_m > 1").drop("_m"))
    group = components(banded.join(hubs, "_band").select("_rep", "_hub").distinct(), "_rep", "_hub")
    members = cut(reps.join(group.select(F.col("id").alias("_rep"), F.col("root").alias("_group")), "_rep")
                  .select("_rep", "_digest", "_copies", "_group", F.col("_s._bytes").alias("_bytes")))
    size = F.greatest(F.ceil(F.sum("_bytes") / block_bytes), F.ceil(F.count("*") / block_rows))
    dealt = members.groupBy("_group").agg(size.cast("int").alias("_blocks"), F.count("*").alias("_m")).where("_m > 1")
    block = F.pmod(F.xxhash64("_rep", F.lit(7)), F.col("_blocks")).cast("int")
    placed = (members.join(dealt, "_group").withColumn("_block", block)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .select("_rep", "_digest", "_copies", "_group",
                      F.least("_block", "_other").alias("_p"), F.greatest("_block", "_other").alias("_q"),
                      (F.col("_block") > F.col("_other")).cast("int").alias("_side")))
    units = (rows.join(placed, F.col("_id") == F.col("_rep"))
             .select("_group", "_p", "_q", "_side", "_rep", "_digest", "_copies", "_text")
             .repartition("_group", "_p", "_q").sortWithinPartitions("_group", "_p", "_q", "_rep"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_ = (row for part in slices(batches, "_text") for row in zip(*(c.to_pylist() for c in part.columns)))
        for _, unit in groupby(rows_, key=lambda r: r[:3]):
            kept = {(rep, digest): (side, copies, text or "") for _, _, _, side, rep, digest, copies, text in unit
                    if _digest((text or "").encode()) == digest}  # an id may come with several texts, and twice
            if len(kept) < 2:
                continue
            side, copies, texts = zip(*kept.values())
            u = _Unit(np.array([rep for rep, _ in kept], np.int64), np.array(copies, np.int64), np.array(side),
                      pa.array(texts, pa.large_string()), n, threshold)
            hit = u.links > 0
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(u.ids[hit]), pa.array(u.links[hit]), pa.array(u.root[hit])],
                                                 names=["_rep", "_n", "_root"])

    linked = cut(units.mapInArrow(verify, "_rep long, _n long, _root long"))
    links = linked.groupBy("_rep").agg(F.sum("_n").alias("_n"))
    classes = components(linked.select("_rep", "_root").distinct(), "_rep", "_root").withColumnRenamed("id", "_rep")
    per_text = (reps.join(classes, "_rep", "left").join(links, "_rep", "left")
                .select(F.col("_digest").alias("_d"), F.coalesce("root", "_rep").alias("_class"),
                        (F.coalesce("_n", F.lit(0)) + F.col("_copies") - 1).alias("_n")))
    out = signed.join(per_text, (F.col("_digest") == F.col("_d")) & F.col("_full") & F.col("_id").isNotNull(), "left")
    return out.select(F.col("_id").alias(id_col), F.coalesce("_class", "_id").alias("class_id"),
                      F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"))
