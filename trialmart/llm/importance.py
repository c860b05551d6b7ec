"""Importance resampling of documents towards a target collection.

Hashed 1- to 3-gram counts of all documents and of all target texts give every
bucket a log ratio (its gain); a document's weight is the sum over its
features.  Gumbel noise, drawn from the id, is added and the highest scores are
taken, which is a draw without replacement in proportion to the weights.

A batch's texts are joined with a separator between any two, one regular
expression finds the words of all of them in one pass, a binary search in the
documents' offsets tells whose each word is, and n-grams whose first and last
word differ in that are masked before the counts are taken.  N-grams are hashed
from the CRCs of their words (:mod:`crc`).  What leaves a task are one counter
per bucket, or one narrow row per document; the ranks come from a range
partitioned sort with the counts of the partitions before, so nothing meets in
one task.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.  Defined
cases: a null or wordless text has no features and weight 0; a document with
fewer than ``least_words`` words or without an id is never drawn and does not
count for the size of the draw (without an id it has no score either); equal
scores go to the smaller id, rows that repeat the id in any order; an empty
target or an empty table makes every gain follow from the other side alone; an
empty table of documents gives no rows; a kept column that is named like a
result gives way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytes_ import slices, text_view
from .crc import crc32_spans, joined
from .spark_ import shuffle_parts, stored

BUCKETS = 10_000
LONGEST = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
RESULTS = ("n_words", "n_features", "weight", "score", "rank")

#: Bytes of a word after lower-casing: digits, letters and all bytes of characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
BATCH_BYTES = 2 << 20


class Features:
    """The hashed n-grams of a batch of texts: (document, bucket) arrays for n = 1, 2, 3."""

    def __init__(self, column: pa.Array, buckets: int = BUCKETS):
        raw, offs = text_view(column)
        data = raw.tobytes()
        text = SEPARATOR.join([data[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]).lower()
        self.documents = len(offs) - 1
        begins = offs[:-1] + np.arange(self.documents)
        spans = np.fromiter(chain.from_iterable(m.span() for m in WORD.finditer(text)), np.int64).reshape(-1, 2)
        starts, ends = spans[:, 0], spans[:, 1]
        self.owner = np.searchsorted(begins, starts, "right") - 1
        bytes_ = np.frombuffer(text, np.uint8)
        word = crc32_spans(bytes_, starts, ends)
        blank = np.full(len(word), crc32_spans(np.array([0x20], np.uint8), np.array([0]), np.array([1]))[0])
        sizes = ends - starts
        spaced = joined(blank, word, sizes)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = [(self.owner, word % np.uint32(buckets))]
        run = word
        for n in range(2, LONGEST + 1):
            run = joined(run[:-1], spaced[n - 1:], sizes[n - 1:] + 1)
            inside = self.owner[: len(run)] == self.owner[n - 1:]
            self.grams.append((self.owner[: len(run)][inside], run[inside] % np.uint32(buckets)))

    def counts(self, buckets: int = BUCKETS) -> np.ndarray:
        return sum(np.bincount(b, minlength=buckets) for _, b in self.grams)

    def per_document(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, weight) of every document of the batch."""
        words = np.bincount(self.owner, minlength=self.documents)
        features = sum(np.bincount(o, minlength=self.documents) for o, _ in self.grams)
        weight = np.zeros(self.documents, np.int64)
        for owner, bucket in self.grams:
            total = np.concatenate([[0], np.cumsum(gains[bucket])])  # owners ascend
            edge = np.searchsorted(owner, np.arange(self.documents + 1))
            weight += total[edge[1:]] - total[edge[:-1]]
        return words, features, weight


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; a task sends one counter per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "_text", BATCH_BYTES):
            total += Features(part.column(0), buckets).counts(buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).alias("_text")).mapInArrow(count, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, *, text_col: str = "text", target_col: str = "text",
                 buckets: int = BUCKETS) -> np.ndarray:
    """``floor(1000 ln ((t+1)(S+buckets) / ((s+1)(T+buckets))))`` per bucket; ``buckets`` counters reach the driver."""
    sides = []
    for texts, column in ((docs, text_col), (target, target_col)):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(texts, column, buckets).collect():
            n[row["bucket"]] = row["n"]
        sides.append(n)
    s, t = (n.astype(np.float64) for n in sides)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, keep: Sequence[str], *, text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``n_words``, ``n_features`` and ``weight``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    rows = docs.select(F.col(text_col).alias("_text"), F.struct(*keep).alias("_row"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", BATCH_BYTES):
            values = Features(part.column(0), len(shared.value)).per_document(shared.value)
            yield pa.RecordBatch.from_arrays([part.column(1), *(pa.array(v, pa.int64()) for v in values)],
                                             names=["_row", "n_words", "n_features", "weight"])

    schema = T.StructType([rows.schema["_row"]]).add("n_words", "long").add("n_features", "long").add("weight", "long")
    return rows.mapInArrow(score, schema).select("_row.*", "n_words", "n_features", "weight")


def draw(weighed: DataFrame, *, id_col: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS,
         seed: int = SEED) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``: 1, 2, 3 ... for the drawn rows, null for the others."""
    key = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    noise = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = stored(weighed.withColumns({"score": F.col("weight") + gumbel, "_at": F.monotonically_increasing_id()}))
    fit = F.coalesce((F.col("n_words") >= least_words) & F.col(id_col).isNotNull(), F.lit(False))
    able = rows.where(fit)
    size = percent * able.count() // 100
    order = [F.col("score").desc(), F.col(id_col).asc(), F.col("_at").asc()]
    # Written once: the counts of the partitions and the rows must come from the same order.
    placed = stored(able.repartitionByRange(shuffle_parts(rows.sparkSession), *order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))  # a row per partition
    ranked = (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
              .withColumn("rank", F.when(F.col("_before") + place <= size, F.col("_before") + place)).drop("_part", "_before"))
    rest = rows.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("_at")


def resample(docs: DataFrame, target: DataFrame, keep: Sequence[str] = ("doc_id",), *, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``keep`` columns (``id_col`` among them) of every row with ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``."""
    gains = bucket_gains(docs, target, text_col=text_col, target_col=target_col, buckets=buckets)
    keep = [c for c in keep if c not in RESULTS]
    return draw(weigh(docs, gains, keep, text_col=text_col), id_col=id_col, percent=percent, least_words=least_words, seed=seed)
