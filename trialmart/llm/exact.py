"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

1.  Every text becomes the SHA-256 of its normalised form, once, in a narrow
    table (id, digest, row number) written under the checkpoint folder.
2.  A Misra-Gries summary of the digests (Spark's mergeable frequent-items
    sketch) is built map-side, merged in two levels, and names the digests
    that may be frequent.
3.  An exact count verifies them; the winners, at most ``tracked`` rows of some
    100 bytes, are broadcast, and their rows get their answer where they are
    read, without a shuffle.
4.  All other digests meet in an ordinary shuffle.

The summary errs by at most 3.5 / ``tracked`` of the rows and lists whatever it
counts above its error, so a digest of more than 7 / ``tracked`` of all rows is
never in the shuffle; ``tracked`` follows the number of shuffle partitions, which
keeps the largest group of step 4 at about a ninth of a mean partition.  A wrong
guess of the summary would cost time only: every group is counted exactly, on
one side or the other.

Texts are equal when they are identical after each run of ``\\x20\\x09-\\x0D``
became one blank (nothing is trimmed).  Defined cases: a null text is an empty
one; of equal texts the smallest id stays, a null id only where no other is
left, and of rows that repeat the id one of them, so every group keeps exactly
one row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spark_ import cut, shuffle_parts, stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Groups of fewer rows are never worth a row of the broadcast table.
LEAST_COPIES = 64
#: Tasks that merge the summaries of the map side before the last one does.
MERGERS = 64


def tracked_items(parts: int) -> int:
    """Counters of the summary: a power of two, 64 per shuffle partition, at most 2**19 (40 MB)."""
    return 1 << min(19, max(12, (64 * parts - 1).bit_length()))


def frequent(rows: DataFrame, column: str, tracked: int) -> DataFrame:
    """Values of the text ``column`` that may have more than 7 / ``tracked`` of all rows, at most ``tracked`` of them."""
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    part = rows.groupBy(merger.alias("_m")).agg(F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("_s"))
    whole = part.groupBy(F.lit(0).alias("_m")).agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))  # no rows, no summary
    return whole.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {tracked})")).alias("_i")).select(F.col("_i.item").alias(column))


def exact_dedup(docs: DataFrame, keep: Sequence[str] = (), *, id_col: str = "doc_id", text_col: str = "text",
                tracked: int | None = None, least_copies: int = LEAST_COPIES) -> DataFrame:
    """``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and the columns ``keep`` of every row."""
    tracked = tracked or tracked_items(shuffle_parts(docs.sparkSession))
    normal = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), BLANKS, " ")
    carried = [c for c in keep if c != id_col]
    rows = stored(docs.select(F.col(id_col).alias("_id"), F.sha2(normal, 256).alias("_digest"),
                              F.monotonically_increasing_id().alias("_row"),
                              *([F.struct(*carried).alias("_carried")] if carried else [])))
    total = rows.count()
    least = max(least_copies, 7 * total // tracked)

    counted = (rows.join(F.broadcast(frequent(rows, "_digest", tracked)), "_digest")
               .groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_keep"))
               .where(F.col("_n") >= least))
    counted = cut(counted)
    first = (rows.join(F.broadcast(counted), "_digest").where(F.col("_id").eqNullSafe(F.col("_keep")))
             .groupBy("_digest").agg(F.min("_row").alias("_first")))
    winners = cut(counted.join(F.broadcast(first), "_digest"))

    own = [F.col("_id").alias(id_col)]
    digest = [F.col("_digest").alias("text_sha256"), *(F.col("_carried").getField(c).alias(c) for c in carried)]
    hot = rows.join(F.broadcast(winners), "_digest").select(
        *own, F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"), (F.col("_row") == F.col("_first")).alias("kept"), *digest)
    order = Window.partitionBy("_digest").orderBy(F.col("_id").asc_nulls_last(), "_row")
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one sort serves both
    rest = rows.join(F.broadcast(winners.select("_digest")), "_digest", "left_anti").select(
        *own, F.first("_id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"), *digest)
    return hot.unionByName(rest)
