"""Hot join keys, measured and split in proportion to their share.

A frequent-items summary of the key column (Spark's mergeable sketch, built
map-side, merged in two levels) names the keys that hold more than a set part
of a mean shuffle partition.  Only those are salted, each with as many sub-keys
as its share needs; every other key joins unsalted.  The table of heavy keys is
bounded: shares add up to one, so their sub-keys add up to ``pieces`` per shuffle
partition at most, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sub-keys per mean shuffle partition.  They fall on partitions by hash; sixteen
#: keep the fullest of some hundred partitions near one and a half times the mean.
PIECES = 16
#: A key is heavy from this part of a mean partition on.
HEAVY_PART = 0.25
#: Tasks that merge the summaries of the map side before the last one does.
MERGERS = 64


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tracked_items(parts: int, heavy_part: float = HEAVY_PART) -> int:
    """Counters that find every key above ``heavy_part`` of a mean partition: the summary errs by 3.5 / counters."""
    return 1 << min(19, max(10, int(7 * parts / heavy_part).bit_length()))


def _summarised(keys: DataFrame, key: str, tracked: int) -> DataFrame:
    """(``key``, ``rows``, ``__all``: rows with any key) of the frequent keys, in one pass over ``keys``."""
    named = keys.select(F.col(key).alias("__k")).where("__k IS NOT NULL")
    part = (named.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("__m"))
            .agg(F.expr(f"approx_top_k_accumulate(__k, {tracked})").alias("__s"), F.count(F.lit(1)).alias("__n")))
    whole = part.groupBy(F.lit(0).alias("__m")).agg(F.expr(f"approx_top_k_combine(__s, {tracked})").alias("__s"),
                                                    F.sum("__n").alias("__all"))
    items = whole.select(F.explode(F.expr(f"approx_top_k_estimate(__s, {tracked})")).alias("__i"), "__all")
    return items.select(F.col("__i.item").alias(key), F.col("__i.count").alias("rows"), "__all")


def frequent_keys(keys: DataFrame, key: str, tracked: int) -> DataFrame:
    """(``key``, estimated rows) of the keys that may hold more than 7 / ``tracked`` of the rows; at most ``tracked`` rows."""
    return _summarised(keys, key, tracked).drop("__all")


def heavy_keys(keys: DataFrame, key: str, *, parts: int | None = None, pieces: int = PIECES,
               heavy_part: float = HEAVY_PART, least_rows: int = 1000) -> DataFrame:
    """(``key``, ``salts``) of the keys worth splitting, as a table of fixed rows.

    One job that reads the key column once.  Its result, at most ``parts / heavy_part`` rows
    (fewer than ``least_rows`` rows of a key are never worth a sub-key), goes
    through the driver once, so that both sides of a join see the same salts.
    """
    spark = keys.sparkSession
    parts = parts or shuffle_partitions(spark)
    tracked = tracked_items(parts, heavy_part)
    found = _summarised(keys, key, tracked)
    mean = F.col("__all") / F.lit(parts)
    heavy = (found.where((F.col("rows") >= least_rows) & (F.col("rows") > mean * heavy_part))
             .select(key, F.ceil(F.col("rows") * pieces / mean).cast("int").alias("salts")).where("salts > 1"))
    return spark.createDataFrame(heavy.collect(), heavy.schema)


def expand_left(df: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: str,
                keys: DataFrame | None = None, clustered: bool = False, pieces: int = PIECES,
                heavy_part: float = HEAVY_PART, least_rows: int = 1000, heavy: DataFrame | None = None) -> DataFrame:
    """Left join to a many side whose keys may be hot.

    The right rows of a heavy key are dealt over its sub-keys by a hash of
    ``spread_by``; a left row with that key is repeated for the sub-keys that
    really occur.  Both lists are broadcast, with the bound of ``heavy_keys``.
    Left rows without a match are kept once, with NULLs.  ``keys`` may give the
    (``right_key``, ``spread_by``) pairs of ``right`` from a cheaper source, for
    instance its base table before the lookups: it is read once or twice, with two
    columns.  ``heavy`` may give the result of an earlier ``heavy_keys``.  ``clustered`` asks for a sort-merge join, whose output lies together
    by key when it is written.
    """
    keys = right if keys is None else keys
    if heavy is None:
        heavy = heavy_keys(keys, right_key, pieces=pieces, heavy_part=heavy_part, least_rows=least_rows)
    on = F.col(key) == F.col(right_key)
    side = right.hint("merge") if clustered else right
    if heavy.isEmpty():
        return df.join(side, on, "left")
    heavy = F.broadcast(heavy.select(F.col(right_key).alias("__hk"), F.col("salts").alias("__salts")))
    dealt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("__salts")).cast("int"), F.lit(0))
    present = (keys.join(heavy, F.col(right_key) == F.col("__hk"))
               .groupBy("__hk").agg(F.collect_set(dealt).alias("__have")))
    right = right.join(heavy, F.col(right_key) == F.col("__hk"), "left").withColumn("__salt", dealt).drop("__hk", "__salts")
    df = (df.join(F.broadcast(present), F.col(key) == F.col("__hk"), "left")
          .withColumn("__here", F.explode(F.coalesce("__have", F.array(F.lit(0))))).drop("__hk", "__have"))
    side = right.hint("merge") if clustered else right
    return df.join(side, on & (F.col("__here") == F.col("__salt")), "left").drop("__here", "__salt")
