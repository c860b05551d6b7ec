"""Marts stored in buckets by a key, so that joins and DISTINCTs on the key exchange no row of them.

The files are sorted buckets by the key's hash, as Spark's own shuffle deals rows.
Keys that hold a large share of the rows are dealt over sub-keys in proportion
(``heavy_keys``), by a hash of a row's own key, in an extra column ``__deal``;
equal rows get equal sub-keys.  Where no key is heavy the column does not exist.
Bucketed Parquet is read through a catalog entry; the manifest has all that is
needed to make one again in another session.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.operators.skew import heavy_keys, shuffle_partitions

DEAL = "__deal"


@dataclass(frozen=True)
class Clustering:
    """Buckets by ``key``; rows of a key in ``heavy`` (key as text: sub-keys) dealt by ``spread_by``."""

    key: str
    spread_by: str
    buckets: int
    heavy: Mapping[str, int]

    @property
    def columns(self) -> list[str]:
        return [self.key, DEAL] if self.heavy else [self.key]

    def _salts(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.key].dataType
        rows = df.sparkSession.createDataFrame(list(self.heavy.items()), "k string, __salts int")
        return F.broadcast(rows.select(F.col("k").cast(kind).alias("__hk"), "__salts"))  # bounded by heavy_keys

    def deal(self, df: DataFrame) -> DataFrame:
        """``df`` with its sub-key."""
        if not self.heavy:
            return df
        salt = F.coalesce(F.pmod(F.xxhash64(self.spread_by), F.col("__salts")).cast("int"), F.lit(0))
        return (df.join(self._salts(df), F.col(self.key) == F.col("__hk"), "left")
                .withColumn(DEAL, salt).drop("__hk", "__salts"))

    def repeat(self, df: DataFrame, out: str) -> DataFrame:
        """The other side of a join: a row per sub-key ``out`` of its key."""
        if not self.heavy:
            return df
        last = F.coalesce(F.col("__salts") - 1, F.lit(0))
        return (df.join(self._salts(df), F.col(self.key) == F.col("__hk"), "left")
                .withColumn(out, F.explode(F.sequence(F.lit(0), last))).drop("__hk", "__salts"))

    def to_json(self) -> dict:
        return asdict(self)


def measured(keys: DataFrame, key: str, as_key: str, spread_by: str, least_rows: int = 1000) -> Clustering:
    """Clustering by ``as_key`` with the heavy keys of ``keys`` (the base table's key column ``key``), a bucket per
    shuffle partition.  One job over one column."""
    buckets = shuffle_partitions(keys.sparkSession)
    heavy = heavy_keys(keys, key, parts=buckets, least_rows=least_rows)
    return Clustering(as_key, spread_by, buckets, {str(r[key]): r["salts"] for r in heavy.collect()})


def entry_name(path: str) -> str:
    """Catalog name of an attempt folder; attempts have names of their own."""
    return "trialmart_" + path.rsplit("attempt=", 1)[1]


def open_buckets(spark: SparkSession, path: str, columns: str, how: Clustering) -> DataFrame:
    """The bucketed files under ``path`` (``columns``: DDL without the sub-key), with their sub-key."""
    keys = ", ".join(f"`{c}`" for c in how.columns)
    deal = f", `{DEAL}` int" if how.heavy else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {entry_name(path)} ({columns}{deal}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {how.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(entry_name(path))


def write_buckets(df: DataFrame, path: str, columns: str, how: Clustering) -> None:
    """One exchange deals the rows as the buckets do, so that each bucket is one file."""
    open_buckets(df.sparkSession, path, columns, how)
    try:
        how.deal(df).repartition(how.buckets, *how.columns).write.insertInto(entry_name(path))
    except Exception:
        close_buckets(df.sparkSession, path)
        raise


def close_buckets(spark: SparkSession, path: str) -> None:
    """Forget the catalog entry; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {entry_name(path)}")
