"""Source tables for the marts.

A ``SourceSet`` maps table names (case-insensitive) to DataFrames.  On a
cluster the tables come from the catalog or from Parquet folders
(``from_catalog`` / ``from_parquet``) and are checked against the declared
schemas (``trialmart.sources.schema``); in tests and the bench they are
derived from the generated tables (``from_testdata``).

No table is hinted as small: Spark decides on a broadcast from bytes, estimated
or measured at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from trialmart.contracts import conform
from trialmart.operators import check_unique
from trialmart.sources.schema import SOURCE_SCHEMAS, UNIQUE_KEYS

#: every source the marts read (FIXTURES.md section 1)
SOURCE_TABLES = list(SOURCE_SCHEMAS)


class SourceSet:
    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = {k.lower(): v for k, v in tables.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name.lower()]

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._tables

    def names(self) -> list[str]:
        return list(self._tables)

    def check_keys(self) -> None:
        """Raise if a dimension that the marts take as unique has a repeated key (SNK-06, JOI-20).

        One map-side combined aggregate per table.
        """
        for name, keys in UNIQUE_KEYS.items():
            if name in self:
                check_unique(self[name].dropna(subset=keys), keys, name)


def read_parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def _declared(tables: dict[str, DataFrame]) -> SourceSet:
    return SourceSet({n: conform(df, SOURCE_SCHEMAS[n.lower()], n) if n.lower() in SOURCE_SCHEMAS else df
                      for n, df in tables.items()})


def from_parquet(spark: SparkSession, folder: str, names: Iterable[str] = SOURCE_TABLES) -> SourceSet:
    """Source tables stored as ``<folder>/<name>.parquet``."""
    return _declared(read_parquet_tables(spark, folder, names))


def from_catalog(spark: SparkSession, names: Iterable[str] = SOURCE_TABLES,
                 database: str | None = None) -> SourceSet:
    """Source tables registered in the session catalog."""
    prefix = f"{database}." if database else ""
    return _declared({n: spark.table(prefix + n) for n in names})


def from_testdata(spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None) -> SourceSet:
    """Trial sources derived from the generated tables at ``sf_dir`` (see ``derived``)."""
    from trialmart.sources import derived

    raw = read_parquet_tables(spark, sf_dir, derived.RAW_TABLES)
    return _declared(derived.derive(spark, raw, list(names) if names else None))
