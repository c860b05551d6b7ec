"""Marts stored in parts, of which a version writes only those that changed.

Rows are dealt over a fixed number of parts by a hash of a key, heavy keys over
sub-keys in proportion (``heavy_keys``) and rows without a key by a hash of the
row.  The layout is kept from version to version, so that rows of a key stay in
their parts; it is made anew only on demand.  A part's digest is its row count
and the sums of two 64-bit hashes of its rows, so the order of rows does not
matter and repeated rows count.  A version lists all its parts in the manifest:
those whose digest is that of the version before are linked, not written.

Columns that are one value throughout a run (the run stamp) are ``constants``:
kept in the manifest, out of files and digests, and put back by readers.  Else
no part would ever be unchanged.

The mart is computed once: its rows wait on the executors' disks while the
digests are compared, and a lost executor's rows are computed again.  Only rows
of changed parts are exchanged.  Digests and the list of parts are bounded by
the number of parts.  0.0 and -0.0 count as equal.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from trialmart.operators.skew import heavy_keys, shuffle_partitions
from trialmart.sinks.clustered import Clustering

PART, ROW = "__part", "__row"


@dataclass(frozen=True)
class Parts:
    """How a mart is stored: by ``key``, in ``count`` parts (None: as many as shuffle partitions).

    ``constants`` maps a column that has one value in this version to that value
    as SQL text.  ``relayout`` measures the heavy keys again and writes all parts.
    """

    key: str
    constants: Mapping[str, str] = field(default_factory=dict)
    count: int | None = None
    relayout: bool = False
    least_rows: int = 1000


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _row_hash(schema: StructType, seed: int) -> Column:
    """64-bit hash of a whole row; a null differs from any value, wherever it stands."""
    nested = (ArrayType, MapType, StructType, VariantType)
    values = [F.to_json(F.struct(f"`{f.name}`"), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
              for f in schema]
    return F.xxhash64(F.lit(seed), *values, *[F.col(f"`{f.name}`").isNull() for f in schema])


def _layout(rows: DataFrame, how: Parts, columns: str, last: Mapping | None) -> tuple[dict, bool]:
    """(layout, whether it is the one of the version before)."""
    count = how.count or (last["layout"]["count"] if last else shuffle_partitions(rows.sparkSession))
    if last and not how.relayout and last["layout"]["key"] == how.key and last["layout"]["count"] == count:
        return last["layout"], last["layout"]["stored"] == columns
    heavy = heavy_keys(rows, how.key, parts=count, least_rows=how.least_rows).collect()
    return {"key": how.key, "count": count, "heavy": {str(r[how.key]): r["salts"] for r in heavy}, "stored": columns}, False


def _dealt(rows: DataFrame, layout: Mapping) -> DataFrame:
    """``rows`` with their hash and their part."""
    how = Clustering(layout["key"], ROW, layout["count"], layout["heavy"])
    dealt = how.deal(rows.withColumn(ROW, _row_hash(rows.schema, 1)))
    by_key = F.pmod(F.xxhash64(*how.columns), F.lit(how.buckets))
    by_row = F.pmod(F.col(ROW), F.lit(how.buckets))
    part = F.when(F.col(how.key).isNull(), by_row).otherwise(by_key).cast("int")
    return dealt.withColumn(PART, part).select(*rows.columns, ROW, PART)


def write_parts(df: DataFrame, path: str, how: Parts, last: Mapping | None) -> dict:
    """Write the parts of ``df`` that differ from the version ``last`` under ``path``; what the manifest needs.

    ``parts`` maps a part to its folder, rows and digest, ``written`` names those that are new.
    """
    absent = sorted(set(how.constants) - set(df.columns))
    if absent:
        raise ValueError(f"constants that the mart lacks: {absent}")
    stored = df.drop(*how.constants)
    columns = ddl(stored.schema)
    if last is not None and last.get("parts") is None:
        last = None
    rows = stored.persist(StorageLevel.DISK_ONLY)
    try:
        layout, same = _layout(rows, how, columns, last)
        layout = dict(layout, stored=columns)
        dealt = _dealt(rows, layout)
        total = [F.sum(h.cast("decimal(28,0)")).cast("string") for h in (F.col(ROW), _row_hash(stored.schema, 2))]
        digests = dealt.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", *total).alias("digest")).collect()
        before = last["parts"] if same else {}
        parts, written = {}, []
        for r in sorted(digests, key=lambda r: r[PART]):  # one row per part
            found = {"path": f"{path}/{PART}={r[PART]}", "rows": r["rows"], "digest": r["digest"]}
            old = before.get(str(r[PART]))
            if old and (old["rows"], old["digest"]) == (found["rows"], found["digest"]):
                found = old
            else:
                written.append(r[PART])
            parts[str(r[PART])] = found
        if written:
            fresh = dealt.drop(ROW) if len(written) == len(parts) else dealt.drop(ROW).where(F.col(PART).isin(written))
            (fresh.repartitionById(layout["count"], F.col(PART)).sortWithinPartitions(PART, how.key)
             .write.mode("errorifexists").partitionBy(PART).parquet(path))
    finally:
        rows.unpersist()
    return {"parts": parts, "layout": layout, "constants": dict(how.constants), "written": written}


def _shown(version: Mapping, schema: StructType) -> list[str]:
    """The mart's columns as SQL over its files, constants put back."""
    known = version["constants"]
    return [f"CAST({known[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in known else f"`{f.name}`" for f in schema]


def read_parts(spark: SparkSession, version: Mapping) -> DataFrame:
    """The rows of a version that is stored in parts."""
    schema, stored = (StructType.fromDDL(version["columns"]), version["layout"]["stored"])
    paths = [p["path"] for p in version["parts"].values()]
    rows = spark.read.schema(stored).parquet(*paths) if paths else spark.createDataFrame([], stored)
    return rows.selectExpr(*_shown(version, schema))


def view_sql(version: Mapping) -> str:
    """A query over the version's files, one branch per attempt that wrote some of them."""
    schema = StructType.fromDDL(version["columns"])
    attempts: dict[str, list[str]] = {}
    for part in version["parts"].values():
        attempt, folder = part["path"].rsplit("/", 1)
        attempts.setdefault(attempt, []).append(folder.removeprefix(f"{PART}="))
    shown = ", ".join(_shown(version, schema))
    if not attempts:
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        return f"SELECT {none} WHERE 1 = 0"
    return " UNION ALL ".join(f"SELECT {shown} FROM parquet.`{a}/{PART}={{{','.join(names)}}}`" for a, names in attempts.items())
