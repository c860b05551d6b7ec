"""Versions of a mart: attempt folders, manifests, and a pointer that is switched last.

Every write goes to a new folder ``<base>/<mart>/run_id=<id>/attempt=<n>``, so
no write ever touches what readers see.  When its files are complete, a manifest
``<base>/<mart>/_manifests/<id>.json`` (path, rows, metrics, schema, inputs)
makes it the version of that run, and ``<base>/<mart>/_current.json`` and the
catalog table are pointed to it.  Manifests and pointer are replaced by an
atomic rename.  A write that dies leaves a folder that nothing names.

A mart in parts (``parts.py``) writes only the parts that differ from the version
readers have; its manifest names the folder of every part, in whichever attempt
it was written, and its catalog entry is a view, replaced in one statement.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from trialmart.contracts import conform
from trialmart.quality import Watch
from trialmart.sinks.clustered import Clustering, open_buckets, write_buckets
from trialmart.sinks.parts import Parts, ddl, read_parts, view_sql, write_parts


def _located(spark: SparkSession, name: str):
    """(file system, full path) of a Hadoop path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist.  Other errors are raised."""
    fs, path = _located(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _read_json(spark: SparkSession, name: str) -> dict | None:
    fs, path = _located(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _replace_json(spark: SparkSession, name: str, value: dict) -> None:
    """Write beside the target, then rename over it, so that a reader finds the old or the new text."""
    jvm = spark._jvm
    fs, target = _located(spark, name)
    fresh = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}.tmp")
    stream = fs.create(fresh, True)
    stream.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, target, options)


def versions(spark: SparkSession, base: str, mart: str) -> list[str]:
    """Run ids of the completely written versions of a mart, in order."""
    names = _listed(spark, f"{base}/{mart}/_manifests")
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def manifest(spark: SparkSession, base: str, mart: str, run_id: str) -> dict | None:
    """What is known of a version: ``path``, ``rows``, ``metrics``, ``schema``, ``inputs``; None if it is not complete."""
    return _read_json(spark, f"{base}/{mart}/_manifests/{run_id}.json")


def current(spark: SparkSession, base: str, mart: str) -> dict | None:
    """The manifest of the version that readers get, None before the first."""
    return _read_json(spark, f"{base}/{mart}/_current.json")


def read_current(spark: SparkSession, base: str, mart: str) -> DataFrame:
    found = current(spark, base, mart)
    if found is None:
        raise ValueError(f"{mart} has no published version under {base}")
    return read_version(spark, found)


def read_version(spark: SparkSession, version: dict, clustered: bool = False) -> DataFrame:
    """The rows of a version; with ``clustered`` a bucketed one as its buckets lie, with the sub-key."""
    if version.get("parts") is not None:
        return read_parts(spark, version)
    if not version.get("clustering"):
        return spark.read.parquet(version["path"])
    if clustered:
        return open_buckets(spark, version["path"], version["columns"], Clustering(**version["clustering"]))
    return spark.read.schema(version["columns"]).parquet(version["path"])  # no file where there is no row


def leftovers(spark: SparkSession, base: str, mart: str) -> list[str]:
    """Attempt folders that no manifest names: of writes that died, or that a rerun has replaced.

    A folder with a part that some version still links is named.
    """
    named = set()
    for known in (manifest(spark, base, mart, v) for v in versions(spark, base, mart)):
        named |= {known["path"], *(p["path"].rsplit("/", 1)[0] for p in (known.get("parts") or {}).values())}
    runs = [n for n in _listed(spark, f"{base}/{mart}") if n.startswith("run_id=")]
    found = [f"{base}/{mart}/{r}/{a}" for r in runs for a in _listed(spark, f"{base}/{mart}/{r}") if a.startswith("attempt=")]
    return sorted(p for p in found if p not in named)


def point_table(spark: SparkSession, table: str, path: str, columns: str = "") -> None:
    """``columns`` declares what the table shows of the files; without it, all of them."""
    if _is_view(spark, table):  # the mart was stored in parts before
        spark.sql(f"DROP VIEW {table}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} {f'({columns})' if columns else ''} USING parquet LOCATION '{path}'")


def _is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def point_view(spark: SparkSession, table: str, version: dict) -> None:
    """Show a version in parts.  A table of that name, of a full refresh, gives way; its files stay."""
    if spark.catalog.tableExists(table) and not _is_view(spark, table):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {view_sql(version)}")


def switch(spark: SparkSession, base: str, mart: str, version: dict, table: str | None = None) -> None:
    """Make a complete version the one that readers get."""
    _replace_json(spark, f"{base}/{mart}/_current.json", version)
    if table and version.get("parts") is not None:
        point_view(spark, table, version)
    elif table:
        point_table(spark, table, version["path"], version.get("columns", ""))


def publish(df: DataFrame, base: str, mart: str, run_id: str, table: str | None = None, contract: StructType | None = None,
            inputs: Mapping[str, str] | None = None, keys: Sequence[str] = (), watch: Watch | None = None,
            clustering: Clustering | None = None, parts: Parts | None = None) -> str:
    """Write ``df`` as the version ``run_id`` of ``mart`` and switch readers to it; returns its folder.

    ``contract`` is checked first.  The row count and the nulls among ``keys`` are
    observed by the write itself, as is what ``watch`` already watches; they are
    part of the manifest with ``inputs``, the versions that ``df`` was built from.
    ``clustering`` stores the rows in buckets; ``parts`` stores them in parts and
    writes those that differ from the version readers have (the folder returned
    holds only these, and does not exist where nothing changed).
    """
    if clustering is not None and parts is not None:
        raise ValueError("a mart lies in buckets or in parts, not in both")
    spark, watch = df.sparkSession, watch or Watch()
    if contract is not None:
        df = conform(df, contract, mart)
    path = f"{base}/{mart}/run_id={run_id}/attempt={uuid.uuid4().hex}"
    seen = watch.observe(df, "written", keys)
    columns, more = ddl(df.schema), {}
    if parts is not None:
        more = write_parts(seen, path, parts, current(spark, base, mart))
    elif clustering is None:
        seen.write.mode("errorifexists").parquet(path)
    else:
        write_buckets(seen, path, columns, clustering)
    metrics = watch.metrics()
    version = {"mart": mart, "run_id": run_id, "path": path, "rows": metrics["written"]["rows"], "metrics": metrics,
               "schema": df.schema.simpleString(), "columns": columns, "inputs": dict(inputs or {}),
               "clustering": clustering.to_json() if clustering else None, **more}
    _replace_json(spark, f"{base}/{mart}/_manifests/{run_id}.json", version)
    switch(spark, base, mart, version, table)
    return path
