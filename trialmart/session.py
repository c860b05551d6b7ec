"""Spark session defaults for the marts.

On a cluster the session is created by the platform; ``build_session`` is for
tests, the bench and local runs.  Settings that matter at scale:

* AQE on, with partition coalescing and skew-join splitting: the big
  many-to-many joins (study x patient, study x status) are keyed on study and
  a single study may hold a large share of rows.
* ``spark.sql.autoBroadcastJoinThreshold`` stays at its (byte-checked)
  default; nothing is hinted.
* ``spark.checkpoint.dir`` is read from the session and never made up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.scheduler.mode": "FAIR",  # marts written at the same time share the executors
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "trialmart", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above; ``extra`` adds settings such as ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, registered with the context.

    No folder is created in its place: a machine-local one would be invisible
    to the executors of a cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def materialised(df: DataFrame) -> DataFrame:
    """``df`` worked out once under the shared checkpoint folder, so that plans read its rows instead of holding its plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
