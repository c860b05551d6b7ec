"""Spark helpers of the subpackage: lineage cuts, connected components, sizing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a single-process local session without that setting gets a folder of
    its own; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into a new folder under the checkpoint folder and read it again."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: one row (id, root) per vertex, root the smallest id.

    Minimum labels travel along the edges.  A vertex that meets a smaller label
    hands it to the vertex that its old label names, so whole trees hang on to one
    another, and every label is replaced by the label of that label; rounds, which
    the driver plans one by one, then grow with the logarithm of the longest chain.
    A round is four joins and two map-side combined minima; a hub's edges meet one
    label row, which the adaptive skew join splits.  Every round is stored and read
    again: a checkpoint would keep the size that Spark estimates for its plan, a
    product over all joins so far, whose digits multiply from round to round until
    they fill the driver.  Joins stay sort-merge joins, whatever the files' size.
    Edges with a null end are ignored; a loop makes its vertex known.
    """
    e = edges.select(F.col(a).alias("_u"), F.col(b).alias("_v")).where("_u is not null and _v is not null")
    both = stored(e.union(e.select("_v", "_u")).distinct())
    label = stored(both.groupBy("_u").agg(F.least(F.min("_v"), F.col("_u")).alias("_l")))
    while True:
        near = (both.join(label.select(F.col("_u").alias("_v"), F.col("_l").alias("_m")).hint("merge"), "_v")
                .groupBy("_u").agg(F.min("_m").alias("_m")))
        step = (label.join(near.hint("merge"), "_u")
                .select("_u", F.col("_l").alias("_old"), F.least("_l", "_m").alias("_l")))
        hook = step.where("_l < _old").groupBy(F.col("_old").alias("_u")).agg(F.min("_l").alias("_h"))
        jump = label.select(F.col("_u").alias("_l"), F.col("_l").alias("_j"))
        moved = stored(step.join(hook.hint("merge"), "_u", "left").join(jump.hint("merge"), "_l", "left")
                       .select("_u", "_old", F.least("_l", "_h", "_j").alias("_l")))
        label = moved.select("_u", "_l")
        if moved.where("_l <> _old").isEmpty():
            return label.select(F.col("_u").alias("id"), F.col("_l").alias("root")).hint("merge")
