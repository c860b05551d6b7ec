"""Text comparison under a collation (Spark's collated string types).

``None`` stands for the binary comparison that Spark does by default.  The
collation is applied where text is compared, grouped or joined; results keep
plain strings, so contracts and files don't change.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Case and trailing blanks don't count.
CASELESS = "UTF8_LCASE_RTRIM"
#: Input bytes per task of a collated DISTINCT: its rows, compressed in the files, are held there sorted, twice as wide.
INPUT_BYTES = 4 << 20
#: Tasks over which the exact copies of a row are dealt before they meet.
COPIES = 16

#: Case, accents and trailing blanks don't count, as in the source system's default collation.
ACCENTLESS = "UNICODE_CI_AI_RTRIM"


def collated(text: Column | str, collation: str | None) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return text if collation is None else F.collate(text, collation)


def same(a: Column | str, b: Column | str, collation: str | None = None) -> Column:
    """``a = b`` under a collation; NULL if one side is NULL."""
    return collated(a, collation) == collated(b, collation)


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the files and local rows that ``df`` is made from; sources of unknown size don't count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < 1 << 60)


def distinct_under(df: DataFrame, collation: str | None = None, columns: Sequence[str] | None = None,
                   input_bytes: int = INPUT_BYTES) -> DataFrame:
    """Distinct rows with all text columns compared under a collation.

    Of rows that are equal under it, the first in binary order of all columns
    stands for its class.  Collated keys are sorted, not hashed, so the rows of a
    task are held in memory: they are dealt over so many tasks that each has a fixed
    part of the input (``input_bytes``).  Exact copies go first, by a plain DISTINCT that deals
    those of one row over several tasks; what is left meets by the collated keys.
    """
    if columns is not None:
        df = df.select(*columns)
    if collation is None:
        return df.distinct()
    keys = [(collated(f.name, collation) if isinstance(f.dataType, StringType) else F.col(f.name)).alias(f"__g{i}")
            for i, f in enumerate(df.schema)]
    names, classes = df.columns, [f"__g{i}" for i in range(len(keys))]
    parts = ceil(_input_bytes(df) / input_bytes)
    if parts > 1:
        dealt = df.withColumn("__deal", F.pmod(F.spark_partition_id(), F.lit(COPIES)))
        spelled = dealt.repartition(parts, *names, "__deal").distinct()
        df = spelled.select(*names, *keys).repartition(parts, *classes)
    else:
        df = df.select(*names, *keys)
    grouped = df.groupBy(*classes).agg(F.min(F.struct(*names)).alias("__row"))
    return grouped.select(*[F.col("__row").getField(c).alias(c) for c in names])
