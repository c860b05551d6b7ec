"""One dimension in many roles.

While the dimension fits Spark's broadcast limit, one join per role costs no
shuffle.  Beyond it each such join would shuffle the whole fact; here the roles
are melted instead: the distinct combinations of role keys are stacked to (role,
key) rows, joined with the dimension once, put together again per combination,
and meet the fact in one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Roles = Mapping[str, Mapping[str, str | Sequence[str]]]


def _bytes(text: str) -> int:
    """A byte size as Spark's settings write it, such as ``10485760b``, ``10MB`` or ``-1``."""
    text = text.strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Does Spark's estimate of ``df`` stay below its broadcast limit?"""
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit


def _needed(pk: str, roles: Roles) -> list[str]:
    return list(dict.fromkeys([pk, *(c for columns in roles.values() for c in columns)]))


def _outputs(columns: Mapping[str, str | Sequence[str]]) -> list[tuple[str, str]]:
    return [(c, out) for c, outs in columns.items() for out in ([outs] if isinstance(outs, str) else outs)]


def lookup_roles_melted(df: DataFrame, dim: DataFrame, pk: str, roles: Roles) -> DataFrame:
    """``{fk: {dim column: output}}`` for all roles by one join with ``dim``.

    ``pk`` must be unique in ``dim`` (``check_keys`` verifies the sources' keys).
    The combinations are made distinct map-side before they are stacked, so a key
    that most rows share is looked up once; ``df`` is read a second time for its
    role columns only.  A combination's hash is part of the last join's key,
    which gives both sides an exchange of their own that AQE can split where many
    rows share one combination.  Rows keep their number; null keys and keys
    without a match give NULLs.
    """
    fks = list(roles)
    parts = [f"__t{i}" for i in range(len(fks))]
    combined = df.select(*[F.col(fk).alias(t) for fk, t in zip(fks, parts)]).distinct()
    stacked = combined.select(*parts, F.inline(F.array(*[
        F.struct(F.lit(i).alias("__role"), F.col(t).alias("__key")) for i, t in enumerate(parts)]))).where("__key IS NOT NULL")
    needed = _needed(pk, roles)
    narrow = dim.select(F.col(pk).alias("__pk"), F.struct(*needed).alias("__found"))
    found = stacked.join(narrow, F.col("__key") == F.col("__pk"))
    wide = (found.groupBy(*parts).agg(F.map_from_entries(F.collect_list(F.struct("__role", "__found"))).alias("__by_role"))
            .withColumn("__hash", F.xxhash64(*parts)))  # at most one entry per role
    on = F.col("__fact_hash") == F.col("__hash")
    for fk, t in zip(fks, parts):
        on = on & F.col(fk).eqNullSafe(F.col(t))
    joined = df.withColumn("__fact_hash", F.xxhash64(*fks)).join(wide, on, "left")
    outputs = [F.col("__by_role")[i][c].alias(out) for i, fk in enumerate(fks) for c, out in _outputs(roles[fk])]
    return joined.select(*[F.col(c) for c in df.columns], *outputs)


def lookup_roles(df: DataFrame, dim: DataFrame, pk: str, roles: Roles) -> DataFrame:
    """The same dimension in several roles (JOI-02, JOI-22): ``{fk: {dim column: output}}``.

    One broadcast join per role while the dimension's columns fit the broadcast
    limit (all roles share the exchange), else one melted join for all of them.
    """
    if len(roles) > 1 and not fits_broadcast(dim.select(*_needed(pk, roles))):
        return lookup_roles_melted(df, dim, pk, roles)
    from trialmart.operators import lookup

    for fk, columns in roles.items():
        df = lookup(df, dim, (fk, pk), columns)
    return df
