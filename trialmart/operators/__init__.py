"""Reusable DataFrame operators behind the marts.

The operators are lazy plan fragments, except ``assign_keys`` (checkpoints the
numbered rows), ``check_unique`` / ``eav_pivot``, ``expand_left`` and
``eav_slots`` (one aggregate job).  Scale
notes that apply throughout:

* No join is hinted.  Spark broadcasts a side whose size, estimated or measured
  by AQE at run time, is below its byte threshold, and shuffles otherwise.
* Aggregations are written so that Spark's partial (map-side) aggregation
  runs before the shuffle; nothing collects a group into one task.
* Latest-per-group is a rank that Spark limits before the exchange, so its table is
  read once and a hot group is reduced map-side.
* A left join to a many side with hot keys is ``expand_left``: AQE cannot split
  the right side of an outer join, so heavy keys are measured and salted.
* A dimension in many roles is ``lookup_roles``: one join for all of them where
  it is too large for a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialmart.operators.collation import ACCENTLESS, CASELESS, collated, distinct_under, same
from trialmart.operators.roles import lookup_roles, lookup_roles_melted
from trialmart.operators.skew import expand_left, frequent_keys, heavy_keys
from trialmart.session import checkpoint_dir

__all__ = [
    "ACCENTLESS", "CASELESS", "collated", "same", "distinct_under", "lookup", "lookup_roles", "lookup_roles_melted",
    "distinct_collated", "expand_left", "frequent_keys",
    "heavy_keys", "string_list", "filtered_count", "latest_per_group", "exclude_active", "eav_slots", "eav_pivot",
    "union_tagged", "assign_keys", "check_unique",
]

_counter = [0]


def _fresh(prefix: str = "__k") -> str:
    _counter[0] += 1
    return f"{prefix}{_counter[0]}"


def _as_pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, tuple) and len(on) == 2 and all(isinstance(x, str) for x in on):
        return [on]
    return list(on)


def lookup(df: DataFrame, dim: DataFrame, on, columns: Mapping[str, str | Sequence[str]],
           where: Column | None = None, extra: Column | None = None,
           collation: str | None = None) -> DataFrame:
    """Left join ``df`` to ``dim`` and bring back renamed columns (JOI-01/02/03/07/08).

    ``on``      ``(fk, pk)`` or a list of such pairs (composite key).
    ``columns`` ``{dim_column: output_name}``; an output may be a list when
                one dimension column feeds several output columns.
    ``where``   filter applied to the dimension *before* the join, i.e. a
                right-side constant predicate in ON; left rows are kept.
    ``extra``   additional ON predicate over left columns only (kept in the
                condition, it never drops left rows).
    ``collation`` compare the keys as text under a collation (``CASELESS``,
                ``ACCENTLESS``); the default comparison is binary.
    The dimension is projected to key + requested columns first, so each
    role joins a narrow table; repeated roles reuse one broadcast exchange.
    """
    pairs = _as_pairs(on)
    if where is not None:
        dim = dim.filter(where)
    keys = [f"__lk{i}" for i in range(len(pairs))]
    if set(keys) & set(df.columns):
        keys = [_fresh() for _ in pairs]
    # outputs are aliased inside the narrow right-side projection; Spark's
    # exchange reuse canonicalises aliases away, so all roles of one
    # dimension still share one broadcast
    sel = [F.col(pk).alias(k) for (_, pk), k in zip(pairs, keys)]
    for src, outs in columns.items():
        for out in ([outs] if isinstance(outs, str) else outs):
            sel.append(F.col(src).alias(out))
    right = dim.select(*sel)
    cond = None
    for (fk, _), k in zip(pairs, keys):
        term = same(fk, k, collation)
        cond = term if cond is None else cond & term
    if extra is not None:
        cond = cond & extra
    return df.join(right, cond, "left").drop(*keys)


def distinct_collated(df: DataFrame, columns: Sequence[str], collation: str = CASELESS) -> DataFrame:
    """Distinct rows of ``columns`` with text compared under ``collation``; the smallest spelling stands for its class."""
    return distinct_under(df, collation, columns)


def string_list(df: DataFrame, key: str, value: str, sep: str = " | ",
                out: str = "value_list") -> DataFrame:
    """Distinct values per key joined by ``sep`` in value order (AGG-01).

    NULL members are skipped and an all-NULL group gives NULL (not ``''``).
    The (key, value) pairs are de-duplicated first, which Spark does with a
    map-side partial aggregate, so a hot key is reduced before the shuffle;
    the final list holds at most one entry per distinct value.
    """
    pairs = df.select(F.col(key).alias(key), F.col(value).alias("__v")).distinct()
    return (pairs.groupBy(key)
            .agg(F.expr(f"listagg(__v, '{sep}') WITHIN GROUP (ORDER BY __v)").alias(out)))


def filtered_count(df: DataFrame, key: str, count_col: str, cond: Column | None,
                   out: str) -> DataFrame:
    """``count(count_col)`` per key over the rows passing ``cond`` (AGG-02).

    Joined back with a left join, keys without qualifying rows get NULL.
    """
    if cond is not None:
        df = df.filter(cond)
    return df.groupBy(key).agg(F.count(count_col).alias(out))


def latest_per_group(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals the group maximum (AGG-03); ties are kept.

    ``rank() = 1`` in one scan: Spark limits each group by rank before the
    exchange (``WindowGroupLimit``), so a task sends only the rows that tie for
    the maximum of its part of a group, and a group holding a large share of all
    rows is neither shuffled nor sorted whole in one task.  Rows with a NULL key
    or order value never match, as with the correlated ``MAX`` subquery this
    replaces.
    """
    at = _fresh("__rank")
    known = F.col(order_col).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    newest = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return df.filter(known).withColumn(at, F.rank().over(newest)).filter(F.col(at) == 1).drop(at)


def exclude_active(df: DataFrame, exclusions: DataFrame, key: str,
                   excl_key: str = "pk_study", active_col: str = "is_active",
                   active_value: str = "Y") -> DataFrame:
    """``NOT EXISTS`` an active exclusion row for the key (FLT-08) as a left anti join.

    Rows whose key is NULL are kept, as with NOT EXISTS.
    """
    k = _fresh()
    excl = exclusions.filter(F.col(active_col) == F.lit(active_value)).select(F.col(excl_key).alias(k))
    return df.join(excl, F.col(key) == F.col(k), "left_anti")


def eav_slots(df: DataFrame, eav: DataFrame, key: str, slots: Mapping[str, Mapping],
              fk: str = "fk_study", type_col: str = "fk_codelst_idtype",
              value_col: str = "studyid_id", least_rows: int = 1000) -> DataFrame:
    """Attribute slots from an entity-attribute-value table (JOI-09, faithful form).

    ``slots`` maps a slot name to ``{"types": [...], "value": <value filter or
    None>, "columns": {eav_col: output}}``.  A slot with several rows for an
    entity fans out, exactly like one filtered join per attribute, and one
    without rows gives NULLs.

    For most entities the table is read once, for the types of all slots, and one
    aggregate per entity collects the rows of every slot; after one left join each
    slot is exploded.  Entities that hold a large share of the attribute rows
    (``heavy_keys``) never become such a row: their slots are joined one after the
    other, the largest last, salted (``expand_left``), so their rows stay spread
    over the tasks.
    """
    match = {}
    for name, spec in slots.items():
        cond = F.col(type_col).isin(list(spec["types"]))
        if spec.get("value") is not None:
            cond = cond & (F.col(value_col) == F.lit(spec["value"]))
        match[name] = cond
    types = sorted({t for spec in slots.values() for t in spec["types"]})
    rows = eav.filter(F.col(type_col).isin(types))
    heavy = heavy_keys(rows, fk, least_rows=least_rows)
    if heavy.isEmpty():
        return _slots_at_once(df, rows, key, slots, match, fk)
    named = F.broadcast(heavy.select(F.col(fk).alias("__heavy")))  # bounded by heavy_keys
    light = _slots_at_once(df.join(named, F.col(key) == F.col("__heavy"), "left_anti"),
                           rows.join(named, F.col(fk) == F.col("__heavy"), "left_anti"), key, slots, match, fk)
    some = df.join(named, F.col(key) == F.col("__heavy"), "left_semi")
    rows = rows.join(named, F.col(fk) == F.col("__heavy"), "left_semi")
    sizes = rows.agg(*[F.count_if(cond).alias(name) for name, cond in match.items()]).first()
    for name in sorted(slots, key=lambda n: sizes[n]):  # the largest slot fans out last, over all its sub-keys
        spec = slots[name]
        columns = [F.col(c).alias(out) for c, out in spec["columns"].items()]
        spread = F.xxhash64(*eav.columns).alias("__spread")  # whole rows: values may repeat
        slot = rows.filter(match[name]).select(F.col(fk).alias("__ent"), spread, *columns)
        some = expand_left(some, slot, key, "__ent", "__spread", heavy=heavy.withColumnRenamed(fk, "__ent")).drop("__ent", "__spread")
    return light.unionByName(some)


def _slots_at_once(df: DataFrame, rows: DataFrame, key: str, slots: Mapping[str, Mapping], match: Mapping[str, Column],
                   fk: str) -> DataFrame:
    ent = _fresh("__ent")
    lists = [F.collect_list(F.when(cond, F.struct(*slots[name]["columns"]))).alias(f"__slot_{name}")
             for name, cond in match.items()]
    wide = rows.groupBy(F.col(fk).alias(ent)).agg(*lists)
    df = df.join(wide, F.col(key) == F.col(ent), "left").drop(ent)
    for name, spec in slots.items():
        slot = f"__slot_{name}"
        df = df.withColumn(slot, F.explode_outer(slot))
        df = df.withColumns({out: F.col(slot).getField(c) for c, out in spec["columns"].items()}).drop(slot)
    return df


def eav_pivot(eav: DataFrame, fk: str, type_col: str, value_col: str,
              types: Mapping[int, str]) -> DataFrame:
    """One row per entity with one column per attribute type (JOI-09, pivot form).

    Only equivalent to the faithful form when (entity, type) is unique, which
    is checked (``check_unique``, one aggregate job); the pivot values are
    listed so Spark does not scan for them first.
    """
    rows = eav.filter(F.col(type_col).isin(list(types)) & F.col(fk).isNotNull())
    check_unique(rows, [fk, type_col], "attribute pivot")
    wide = rows.groupBy(fk).pivot(type_col, list(types)).agg(F.first(value_col))
    return wide.select(fk, *[F.col(str(t)).alias(name) for t, name in types.items()])


def union_tagged(branches: Iterable[DataFrame], distinct: bool = True, collation: str | None = None) -> DataFrame:
    """Positional UNION of branches (names from the first); DISTINCT like SQL UNION (SET-01), under ``collation``."""
    it = iter(branches)
    out = next(it)
    for b in it:
        out = out.union(b)
    return distinct_under(out, collation) if distinct else out


def assign_keys(new_rows: DataFrame, existing: DataFrame, key_col: str,
                order_cols: Sequence[str]) -> DataFrame:
    """Dense surrogate keys ``max(existing) + 1 ...`` in natural-key order (SNK-04).

    Distributed without a global single-task window: rows are range
    partitioned by the natural key and sorted inside each partition, the
    position inside a partition comes from ``monotonically_increasing_id``
    (partition id in the high bits, record number in the low 33 bits), the
    numbered rows are checkpointed once, and
    each partition's offset is the running total of the per-partition counts
    (one row per partition, broadcast back).  The existing maximum enters as
    a scalar subquery.
    """
    base = existing.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("bigint")).scalar()
    low_bits = (1 << 33) - 1
    # The numbering is read twice (per-partition counts and the rows), and a
    # recomputed range partitioning may place rows differently; checkpoint it
    # once into the shared checkpoint folder so both reads see the same rows
    # (this also cuts lineage before the key assignment).
    checkpoint_dir(new_rows.sparkSession)
    numbered = (new_rows.repartitionByRange(*order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("__id", F.monotonically_increasing_id())
                .withColumn("__pid", F.shiftrightunsigned("__id", 33))
                .withColumn("__rn", F.col("__id").bitwiseAND(F.lit(low_bits)) + 1)
                .checkpoint(eager=True))
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(
            Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("__off"))
    out = (numbered.join(F.broadcast(offsets), "__pid")  # one row per partition
           .withColumn(key_col, (base + F.col("__off") + F.col("__rn")).cast("bigint")))
    return out.drop("__id", "__pid", "__rn", "__off")


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "") -> DataFrame:
    """Raise if ``keys`` is not unique in ``df`` (SNK-06); returns ``df`` for chaining.

    One aggregate job; only a single offending key is fetched to the driver.
    """
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .filter(F.col("__n") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"duplicate key {dict(dup[0].asDict())} in {name or keys}")
    return df
