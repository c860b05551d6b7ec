"""Operator semantics on tiny inputs."""

import pytest
from pyspark.sql import functions as F

from trialmart import operators as op


def test_lookup_keeps_left_rows(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, fk long")
    dim = spark.createDataFrame([(10, "ten")], "pk long, d string")
    out = op.lookup(left, dim, ("fk", "pk"), {"d": ["d1", "d2"]})
    assert sorted(out.collect()) == [(1, 10, "ten", "ten"), (2, None, None, None), (3, 99, None, None)]


def test_lookup_right_side_filter_keeps_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "id long")
    team = spark.createDataFrame([(1, 8132, "D"), (1, 9, "D"), (2, 8132, "S")], "s long, r long, t string")
    out = op.lookup(left, team, ("id", "s"), {"r": "role"},
                    where=(F.col("r") == 8132) & (F.col("t") == "D"))
    assert sorted(out.collect()) == [(1, 8132), (2, None)]


def test_string_list_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k long, v string")
    got = dict(op.string_list(df, "k", "v", out="l").collect())
    assert got == {1: "a | b", 2: None}


def test_latest_per_group_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (1, 7), (2, 3), (None, 9)], "g long, o long")
    got = sorted(op.latest_per_group(df, ["g"], "o").collect())
    assert got == [(1, 7), (1, 7), (2, 3)]


def test_latest_per_group_null_orders_and_several_keys(spark):
    df = spark.createDataFrame([(1, "a", None, 1), (1, "a", 2.0, 2), (1, "a", float("nan"), 3), (1, "a", float("nan"), 4), (1, "b", 1.0, 5),
                                (1, None, 9.0, 6), (2, "a", None, 7), (2, "b", -1.0, 8)], "g long, h string, o double, __rank int")
    assert sorted(r["__rank"] for r in op.latest_per_group(df, ["g", "h"], "o").collect()) == [3, 4, 5, 8]
    assert op.latest_per_group(df.limit(0), ["g", "h"], "o").collect() == []


def test_exclude_active(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "s long")
    ex = spark.createDataFrame([(1, "Y"), (2, "N")], "pk_study long, is_active string")
    assert sorted(op.exclude_active(df, ex, "s").collect(), key=str) == sorted([(2,), (None,)], key=str)


def test_eav_slots_fan_out(spark):
    ent = spark.createDataFrame([(1,), (2,)], "pk long")
    eav = spark.createDataFrame([(1, 10, "a"), (1, 20, "Y"), (1, 21, "Y"), (2, 10, "b")],
                                "fk_study long, fk_codelst_idtype long, studyid_id string")
    slots = {"x": {"types": [10], "columns": {"studyid_id": "x"}},
             "cat": {"types": [20, 21], "value": "Y", "columns": {"fk_codelst_idtype": "cat"}}}
    got = sorted(op.eav_slots(ent, eav, "pk", slots).collect(), key=str)
    assert got == sorted([(1, "a", 20), (1, "a", 21), (2, "b", None)], key=str)


def test_assign_keys_dense_in_natural_order(spark):
    existing = spark.createDataFrame([(5, "x")], "k long, n string")
    new = spark.createDataFrame([(n,) for n in ["d", "b", "a", "c"]], "n string").repartition(3)
    got = sorted(op.assign_keys(new, existing, "k", ["n"]).select("n", "k").collect())
    assert got == [("a", 6), ("b", 7), ("c", 8), ("d", 9)]


def test_check_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(ValueError):
        op.check_unique(df, ["k"])


def test_union_tagged_is_distinct_and_positional(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "c long, d string")
    out = op.union_tagged([a, b])
    assert out.columns == ["a", "b"] and sorted(out.collect()) == [(1, "x"), (2, "y")]
