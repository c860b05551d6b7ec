"""Marts in parts: a version writes changed parts only and reads like a full refresh."""

import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from trialmart.quality import Watch, watched
from trialmart.sinks import (PARENTS, TABLES, Parts, current, leftovers, manifest, publish, quality_report, read_current,
                             read_version, run_nightly)
from trialmart.sources import SourceSet, from_testdata


def _folder():
    return tempfile.mkdtemp(prefix="trialmart-test-")


def _rows(df):
    return sorted(map(str, df.collect()))


def _files(base):
    return {f for f in glob.glob(f"{base}/**/*.parquet", recursive=True) if os.path.isfile(f)}


def _mart(spark, hot=0):
    return spark.range(4000).selectExpr(
        f"CASE WHEN id % 10 < {hot} THEN 7L WHEN id % 13 = 0 THEN NULL ELSE id % 97 END AS k", "id DIV 2 AS v",
        "IF(id % 5 = 0, NULL, concat('t', id % 11)) AS t", "TIMESTAMP_NTZ '2024-02-01 06:00:00' AS xDMrunDt")


def _stamp(night):
    return {"xDMrunDt": f"TIMESTAMP_NTZ '{night}'"}


@pytest.mark.parametrize("hot", [0, 7])
def test_only_changed_parts_are_written(spark, hot):
    base, first = _folder(), _mart(spark, hot)
    publish(first, base, "m", "1", "tm_parts_test", keys=["k"], parts=Parts("k", _stamp("2024-02-01 06:00:00"), 20, least_rows=50))
    one, files = current(spark, base, "m"), _files(base)
    assert one["rows"] == 4000 == sum(p["rows"] for p in one["parts"].values())
    assert set(one["layout"]["heavy"]) == ({"7"} if hot else set())
    assert max(p["rows"] for p in one["parts"].values()) < 3 * 4000 / 20  # also with null keys and a hot key
    assert _rows(read_current(spark, base, "m")) == _rows(first) == _rows(spark.table("tm_parts_test"))

    # the same rows in another order, another night: no file, all rows, the new stamp
    night2 = first.orderBy(F.rand(3)).withColumn("xDMrunDt", F.lit("2024-02-02 06:00:00").cast("timestamp_ntz"))
    publish(night2, base, "m", "2", "tm_parts_test", keys=["k"], parts=Parts("k", _stamp("2024-02-02 06:00:00"), 20))
    two = current(spark, base, "m")
    assert _files(base) == files and two["written"] == [] and two["metrics"] == one["metrics"]
    assert _rows(read_current(spark, base, "m")) == _rows(night2) == _rows(spark.table("tm_parts_test"))

    # one key changed: its parts only; a repeated row, a lost key and null against value are changes, too
    night3 = (night2.withColumn("t", F.when((F.col("k") == 5) & (F.col("v") < 100), None).otherwise(F.col("t")))
              .where("k IS NULL OR k <> 6").union(night2.where("k = 8").limit(1)))
    publish(night3, base, "m", "3", "tm_parts_test", keys=["k"], parts=Parts("k", _stamp("2024-02-02 06:00:00")))
    three = current(spark, base, "m")
    assert 1 <= len(three["written"]) <= 3 and len(_files(base)) == len(files) + len(three["written"])
    assert _rows(read_current(spark, base, "m")) == _rows(night3) == _rows(spark.table("tm_parts_test"))
    assert _rows(read_version(spark, manifest(spark, base, "m", "1"))) == _rows(first)  # earlier versions stay whole
    assert leftovers(spark, base, "m") == []


def test_digests_see_small_changes(spark):
    """Rows that swap a value, a null that moves to the next column, a row that appears twice."""
    base = _folder()
    tables = [[(1, "a", None), (1, "b", "c")], [(1, None, "a"), (1, "b", "c")], [(1, "a", "c"), (1, "b", None)],
              [(1, "a", None), (1, "b", "c"), (1, "b", "c")], [(1, "", None), (1, "b", "c")], [(1, None, None), (1, "b", "c")]]
    for night, rows in enumerate(tables):
        publish(spark.createDataFrame(rows, "k int, x string, y string"), base, "m", str(night), parts=Parts("k", count=3))
        assert len(current(spark, base, "m")["written"]) == 1
        assert _rows(read_current(spark, base, "m")) == _rows(spark.createDataFrame(rows, "k int, x string, y string"))


def test_nested_columns_other_columns_and_empty(spark):
    base, how = _folder(), Parts("k", count=4)
    df = spark.range(50).selectExpr("id AS k", "array(id, NULL) AS a", "map('x', id) AS m", "named_struct('p', id, 'q', NULL) AS s")
    publish(df, base, "m", "1", "tm_parts_other", parts=how)
    publish(df, base, "m", "2", "tm_parts_other", parts=how)
    assert current(spark, base, "m")["written"] == [] and _rows(read_current(spark, base, "m")) == _rows(df)
    wider = df.withColumn("__x", F.lit(1))  # another column: nothing can be linked
    publish(wider, base, "m", "3", "tm_parts_other", parts=how)
    assert len(current(spark, base, "m")["written"]) == 4 and _rows(spark.table("tm_parts_other")) == _rows(wider)
    publish(wider.limit(0), base, "m", "4", "tm_parts_other", parts=how)
    assert read_current(spark, base, "m").count() == spark.table("tm_parts_other").count() == 0
    assert read_current(spark, base, "m").columns == spark.table("tm_parts_other").columns == wider.columns
    publish(wider, base, "m", "5", "tm_parts_other")  # a full refresh again, and back
    assert _rows(spark.table("tm_parts_other")) == _rows(wider)
    publish(wider, base, "m", "6", "tm_parts_other", parts=how)
    assert _rows(spark.table("tm_parts_other")) == _rows(read_current(spark, base, "m")) == _rows(wider)
    with pytest.raises(ValueError, match="lacks"):
        publish(df, base, "m", "7", parts=Parts("k", {"none": "1"}))


def test_write_of_parts_that_dies(spark):
    """Readers keep the version they had; the next run writes what the dead one did not finish."""
    base, how = _folder(), Parts("k", count=4)
    df = spark.range(400).selectExpr("id % 40 AS k", "id AS v")
    publish(df, base, "m", "1", "tm_parts_dies", parts=how)
    dying = df.withColumn("v", F.when(F.col("v") == 399, F.raise_error(F.lit("killed"))).otherwise(F.col("v") + 1))
    with pytest.raises(Exception, match="killed"):
        publish(dying, base, "m", "2", "tm_parts_dies", parts=how)
    assert _rows(read_current(spark, base, "m")) == _rows(spark.table("tm_parts_dies")) == _rows(df)
    changed = df.withColumn("v", F.col("v") + 1)
    publish(changed, base, "m", "2", "tm_parts_dies", parts=how)
    assert len(current(spark, base, "m")["written"]) == 4 and _rows(spark.table("tm_parts_dies")) == _rows(changed)


def test_watched_rows_of_parts(spark):
    base, df = _folder(), spark.range(100).selectExpr("id AS k", "IF(id % 4 = 0, NULL, id) AS n")
    for night in "12":
        with Watch() as watch:
            publish(watched(df).union(df), base, "m", night, keys=["n"], watch=watch, parts=Parts("k", count=3))
        assert manifest(spark, base, "m", night)["metrics"] == {"driving": {"rows": 100}, "written": {"rows": 200, "null_n": 50}}


def test_random_nights_equal_a_full_refresh(spark):
    rng, base = random.Random(8), _folder()
    rows = [(rng.choice([None, *range(30)]), rng.randrange(5), rng.choice([None, "", "a", "é"])) for _ in range(300)]
    for night in range(5):
        for _ in range(rng.randrange(0, 4)):
            rows[rng.randrange(len(rows))] = (rng.choice([None, *range(30)]), rng.randrange(5), rng.choice([None, "", "a", "é"]))
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v int, t string").repartition(1 + night)
        publish(df, base, "m", str(night), parts=Parts("k", count=6))
        assert _rows(read_current(spark, base, "m")) == _rows(df)
        assert len(current(spark, base, "m")["written"]) <= (6 if night == 0 else 2 * 3)


def test_two_nights_of_changed_parts(spark):
    """An unchanged night writes the patient mart and history only; a changed one gives the rows of a full refresh."""
    src, base = from_testdata(spark, SMOKE), _folder()
    spark.sql("CREATE DATABASE IF NOT EXISTS trialmart_parts")
    spark.catalog.setCurrentDatabase("trialmart_parts")
    try:
        run_nightly(spark, src, base, "2024-02-01 06:00:00", tables=True, changed_only=True)
        night1 = read_current(spark, base, "worklist")
        before = _rows(night1)
        files = {m: _files(f"{base}/{m}") for m in PARENTS}
        run_nightly(spark, src, base, "2024-02-02 06:00:00", tables=True, changed_only=True)
        for mart in set(PARENTS) - {"patient"}:
            assert _files(f"{base}/{mart}") == files[mart] and current(spark, base, mart)["written"] == []
        assert _rows(spark.table("dm_PharmaPats_H").drop("run_id")) == before

        studies = src["er_study"].withColumn("study_title", F.when(F.col("pk_study") == 3, "another title").otherwise(F.col("study_title")))
        later = SourceSet({n: src[n] for n in src.names()} | {"er_study": studies})
        run_nightly(spark, later, base, "2024-02-03 06:00:00", tables=True, changed_only=True)
        full = _folder()
        run_nightly(spark, later, full, "2024-02-03 06:00:00")
        for mart in PARENTS:
            got, want = read_current(spark, base, mart), read_current(spark, full, mart)
            if mart == "lab_refs":  # its rows keep the time of the night that added them
                got, want = got.drop("createDtTm"), want.drop("createDtTm")
            assert got.columns == want.columns and _rows(got) == _rows(want)
            assert spark.table(TABLES[mart]).count() == want.count()
        study = current(spark, base, "study")
        assert 0 < len(study["written"]) < len(study["parts"]) and current(spark, base, "study_team")["written"] != list(study["parts"])
        report = {r.mart: r.rows for r in quality_report(spark, base, "20240203060000").collect()}
        assert report == {m: read_current(spark, full, m).count() for m in PARENTS}
    finally:
        spark.catalog.setCurrentDatabase("default")
