"""Publishing, history and the nightly run."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from trialmart.contracts import conform, declared
from trialmart.operators import check_unique, eav_pivot
from trialmart.plans.contracts import MART_SCHEMAS
from trialmart.session import checkpoint_dir
from trialmart.quality import Watch, watched
from trialmart.sinks import (PARENTS, TABLES, NightlyError, archive_snapshot, current, leftovers, manifest, nightly, publish,
                             quality_report, read_current, run_nightly, versions)
from trialmart.sources import SOURCE_TABLES, SourceSet, from_testdata


def _folder():
    return tempfile.mkdtemp(prefix="trialmart-test-")


def test_history_archive_keeps_all_rows_once(spark):
    base = _folder()
    snap = spark.sql("SELECT id, IF(id % 2 = 0, TIMESTAMP_NTZ '2024-02-01 06:00:00', NULL) AS xDMrunDt FROM range(5)")
    history = f"{base}/history"
    for run in ("20240201060000", "20240202060000"):
        path = publish(snap, base, "worklist", run)
        archive_snapshot(spark, path, history, run)
        archive_snapshot(spark, path, history, run)
    rows = spark.read.parquet(history)
    assert rows.count() == 10 and rows.where("xDMrunDt is null").count() == 4


def test_half_written_partition_is_completed(spark):
    base = _folder()
    history = f"{base}/history"
    path = publish(spark.range(7), base, "worklist", "1")
    archive_snapshot(spark, publish(spark.range(2), base, "part", "1"), history, "1")
    archive_snapshot(spark, path, history, "1")
    assert spark.read.parquet(history).count() == 7


def test_publish_new_version_and_repoint(spark):
    base = _folder()
    publish(spark.range(3), base, "m", "1", table="tm_publish_test")
    publish(spark.range(7), base, "m", "2", table="tm_publish_test")
    assert spark.table("tm_publish_test").count() == 7
    assert versions(spark, base, "m") == ["1", "2"] and versions(spark, base, "none") == []


def test_readers_survive_a_rerun_that_dies(spark):
    """A rerun writes beside the published version; killed midway, it leaves the pointer, the table and all rows."""
    base = _folder()
    path = publish(spark.range(1000), base, "m", "1", table="tm_rerun_test")
    before, open_reader = current(spark, base, "m"), read_current(spark, base, "m")
    dying = spark.range(0, 1000, 1, 8).withColumn("id", F.when(F.col("id") == 990, F.raise_error(F.lit("killed"))).otherwise(F.col("id") + 5000))
    with pytest.raises(Exception, match="killed"):
        publish(dying, base, "m", "1", table="tm_rerun_test")
    assert current(spark, base, "m") == before and before["path"] == path and before["rows"] == 1000
    assert open_reader.count() == read_current(spark, base, "m").count() == spark.table("tm_rerun_test").count() == 1000
    left = leftovers(spark, base, "m")
    assert len(left) == 1 and path not in left
    # a rerun that ends replaces the version; whoever still reads the old one has all its rows
    again = publish(spark.range(7), base, "m", "1", table="tm_rerun_test")
    assert again != path and open_reader.count() == 1000 and spark.table("tm_rerun_test").count() == 7
    assert manifest(spark, base, "m", "1")["rows"] == 7 and versions(spark, base, "m") == ["1"]
    assert set(leftovers(spark, base, "m")) == {*left, path}
    with pytest.raises(ValueError, match="no published version"):
        read_current(spark, base, "other")


def test_metrics_cost_no_job(spark):
    def jobs(action):
        group = f"jobs-{action.__name__}"
        spark.sparkContext.setJobGroup(group, group)
        action()
        spark.sparkContext.setJobGroup("other", "other")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    base, df = _folder(), spark.range(100).selectExpr("id", "IF(id % 4 = 0, NULL, id) AS k").groupBy("id", "k").count()

    def plain():
        df.write.parquet(f"{base}/plain")

    def observed():
        with Watch() as watch:
            publish(watched(df, "driving").union(df), base, "m", "1", keys=["k"], watch=watch)

    def both():
        df.union(df).write.parquet(f"{base}/both")

    assert jobs(observed) <= jobs(both) and jobs(plain) >= 1
    assert manifest(spark, base, "m", "1")["metrics"] == {"driving": {"rows": 100}, "written": {"rows": 200, "null_k": 50}}
    publish(spark.createDataFrame([], "k long"), base, "none", "1", keys=["k"])
    assert manifest(spark, base, "none", "1")["rows"] == 0
    assert watched(df) is df


def test_failed_night_resumes(spark, monkeypatch):
    """One mart fails: its dependants wait, the others are published; the resumed run builds the rest only."""
    base, src, night = _folder(), from_testdata(spark, SMOKE), "2024-02-01 06:00:00"
    real, spans = nightly.build_patient, {}

    def timer(name, fn):
        begin = time.perf_counter()
        out = fn()
        spans[name] = (begin, time.perf_counter())
        return out

    def broken(*_):
        raise OSError("disk")

    monkeypatch.setattr(nightly, "build_patient", broken)
    with pytest.raises(NightlyError, match="patient") as error:
        run_nightly(spark, src, base, night, timer=timer)
    assert set(error.value.failed) == {"patient"} and set(error.value.skipped) == {"accruals", "enrollments", "statuses", "worklist"}
    done = {"study", "study_current", "calendar", "study_team", "lab_refs"}
    assert set(error.value.paths) == set(spans) == done
    ordered = sorted(spans.values())
    assert any(b[0] < a[1] for a, b in zip(ordered, ordered[1:]))  # marts were written at the same time
    first = {m: manifest(spark, base, m, "20240201060000")["path"] for m in done}
    monkeypatch.setattr(nightly, "build_patient", real)
    spans.clear()
    paths = run_nightly(spark, src, base, night, timer=timer, resume=True)
    assert set(spans) == set(PARENTS) - done and {m: paths[m] for m in done} == first
    report = {r.mart: r for r in quality_report(spark, base, "20240201060000").collect()}
    assert set(report) == set(PARENTS) and report["study_team"].fan_out_milli == 1000
    assert all(r.rows == spark.read.parquet(paths[m]).count() for m, r in report.items())
    assert report["patient"].driving_rows == src["er_patprot"].where("patprot_stat = 1").count()
    assert report["study"].null_keys["pkStudy_st"] == 0 and report["study"].rows_before is None


def test_contract_is_checked(spark):
    contract = declared("b bigint, A string")
    df = spark.sql("SELECT 'x' AS a, 1L AS B, 2 AS more")
    assert conform(df, contract, "t").columns == ["b", "A"]
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("a"), contract, "t")
    with pytest.raises(ValueError, match="types differ"):
        publish(df.withColumn("b", F.lit(1)), _folder(), "t", "1", contract=contract)


def test_duplicate_keys_stop_the_run(spark):
    twice = spark.sql("SELECT 1L AS pk_codelst, 'x' AS codelst_desc FROM range(2)")
    with pytest.raises(ValueError, match="duplicate key"):
        SourceSet({"er_codelst": twice}).check_keys()
    with pytest.raises(ValueError, match="duplicate key"):
        check_unique(twice, ["pk_codelst"])
    with pytest.raises(ValueError, match="duplicate key"):
        eav_pivot(twice, "pk_codelst", "pk_codelst", "codelst_desc", {1: "one"})


def test_checkpoint_folder_must_be_named(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    assert checkpoint_dir(spark)


def test_two_nights(spark):
    """Keys stay, the reference grows by new names only, history holds night 1 once also after a rerun."""
    base = _folder()
    src = from_testdata(spark, SMOKE)
    assert set(SOURCE_TABLES) == {n.lower() for n in src.names()}
    spark.sql("CREATE DATABASE IF NOT EXISTS trialmart_nights")
    spark.catalog.setCurrentDatabase("trialmart_nights")
    try:
        run_nightly(spark, src, base, "2024-02-01 06:00:00", tables=True)
        first = {r.labdesc: r.lc_idx for r in spark.table("ref_labs_cpts").collect()}
        night1 = spark.table("dm_PharmaPats_YDA").count()
        labs = src["mq_labs_90days"]
        new = labs.limit(1).withColumn("lab_name", F.lit("AAA NEW LAB"))
        later = SourceSet({n: src[n] for n in src.names()} | {"mq_labs_90days": labs.unionByName(new)})
        for _ in range(2):
            run_nightly(spark, later, base, "2024-02-02 06:00:00", tables=True)
            second = [(r.labdesc, r.lc_idx) for r in spark.table("ref_labs_cpts").collect()]
            assert {n for n, _ in second} - set(first) == {"AAA NEW LAB"}
            assert all(dict(second)[n] == k for n, k in first.items() if n is not None)
            assert len({k for _, k in second}) == len(second)
            history = spark.table("dm_PharmaPats_H")
            assert history.count() == night1 and history.select("run_id").distinct().count() == 1
        assert {t.name for t in spark.catalog.listTables()} >= {n.lower() for n in TABLES.values()}
        assert spark.table("dm_patient_statuses").columns == MART_SCHEMAS["statuses"].names
    finally:
        spark.catalog.setCurrentDatabase("default")
