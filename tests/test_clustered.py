"""Marts in buckets by study: no exchange of patients in M6-M8, hot studies over sub-keys, same rows."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from trialmart.plans import build_accruals, build_enrollments, build_statuses
from trialmart.plans.accrual import study_patient
from trialmart.sinks import Clustering, current, manifest, measured, publish, read_current, read_version, run_nightly
from trialmart.sinks.clustered import DEAL, close_buckets, entry_name
from trialmart.sources import from_testdata

NIGHT, RUN = "2024-02-01 06:00:00", "20240201060000"
LAYOUT = [("s", ["pkStudy_st", "title"]), ("p", [("row", None), ("patient", None)])]


def _rows(df):
    return sorted(map(str, df.collect()))


def _exchanged(df):
    """What each shuffle of the executed plan reads of files (ReadSchema); only the patients are files here."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = text.splitlines()
    depth = [len(re.match(r"[\s:+\-|*()\d]*", line).group()) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if re.search(r"(?<!Broadcast)Exchange (hash|round|range|single)", line, re.I):
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                if "FileScan" in lines[j]:
                    found.append(re.search(r"ReadSchema: (.*)", lines[j]).group(1))
    return found


@pytest.fixture
def no_broadcast(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _patients(spark, hot):
    return spark.range(20_000).selectExpr(
        f"CASE WHEN id % 10 < {hot} THEN 1L WHEN id % 50 = 9 THEN NULL ELSE id % 300 END AS pkStudy_st", "id DIV 2 AS row",
        "CAST(id DIV 4 AS STRING) AS patient", "'Y' AS statusIsCurrentFlag_pps", "IF(id % 7 = 0, NULL, 'd') AS enroll_Dt_pp",
        "IF(id % 3 = 0, 'x', NULL) AS discontinueDt_pp")


@pytest.mark.parametrize("hot", [0, 7])
def test_patients_are_not_exchanged(no_broadcast, hot):
    spark, base = no_broadcast, tempfile.mkdtemp(prefix="trialmart-test-")
    study = spark.range(400).selectExpr("id AS pkStudy_st", "repeat('t', 50) AS title")
    patient = _patients(spark, hot)
    how = measured(patient, "pkStudy_st", "pkStudy_st", "row", least_rows=100)
    assert how.buckets == 40 and set(how.heavy) == ({"1"} if hot else set())
    publish(patient, base, "patient", "1", clustering=how)
    stored = read_version(spark, manifest(spark, base, "patient", "1"), clustered=True)
    for keep in (False, True):
        out = study_patient(study, stored, LAYOUT, NIGHT, keep, how)
        plain = study_patient(study, patient, LAYOUT, NIGHT, keep)
        assert _rows(out) == _rows(plain) and out.columns == plain.columns
        assert set(_exchanged(out)) <= {"struct<pkStudy_st:bigint>"} and (keep or not _exchanged(out))
        if hot:
            parts = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
            assert max(parts) < sum(parts) / 8  # the hot study holds 70 %
    unclustered = study_patient(study, read_current(spark, base, "patient"), LAYOUT, NIGHT)
    assert "patient:string" in "".join(_exchanged(unclustered))  # the check sees an exchange where there is one
    if hot:
        with pytest.raises(ValueError, match="lacks"):
            study_patient(study, stored, [("s", ["pkStudy_st"]), ("p", [("patient", None)])], NIGHT, clustering=how)


def test_buckets_are_found_again(spark):
    """The catalog entry is made from the manifest; the sub-key is not part of the mart or its table."""
    base, patient = tempfile.mkdtemp(prefix="trialmart-test-"), _patients(spark, 7)
    how = Clustering("pkStudy_st", "row", 6, {"1": 5})
    path = publish(patient, base, "patient", "1", "tm_clustered_test", clustering=how, keys=["pkStudy_st"])
    version = current(spark, base, "patient")
    assert version["rows"] == 20_000 and version["metrics"]["written"]["null_pkStudy_st"] == patient.where("pkStudy_st IS NULL").count()
    close_buckets(spark, path)
    again = read_version(spark, version, clustered=True)
    assert _rows(again.drop(DEAL)) == _rows(patient)
    assert again.where("pkStudy_st = 1").agg(F.count_distinct(DEAL)).first()[0] == 5
    assert again.where("pkStudy_st = 2 OR pkStudy_st IS NULL").agg(F.max(DEAL)).first()[0] == 0
    assert read_current(spark, base, "patient").columns == spark.table("tm_clustered_test").columns == patient.columns
    assert spark.table("tm_clustered_test").count() == 20_000
    publish(patient.limit(0), base, "patient", "2", "tm_clustered_test", clustering=how)
    assert spark.table("tm_clustered_test").count() == read_current(spark, base, "patient").count() == 0
    close_buckets(spark, current(spark, base, "patient")["path"])


def test_night_with_buckets_equals_plain_builds(spark):
    base, src = tempfile.mkdtemp(prefix="trialmart-test-"), from_testdata(spark, SMOKE)
    paths = run_nightly(spark, src, base, NIGHT)
    assert manifest(spark, base, "patient", RUN)["clustering"]["key"] == "pkStudy_st"
    assert not spark.catalog.tableExists(entry_name(paths["patient"]))
    study, patient = (read_current(spark, base, m) for m in ("study_current", "patient"))
    for name, build in [("accruals", build_accruals), ("enrollments", build_enrollments), ("statuses", build_statuses)]:
        assert _rows(spark.read.parquet(paths[name])) == _rows(build(study, patient, NIGHT))
