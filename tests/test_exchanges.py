"""How often wide rows travel in the marts, and how much one task holds, without broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from trialmart.operators import ACCENTLESS, distinct_under, heavy_keys
from trialmart.plans import MartBuild
from trialmart.plans.accrual import study_patient
from trialmart.plans.patient import _equal_inside
from trialmart.sources import from_testdata

RUN_TS = "2024-02-01 06:00:00"
OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in OFF}
    for k, v in OFF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_patients_travel_by_person_once(shuffled):
    """M3: protocols, records, facilities and persons meet by person; no exchange of the joined rows."""
    plan = _plan(MartBuild(from_testdata(shuffled, SMOKE), run_ts=RUN_TS).patient)
    top = [line for line in plan.splitlines() if "SortMergeJoin" in line][:3]
    assert ["fk_per#" in line for line in top] == [True] * 3
    assert len(re.findall(r"hashpartitioning\(fk_per#", plan)) == 1
    for key in ("__pss_per", "__pf_per"):
        assert len(re.findall(rf"hashpartitioning\({key}#\d+L, \d+\)", plan)) == 1


def test_equality_inside_a_group_is_equality(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (None, None), (None, 1), (2, None), (-3, -3)], "a long, b long")
    assert sorted(rows.where(_equal_inside("a", "b")).collect()) == [(-3, -3), (1, 1)]


LAYOUT = [("s", ["pkStudy_st", "title"]), ("p", [("patient", None), ("status_note", None)])]


def _patients(spark):
    """70 % of the rows on study 1, rows without a study, every row twice."""
    rows = spark.range(20_000).repartition(8).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 1L WHEN id % 10 = 7 THEN NULL ELSE id % 40 END AS pkStudy_st", "CAST(id AS STRING) AS patient",
        "IF(id % 4 = 0, NULL, 'n') AS status_note", "IF(id % 3 = 0, 'x', NULL) AS discontinueDt_pp")
    return rows.union(rows)


@pytest.mark.parametrize("hot", [True, False])
def test_statuses_deal_patients_once(shuffled, hot):
    """M8: one exchange serves DISTINCT and join; a hot study lies on sub-keys, the rows are those of the plain form."""
    few = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: shuffled.conf.get(k) for k in few}
    for k, v in few.items():
        shuffled.conf.set(k, v)
    try:
        study = shuffled.range(50).selectExpr("IF(id = 49, NULL, id) AS pkStudy_st", "repeat('t', 50) AS title")
        study = study.union(study)
        patient = _patients(shuffled)
        if not hot:
            patient = patient.where("pkStudy_st <> 1 OR pkStudy_st IS NULL")
        heavy = heavy_keys(patient, "pkStudy_st", least_rows=5000)
        assert [r.pkStudy_st for r in heavy.collect()] == ([1] if hot else [])
        args = (study, patient, LAYOUT, RUN_TS, True)
        out, plain = study_patient(*args, heavy=heavy), study_patient(*args)
        assert out.columns == plain.columns
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
        inner = _plan(study_patient(study, patient, LAYOUT, RUN_TS, True, heavy=heavy))
        assert not re.findall(r"hashpartitioning\([^)]*patient#", inner)  # no exchange of its own for DISTINCT
        assert re.findall(r"hashpartitioning\([^)]*patient#", _plan(plain))
        if hot:
            parts = [r["count"] for r in out.where("pkStudy_st = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert len(parts) > 20 and max(parts) < sum(parts) / 8
    finally:
        for k, v in before.items():
            shuffled.conf.set(k, v)


@pytest.mark.parametrize("mart", ["accruals", "enrollments", "statuses"])
def test_current_marts_exchange_patients_by_study_once(shuffled, mart):
    plan = _plan(getattr(MartBuild(from_testdata(shuffled, SMOKE), run_ts=RUN_TS), mart))
    assert "hashpartitioning(__p_study#" in plan
    assert not re.findall(r"hashpartitioning\([^)]*enrollOrg_pp_lu#", plan)


def test_study_columns_are_computed_before_the_fan_out(spark):
    """M1: texts and dates of a study are worked out once per study, not per status record and coordinator."""
    plan = MartBuild(from_testdata(spark, SMOKE), run_ts=RUN_TS).study._jdf.queryExecution().optimizedPlan().toString().splitlines()
    fan_out = next(i for i, line in enumerate(plan) if "Join" in line)
    above = "".join(plan[:fan_out])
    assert "regexp_extract" not in above and "AS phase_st_lu" not in above and "AS createDt_st#" not in above
    assert "AS phase_st_lu" in "".join(plan[fan_out:])


def test_collated_distinct_deals_rows_by_the_size_of_the_input(spark, tmp_path):
    """M9: four times the input gives four times the tasks; exact copies and other spellings still are one row."""
    rows = spark.range(20_000).selectExpr(
        "IF(id % 2 = 0, 'Row É', 'row e ') || CAST(IF(id % 10 < 3, 0, id DIV 4) AS STRING) AS name",
        "IF(id % 7 = 0, NULL, 'x') AS note", "IF(id % 3 = 0, NULL, 1) AS n")
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    found = {}
    for part in (1 << 40, 8192, 2048):
        out = distinct_under(rows, ACCENTLESS, input_bytes=part)
        found[part] = sorted(map(str, out.collect()))
        if part < 1 << 40:
            sizes = [int(n) for n in re.findall(r"REPARTITION_BY_NUM.*|, (\d+)\), REPARTITION_BY_NUM", _plan(out)) if n]
            assert len(sizes) >= 2 and len(set(sizes)) == 1
            found[part, "tasks"] = sizes[0]
    assert found[1 << 40] == found[8192] == found[2048] and 100 < len(found[2048]) < 20_000
    assert found[2048, "tasks"] >= 3 * found[8192, "tasks"] > 3
