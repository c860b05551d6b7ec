"""Plan assertions: the physical shape Catalyst picks for the operators."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from trialmart import operators as op
from trialmart.plans import MartBuild, probes
from trialmart.plans.accrual import study_patient
from trialmart.sources import from_testdata

RUN_TS = "2024-02-01 06:00:00"


def _plan(df):
    df.collect()  # AQE: look at the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(probes.lookup_code(spark, SMOKE))


def test_not_exists_is_left_anti(spark):
    assert "LeftAnti" in _plan(probes.anti_not_exists(spark, SMOKE))


def test_isnull_after_left_join_stays_outer(spark):
    assert "LeftOuter" in _plan(probes.left_join_isnull_kept(spark, SMOKE))


def test_filters_reach_the_scan(spark):
    plan = probes.filter_equality(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_latest_per_group_reads_once(spark):
    plan = _plan(probes.latest_then_filter(spark, SMOKE)).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")  # limited before rows travel


def test_latest_of_a_hot_group_is_reduced_before_the_exchange(spark):
    """A group of 70,000 rows over ten tasks: each sends its own maximum and the row that ended its limit."""
    rows = spark.range(0, 100_000, 1, 10).where("id % 10 < 7").selectExpr("1 AS g", "id AS o", "id")
    latest = op.latest_per_group(rows, ["g"], "o")
    assert [r.id for r in latest.collect()] == [99_996]
    assert _rows_of(latest._jdf.queryExecution().executedPlan(), "Exchange") <= 2 * 10


def _rows_of(plan, name):
    """Rows that the first node of that name wrote, from the metrics of the executed plan."""
    todo = [plan]
    while todo:
        node = todo.pop(0)
        kind = node.nodeName()
        if kind == name:
            return node.metrics().apply("shuffleRecordsWritten").value()
        if kind == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in kind:
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    raise LookupError(name)


# --- hot keys ---------------------------------------------------------------------------

SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_study_is_split_in_statuses(skewed):
    """M8: 70 % of the patients on one study; the inner part of the plan is split by AQE."""
    layout = [("s", ["pkStudy_st", "title"]), ("p", [("patient", None)])]
    study = skewed.range(50).selectExpr("id AS pkStudy_st", "repeat('t', 50) AS title")
    patient = (skewed.range(20_000).repartition(8)
               .selectExpr("IF(id % 10 < 7, 1L, id % 40) AS pkStudy_st", "CAST(id AS STRING) AS patient",
                           "IF(id % 3 = 0, 'x', NULL) AS discontinueDt_pp"))
    out = study_patient(study, patient, layout, RUN_TS, keep_studies_without_patients=True)
    assert "skew=true" in _plan(out)
    plain = (study.join(patient.withColumnRenamed("pkStudy_st", "k"), F.expr("pkStudy_st = k"), "left")
             .where("discontinueDt_pp IS NULL").select("pkStudy_st", "title", "patient").distinct())
    assert sorted(map(str, out.drop("xDMrunDt").collect())) == sorted(map(str, plain.collect()))


@pytest.fixture
def wide_shuffle(skewed):
    before = skewed.conf.get("spark.sql.shuffle.partitions")
    skewed.conf.set("spark.sql.shuffle.partitions", "200")
    yield skewed
    skewed.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_key_is_dealt_evenly(wide_shuffle):
    """M1, M4: a key with 70 % of the rows and 200 partitions: no task has twice the median, no row is lost or doubled."""
    left = wide_shuffle.range(4000).selectExpr("IF(id = 59, NULL, id) AS k", "id AS l")
    right = wide_shuffle.range(60_000).selectExpr("IF(id % 10 < 7, 3L, id % 5000) AS r_k", "id AS r")
    out = op.expand_left(left, right, "k", "r_k", "r", least_rows=50)
    plain = left.join(right, F.expr("k = r_k"), "left")
    assert out.columns == ["k", "l", "r_k", "r"]
    assert sorted(map(str, out.select("k", "l", "r").collect())) == sorted(map(str, plain.select("k", "l", "r").collect()))
    rows = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(rows) == 200 and rows[-1] <= 2 * rows[100]
    whole = max(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert whole > 40_000


def test_only_heavy_keys_are_salted(spark):
    keys = spark.range(50_000).selectExpr("CASE WHEN id % 2 = 0 THEN 1 WHEN id % 10 = 1 THEN 2 WHEN id % 10 = 3 THEN NULL ELSE id END AS k")
    salts = {r.k: r.salts for r in op.heavy_keys(keys, "k", parts=100, pieces=4).collect()}
    assert set(salts) == {1, 2}  # 50 % and 10 % of the rows, nulls don't count
    assert salts[1] == pytest.approx(4 * 100 * 25 / 45, abs=2) and salts[2] == pytest.approx(4 * 100 * 5 / 45, abs=2)
    assert op.heavy_keys(keys.where("k > 2"), "k", parts=100).isEmpty() and op.heavy_keys(keys.limit(0), "k").isEmpty()
    plan = op.expand_left(spark.range(9), keys.where("k > 2").selectExpr("k", "k AS r"), "id", "k", "r")
    assert "__salt" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_user_roles_share_one_join(spark):
    """M4 without broadcasts: the eight user roles need one join with the users and one exchange of the fact."""
    src = from_testdata(spark, SMOKE)
    wanted = sorted(map(str, MartBuild(src, run_ts=RUN_TS).calendar.collect()))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        calendar = MartBuild(src, run_ts=RUN_TS).calendar
        assert sorted(map(str, calendar.collect())) == wanted and len(wanted) > 100
        final = calendar._jdf.queryExecution().executedPlan().toString()
        logical = calendar._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Join Inner, \(__key#", logical)) == 1 and "pk_user" not in "".join(re.findall("Join .*", logical))
        assert final.split("== Initial Plan ==")[0].count("hashpartitioning(__fact_hash") == 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_melted_roles_equal_single_lookups(spark):
    dim = spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (3, None, 3.0)], "pk long, name string, x double")
    df = spark.createDataFrame([(k, a, b) for k in range(40) for a, b in [(1, 2), (None, 3), (3, 3), (9, None), (None, None), (2, 1)]],
                               "id long, a long, b long").unionByName(spark.createDataFrame([(1, 1, 2)], "id long, a long, b long"))
    roles = {"a": {"name": "a_name", "pk": "a_pk"}, "b": {"name": "b_name", "x": ["b_x", "b_x2"]}}
    melted, plain = op.lookup_roles_melted(df, dim, "pk", roles), df
    for fk, columns in roles.items():
        plain = op.lookup(plain, dim, (fk, "pk"), columns)
    assert melted.columns == plain.columns
    assert sorted(map(str, melted.collect())) == sorted(map(str, plain.collect()))
    assert op.lookup_roles_melted(df.limit(0), dim, "pk", roles).collect() == []
    assert op.lookup_roles_melted(df, dim.limit(0), "pk", roles).where("a_name IS NOT NULL OR b_x IS NOT NULL").count() == 0


def test_eav_is_scanned_once(spark):
    src = from_testdata(spark, SMOKE, ["er_studyid", "er_study"])
    eav = src["er_studyid"]
    slots = {f"s{t}": {"types": [t], "columns": {"studyid_id": f"v{t}"}} for t in (6068, 7109, 8004)}
    out = op.eav_slots(src["er_study"].select("pk_study"), eav, "pk_study", slots)
    once = eav.filter(F.col("fk_codelst_idtype").isin([6068, 7109, 8004])).select("fk_study")
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves(out) == leaves(src["er_study"].select("pk_study")) + leaves(once)
    chain = src["er_study"].select("pk_study")
    for t in (6068, 7109, 8004):
        chain = op.lookup(chain, eav, ("pk_study", "fk_study"), {"studyid_id": f"v{t}"}, where=F.col("fk_codelst_idtype") == t)
    assert sorted(map(str, out.collect())) == sorted(map(str, chain.collect()))


def test_hot_entity_never_is_one_row(wide_shuffle):
    """JOI-09: one study holds 70 % of the attributes, most of them in one slot; results as by one join per slot, spread over tasks."""
    spark = wide_shuffle
    eav = spark.range(12_000).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 5L WHEN id % 400 = 9 THEN NULL ELSE id % 3000 END AS fk_study",
        "CAST(CASE WHEN id % 10 < 7 THEN IF(id > 11990, 2, 1) ELSE 1 + id % 3 END AS INT) AS fk_codelst_idtype",
        "IF(id % 3 = 0, 'Y', 'v' || (id % 5000)) AS studyid_id", "id AS pk_studyid")
    df = spark.range(3100).selectExpr("IF(id = 3099, NULL, id) AS pk_study", "'t' || id AS title")
    slots = {"one": {"types": [1], "columns": {"studyid_id": "v1"}}, "two": {"types": [2, 3], "columns": {"studyid_id": "v2", "fk_codelst_idtype": "t2"}},
             "yes": {"types": [3], "value": "Y", "columns": {"studyid_id": "v3"}}}
    out = op.eav_slots(df, eav, "pk_study", slots, least_rows=50)
    plain = df
    for spec in slots.values():
        where = F.col("fk_codelst_idtype").isin(spec["types"])
        if "value" in spec:
            where = where & (F.col("studyid_id") == spec["value"])
        plain = op.lookup(plain, eav, ("pk_study", "fk_study"), spec["columns"], where=where)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    hot = out.where("pk_study = 5")
    parts = [r["count"] for r in hot.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(parts) > 50_000 and len(parts) >= 50 and max(parts) < sum(parts) / 20


def test_worklist_restricts_activity_first(spark):
    build = MartBuild(from_testdata(spark, SMOKE), run_ts=RUN_TS)
    plan = build.worklist._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    top = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("Aggregate" in line for line in lines[:top])  # no distinct above the last join
    assert "LeftSemi" in plan


def test_worklist_does_not_hold_the_plans_of_its_parents(spark):
    """The driver plans M2, M3 and M4 once, not at each of the seven reads of the patients."""
    build = MartBuild(from_testdata(spark, SMOKE), run_ts=RUN_TS)
    plan = build.worklist._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 15
