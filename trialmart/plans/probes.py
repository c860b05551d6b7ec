"""Operator-level queries over the generated tables.

Each query exercises one library operator or function on whole tables, with
NULLs, blanks and junk text injected by expression (the generated tables
have none).  The matching DuckDB SQL is in ``oracle.operators``; the
injected inputs come from the same SQL text (``INPUTS``) on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart import operators as op
from trialmart import sinks
from trialmart.contracts import conform, declared
from trialmart.quality import Watch, watched
from trialmart.session import checkpoint_dir
from trialmart.plans.worklist import build_worklist, current_calendar_names, emr_activity, industrial_patients
from trialmart.plans.worklist import register_new_codes as register_codes
from trialmart.sources.derived import for_spark

RUN_TS = "2024-02-01 06:00:00"

# Inputs with injected edge values, shared with the oracle (common SQL subset).
INPUTS = {
    "cust_text": """
SELECT c_custkey, c_name, c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE c_custkey % 5 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' ELSE c_mktsegment END AS first_name,
  CASE c_custkey % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'Q'
       ELSE 'Middle' END AS middle_name,
  CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS STRING)
       ELSE split_part(c_name, '#', 1) || CAST(c_custkey % 13 AS STRING) END AS last_name,
  c_name || CASE WHEN c_custkey % 2 = 0 THEN '   ' ELSE '' END AS padded,
  CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN CAST(NULL AS STRING)
       ELSE c_mktsegment END AS maybe_blank,
  CASE c_custkey % 6 WHEN 0 THEN 'A' || CAST(c_custkey AS STRING) WHEN 1 THEN '-' || CAST(c_custkey AS STRING)
       WHEN 2 THEN '' WHEN 3 THEN split_part(c_name, '#', 2) || ' ' ELSE split_part(c_name, '#', 2) END AS code
FROM {customer}""",
    "part_text": """
SELECT p_partkey, p_name, p_type, CAST(p_size AS BIGINT) AS p_size,
  CASE p_partkey % 7 WHEN 0 THEN CAST(p_size AS STRING) || ' ' WHEN 1 THEN CAST(p_size AS STRING) || ',20'
       WHEN 2 THEN '' WHEN 3 THEN 'abc' WHEN 4 THEN CAST(NULL AS STRING)
       WHEN 5 THEN '  ' || CAST(p_size AS STRING) || 'x' ELSE CAST(p_size AS STRING) END AS num_text,
  CASE p_partkey % 4 WHEN 0 THEN CAST(CAST(FLOOR(p_partkey / 10) AS BIGINT) AS STRING) || ' '
       WHEN 1 THEN CAST(CAST(FLOOR(p_partkey / 10) AS BIGINT) AS STRING) || 'x'
       WHEN 2 THEN 'abc' ELSE CAST(NULL AS STRING) END AS parent_text,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(FLOOR(p_partkey / 10) AS BIGINT) END AS parent_key,
  CAST(CASE p_partkey % 5 WHEN 0 THEN 7110 WHEN 1 THEN 7111 WHEN 2 THEN 7112 WHEN 3 THEN 8089
       ELSE NULL END AS BIGINT) AS category_type,
  CASE WHEN p_type = 'SMALL' THEN CAST(NULL AS STRING) WHEN p_size % 2 = 0 THEN 'TRE' ELSE 'DIA' END AS study_type
FROM {part}""",
    "order_text": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
  CASE WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '200' DAY ELSE CAST(NULL AS TIMESTAMP) END AS disc_dt,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE o_orderdate END AS enroll_dt,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END AS BIGINT) AS done_flag
FROM {orders}""",
}


# A word in four spellings that are one under the source's collation.
_SPELL = ("CASE {k} % 4 WHEN 0 THEN {w} WHEN 1 THEN lower({w}) WHEN 2 THEN replace({w}, 'E', 'É') "
          "ELSE lower(replace({w}, 'A', 'à')) || '  ' END")


def _spelled(word: str, key: str) -> str:
    return _SPELL.format(w=word, k=key)


# Inputs of the worklist with spelled keys and constants, shared with the oracle (common SQL subset).
COLLATED = {
    "col_refs": f"""
SELECT CAST(n_nationkey * 10 AS BIGINT) AS lc_idx, CASE WHEN n_nationkey = 3 THEN CAST(NULL AS STRING) WHEN n_nationkey = 4 THEN '  '
       ELSE {_spelled('n_name', 'n_nationkey')} END AS labdesc, 'LC' || CAST(n_nationkey AS STRING) AS labname_mq,
  'CPT' || CAST(n_nationkey % 5 AS STRING) AS cpt, '' AS cpt_additional, '' AS labname_tricore,
  CASE WHEN n_nationkey % 2 = 0 THEN 'Mapped' ELSE 'mapped ' END AS map_status, '' AS comments,
  TIMESTAMP '2024-01-01 00:00:00' AS createDtTm, CAST(NULL AS TIMESTAMP) AS modDtTm
FROM {{nation}} WHERE n_nationkey % 3 <> 2""",
    "col_studies": f"""
SELECT CAST(s_suppkey AS BIGINT) AS pkStudy_st, 'ST-' || CAST(s_suppkey AS STRING) AS studyNumber_st,
  {_spelled("'TEA STUDY'", 's_suppkey')} AS title_st,
  CASE s_suppkey % 4 WHEN 0 THEN 'Industrial' WHEN 1 THEN 'industrial ' WHEN 2 THEN 'INDUSTRIÁL' ELSE 'Other' END AS researchType_st_lu
FROM {{supplier}}""",
    "col_patients": """
SELECT CAST(c_custkey % 9 AS BIGINT) AS pkStudy_st, 'P' || CAST(c_custkey AS STRING) AS patStudyId_pp,
  CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE '' END AS personCode_p, 'Y' AS statusIsCurrentFlag_pps,
  TIMESTAMP '2023-05-05 00:00:00' AS enroll_Dt_pp, CAST(NULL AS TIMESTAMP) AS discontinueDt_pp,
  c_mktsegment AS patLast_p, 'Zoe' AS patFirst_p, '' AS patMiddle_p
FROM {customer}""",
    "col_calendar": """
SELECT CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE '' END AS personCode_p,
  CASE c_custkey % 4 WHEN 0 THEN 'Current Schedule' WHEN 1 THEN 'current schedule ' WHEN 2 THEN 'Currént Schedule' ELSE 'Past Schedule' END
    AS statusDesc_se1,
  CASE WHEN c_custkey % 5 = 0 THEN 'visit' ELSE 'Visit ' END AS scheduleName_ea
FROM {customer}""",
    "col_appointments": f"""
SELECT 'Patient ' || CAST(o_custkey AS STRING) AS patient_name, CAST(o_custkey AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END AS mrn,
  TIMESTAMP '2024-01-31 08:00:00' AS app_dttm, {_spelled("'EARLY VISIT'", 'o_orderkey')} AS activity_desc,
  'AB' AS provider_initials, o_orderstatus AS location
FROM {{orders}}""",
    "col_chemos": f"""
SELECT 'Patient ' || CAST(o_custkey AS STRING) AS patient_name, CAST(o_custkey AS STRING) AS mrn,
  TIMESTAMP '2024-01-31 09:00:00' AS app_dttm, 'AB' AS provider, {_spelled("'TAXANE'", 'o_orderkey')} AS drug_name,
  CAST(1 AS BIGINT) AS cycle_number, CAST(2 AS BIGINT) AS cycle_day, CAST(0 AS BIGINT) AS dlyd
FROM {{orders}} WHERE o_orderkey % 3 = 0""",
    "col_labs": f"""
SELECT 'Patient ' || CAST(o_custkey AS STRING) AS patient_name, CAST(o_custkey AS STRING) AS mrn,
  TIMESTAMP '2024-01-31 10:00:00' AS app_dttm, 'AB' AS provider,
  CASE WHEN l_orderkey % 50 = 0 THEN CAST(NULL AS STRING) WHEN l_orderkey % 50 = 1 THEN ' ' ELSE {_spelled('n_name', 'l_orderkey')} END AS lab_name,
  'LC' || CAST(n_nationkey AS STRING) AS lab_code, 'fasting' AS condition_notes
FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey JOIN {{nation}} ON n_nationkey = l_suppkey % 25""",
}


def _input(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "part", "orders")}
    return spark.sql(for_spark(INPUTS[name]), **tables)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- lookups / joins -------------------------------------------------------

def lookup_code(spark, sf):
    c = _t(spark, sf, "customer").withColumn(
        "fk", F.when(F.col("c_custkey") % 13 == 0, None)
        .when(F.col("c_custkey") % 11 == 0, F.lit(99)).otherwise(F.col("c_nationkey")).cast("bigint"))
    out = op.lookup(c, _t(spark, sf, "nation"), ("fk", "n_nationkey"), {"n_name": "nation_name"})
    return out.select("c_custkey", "fk", "nation_name")


def lookup_chained(spark, sf):
    c = _t(spark, sf, "customer")
    c = op.lookup(c, _t(spark, sf, "nation"), ("c_nationkey", "n_nationkey"),
                  {"n_name": "nation_name", "n_regionkey": "__region"})
    c = op.lookup(c, _t(spark, sf, "region"), ("__region", "r_regionkey"), {"r_name": "region_name"})
    return c.select("c_custkey", "nation_name", "region_name")


def lookup_master(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    li = op.lookup(li, _t(spark, sf, "orders"), ("l_orderkey", "o_orderkey"),
                   {"o_custkey": "o_custkey", "o_orderpriority": "o_orderpriority"})
    li = op.lookup(li, _t(spark, sf, "customer"), ("o_custkey", "c_custkey"), {"c_name": "c_name"})
    return li


def lookup_multi_role(spark, sf):
    nation = _t(spark, sf, "nation")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    o = op.lookup(o, _t(spark, sf, "customer"), ("o_custkey", "c_custkey"), {"c_nationkey": "__cn"})
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    li = op.lookup(li, _t(spark, sf, "supplier"), ("l_suppkey", "s_suppkey"), {"s_nationkey": "__sn"})
    li = op.lookup(li, o, ("l_orderkey", "o_orderkey"), {"__cn": "__cn"})
    li = op.lookup_roles(li, nation, "n_nationkey",
                         {"__sn": {"n_name": "supplier_nation"}, "__cn": {"n_name": "customer_nation"}})
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "supplier_nation", "customer_nation")


def lookup_roles_melted(spark, sf):
    """Three roles of one dimension by one join: null keys, keys without a match, one key in two roles."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).cast("bigint").alias("first"),
        F.when(F.col("l_linenumber") == 1, F.lit(-1)).otherwise(F.col("l_suppkey") % 40).cast("bigint").alias("second"),
        F.col("l_suppkey").cast("bigint").alias("third"))
    return op.lookup_roles_melted(li, _t(spark, sf, "supplier"), "s_suppkey", {
        "first": {"s_name": "first_name", "s_nationkey": ["first_nation", "first_nation_again"]},
        "second": {"s_name": "second_name"}, "third": {"s_name": "third_name", "s_suppkey": "third_key"}})


def lookup_reference(spark, sf):
    o = _t(spark, sf, "orders")
    ref = (o.select(F.substring("o_orderpriority", 1, 1).alias("value"),
                    F.col("o_orderpriority").alias("description"),
                    (F.substring("o_orderpriority", 1, 1).cast("bigint") * 10).alias("report_sort"))
           .distinct()
           .withColumn("value", F.when(F.col("value") != "3", F.col("value"))))
    o = o.withColumn("code", F.substring("o_orderpriority", 1, 1))
    return op.lookup(o, ref, ("code", "value"),
                     {"description": "priority_name", "report_sort": "priority_sort"}).select("o_orderkey", "code", "priority_name", "priority_sort")


def self_join_parent(spark, sf):
    p = _input(spark, sf, "part_text")
    out = op.lookup(p, _t(spark, sf, "part"), ("parent_key", "p_partkey"), {"p_name": "parent_name"})
    return out.select("p_partkey", "parent_key", "parent_name")


def self_join_text_key(spark, sf):
    p = _input(spark, sf, "part_text").withColumn("parent_num", fn.to_unsigned("parent_text"))
    out = op.lookup(p, _t(spark, sf, "part"), ("parent_num", "p_partkey"), {"p_name": "parent_name"})
    return out.select("p_partkey", "parent_text", "parent_num", "parent_name").distinct()


def _customer_orders(spark, sf):
    o = _t(spark, sf, "orders").withColumn("__k", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")))
    return _t(spark, sf, "customer").select("c_custkey"), o.select("__k", "o_orderkey")


def left_join_expand(spark, sf):
    customers, orders = _customer_orders(spark, sf)
    return op.expand_left(customers, orders, "c_custkey", "__k", "o_orderkey").drop("__k")


def left_join_hot_keys(spark, sf):
    """Most lines on two customers, the rest spread; only those two are split, others and misses stay whole."""
    lines = (_t(spark, sf, "lineitem").join(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                                            F.col("l_orderkey") == F.col("o_orderkey"))
             .select(F.when(F.col("l_orderkey") % 10 < 6, F.lit(7)).when(F.col("l_orderkey") % 10 == 6, F.lit(11))
                     .when(F.col("l_orderkey") % 10 == 7, F.lit(None)).otherwise(F.col("o_custkey")).cast("bigint").alias("__k"),
                     "l_orderkey", "l_linenumber"))
    customers = _t(spark, sf, "customer").select("c_custkey", "c_name")
    return op.expand_left(customers, lines, "c_custkey", "__k", "l_orderkey", least_rows=100).drop("__k")


def left_join_composite(spark, sf):
    li = _t(spark, sf, "lineitem")
    agg = (li.groupBy("l_orderkey", "l_suppkey")
           .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_linenumber").cast("bigint").alias("max_line"))
           .withColumn("l_suppkey", F.when(F.col("l_suppkey") % 4 != 0, F.col("l_suppkey"))))
    out = op.lookup(li.select("l_orderkey", "l_linenumber", "l_suppkey"), agg,
                    [("l_orderkey", "l_orderkey"), ("l_suppkey", "l_suppkey")],
                    {"n_lines": "n_lines", "max_line": "max_line"})
    return out


def left_join_filtered_right(spark, sf):
    return op.lookup(_t(spark, sf, "customer").select("c_custkey"), _t(spark, sf, "orders"),
                     ("c_custkey", "o_custkey"), {"o_orderkey": "o_orderkey"},
                     where=(F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))


def left_join_on_predicate(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = op.lookup(c, _t(spark, sf, "orders"), ("c_custkey", "o_custkey"), {"o_orderkey": "o_orderkey"},
                    extra=F.col("c_acctbal") > 0)
    return out.select("c_custkey", "o_orderkey")


def _conversation_slots():
    return {
        "t0": {"types": [0], "columns": {"text": "turn0_text"}},
        "t1": {"types": [1], "columns": {"text": "turn1_text"}},
        "t2": {"types": [2], "columns": {"text": "turn2_text"}},
        "late": {"types": [3, 4], "value": "user", "columns": {"role": "late_user_role",
                                                                 "turn": "late_user_turn"}},
    }


def eav_slots(spark, sf):
    conv = _t(spark, sf, "conversations")
    entities = conv.select("conv_id").distinct()
    return op.eav_slots(entities, conv, "conv_id", _conversation_slots(), fk="conv_id",
                        type_col="turn", value_col="role")


def eav_pivot(spark, sf):
    conv = _t(spark, sf, "conversations")
    return op.eav_pivot(conv, "conv_id", "turn", "text",
                        {0: "turn0_text", 1: "turn1_text", 2: "turn2_text"})


def inner_chain(spark, sf):
    o = _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = _t(spark, sf, "part").filter(F.col("p_size") > 40).select("p_partkey", "p_name")
    return (o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
            .join(p, F.col("l_partkey") == F.col("p_partkey"), "inner")
            .select("o_orderkey", "l_linenumber", "p_partkey", "p_name"))


def left_join_null_rejecting(spark, sf):
    o = _input(spark, sf, "order_text").filter(F.col("priority") == "1-URGENT")
    c = _t(spark, sf, "customer").select("c_custkey")
    return (c.join(o, F.col("c_custkey") == F.col("o_custkey"), "inner")
            .select("c_custkey", "o_orderkey"))


def left_join_isnull_kept(spark, sf):
    o = _input(spark, sf, "order_text").select(
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "disc_dt")
    c = _t(spark, sf, "customer").select("c_custkey")
    return (c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
            .filter(F.col("disc_dt").isNull()).select("c_custkey", "o_orderkey"))


def anti_not_exists(spark, sf):
    flagged = _t(spark, sf, "orders").withColumn(
        "is_active", F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"),
                            "Y").otherwise("N"))
    return op.exclude_active(_t(spark, sf, "customer"), flagged, "c_custkey",
                             excl_key="o_custkey").select("c_custkey", "c_name")


def anti_left_isnull(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    out = op.lookup(docs, _t(spark, sf, "labels"), ("doc_id", "doc_id"), {"quality": "__q"})
    return out.filter(F.col("__q").isNull()).select("doc_id", "lang", "source")


def assign_surrogate_key(spark, sf):
    p = _t(spark, sf, "part").withColumn(
        "natural_key", F.concat("p_name", F.lit(" #"), F.col("p_size").cast("string")))
    ref = p.filter(F.col("p_partkey") % 2 == 0).select(F.col("p_partkey").alias("lc_idx"), "natural_key")
    new = (p.filter(F.col("p_partkey") % 2 == 1).select("natural_key")
           .join(ref.select("natural_key"), "natural_key", "left_anti").distinct())
    return op.assign_keys(new, ref, "lc_idx", ["natural_key"]).select("natural_key", "lc_idx")


def join_distinct_list(spark, sf):
    building = (_t(spark, sf, "orders")
                .join(_t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING"),
                      F.col("o_custkey") == F.col("c_custkey"), "inner")
                .select("o_orderkey", "o_orderpriority").distinct())
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return (li.join(building, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
            .select("l_orderkey", "l_linenumber", "o_orderpriority"))


def left_join_distinct_dim(spark, sf):
    dim = (_t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
           .select(F.col("o_custkey").alias("__ck"), "o_orderpriority").distinct())
    c = _t(spark, sf, "customer").select("c_custkey")
    return (c.join(dim, F.col("c_custkey") == F.col("__ck"), "left")
            .select("c_custkey", "o_orderpriority"))


# --- aggregation ------------------------------------------------------------

def agg_string_list(spark, sf):
    o = _input(spark, sf, "order_text")
    return op.string_list(o, "o_custkey", "priority", out="priorities")


def agg_filtered_count(spark, sf):
    cnt = op.filtered_count(_t(spark, sf, "orders"), "o_custkey", "o_orderkey",
                            F.col("o_orderpriority") == "1-URGENT", "n_urgent")
    return (_t(spark, sf, "customer").select("c_custkey")
            .join(cnt, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "n_urgent"))


def latest_per_group(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return op.latest_per_group(li, ["l_orderkey"], "l_linenumber")


def latest_then_filter(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    latest = op.latest_per_group(ev, ["user_id", "event_type"], "event_id")
    return latest.filter(fn.on_or_after("ts", "2024-01-25"))


# --- set operations -----------------------------------------------------------

def union_distinct(spark, sf):
    ev = _t(spark, sf, "events")
    return op.union_tagged([
        ev.filter(F.col("event_type") == "view").select("user_id", "event_type"),
        ev.filter(F.col("event_type") == "click").select("user_id", "event_type"),
        ev.filter(F.col("value") > 50).select("user_id", "event_type"),
    ])


def union_tagged_sources(spark, sf):
    ev = _t(spark, sf, "events")
    blank = F.lit("")
    return op.union_tagged([
        ev.filter(F.col("event_type") == "view").select(
            F.col("user_id").alias("user_key"), F.col("ts").alias("event_ts"),
            F.col("props").alias("view_props"), blank.alias("purchase_props"),
            blank.alias("signup_props"), F.lit("View").alias("source_tag")),
        ev.filter(F.col("event_type") == "purchase").select(
            "user_id", "ts", blank, "props", blank, F.lit("Purchase")),
        ev.filter(F.col("event_type") == "signup").select(
            "user_id", "ts", blank, blank, "props", F.lit("Signup")),
    ])


def distinct_rows(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()
    return o.withColumn("xDMrunDt", fn.run_stamp(RUN_TS))


# --- filters ---------------------------------------------------------------------

def filter_equality(spark, sf):
    return _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


def filter_null_conjunction(spark, sf):
    o = _input(spark, sf, "order_text")
    return (o.filter(F.col("enroll_dt").isNotNull() & F.col("disc_dt").isNull())
            .select("o_orderkey", "enroll_dt"))


def filter_not_blank(spark, sf):
    return _input(spark, sf, "cust_text").filter(fn.not_blank("maybe_blank")).select("c_custkey", "maybe_blank")


def filter_in_list(spark, sf):
    return (_t(spark, sf, "lineitem").filter(F.col("l_linenumber").isin(2, 5))
            .select("l_orderkey", "l_linenumber"))


def filter_date_threshold(spark, sf):
    return (_t(spark, sf, "orders").filter(fn.on_or_after("o_orderdate", "1998-01-01"))
            .select("o_orderkey", "o_orderdate"))


def filter_regex_numeric(spark, sf):
    return _input(spark, sf, "cust_text").filter(fn.is_signed_integer("code")).select("c_custkey", "code")


# --- scalar functions --------------------------------------------------------------

def fn_clip(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.clip("padded", 10).alias("name10"),
                    fn.clip("padded", 25).alias("name25"), fn.clip("maybe_blank", 3).alias("seg3"))


def fn_substring(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.cut("padded", 5).alias("name5"),
                    fn.cut("padded", 20).alias("name20"), fn.cut("maybe_blank", 2).alias("seg2"))


def fn_trim(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", F.rtrim("padded").alias("rtrimmed"),
                    F.trim(F.concat(F.lit("  "), F.col("padded"))).alias("trimmed"),
                    F.rtrim("maybe_blank").alias("blank_rtrim"))


def fn_initial(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.initial("first_name").alias("first_initial"),
                    fn.last_initial("last_name", "first_name").alias("last_initial"))


def fn_date_key(spark, sf):
    o = _input(spark, sf, "order_text")
    return o.select("o_orderkey", fn.date_key("o_orderdate").alias("order_day"),
                    fn.date_key("disc_dt").alias("disc_day"))


def fn_to_unsigned(spark, sf):
    p = _input(spark, sf, "part_text")
    huge = F.concat("num_text", F.lit("9" * 17))
    return p.select("p_partkey", "num_text", fn.to_unsigned("num_text").alias("num_value"),
                    fn.to_unsigned(F.rtrim("num_text")).alias("num_value_rtrim"),
                    fn.to_unsigned(huge).alias("saturated"),
                    fn.to_unsigned(huge, wide=True).cast("string").alias("unsigned_text"))


def fn_full_name(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.full_name("first_name", "last_name").alias("full_name"))


def fn_last_first(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.last_first("last_name", "first_name").alias("last_first"))


def fn_name_collapse(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.name_collapse("first_name", "middle_name", "last_name").alias("pat_name"))


def fn_name_upper(spark, sf):
    c = _input(spark, sf, "cust_text")
    return c.select("c_custkey", fn.name_upper("last_name", "first_name", "middle_name").alias("pat_name"))


def fn_cycle_label(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 11 == 0, None).otherwise(F.col("l_linenumber") % 3).cast("bigint").alias("cyc"),
        (F.col("l_partkey") % 4).alias("day"),
        F.when(F.col("l_suppkey") % 3 == 0, None).when(F.col("l_suppkey") % 3 == 1, 1).otherwise(0).alias("dly"))
    return li.select("l_orderkey", "l_linenumber", fn.cycle_label("cyc", "day", "dly").alias("cycle_info"))


# --- CASE shapes -------------------------------------------------------------------

def case_flag(spark, sf):
    o = _input(spark, sf, "order_text")
    return o.select("o_orderkey", fn.flag("done_flag").alias("done_yn"))


def case_label(spark, sf):
    o = _input(spark, sf, "order_text")
    return o.select("o_orderkey", fn.label(F.col("priority") == "1-URGENT", "Urgent", "Routine").alias("urgency"))


def case_code_map(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", fn.code_map("o_orderstatus", {"F": "Finished", "O": "Open"}).alias("status_name"))


def case_code_map_null(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", fn.code_map("o_orderstatus", {"F": "Finished", "O": "Open"},
                                              default=None).alias("status_name"))


def case_category(spark, sf):
    p = _input(spark, sf, "part_text")
    cat = fn.study_category(F.col("category_type"), F.col("study_type"), [7111, 7112], "TRE")
    return p.select("p_partkey", cat.alias("category"))


def case_fallback(spark, sf):
    o = _input(spark, sf, "order_text").withColumn(
        "dropdown", F.when(F.col("o_orderstatus") == "P", F.lit("Other")).otherwise(F.col("priority")))
    return o.select("o_orderkey", fn.fallback("dropdown", "o_orderstatus").alias("funding"))


# --- projections / contracts ---------------------------------------------------------

def project_alias(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("pkPerson_p"), F.col("c_name").alias("personCode_p"),
                    F.col("c_mktsegment").alias("segment_p"))


IDENTIFIED_CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]
CUSTOMER_PHI = ["c_name"]


def project_deidentified(spark, sf):
    c = _t(spark, sf, "customer").select(*IDENTIFIED_CUSTOMER)
    out = c.drop(*CUSTOMER_PHI)
    assert not set(out.columns) & set(CUSTOMER_PHI)
    return out


CONTRACT = {"o_orderkey": "pkOrder_o", "o_custkey": "pkCustomer_c", "o_orderstatus": "status_o"}


def rename_to_contract(spark, sf):
    """Renamed columns pass the contract in its order; a missing column and a wrong type are refused."""
    contract = declared("status_o string, pkOrder_o bigint, pkCustomer_c bigint")
    o = _t(spark, sf, "orders").select(*CONTRACT, "o_orderdate").withColumnsRenamed(CONTRACT)
    o = o.withColumns({c: F.col(c).cast("bigint") for c in ("pkOrder_o", "pkCustomer_c")})
    for broken in (o.drop("status_o"), o.withColumn("pkCustomer_c", F.col("pkCustomer_c").cast("string"))):
        try:
            conform(broken, contract, "orders")
        except ValueError:
            continue
        raise AssertionError("a broken table passed its contract")
    return conform(o, contract, "orders")


def check_unique_key(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return op.check_unique(o, ["o_orderkey"], "orders")


# --- collation -----------------------------------------------------------------------

def _mixed_case(spark, sf):
    """Nation names in changing spelling: lower case, upper case, trailing blanks."""
    name = F.concat("n_name", F.when(F.col("c_custkey") % 2 == 0, F.lit("  ")).otherwise(F.lit("")))
    c = op.lookup(_t(spark, sf, "customer"), _t(spark, sf, "nation"), ("c_nationkey", "n_nationkey"), {"n_name": "n_name"})
    return c.select("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, F.lower(name)).otherwise(name).alias("spelled"))


def lookup_collated(spark, sf):
    out = op.lookup(_mixed_case(spark, sf), _t(spark, sf, "nation"), ("spelled", "n_name"),
                    {"n_nationkey": "nation_key"}, collation=op.CASELESS)
    return out.select("c_custkey", "spelled", "nation_key")


def distinct_collated(spark, sf):
    return op.distinct_collated(_mixed_case(spark, sf), ["spelled", "c_mktsegment"])


def _collation_inputs(spark, sf):
    names = ("customer", "nation", "orders", "lineitem", "supplier")
    tables = {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in names}
    return {name: spark.sql(for_spark(sql), **tables) for name, sql in COLLATED.items()}


def register_new_codes_collated(spark, sf):
    """Lab names in other case, with accents or trailing blanks are the known ones; new spellings are added once."""
    inputs = _collation_inputs(spark, sf)
    out = register_codes(inputs["col_labs"], inputs["col_refs"], RUN_TS, "anti", op.ACCENTLESS)
    return out.select("lc_idx", "labdesc", "labname_mq", "cpt", "map_status")


def register_new_codes_anti(spark, sf):
    """The nightly default of M10: names that the reference lacks, binary comparison, NULL names left out."""
    inputs = _collation_inputs(spark, sf)
    out = register_codes(inputs["col_labs"], inputs["col_refs"], RUN_TS, "anti")
    return out.select("lc_idx", "labdesc", "labname_mq", "cpt", "map_status")


def worklist_collated(spark, sf):
    """M9 under a collation: joins, constants, UNION and DISTINCT ignore case, accents and trailing blanks."""
    i = _collation_inputs(spark, sf)
    patients = industrial_patients(i["col_studies"], i["col_patients"], op.ACCENTLESS)
    activity = emr_activity(i["col_appointments"], i["col_chemos"], i["col_labs"], patients, op.ACCENTLESS)
    names = current_calendar_names(i["col_calendar"], op.ACCENTLESS)
    out = build_worklist(activity, patients, i["col_refs"], names, RUN_TS, op.ACCENTLESS)
    return out.select("studyNumber_st", "studyTitle_st", "patStudyId_pp", "patName_p", "MRN_mq", "ApptDate_mq", "Activity_mq",
                      "DrugName_mq", "LabName_mq", "LabCode_mq", "CycleInfo_mq", "Source_mq", "cpt", "map_status", "scheduleName_ea")


# --- sinks ---------------------------------------------------------------------------

def sink_full_refresh(spark, sf):
    """Two refreshes of one mart; the second version is what readers get."""
    base = f"{checkpoint_dir(spark)}/probe-{uuid.uuid4()}"
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.publish(o.withColumn("o_orderstatus", F.lit("?")), base, "orders", "20240201060000")
    path = sinks.publish(o, base, "orders", "20240202060000")
    return spark.read.parquet(path)


def sink_snapshot_history(spark, sf):
    """Two nightly snapshots in history, the first archived twice; some rows have no stamp."""
    base = f"{checkpoint_dir(spark)}/probe-{uuid.uuid4()}"
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for night in ("20240201060000", "20240202060000"):
        stamp = F.when(F.col("o_orderkey") % 5 != 0, F.to_timestamp_ntz(F.lit(night), F.lit("yyyyMMddHHmmss")))
        path = sinks.publish(o.withColumn("xDMrunDt", stamp), base, "worklist", night)
        for _ in range(2):
            sinks.archive_snapshot(spark, path, f"{base}/history", night)
    return spark.read.parquet(f"{base}/history").select("o_orderkey", "o_orderstatus", "xDMrunDt", F.col("run_id").cast("string"))


def sink_changed_parts(spark, sf):
    """Three nights of orders in parts by customer: the second changes nothing but the stamp, the third some customers."""
    base = f"{checkpoint_dir(spark)}/probe-{uuid.uuid4()}"
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_custkey") % 40 == 1, F.lit("?")).otherwise(F.col("o_orderstatus")))
    for night, rows in (("2024-02-01 06:00:00", o), ("2024-02-02 06:00:00", o), ("2024-02-03 06:00:00", changed)):
        rows = rows.withColumn("xDMrunDt", fn.run_stamp(night))
        parts = sinks.Parts("o_custkey", {"xDMrunDt": f"TIMESTAMP_NTZ '{night}'"})
        sinks.publish(rows, base, "orders", sinks.run_id_of(night), parts=parts)
    return sinks.read_current(spark, base, "orders")


def sink_rerun(spark, sf):
    """A rerun of a published run that dies midway: readers keep the version they had."""
    base = f"{checkpoint_dir(spark)}/probe-{uuid.uuid4()}"
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.publish(o, base, "orders", "20240201060000")
    last = o.agg(F.max("o_orderkey")).scalar()
    dying = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("lost"))).otherwise(F.lit("?")))
    try:
        sinks.publish(dying, base, "orders", "20240201060000")
    except Exception as error:
        if "lost" not in str(error):
            raise
    return sinks.read_current(spark, base, "orders")


def quality_report(spark, sf):
    """Two nights of two marts; the figures are those that the writes observed."""
    base = f"{checkpoint_dir(spark)}/probe-{uuid.uuid4()}"
    orders, lines = _t(spark, sf, "orders"), _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    for night, status in (("20240201060000", "F"), ("20240202060000", "O")):
        with Watch() as watch:
            open_orders = watched(orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey"))
            wide = open_orders.join(lines.where("l_suppkey % 3 = 0"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
            sinks.publish(wide, base, "order_lines", night, keys=["o_orderkey", "l_orderkey"], watch=watch)
        with Watch() as watch:
            named = op.lookup(watched(orders.where(F.col("o_orderstatus") != status).select("o_orderkey", "o_custkey")),
                              _t(spark, sf, "customer"), ("o_custkey", "c_custkey"), {"c_name": "c_name"}, where=F.col("c_custkey") % 2 == 0)
            sinks.publish(named, base, "order_customers", night, keys=["c_name"], watch=watch)
    report = sinks.quality_report(spark, base, "20240202060000", ["order_lines", "order_customers"])
    return report.select("mart", "run_id", "rows", "driving_rows", "fan_out_milli", "rows_before",
                         F.col("null_keys")["l_orderkey"].alias("null_lines"), F.col("null_keys")["c_name"].alias("null_names"))


def run_stamp(spark, sf):
    return _t(spark, sf, "region").select("r_regionkey", fn.run_stamp(RUN_TS).alias("xDMrunDt"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        lookup_code, lookup_chained, lookup_master, lookup_multi_role, lookup_roles_melted, lookup_reference,
        self_join_parent, self_join_text_key, left_join_expand, left_join_hot_keys, left_join_composite,
        left_join_filtered_right, left_join_on_predicate, eav_slots, eav_pivot, inner_chain,
        left_join_null_rejecting, left_join_isnull_kept, anti_not_exists, anti_left_isnull,
        assign_surrogate_key, join_distinct_list, left_join_distinct_dim,
        agg_string_list, agg_filtered_count, latest_per_group, latest_then_filter,
        union_distinct, union_tagged_sources, distinct_rows,
        filter_equality, filter_null_conjunction, filter_not_blank, filter_in_list,
        filter_date_threshold, filter_regex_numeric,
        fn_clip, fn_substring, fn_trim, fn_initial, fn_date_key, fn_to_unsigned, fn_full_name,
        fn_last_first, fn_name_collapse, fn_name_upper, fn_cycle_label,
        case_flag, case_label, case_code_map, case_code_map_null, case_category, case_fallback,
        project_alias, project_deidentified, rename_to_contract, check_unique_key, run_stamp,
        lookup_collated, distinct_collated, worklist_collated, register_new_codes_collated, register_new_codes_anti, sink_full_refresh, sink_snapshot_history, sink_rerun, sink_changed_parts, quality_report,
    ]
}
