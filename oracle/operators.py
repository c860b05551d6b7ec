"""Oracle SQL (DuckDB) for the operator-level queries in ``trialmart.plans.probes``."""

from __future__ import annotations

from oracle.marts import CL, DK, FL, FN, RUN, U
from trialmart.plans.probes import COLLATED, INPUTS
from trialmart.sources.derived import for_duckdb


_MIXED = """
WITH mixed AS (
  SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN lower(n) ELSE n END AS spelled
  FROM (SELECT *, n_name || CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE '' END AS n
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey))"""


def _w(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({for_duckdb(INPUTS[n])})" for n in names) + "\n"


def _collated(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({for_duckdb(COLLATED[n])})" for n in names)


def _k(text: str) -> str:
    """What the source's collation compares: no case, no accents, no trailing blanks."""
    return f"lower(strip_accents(rtrim({text})))"


def _classes(relation: str, text: str, other: str = "") -> str:
    """One row per class of equal text columns, the first in binary order."""
    columns = [*text.split(), *other.split()]
    keys = ", ".join([*(_k(c) for c in text.split()), *other.split()])
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS place_"
            f" FROM ({relation})) WHERE place_ = 1")


def _new_codes(known: str, distinct: str) -> str:
    return _collated("col_labs", "col_refs") + f""",
fresh AS (SELECT lab_name, lab_code FROM ({distinct}) f
          WHERE NOT EXISTS (SELECT 1 FROM col_refs WHERE {known}))
SELECT lc_idx, labdesc, labname_mq, cpt, map_status FROM col_refs
UNION ALL
SELECT (SELECT max(lc_idx) FROM col_refs) + row_number() OVER (ORDER BY lab_name, lab_code), lab_name, lab_code, NULL, 'Unknown' FROM fresh"""


_NAMED_LABS = "SELECT lab_name, lab_code FROM col_labs WHERE lab_name IS NOT NULL"
_ACTIVITY = """
SELECT patient_name, mrn, app_dttm, activity_desc AS activity, provider_initials AS provider, location, '' AS drug, '' AS lab, '' AS code,
       '' AS notes, '' AS cycle, 'Appt' AS source FROM col_appointments
UNION ALL SELECT patient_name, mrn, app_dttm, '', provider, '', drug_name, '', '', '', 'C1 / D2', 'Chemo' FROM col_chemos
UNION ALL SELECT patient_name, mrn, app_dttm, '', provider, '', '', lab_name, lab_code, condition_notes, '', 'Labs' FROM col_labs"""

CYCLE = ("trim(CASE WHEN cyc = 0 THEN '' ELSE 'C' || CAST(cyc AS VARCHAR) || ' / ' END"
         " || CASE WHEN day = 0 THEN '' ELSE 'D' || CAST(day AS VARCHAR) END"
         " || CASE WHEN dly = 0 THEN '' ELSE ' Delayed' END)")

SQL = {
    "lookup_code": """
SELECT c.c_custkey, c.fk, n.n_name AS nation_name
FROM (SELECT c_custkey, CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 99
             ELSE c_nationkey END AS BIGINT) AS fk FROM customer) c
LEFT JOIN nation n ON n.n_nationkey = c.fk""",
    "lookup_chained": """
SELECT c.c_custkey, n.n_name AS nation_name, r.r_name AS region_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "lookup_master": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, o.o_orderpriority, c.c_name
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey""",
    "lookup_multi_role": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, sn.n_name AS supplier_nation, cn.n_name AS customer_nation
FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey""",
    "sink_changed_parts": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 40 = 1 THEN '?' ELSE o_orderstatus END AS o_orderstatus,
               TIMESTAMP '2024-02-03 06:00:00' AS "xDMrunDt"
        FROM orders""",
    "sink_rerun": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "quality_report": """
WITH wide AS (
  SELECT o_orderstatus, o_orderkey, l_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_suppkey % 3 = 0),
named AS (
  SELECT o_orderstatus, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0)
SELECT 'order_lines' AS mart, '20240202060000' AS run_id, count(*) AS rows, count(DISTINCT o_orderkey) AS driving_rows,
       1000 * count(*) // count(DISTINCT o_orderkey) AS fan_out_milli,
       (SELECT count(*) FROM wide WHERE o_orderstatus = 'F') AS rows_before,
       count(*) FILTER (l_orderkey IS NULL) AS null_lines, CAST(NULL AS BIGINT) AS null_names
FROM wide WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'order_customers', '20240202060000', count(*), count(*), 1000, (SELECT count(*) FROM named WHERE o_orderstatus <> 'F'),
       CAST(NULL AS BIGINT), count(*) FILTER (c_name IS NULL)
FROM named WHERE o_orderstatus <> 'O'""",
    "register_new_codes_anti": _new_codes("labdesc = lab_name", f"SELECT DISTINCT * FROM ({_NAMED_LABS})"),
    "register_new_codes_collated": _new_codes(f"{_k('labdesc')} = {_k('lab_name')}", _classes(_NAMED_LABS, "lab_name lab_code")),
    "worklist_collated": _collated(*COLLATED) + f""",
trials AS ({_classes(f"SELECT * FROM col_studies WHERE {_k('researchType_st_lu')} = 'industrial'", "studyNumber_st title_st", "pkStudy_st")}),
people AS (SELECT studyNumber_st, title_st, patStudyId_pp, personCode_p, upper(patLast_p || ', Zoe ') AS patName
           FROM col_patients JOIN trials USING (pkStudy_st) WHERE regexp_matches(personCode_p, '^-?[0-9]+$')),
pats AS ({_classes("people", "personCode_p studyNumber_st title_st patStudyId_pp patName")}),
activity AS ({_classes(f"SELECT * FROM ({_ACTIVITY}) WHERE {_k('mrn')} IN (SELECT {_k('personCode_p')} FROM pats)",
                       "patient_name mrn activity provider location drug lab code notes cycle source", "app_dttm")}),
mapping AS ({_classes(f"SELECT * FROM col_refs WHERE {_k('labdesc')} <> ''", "labdesc cpt cpt_additional labname_tricore map_status")}),
schedules AS ({_classes(f"SELECT * FROM col_calendar WHERE {_k('statusDesc_se1')} = 'current schedule'", "personCode_p scheduleName_ea")})
SELECT studyNumber_st, title_st AS studyTitle_st, patStudyId_pp, patName AS patName_p, mrn AS MRN_mq, app_dttm AS ApptDate_mq,
       activity AS Activity_mq, drug AS DrugName_mq, lab AS LabName_mq, code AS LabCode_mq, cycle AS CycleInfo_mq, source AS Source_mq,
       cpt, map_status, scheduleName_ea
FROM activity JOIN pats ON {_k('mrn')} = {_k('pats.personCode_p')}
LEFT JOIN schedules ON {_k('schedules.personCode_p')} = {_k('mrn')}
LEFT JOIN mapping ON {_k('labdesc')} = {_k('lab')}""",
    "lookup_roles_melted": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey END AS k1,
         CASE WHEN l_linenumber = 1 THEN -1 ELSE l_suppkey % 40 END AS k2, l_suppkey AS k3 FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(k1 AS BIGINT) AS first, CAST(k2 AS BIGINT) AS second, CAST(k3 AS BIGINT) AS third,
       a.s_name AS first_name, a.s_nationkey AS first_nation, a.s_nationkey AS first_nation_again,
       b.s_name AS second_name, c.s_name AS third_name, c.s_suppkey AS third_key
FROM lines LEFT JOIN supplier a ON a.s_suppkey = k1 LEFT JOIN supplier b ON b.s_suppkey = k2
LEFT JOIN supplier c ON c.s_suppkey = k3""",
    "left_join_hot_keys": """
WITH lines AS (
  SELECT CASE WHEN l_orderkey % 10 < 6 THEN 7 WHEN l_orderkey % 10 = 6 THEN 11 WHEN l_orderkey % 10 = 7 THEN NULL
              ELSE o_custkey END AS k, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT c_custkey, c_name, l_orderkey, l_linenumber FROM customer LEFT JOIN lines ON k = c_custkey""",
    "lookup_reference": """
SELECT o.o_orderkey, substr(o.o_orderpriority, 1, 1) AS code, r.description AS priority_name,
       r.report_sort AS priority_sort
FROM orders o LEFT JOIN (
  SELECT DISTINCT substr(o_orderpriority, 1, 1) AS value, o_orderpriority AS description,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10 AS report_sort
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '3') r
  ON r.value = substr(o.o_orderpriority, 1, 1)""",
    "self_join_parent": _w("part_text") + """
SELECT c.p_partkey, c.parent_key, p.p_name AS parent_name
FROM part_text c LEFT JOIN part p ON p.p_partkey = c.parent_key""",
    "self_join_text_key": _w("part_text") + f"""
SELECT DISTINCT c.p_partkey, c.parent_text, {U('c.parent_text')} AS parent_num, p.p_name AS parent_name
FROM part_text c LEFT JOIN part p ON p.p_partkey = {U('c.parent_text')}""",
    "left_join_expand": """
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0""",
    "left_join_composite": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, a.n_lines, a.max_line
FROM lineitem l LEFT JOIN (
  SELECT l_orderkey, l_suppkey, count(*) AS n_lines, CAST(max(l_linenumber) AS BIGINT) AS max_line
  FROM lineitem GROUP BY l_orderkey, l_suppkey) a
  ON a.l_orderkey = l.l_orderkey AND a.l_suppkey = l.l_suppkey AND a.l_suppkey % 4 <> 0""",
    "left_join_filtered_right": """
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT'""",
    "left_join_on_predicate": """
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0""",
    "eav_slots": """
SELECT e.conv_id, t0.text AS turn0_text, t1.text AS turn1_text, t2.text AS turn2_text,
       lt.role AS late_user_role, lt.turn AS late_user_turn
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN conversations t0 ON t0.conv_id = e.conv_id AND t0.turn = 0
LEFT JOIN conversations t1 ON t1.conv_id = e.conv_id AND t1.turn = 1
LEFT JOIN conversations t2 ON t2.conv_id = e.conv_id AND t2.turn = 2
LEFT JOIN conversations lt ON lt.conv_id = e.conv_id AND lt.turn IN (3, 4) AND lt.role = 'user'""",
    "eav_pivot": """
SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS turn0_text,
       max(CASE WHEN turn = 1 THEN text END) AS turn1_text,
       max(CASE WHEN turn = 2 THEN text END) AS turn2_text
FROM conversations WHERE turn IN (0, 1, 2) GROUP BY conv_id""",
    "inner_chain": """
SELECT o.o_orderkey, l.l_linenumber, p.p_partkey, p.p_name
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND o.o_orderstatus = 'F'
JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size > 40""",
    "left_join_null_rejecting": _w("order_text") + """
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN order_text o ON o.o_custkey = c.c_custkey WHERE o.priority = '1-URGENT'""",
    "left_join_isnull_kept": _w("order_text") + """
SELECT c.c_custkey, o.o_orderkey FROM customer c
LEFT JOIN (SELECT * FROM order_text WHERE o_custkey % 3 <> 0) o ON o.o_custkey = c.c_custkey
WHERE o.disc_dt IS NULL""",
    "anti_not_exists": """
SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F')""",
    "anti_left_isnull": """
SELECT d.doc_id, d.lang, d.source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.quality IS NULL""",
    "assign_surrogate_key": """
WITH p AS (SELECT p_partkey, p_name || ' #' || CAST(p_size AS VARCHAR) AS natural_key FROM part),
ref AS (SELECT p_partkey AS lc_idx, natural_key FROM p WHERE p_partkey % 2 = 0),
new AS (SELECT DISTINCT natural_key FROM p WHERE p_partkey % 2 = 1
        AND natural_key NOT IN (SELECT natural_key FROM ref))
SELECT natural_key, CAST((SELECT coalesce(max(lc_idx), 0) FROM ref)
       + row_number() OVER (ORDER BY natural_key ASC NULLS FIRST) AS BIGINT) AS lc_idx FROM new""",
    "join_distinct_list": """
SELECT l.l_orderkey, l.l_linenumber, b.o_orderpriority FROM lineitem l
JOIN (SELECT DISTINCT o.o_orderkey, o.o_orderpriority FROM orders o
      JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_mktsegment = 'BUILDING') b
  ON b.o_orderkey = l.l_orderkey""",
    "left_join_distinct_dim": """
SELECT c.c_custkey, d.o_orderpriority FROM customer c
LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F') d
  ON d.o_custkey = c.c_custkey""",
    "agg_string_list": _w("order_text") + """
SELECT o_custkey, string_agg(DISTINCT priority, ' | ' ORDER BY priority) AS priorities
FROM order_text GROUP BY o_custkey""",
    "agg_filtered_count": """
SELECT c.c_custkey, n.n_urgent FROM customer c
LEFT JOIN (SELECT o_custkey, count(o_orderkey) AS n_urgent FROM orders
           WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) n ON n.o_custkey = c.c_custkey""",
    "latest_per_group": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
WHERE l_linenumber = (SELECT max(m.l_linenumber) FROM lineitem m WHERE m.l_orderkey = l.l_orderkey)""",
    "latest_then_filter": """
SELECT event_id, user_id, event_type, ts FROM events e
WHERE event_id = (SELECT max(m.event_id) FROM events m
                  WHERE m.user_id = e.user_id AND m.event_type = e.event_type)
  AND ts >= TIMESTAMP '2024-01-25 00:00:00'""",
    "union_distinct": """
SELECT user_id, event_type FROM events WHERE event_type = 'view'
UNION SELECT user_id, event_type FROM events WHERE event_type = 'click'
UNION SELECT user_id, event_type FROM events WHERE value > 50""",
    "union_tagged_sources": """
SELECT user_id AS user_key, ts AS event_ts, props AS view_props, '' AS purchase_props,
       '' AS signup_props, 'View' AS source_tag FROM events WHERE event_type = 'view'
UNION SELECT user_id, ts, '', props, '', 'Purchase' FROM events WHERE event_type = 'purchase'
UNION SELECT user_id, ts, '', '', props, 'Signup' FROM events WHERE event_type = 'signup'""",
    "distinct_rows": f"""
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority, {RUN} AS xDMrunDt FROM orders""",
    "filter_equality": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_null_conjunction": _w("order_text") + """
SELECT o_orderkey, enroll_dt FROM order_text WHERE enroll_dt IS NOT NULL AND disc_dt IS NULL""",
    "filter_not_blank": _w("cust_text") + """
SELECT c_custkey, maybe_blank FROM cust_text WHERE rtrim(maybe_blank) <> ''""",
    "filter_in_list": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (2, 5)",
    "filter_date_threshold": """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-01-01'""",
    "filter_regex_numeric": _w("cust_text") + """
SELECT c_custkey, code FROM cust_text WHERE regexp_matches(code, '^-?[0-9]+$')""",
    "fn_clip": _w("cust_text") + f"""
SELECT c_custkey, {CL('padded', 10)} AS name10, {CL('padded', 25)} AS name25,
       {CL('maybe_blank', 3)} AS seg3 FROM cust_text""",
    "fn_substring": _w("cust_text") + """
SELECT c_custkey, substr(padded, 1, 5) AS name5, substr(padded, 1, 20) AS name20,
       substr(maybe_blank, 1, 2) AS seg2 FROM cust_text""",
    "fn_trim": _w("cust_text") + """
SELECT c_custkey, rtrim(padded) AS rtrimmed, trim('  ' || padded) AS trimmed,
       rtrim(maybe_blank) AS blank_rtrim FROM cust_text""",
    "fn_initial": _w("cust_text") + """
SELECT c_custkey, substr(first_name, 1, 1) AS first_initial,
       last_name || ' ' || substr(first_name, 1, 1) AS last_initial FROM cust_text""",
    "fn_date_key": _w("order_text") + f"""
SELECT o_orderkey, {DK('o_orderdate')} AS order_day, {DK('disc_dt')} AS disc_day FROM order_text""",
    "lookup_collated": _MIXED + """
SELECT c_custkey, spelled, n_nationkey AS nation_key
FROM mixed LEFT JOIN nation ON lower(n_name) = rtrim(lower(spelled))""",
    "distinct_collated": _MIXED + """
SELECT min(spelled) AS spelled, c_mktsegment FROM (
  SELECT spelled, min(c_mktsegment) OVER (PARTITION BY rtrim(lower(c_mktsegment))) AS c_mktsegment FROM mixed)
GROUP BY rtrim(lower(spelled)), c_mktsegment""",
    "sink_full_refresh": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "sink_snapshot_history": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN stamp END AS "xDMrunDt", run_id
FROM orders, (VALUES ('20240201060000', TIMESTAMP '2024-02-01 06:00:00'),
                     ('20240202060000', TIMESTAMP '2024-02-02 06:00:00')) AS n(run_id, stamp)""",
    "fn_to_unsigned": _w("part_text") + f"""
SELECT p_partkey, num_text, {U('num_text')} AS num_value, {U('rtrim(num_text)')} AS num_value_rtrim,
  CAST(CASE WHEN num_text IS NULL THEN NULL WHEN d = '' THEN 0
       ELSE least(CAST(d AS HUGEINT), 9223372036854775807) END AS BIGINT) AS saturated,
  CAST(CASE WHEN num_text IS NULL THEN NULL WHEN d = '' THEN 0
       ELSE least(CAST(d AS HUGEINT), 18446744073709551615) END AS VARCHAR) AS unsigned_text
FROM (SELECT *, regexp_extract(num_text || '99999999999999999', '^\\s*([0-9]+)', 1) AS d FROM part_text)""",
    "fn_full_name": _w("cust_text") + f"""
SELECT c_custkey, {FN('first_name', 'last_name')} AS full_name FROM cust_text""",
    "fn_last_first": _w("cust_text") + """
SELECT c_custkey, last_name || ', ' || first_name AS last_first FROM cust_text""",
    "fn_name_collapse": _w("cust_text") + """
SELECT c_custkey, replace(coalesce(first_name, '') || ' ' || coalesce(middle_name, '') || ' '
       || coalesce(last_name, ''), '  ', ' ') AS pat_name FROM cust_text""",
    "fn_name_upper": _w("cust_text") + """
SELECT c_custkey, upper(replace(coalesce(last_name, '') || ', ' || coalesce(first_name, '') || ' '
       || CASE WHEN length(middle_name) > 0 THEN middle_name || '.' ELSE '' END, '  ', ' ')) AS pat_name
FROM cust_text""",
    "fn_cycle_label": f"""
SELECT l_orderkey, l_linenumber, {CYCLE} AS cycle_info FROM (
  SELECT l_orderkey, l_linenumber,
         CAST(CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber % 3 END AS BIGINT) AS cyc,
         l_partkey % 4 AS day,
         CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 3 = 1 THEN 1 ELSE 0 END AS dly
  FROM lineitem) x""",
    "case_flag": _w("order_text") + f"SELECT o_orderkey, {FL('done_flag')} AS done_yn FROM order_text",
    "case_label": _w("order_text") + """
SELECT o_orderkey, CASE WHEN priority = '1-URGENT' THEN 'Urgent' ELSE 'Routine' END AS urgency
FROM order_text""",
    "case_code_map": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN 'Open'
       ELSE '' END AS status_name FROM orders""",
    "case_code_map_null": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN 'Open'
       END AS status_name FROM orders""",
    "case_category": _w("part_text") + """
SELECT p_partkey, CASE
  WHEN category_type IN (7111, 7112) AND study_type = 'TRE' THEN 'Interventional Treatment'
  WHEN category_type IN (7111, 7112) AND study_type <> 'TRE' THEN 'Interventional Non-Treatment'
  WHEN category_type NOT IN (7111, 7112) THEN 'Non-Interventional'
  WHEN category_type IS NULL THEN '' END AS category FROM part_text""",
    "case_fallback": _w("order_text") + """
SELECT o_orderkey, CASE WHEN dropdown = 'Other' OR dropdown IS NULL THEN o_orderstatus ELSE dropdown END AS funding
FROM (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'P' THEN 'Other' ELSE priority END AS dropdown FROM order_text) x""",
    "project_alias": """
SELECT c_custkey AS pkPerson_p, c_name AS personCode_p, c_mktsegment AS segment_p FROM customer""",
    "project_deidentified": "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
    "rename_to_contract": """
SELECT o_orderkey AS pkOrder_o, o_custkey AS pkCustomer_c, o_orderstatus AS status_o FROM orders""",
    "check_unique_key": "SELECT o_orderkey, o_custkey FROM orders",
    "run_stamp": f"SELECT r_regionkey, {RUN} AS xDMrunDt FROM region",
}


def operator_sql() -> dict[str, str]:
    return dict(SQL)
