"""Trial-system source tables derived from the driver's generated tables.

The marts need trial-management tables (``er_*``, ``sch_*``, ``person`` ...)
and medical-record extracts (``mq_*``).  For tests and the bench they are
derived by projection from the TPC-H-like tables, so that every mart grows
with the input and can be checked against an independent SQL oracle.

Each derived table is one SELECT written in the SQL subset that both Spark
and DuckDB accept; ``{name}`` marks an input table and ``TS'...'`` a
timestamp-without-time-zone literal.  Spark runs it with ``spark.sql`` and
DataFrame parameters; the oracle inlines the same text as CTEs.  NULLs,
blanks, junk text, missing codes and duplicate keys are injected by
expression (the generated tables contain no NULLs).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

NP = "(SELECT count(*) FROM {part})"          # number of studies
NU = "(SELECT count(*) FROM {supplier})"      # number of users


def _ufk(expr: str, null_mod: int) -> str:
    """A user reference: NULL for some rows, else a key of ``er_user``."""
    return (f"CASE WHEN ({expr}) % {null_mod} = 0 THEN CAST(NULL AS BIGINT) "
            f"ELSE CAST(({expr}) % {NU} AS BIGINT) END")


def _day(base: str, expr: str) -> str:
    return f"{base} + INTERVAL '1' DAY * ({expr})"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# Fixed code values the marts test by constant (code list keys and labels).
CODELIST_FIXED = """
  (30, 'TRE'), (31, 'DIA'), (32, 'PRE'), (33, 'SUP'), (34, 'OTH'),
  (40, 'Industrial'), (41, 'Cooperative Group'), (42, 'Institutional'),
  (50, 'Other'), (51, 'National Cancer Institute'), (52, 'Industry'),
  (8130, 'Primary Research Coordinator'), (8132, 'Primary Regulatory Coordinator'),
  (8211, 'Primary Data Coordinator'), (12087, 'Primary Lab Technician')"""

SCH_CODELIST_FIXED = """
  (285, 'active', 'Active'), (286, 'wipstat', 'Work in Progress'),
  (287, 'deactivated', 'Deactivated'), (288, 'reactivated', 'Reactivated')"""

RESEARCH_CATEGORY_FIXED = """
  ('OBS', 'Observational', 1), ('INT', 'Interventional', 2), ('OTH INT', 'Other Interventional', 3)"""

STUDY_TYPE_FIXED = """
  ('TRE', 'Treatment', 1), ('DIA', 'Diagnostic', 2), ('PRE', 'Prevention', 3),
  ('SUP', 'Supportive Care', 4)"""


def _eav_branch(type_expr: str, value_expr: str, where: str | None) -> str:
    w = f" WHERE {where}" if where else ""
    return (f"SELECT CAST(p_partkey AS BIGINT) AS fk_study, {_big(type_expr)} AS fk_codelst_idtype, "
            f"{value_expr} AS studyid_id FROM {{part}}{w}")


_EAV = " UNION ALL ".join([
    _eav_branch("6068", "'NCI-' || lpad(CAST(p_partkey AS STRING), 6, '0') || '  '", "p_partkey % 10 <> 0"),
    _eav_branch("7109", "CAST(p_size % 6 AS STRING)", "p_partkey % 9 <> 1"),
    _eav_branch("8004", "CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END", "p_partkey % 4 <> 0"),
    _eav_branch("8151", "CASE WHEN p_partkey % 3 = 0 THEN 'Y' ELSE 'N' END", None),
    _eav_branch("12085", "CASE p_partkey % 3 WHEN 0 THEN 'Treatment accrual credit' "
                         "WHEN 1 THEN 'Cancer control and screening accrual' ELSE 'None' END",
                "p_partkey % 5 <> 2"),
    _eav_branch("11065", "CAST(p_size % 4 + 1 AS STRING)", "p_partkey % 6 <> 5"),
    _eav_branch("9183", "CAST(p_size % 3 + 1 AS STRING) || CASE WHEN p_partkey % 10 = 3 "
                        "THEN 'st line' ELSE '' END", None),
    _eav_branch("CASE p_partkey % 5 WHEN 0 THEN 7110 WHEN 1 THEN 7111 WHEN 2 THEN 7112 "
                "WHEN 3 THEN 8089 ELSE 7111 END",
                "CASE WHEN p_partkey % 11 = 0 THEN 'N' ELSE 'Y' END", "p_partkey % 8 <> 7"),
    _eav_branch("7110", "'Y'", "p_partkey % 13 = 0"),
    _eav_branch("8576", "CASE p_partkey % 7 WHEN 0 THEN CAST(p_size % 8 AS STRING) || ' ' "
                        "WHEN 1 THEN 'x' || CAST(p_size % 8 AS STRING) ELSE CAST(p_size % 8 AS STRING) END",
                "p_partkey % 12 <> 11"),
    _eav_branch("12133", "CASE p_partkey % 6 WHEN 0 THEN CAST(p_size * 5 AS STRING) || ' ' "
                         "WHEN 1 THEN CAST(p_size * 5 AS STRING) || ',20' WHEN 2 THEN '' "
                         "WHEN 3 THEN 'abc' WHEN 4 THEN CAST(NULL AS STRING) "
                         "ELSE CAST(p_size * 5 AS STRING) END", None),
    _eav_branch("8295", "'Additional info for ' || p_name", "p_partkey % 3 <> 2"),
    _eav_branch("8295", "'Second note ' || p_brand", "p_partkey % 17 = 0"),
    _eav_branch("8258", "'IRB-' || lpad(CAST(p_partkey AS STRING), 9, '0')", "p_partkey % 7 <> 3"),
    _eav_branch("8259", "CASE WHEN p_partkey % 2 = 0 THEN 'Central IRB ' || p_brand "
                        "ELSE CAST(NULL AS STRING) END", None),
])


def _patstudystat(k: int) -> str:
    end = ("o_orderdate + INTERVAL '15' DAY" if k == 0
           else "CAST(NULL AS TIMESTAMP)")
    return f"""
SELECT {_big(f'o_orderkey * 2 + {k}')} AS pk_patstudystat,
  o_custkey AS fk_per,
  {_big(f'o_orderkey % {NP}')} AS fk_study,
  {_big(f'(o_orderkey + {k}) % 25')} AS fk_codelst_stat,
  {_big(f'CASE WHEN {k} = 1 AND o_orderkey % 8 <> 0 THEN 1 ELSE 0 END')} AS current_stat,
  o_orderdate + INTERVAL '{15 * k}' DAY AS patstudystat_date,
  {end} AS patstudystat_endt,
  {_big(f'CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey + {k}) % 25 END')} AS patstudystat_reason,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS STRING)
       ELSE 'Visit note ' || CAST(o_orderkey AS STRING) || ' step {k}' END AS patstudystat_note,
  'v' || CAST(o_orderkey % 4 + 1 AS STRING) AS inform_consent_ver,
  'SCR' || CAST(o_orderkey AS STRING) AS screen_number,
  {_ufk(f'o_orderkey + {k}', 9)} AS screened_by,
  {_big('CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 25 END')} AS screening_outcome,
  {_ufk(f'o_orderkey * 3 + {k}', 13)} AS creator,
  {_ufk(f'o_custkey + {k}', 7)} AS last_modified_by,
  o_orderdate + INTERVAL '{15 * k}' DAY AS created_on,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL '{15 * k + 2}' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS last_modified_date
FROM {{orders}}"""


def _eventstat(k: int) -> str:
    end = ("o_orderdate + INTERVAL '5' DAY" if k == 0 else
           "CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL '8' DAY ELSE CAST(NULL AS TIMESTAMP) END")
    return f"""
SELECT {_big(f'o_orderkey * 2 + {k}')} AS pk_eventstat,
  o_orderkey AS fk_event,
  {_big(f'500 + (o_orderkey + {k}) % 25')} AS eventstat,
  {end} AS eventstat_enddt,
  {_ufk(f'o_orderkey + {k} * 5', 11)} AS creator,
  {_ufk(f'o_custkey * 2 + {k}', 6)} AS last_modified_by,
  o_orderdate + INTERVAL '{k}' DAY AS created_on,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS TIMESTAMP)
       ELSE o_orderdate + INTERVAL '{k + 1}' DAY END AS last_modified_date
FROM {{orders}}"""


_MQ_PATIENT = """'PATIENT ' || CAST(user_id AS STRING) AS patient_name,
  CASE WHEN user_id % 10 = 9 THEN 'A' || CAST(user_id AS STRING)
       ELSE CAST(user_id + 100000 AS STRING) END AS mrn,
  ts AS app_dttm"""

_MQ_LAB = f"""SELECT {_MQ_PATIENT},
  'Dr ' || CAST(user_id % 9 AS STRING) AS provider,
  CASE WHEN event_id % 53 = 0 THEN CAST(NULL AS STRING)
       ELSE 'LAB-' || CAST(event_id % 40 AS STRING) END AS lab_name,
  'LC' || CAST(event_id % 40 AS STRING)
       || CASE WHEN event_id % 40 = 3 AND event_id % 2 = 0 THEN 'B' ELSE '' END AS lab_code,
  CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS STRING) ELSE 'Fasting: ' || props END AS condition_notes
FROM {{events}}"""


# (name, SQL template) in dependency order.
DERIVED: list[tuple[str, str]] = [
    ("er_codelst", f"""
SELECT CAST(n_nationkey AS BIGINT) AS pk_codelst,
  CASE n_nationkey % 5 WHEN 0 THEN n_name || '   '
       WHEN 1 THEN n_name || ' - extended description of the coded value for reports'
       ELSE n_name END AS codelst_desc
FROM {{nation}}
UNION ALL
SELECT CAST(k AS BIGINT) AS pk_codelst, d AS codelst_desc FROM (VALUES {CODELIST_FIXED}) AS t(k, d)"""),

    ("sch_codelst", f"""
SELECT CAST(500 + n_nationkey AS BIGINT) AS pk_codelst, substr(n_name, 1, 6) AS codelst_subtyp,
  n_name AS codelst_desc
FROM {{nation}}
UNION ALL
SELECT CAST(k AS BIGINT) AS pk_codelst, s AS codelst_subtyp, d AS codelst_desc
FROM (VALUES {SCH_CODELIST_FIXED}) AS t(k, s, d)"""),

    ("er_site", """
SELECT CAST(r_regionkey AS BIGINT) AS pk_site, r_name || ' Cancer Center Site' AS site_name,
  CAST(r_regionkey * 3 AS BIGINT) AS fk_codelst_type,
  CASE WHEN r_regionkey = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(r_regionkey - 1 AS BIGINT) END AS site_parent
FROM {region}"""),

    ("er_user", f"""
SELECT s_suppkey AS pk_user,
  CASE WHEN s_suppkey % 11 = 0 THEN CAST(NULL AS STRING)
       ELSE split_part(s_name, '#', 1) || CAST(s_nationkey AS STRING) END AS usr_firstname,
  'U' || split_part(s_name, '#', 2) AS usr_lastname,
  CASE s_suppkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'D' WHEN 2 THEN 'B' ELSE 'Z' END AS usr_stat,
  CASE s_suppkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'X' WHEN 3 THEN 'P'
       ELSE CAST(NULL AS STRING) END AS usr_type,
  CASE WHEN s_suppkey % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(s_nationkey % 6 AS BIGINT) END AS fk_siteid,
  {_ufk('s_suppkey * 7 + 3', 9)} AS creator,
  {_day("TS'2014-01-01 00:00:00'", 's_suppkey % 700')} AS created_on
FROM {{supplier}}"""),

    ("er_study", f"""
SELECT p_partkey AS pk_study,
  p_brand || '-' || CAST(p_partkey AS STRING) AS study_number,
  p_name || ' in ' || lower(p_type) || ' cohorts' AS study_title,
  CASE WHEN p_partkey % 9 = 0 THEN CAST(NULL AS STRING)
       ELSE 'NCT' || lpad(CAST(p_partkey AS STRING), 8, '0') END AS nct_number,
  CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN '' ELSE CAST(NULL AS STRING) END AS study_maj_auth,
  CASE WHEN p_partkey % 4 = 0 THEN 'Dr. ' || p_brand ELSE CAST(NULL AS STRING) END AS study_otherprinv,
  p_name AS study_prodname,
  CAST(p_size * 10 AS BIGINT) AS study_nsamplsize,
  CAST(p_size AS BIGINT) AS study_samplsize,
  CAST(p_size % 12 + 1 AS BIGINT) AS study_dur,
  CASE WHEN p_partkey % 2 = 0 THEN 'months' ELSE 'years' END AS study_durunit,
  {_day("TS'2012-01-01 00:00:00'", 'p_partkey % 2500')} AS study_estbegindt,
  CASE p_partkey % 6
       WHEN 0 THEN CAST(CAST(FLOOR(p_partkey / 10) AS BIGINT) AS STRING)
       WHEN 1 THEN CAST(CAST(FLOOR(p_partkey / 10) AS BIGINT) AS STRING) || ' '
       WHEN 2 THEN ''
       WHEN 3 THEN 'abc'
       WHEN 4 THEN CAST(NULL AS STRING)
       ELSE CAST(CAST(FLOOR(p_partkey / 10) AS BIGINT) AS STRING) || ',20' END AS study_assoc,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS BIGINT)
       ELSE CAST(FLOOR(p_partkey / 10) AS BIGINT) END AS study_parentid,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE 'Sponsor ' || p_brand END AS study_sponsor,
  'SP' || CAST(p_partkey * 13 AS STRING) AS study_sponsorid,
  CASE WHEN p_partkey % 3 = 1 THEN 'Contact ' || p_name ELSE CAST(NULL AS STRING) END AS study_contact,
  CASE WHEN p_partkey % 3 = 0 THEN 'NCI-2019-' || lpad(CAST(p_partkey AS STRING), 5, '0')
       ELSE CAST(NULL AS STRING) END AS nci_trial_identifier,
  {_day("TS'2012-02-15 00:00:00'", 'p_partkey % 2500')} AS study_actualdt,
  CASE WHEN p_partkey % 4 = 1 THEN {_day("TS'2016-06-01 00:00:00'", 'p_partkey % 1500')}
       ELSE CAST(NULL AS TIMESTAMP) END AS study_end_date,
  {_ufk('p_partkey * 5 + 1', 19)} AS study_coordinator,
  {_ufk('p_partkey * 3 + 2', 23)} AS study_prinv,
  {_ufk('p_partkey + 4', 29)} AS fk_author,
  {_ufk('p_partkey * 11', 31)} AS creator,
  {_ufk('p_partkey * 17 + 5', 7)} AS last_modified_by,
  {_day("TS'2011-11-01 00:00:00'", 'p_partkey % 2500')} AS created_on,
  CASE WHEN p_partkey % 4 = 3 THEN CAST(NULL AS TIMESTAMP)
       ELSE {_day("TS'2013-03-01 00:00:00'", 'p_partkey % 2000')} END AS last_modified_date,
  {_big('CASE p_partkey % 5 WHEN 0 THEN 50 WHEN 1 THEN 51 WHEN 2 THEN 52 WHEN 3 THEN NULL ELSE 999 END')} AS fk_codelst_sponsor,
  {_big('p_size % 25')} AS fk_codelst_phase,
  {_big('CASE p_partkey % 3 WHEN 0 THEN 40 WHEN 1 THEN 41 ELSE 42 END')} AS fk_codelst_restype,
  {_big('(p_partkey + 3) % 25')} AS fk_codelst_scope,
  {_big('CASE p_partkey % 6 WHEN 0 THEN 30 WHEN 1 THEN 31 WHEN 2 THEN 30 WHEN 3 THEN 32 WHEN 4 THEN NULL ELSE 34 END')} AS fk_codelst_type,
  {_big('(p_partkey + 7) % 25')} AS fk_codelst_purpose,
  {_big('(p_size + 1) % 25')} AS fk_codelst_tarea,
  {_big('CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_partkey % 25 END')} AS fk_codelst_blind,
  {_big('p_size % 30')} AS study_division
FROM {{part}}"""),

    ("er_studystat", f"""
SELECT o_orderkey AS pk_studystat,
  {_big(f'o_orderkey % {NP}')} AS fk_study,
  {_big('CASE WHEN o_custkey % 23 = 0 THEN 7 ELSE o_custkey % 5 END')} AS fk_site,
  CAST(20 AS BIGINT) AS status_type,
  {_big('o_custkey % 25')} AS fk_codelst_studystat,
  {_big('CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 25 END')} AS outcome,
  {_big('CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey + 2) % 25 ELSE NULL END')} AS fk_codelst_revboard,
  {_big("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END")} AS current_stat,
  {_big('CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 END')} AS studystat_hspn,
  o_orderdate AS studystat_date,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + INTERVAL '90' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS studystat_endt,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '365' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS studystat_validt,
  CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL '14' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS studystat_meetdt,
  CASE WHEN o_orderkey % 4 = 1 THEN CAST(NULL AS STRING)
       ELSE 'Status ' || o_orderpriority || ' noted for order ' || CAST(o_orderkey AS STRING) || '   ' END AS studystat_note,
  {_ufk('o_orderkey + 1', 13)} AS fk_user_docby,
  {_ufk('o_custkey * 3', 11)} AS studystat_assignedto,
  {_ufk('o_orderkey * 7 + 2', 19)} AS creator,
  {_ufk('o_orderkey * 5 + 3', 9)} AS last_modified_by,
  o_orderdate + INTERVAL '1' DAY AS created_on,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS TIMESTAMP)
       ELSE o_orderdate + INTERVAL '20' DAY END AS last_modified_date
FROM {{orders}}"""),

    ("er_studysites", f"""
SELECT {_big('fk_study * 10 + fk_site')} AS pk_studysites, fk_study, fk_site,
  CASE (fk_study + fk_site) % 5
       WHEN 0 THEN CAST(fk_study % 40 + 5 AS STRING) || ' '
       WHEN 1 THEN CAST(fk_study % 40 + 5 AS STRING) || ',20'
       WHEN 2 THEN ''
       WHEN 3 THEN CASE WHEN fk_study % 2 = 0 THEN 'abc' ELSE CAST(NULL AS STRING) END
       ELSE CAST(fk_study % 40 + 5 AS STRING) END AS studysite_lsamplesize,
  CAST(n_status AS STRING) AS studysite_enrcount,
  {_ufk('fk_study * 3 + fk_site', 7)} AS creator,
  {_ufk('fk_study + fk_site * 11', 5)} AS last_modified_by,
  first_date AS created_on,
  last_date AS last_modified_on
FROM (SELECT fk_study, fk_site, count(*) AS n_status, min(studystat_date) AS first_date,
             max(studystat_date) AS last_date
      FROM {{er_studystat}} GROUP BY fk_study, fk_site) AS g
WHERE (fk_study + fk_site) % 7 <> 0"""),

    ("er_studyteam", f"""
SELECT o_orderkey AS pk_studyteam,
  {_big(f'(o_orderkey + 7) % {NP}')} AS fk_study,
  CASE WHEN o_custkey % 29 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(o_custkey % {NU} AS BIGINT) END AS fk_user,
  {_big('CASE o_orderkey % 8 WHEN 0 THEN 9 WHEN 1 THEN 8130 WHEN 2 THEN 8132 WHEN 3 THEN 8211 WHEN 4 THEN 12087 WHEN 5 THEN 8132 WHEN 6 THEN 17 ELSE NULL END')} AS fk_codelst_tmrole,
  CASE WHEN o_custkey % 3 = 0 THEN 'S' ELSE 'D' END AS study_team_usr_type,
  CASE o_orderstatus WHEN 'O' THEN 'Deactivated' WHEN 'F' THEN 'Active' ELSE 'Active   ' END AS studyteam_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'S' ELSE CAST(NULL AS STRING) END AS study_siteflag,
  lpad(CAST(o_orderkey % 997 AS STRING), 12, '21') AS study_team_rights,
  {_ufk('o_orderkey * 3 + 1', 7)} AS creator,
  {_ufk('o_orderkey + 11', 5)} AS last_modified_by,
  o_orderdate AS created_on,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL '3' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS last_modified_date
FROM {{orders}}"""),

    ("er_studyid", _EAV),

    ("er_studydiseasesite", """
SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS pkstudydiseasesite,
  l_partkey AS fk_study,
  CAST(CASE WHEN l_partkey % 50 = 0 THEN 99 WHEN l_linenumber = 7 THEN 98
            ELSE l_linenumber + (l_partkey % 4) * 5 END AS BIGINT) AS study_disease_site
FROM {lineitem}"""),

    ("person", f"""
SELECT c_custkey AS pk_person,
  CAST(c_nationkey % 5 AS BIGINT) AS fk_site,
  CASE WHEN c_custkey % 7 = 0 THEN 'A' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 29 = 1 THEN ''
       WHEN c_custkey % 31 = 2 THEN '-' || CAST(c_custkey AS STRING)
       ELSE CAST(c_custkey + 100000 AS STRING) END AS person_code,
  'Lname' || CAST(c_custkey % 97 AS STRING) || CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE '' END AS person_lname,
  CASE WHEN c_custkey % 13 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS person_fname,
  CASE c_custkey % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN 'Q' ELSE 'Middle' END AS person_mname,
  {_day("TS'1940-01-01 00:00:00'", 'c_custkey % 20000')} AS person_dob,
  CASE WHEN c_custkey % 19 = 0 THEN {_day("TS'2018-01-01 00:00:00'", 'c_custkey % 900')}
       ELSE CAST(NULL AS TIMESTAMP) END AS person_deathdt,
  CASE WHEN c_custkey % 19 = 0 THEN 'Other cause recorded for ' || c_name
       ELSE CAST(NULL AS STRING) END AS cause_of_death_other,
  CASE c_custkey % 6 WHEN 0 THEN CAST(c_nationkey AS STRING) WHEN 1 THEN CAST(c_nationkey AS STRING) || ' '
       WHEN 2 THEN ' ' WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN ''
       ELSE 'x' || CAST(c_nationkey AS STRING) END AS person_add_ethnicity,
  'City' || CAST(c_nationkey AS STRING) || ' ' AS person_city,
  'ST' || CAST(c_custkey % 50 AS STRING) AS person_state,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'County ' || CAST(c_custkey % 33 AS STRING) END AS person_county,
  lpad(CAST(c_custkey % 99999 AS STRING), 5, '0') || CASE WHEN c_custkey % 5 = 0 THEN '-1234' ELSE ' ' END AS person_zip,
  'Country ' || CAST(c_nationkey AS STRING) AS person_country,
  CAST(c_custkey AS STRING) || ' Main Street' AS person_address1,
  CASE WHEN c_custkey % 4 = 0 THEN 'Apt ' || CAST(c_custkey % 40 AS STRING) ELSE CAST(NULL AS STRING) END AS person_address2,
  {_day("TS'2015-05-01 00:00:00'", 'c_custkey % 1800')} AS person_regdate,
  {_ufk('c_custkey * 3 + 1', 11)} AS person_regby,
  {_big('c_custkey % 3')} AS fk_codelst_pstat,
  {_big('CASE WHEN c_custkey % 19 = 0 THEN 5 ELSE NULL END')} AS fk_codelst_pat_dth_cause,
  {_big('c_custkey % 2 + 10')} AS fk_codelst_gender,
  {_big('CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 12 + c_custkey % 2 END')} AS fk_codelst_ethnicity,
  {_big('14 + c_custkey % 5')} AS fk_codelst_race,
  {_ufk('c_custkey + 2', 7)} AS creator,
  {_ufk('c_custkey * 5', 13)} AS last_modified_by,
  {_day("TS'2015-04-20 00:00:00'", 'c_custkey % 1800')} AS created_on,
  CASE WHEN c_custkey % 3 = 1 THEN {_day("TS'2019-02-01 00:00:00'", 'c_custkey % 500')}
       ELSE CAST(NULL AS TIMESTAMP) END AS last_modified_date
FROM {{customer}}"""),

    ("er_person_add_race", """
SELECT o_orderkey AS pkpersonaddrace, o_custkey AS fk_person,
  CASE o_orderkey % 6 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN ' '
       ELSE CAST((o_custkey + o_orderkey % 3) % 27 AS STRING) END AS person_add_race
FROM {orders}"""),

    ("pat_perid", """
SELECT c_custkey AS fk_per,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 8100 ELSE 8101 END AS BIGINT) AS fk_codelst_idtype,
  CAST(c_custkey % 6 AS STRING) AS perid_id
FROM {customer}
UNION ALL
SELECT c_custkey AS fk_per, CAST(8101 AS BIGINT) AS fk_codelst_idtype,
  CAST((c_custkey + 1) % 6 AS STRING) AS perid_id
FROM {customer} WHERE c_custkey % 37 = 0"""),

    ("er_patprot", f"""
SELECT o_orderkey AS pk_patprot,
  o_custkey AS fk_per,
  {_big(f'o_orderkey % {NP}')} AS fk_study,
  {_big('CASE WHEN o_orderkey % 19 = 0 THEN 7 ELSE o_custkey % 5 END')} AS fk_site_enrolling,
  {_big('CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END')} AS patprot_stat,
  'PS-' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '  ' ELSE '' END AS patprot_patstdid,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE o_orderdate END AS patprot_enroldt,
  {_big('CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 2 END')} AS patprot_consign,
  o_orderdate - INTERVAL '5' DAY AS patprot_consigndt,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL '200' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS patprot_discdt,
  CASE WHEN o_orderstatus = 'O' THEN 'Withdrawn: ' || o_orderpriority
       ELSE CAST(NULL AS STRING) END AS patprot_reason,
  o_orderdate + INTERVAL '7' DAY AS patprot_start,
  CASE WHEN o_orderkey % 97 = 0 THEN o_orderdate + INTERVAL '300' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS date_of_death,
  CASE WHEN o_orderkey % 97 = 0 THEN 'Not related   ' ELSE CAST(NULL AS STRING) END AS death_std_rltd_other,
  {_ufk('o_orderkey + 3', 17)} AS fk_user,
  {_ufk('o_custkey * 7 + 1', 13)} AS fk_userassto,
  {_ufk('o_custkey * 11 + 5', 11)} AS patprot_physician,
  {_big('CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 25 END')} AS fk_codelstloc,
  {_big('CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 6 END')} AS patprot_treatingorg,
  {_big('CASE WHEN o_orderkey % 97 = 0 THEN 3 ELSE NULL END')} AS fk_codelst_ptst_dth_stdrel,
  {_big('CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 30 ELSE NULL END')} AS patprot_othr_dis_code,
  {_ufk('o_orderkey * 2 + 1', 23)} AS creator,
  {_ufk('o_orderkey * 3 + 2', 7)} AS last_modified_by,
  o_orderdate AS created_on,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(NULL AS TIMESTAMP)
       ELSE o_orderdate + INTERVAL '30' DAY END AS last_modified_date
FROM {{orders}}"""),

    ("er_patstudystat", _patstudystat(0) + "\nUNION ALL" + _patstudystat(1)),

    ("er_patfacility", f"""
SELECT c_custkey AS fk_per, CAST(c_custkey % 5 AS BIGINT) AS fk_site,
  'F' || lpad(CAST(c_custkey AS STRING), 7, '0') AS pat_facilityid,
  {_big('CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 7 WHEN 2 THEN NULL ELSE 5 END')} AS pat_accessright,
  {_big('CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END')} AS patfacility_default,
  {_ufk('c_custkey * 13 + 1', 7)} AS patfacility_provider,
  CASE WHEN c_custkey % 6 = 0 THEN 'Outside provider ' || c_mktsegment
       ELSE CAST(NULL AS STRING) END AS patfacility_otherprovider,
  {_day("TS'2015-05-03 00:00:00'", 'c_custkey % 1800')} AS patfacility_regdate
FROM {{customer}}
UNION ALL
SELECT c_custkey AS fk_per, CAST(c_custkey % 5 AS BIGINT) AS fk_site,
  'G' || lpad(CAST(c_custkey AS STRING), 7, '0') AS pat_facilityid,
  CAST(7 AS BIGINT) AS pat_accessright,
  CAST(0 AS BIGINT) AS patfacility_default,
  CAST(NULL AS BIGINT) AS patfacility_provider,
  CAST(NULL AS STRING) AS patfacility_otherprovider,
  {_day("TS'2017-01-10 00:00:00'", 'c_custkey % 900')} AS patfacility_regdate
FROM {{customer}} WHERE c_custkey % 10 = 0"""),

    ("event_assoc", f"""
SELECT CAST(1000000 + p_partkey AS BIGINT) AS event_id,
  CASE WHEN p_partkey % 41 = 0 THEN CAST(NULL AS BIGINT) ELSE p_partkey END AS chain_id,
  CASE WHEN p_partkey % 4 = 0 THEN 'A' ELSE 'P' END AS event_type,
  'Calendar ' || p_brand || ' arm ' || CAST(p_size % 3 AS STRING) AS name,
  'Schedule of ' || p_name || ' visits' || CASE WHEN p_partkey % 2 = 0 THEN '   ' ELSE '' END AS description,
  {_ufk('p_partkey + 9', 7)} AS creator,
  {_ufk('p_partkey * 3', 5)} AS last_modified_by,
  {_day("TS'2019-06-01 00:00:00'", 'p_partkey % 300')} AS created_on,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(NULL AS TIMESTAMP)
       ELSE {_day("TS'2020-01-15 00:00:00'", 'p_partkey % 300')} END AS last_modified_date
FROM {{part}}"""),

    ("sch_protstat", f"""
SELECT event_id AS pk_protstat,
  {_big(f'1000000 + event_id % {NP}')} AS fk_event,
  {_big('CASE event_id % 7 WHEN 0 THEN 285 WHEN 1 THEN 285 WHEN 2 THEN 285 WHEN 3 THEN 288 WHEN 4 THEN 288 WHEN 5 THEN 286 ELSE 287 END')} AS fk_codelst_calstat,
  ts - INTERVAL '1500' DAY AS protstat_dt,
  CASE WHEN event_id % 3 = 0 THEN 'Calendar status ' || event_type ELSE CAST(NULL AS STRING) END AS protstat_note,
  {_ufk('event_id + 1', 11)} AS creator,
  {_ufk('user_id * 3', 7)} AS last_modified_by,
  ts - INTERVAL '1500' DAY AS created_on,
  ts - INTERVAL '1499' DAY AS last_modified_date
FROM {{events}}"""),

    ("sch_events1", f"""
SELECT o_orderkey AS event_id,
  {_big(f'1000000 + o_orderkey % {NP}')} AS session_id,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(NULL AS BIGINT) ELSE o_custkey END AS patient_id,
  {_big("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END")} AS status,
  'Visit ' || CAST(o_orderkey % 20 AS STRING) || ' ' || o_orderpriority AS description,
  {_big('o_orderkey % 20')} AS event_sequence,
  o_orderdate AS start_date_time,
  o_orderdate + INTERVAL '1' DAY AS end_date_time,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '2' DAY
       ELSE CAST(NULL AS TIMESTAMP) END AS event_exeon,
  o_orderdate + INTERVAL '3' DAY AS actual_schdate,
  {_big('CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 500 + o_custkey % 25 END')} AS fk_codelst_covertype,
  {_ufk('o_orderkey * 5 + 2', 13)} AS creator,
  {_ufk('o_orderkey + 17', 6)} AS last_modified_by,
  o_orderdate - INTERVAL '30' DAY AS created_on,
  CASE WHEN o_orderkey % 2 = 1 THEN CAST(NULL AS TIMESTAMP)
       ELSE o_orderdate - INTERVAL '10' DAY END AS last_modified_date
FROM {{orders}}"""),

    ("sch_eventstat", _eventstat(0) + "\nUNION ALL" + _eventstat(1)),

    ("mq_appointments", f"""
SELECT {_MQ_PATIENT},
  'Visit ' || props AS activity_desc,
  upper(substr(event_type, 1, 2)) AS provider_initials,
  'Clinic ' || CAST(user_id % 4 AS STRING) AS location
FROM {{events}} WHERE event_type IN ('view', 'click')
UNION ALL
SELECT {_MQ_PATIENT},
  'Visit ' || props AS activity_desc,
  upper(substr(event_type, 1, 2)) AS provider_initials,
  'Clinic ' || CAST(user_id % 4 AS STRING) AS location
FROM {{events}} WHERE event_type = 'view' AND event_id % 10 = 0"""),

    ("mq_chemos", f"""
SELECT {_MQ_PATIENT},
  'Dr ' || CAST(user_id % 9 AS STRING) AS provider,
  'Drug-' || CAST(event_id % 9 AS STRING) AS drug_name,
  {_big('CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 4 END')} AS cycle_number,
  {_big('CASE WHEN event_id % 6 = 0 THEN 0 ELSE event_id % 9 END')} AS cycle_day,
  {_big('CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END')} AS dlyd
FROM {{events}} WHERE event_type = 'purchase'"""),

    ("mq_labs", _MQ_LAB + " WHERE event_type IN ('signup', 'error')"),

    ("mq_labs_90days", _MQ_LAB + " WHERE event_type IN ('signup', 'error', 'click')"),

    ("ref_labs_cpts", f"""
SELECT CAST(n_nationkey + 1 AS BIGINT) AS lc_idx,
  CASE WHEN n_nationkey = 24 THEN '' WHEN n_nationkey = 23 THEN 'LAB-5'
       ELSE 'LAB-' || CAST(n_nationkey AS STRING) END AS labdesc,
  'LC' || CAST(n_nationkey AS STRING) AS labname_mq,
  CAST(80000 + n_nationkey * 7 AS STRING) AS cpt,
  CASE WHEN n_nationkey % 3 = 0 THEN '36415' ELSE '' END AS cpt_additional,
  n_name || ' PANEL' AS labname_tricore,
  CASE WHEN n_nationkey % 6 = 0 THEN CAST(NULL AS STRING) ELSE 'Mapped' END AS map_status,
  'Seed' AS comments,
  {_day("TS'2021-02-01 00:00:00'", 'n_nationkey')} AS createdttm,
  CASE WHEN n_nationkey % 2 = 0 THEN {_day("TS'2021-06-01 00:00:00'", 'n_nationkey')}
       ELSE CAST(NULL AS TIMESTAMP) END AS moddttm
FROM {{nation}}"""),

    ("ref_program_code", """
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS value, o_orderpriority AS description,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10 AS report_sort
FROM {orders}"""),

    ("ref_research_category", f"""
SELECT v AS value, d AS description, CAST(s AS BIGINT) AS report_sort
FROM (VALUES {RESEARCH_CATEGORY_FIXED}) AS t(v, d, s)"""),

    ("ref_study_type", f"""
SELECT v AS value, d AS description, CAST(s AS BIGINT) AS report_sort
FROM (VALUES {STUDY_TYPE_FIXED}) AS t(v, d, s)"""),

    ("ref_treatment_line", """
SELECT DISTINCT CAST(p_size % 3 + 1 AS STRING) AS value,
  'Line ' || CAST(p_size % 3 + 1 AS STRING) AS description,
  CAST(p_size % 3 + 1 AS BIGINT) AS report_sort
FROM {part} WHERE p_size % 3 <> 2"""),

    ("ref_clinical_working_group", """
SELECT CAST(r - 1 AS STRING) AS value, p_type || ' working group' AS description,
  CAST(r * 10 AS STRING) || ' ' AS report_sort
FROM (SELECT p_type, DENSE_RANK() OVER (ORDER BY p_type) AS r
      FROM (SELECT DISTINCT p_type FROM {part}) AS d) AS x"""),

    ("ref_disease_site", """
SELECT CAST(r_regionkey AS STRING) AS value, r_name || ' disease site' AS description
FROM {region}"""),

    ("ref_study_exclusions", """
SELECT p_partkey AS pk_study, CASE WHEN p_partkey % 100 = 0 THEN 'Y' ELSE 'N' END AS is_active
FROM {part} WHERE p_partkey % 50 = 0"""),
]

DERIVED_SQL = dict(DERIVED)
RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
_PLACEHOLDER = re.compile(r"\{([a-z_0-9]+)\}")
_TS = re.compile(r"TS'([^']*)'")


def dependencies(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(DERIVED_SQL[name])))


def for_spark(template: str) -> str:
    """Spark dialect: timestamp literals without time zone, timestamp casts NTZ."""
    t = _TS.sub(r"TIMESTAMP_NTZ '\1'", template)
    return t.replace("CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP_NTZ)")


def for_duckdb(template: str) -> str:
    t = _TS.sub(r"TIMESTAMP '\1'", template)
    return _PLACEHOLDER.sub(r"\1", t)


def derive(spark: SparkSession, raw: dict[str, DataFrame],
           names: list[str] | None = None) -> dict[str, DataFrame]:
    """Build the derived source tables (lazily) from the raw tables."""
    out: dict[str, DataFrame] = {}
    wanted = set(names or DERIVED_SQL)
    # close over dependencies
    stack = list(wanted)
    while stack:
        n = stack.pop()
        for d in dependencies(n):
            if d in DERIVED_SQL and d not in wanted:
                wanted.add(d)
                stack.append(d)
    for name, template in DERIVED:
        if name not in wanted:
            continue
        args = {d: (out[d] if d in out else raw[d]) for d in dependencies(name)}
        out[name] = spark.sql(for_spark(template), **args)
    return out


def duckdb_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, SQL) pairs in dependency order for the oracle's WITH clause."""
    wanted = set(names)
    stack = list(wanted)
    while stack:
        n = stack.pop()
        for d in dependencies(n):
            if d in DERIVED_SQL and d not in wanted:
                wanted.add(d)
                stack.append(d)
    return [(n, for_duckdb(t).strip()) for n, t in DERIVED if n in wanted]
