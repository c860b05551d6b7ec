"""M10 lab-code registration and M9 billing worklist.

M10 adds the lab names of the 90-day extract that have no usable mapping
to the reference table as ``'Unknown'`` rows with fresh keys.  ``faithful``
reproduces the source rule (left join + ``map_status IS NULL``: a name that is
mapped with a NULL status is re-added, NULL names are added too); ``anti``
is a true anti join on the name that also drops NULL names.

M9 is the union of yesterday's appointments, chemotherapy orders and labs,
kept when the MRN belongs to a current industrial-trial patient, with the
lab's CPT mapping (reading the reference table *after* M10 added codes)
and the patient's current calendar name.

Both compare text by the ``collation`` of the source system if one is given:
lab names, MRNs, constants, DISTINCT and UNION.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart.operators import assign_keys, distinct_under, lookup, same, union_tagged
from trialmart.plans.accrual import _current_enrolled

INDUSTRIAL = "Industrial"
CURRENT_SCHEDULE = "Current Schedule"
REF_COLUMNS = ["lc_idx", "labdesc", "labname_mq", "cpt", "cpt_additional", "labname_tricore",
               "map_status", "comments", "createDtTm", "modDtTm"]
WORKLIST_MQ = ["PatientName_mq", "MRN_mq", "ApptDate_mq", "Activity_mq", "Provider_mq",
               "Location_mq", "DrugName_mq", "LabName_mq", "LabCode_mq", "LabNotes_mq",
               "CycleInfo_mq", "Source_mq"]


def new_lab_codes(extract: DataFrame, ref: DataFrame, run_ts=None, mode: str = "faithful",
                  collation: str | None = None) -> DataFrame:
    """Rows M10 appends to ``ref_labs_cpts`` (with keys continuing ``max(lc_idx)``)."""
    labs = extract.select("lab_name", "lab_code")
    if mode == "faithful":
        matched = lookup(labs, ref, ("lab_name", "labdesc"),
                         {"cpt": "__cpt", "map_status": "__status"}, collation=collation)
        fresh = (matched.filter(F.col("__status").isNull())
                 .select(F.col("lab_name").alias("labdesc"), F.col("lab_code").alias("labname_mq"),
                         F.col("__cpt").alias("cpt")))
    elif mode == "anti":
        names = ref.select(F.col("labdesc").alias("__known"))
        fresh = (labs.filter(F.col("lab_name").isNotNull())
                 .join(names, same("lab_name", "__known", collation), "left_anti")
                 .select(F.col("lab_name").alias("labdesc"), F.col("lab_code").alias("labname_mq"),
                         F.lit(None).cast("string").alias("cpt")))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    keyed = assign_keys(distinct_under(fresh, collation), ref, "lc_idx", ["labdesc", "labname_mq", "cpt"])
    return keyed.select(
        "lc_idx", "labdesc", "labname_mq", "cpt",
        F.lit("").alias("cpt_additional"), F.lit("").alias("labname_tricore"),
        F.lit("Unknown").alias("map_status"), F.lit("Auto").alias("comments"),
        fn.run_stamp(run_ts).alias("createDtTm"),
        F.lit(None).cast("timestamp_ntz").alias("modDtTm"))


def register_new_codes(extract: DataFrame, ref: DataFrame, run_ts=None, mode: str = "faithful",
                       collation: str | None = None) -> DataFrame:
    """M10: the reference table after the append (existing rows + new rows)."""
    base = ref.select(*[F.col(c).alias(c) for c in REF_COLUMNS])
    return base.unionByName(new_lab_codes(extract, base, run_ts, mode, collation))


def industrial_patients(study_current: DataFrame, patient: DataFrame, collation: str | None = None,
                        keep=lambda rows: rows) -> DataFrame:
    """Current, enrolled, not discontinued patients of industrial trials with a numeric MRN.

    The worklist reads them seven times; where the marts are not published,
    ``keep`` (``materialised``) holds either side and the result, or every read
    would bring the plans of the marts along.
    """
    studies = keep(distinct_under(
        study_current.filter(same("researchType_st_lu", F.lit(INDUSTRIAL), collation))
        .select("pkStudy_st", "studyNumber_st", F.col("title_st").alias("studyTitle_st")), collation))
    pats = (_current_enrolled(patient).filter(fn.is_signed_integer("personCode_p"))
            .select(F.col("pkStudy_st").alias("__p_study"), "patStudyId_pp", "personCode_p",
                    fn.name_upper("patLast_p", "patFirst_p", "patMiddle_p").alias("patName_p")))
    pats = keep(distinct_under(pats, collation))
    # both sides carry the study key, so the join output is already distinct
    return keep(studies.join(pats, F.col("pkStudy_st") == F.col("__p_study"), "inner")
                .select("pkStudy_st", "studyNumber_st", "studyTitle_st", "patStudyId_pp",
                        "personCode_p", "patName_p"))


def current_calendar_names(calendar: DataFrame, collation: str | None = None) -> DataFrame:
    names = (calendar.filter(same("statusDesc_se1", F.lit(CURRENT_SCHEDULE), collation))
             .select(F.col("personCode_p").alias("__cal_mrn"), "scheduleName_ea"))
    return distinct_under(names, collation)


def emr_activity(appointments: DataFrame, chemos: DataFrame, labs: DataFrame,
                 patients: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """Three extracts as one tagged, positional UNION (DISTINCT).

    With ``patients`` every branch is restricted to their MRNs first, so only
    their activity reaches the shuffle of the DISTINCT.
    """
    if patients is not None:
        mrns = patients.select(F.col("personCode_p").alias("__only")).distinct()
        appointments, chemos, labs = (
            x.join(mrns, same("mrn", "__only", collation), "left_semi") for x in (appointments, chemos, labs))
    blank = F.lit("")
    appt = appointments.select(
        F.col("patient_name").alias("PatientName_mq"), F.col("mrn").alias("MRN_mq"),
        F.col("app_dttm").alias("ApptDate_mq"), F.col("activity_desc").alias("Activity_mq"),
        F.col("provider_initials").alias("Provider_mq"), F.col("location").alias("Location_mq"),
        blank.alias("DrugName_mq"), blank.alias("LabName_mq"), blank.alias("LabCode_mq"),
        blank.alias("LabNotes_mq"), blank.alias("CycleInfo_mq"), F.lit("Appt").alias("Source_mq"))
    chemo = chemos.select(
        "patient_name", "mrn", "app_dttm", blank, "provider", blank, "drug_name", blank, blank,
        blank, fn.cycle_label("cycle_number", "cycle_day", "dlyd"), F.lit("Chemo"))
    lab = labs.select(
        "patient_name", "mrn", "app_dttm", blank, "provider", blank, blank, "lab_name",
        "lab_code", "condition_notes", blank, F.lit("Labs"))
    return union_tagged([appt, chemo, lab], distinct=True, collation=collation)


CPT_COLUMNS = ["cpt", "cpt_additional", "labname_tricore", "map_status"]


def build_worklist(activity: DataFrame, patients: DataFrame, ref: DataFrame,
                   calendar_names: DataFrame, run_ts=None, collation: str | None = None) -> DataFrame:
    """M9 ``dm_PharmaPats_YDA`` snapshot (22 columns).

    Only activity with a lab name can have a CPT mapping, so the rest does not
    join the reference table.  Every side is distinct and all join keys are in
    the output, so the result is distinct without another shuffle.
    """
    blank = F.lit("")
    cpts = distinct_under(ref.filter(~same("labdesc", blank, collation))
                          .select(F.col("labdesc").alias("__cpt_name"), *CPT_COLUMNS), collation)
    pats = distinct_under(patients.select(F.col("personCode_p").alias("__mrn"), "studyNumber_st",
                                          "studyTitle_st", "patStudyId_pp", "patName_p"), collation)
    named = F.coalesce(~same("LabName_mq", blank, collation), F.lit(False))
    mapped = activity.filter(named).join(cpts, same("__cpt_name", "LabName_mq", collation), "left").drop("__cpt_name")
    bare = activity.filter(~named).select(
        "*", *[F.lit(None).cast(cpts.schema[c].dataType).alias(c) for c in CPT_COLUMNS])
    df = (mapped.union(bare).join(pats, same("MRN_mq", "__mrn", collation), "inner")
          .join(calendar_names, same("MRN_mq", "__cal_mrn", collation), "left"))
    return df.select("studyNumber_st", "studyTitle_st", "patStudyId_pp", "patName_p", *WORKLIST_MQ,
                     *CPT_COLUMNS, "scheduleName_ea", fn.run_stamp(run_ts).alias("xDMrunDt"))
