"""M4 ``dm_calendar``: calendars x latest qualifying calendar status x
scheduled events x open event status, plus 13 lookups.

The "latest status" rule is a correlated ``MAX(pk)`` per (calendar, status)
in the source; here it is ``latest_per_group`` (a rank in one scan), and
the date threshold is applied *after* taking the latest row, so a calendar
whose latest Active row is too old drops out, as in the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart.operators import expand_left, latest_per_group, lookup, lookup_roles
from trialmart.quality import watched
from trialmart.sources import SourceSet

# Fixed code values: calendar statuses Active and Reactivated.
CALENDAR_ACTIVE_STATUSES = [285, 288]
CALENDAR_SINCE = "2019-12-01"
CALENDAR_EVENT_TYPE = "P"
CURRENT_SCHEDULE_STATUS = 0


def _names(prefix: str) -> dict[str, str]:
    return {"usr_firstname": f"{prefix}_first", "usr_lastname": f"{prefix}_last"}


def latest_calendar_status(protstat: DataFrame, since: str = CALENDAR_SINCE) -> DataFrame:
    """Latest Active / Reactivated status row per calendar, kept when on or after ``since``."""
    qualifying = protstat.filter(F.col("fk_codelst_calstat").isin(CALENDAR_ACTIVE_STATUSES))
    latest = latest_per_group(qualifying, ["fk_event", "fk_codelst_calstat"], "pk_protstat")
    return latest.filter(fn.on_or_after("protstat_dt", since))


def build_calendar(src: SourceSet, run_ts=None, since: str = CALENDAR_SINCE) -> DataFrame:
    """M4 ``dm_calendar`` (57 columns)."""
    users, sch = src["er_user"], src["sch_codelst"]

    ea = src["event_assoc"].select(
        F.col("event_id").alias("__ea_id"), F.col("chain_id").alias("__ea_chain"),
        F.col("event_type").alias("__ea_type"), F.col("name").alias("__ea_name"),
        F.col("description").alias("__ea_desc"), F.col("creator").alias("__ea_creator"),
        F.col("last_modified_by").alias("__ea_modby"), F.col("created_on").alias("__ea_created"),
        F.col("last_modified_date").alias("__ea_modified"))
    sps = latest_calendar_status(src["sch_protstat"], since).select(
        F.col("pk_protstat").alias("__sps_pk"), F.col("fk_event").alias("__sps_event"),
        F.col("fk_codelst_calstat").alias("__sps_stat"), F.col("protstat_dt").alias("__sps_dt"),
        F.col("protstat_note").alias("__sps_note"), F.col("creator").alias("__sps_creator"),
        F.col("last_modified_by").alias("__sps_modby"), F.col("created_on").alias("__sps_created"),
        F.col("last_modified_date").alias("__sps_modified"))
    se1 = src["sch_events1"].select(
        F.col("event_id").alias("__se1_id"), F.col("session_id").alias("__se1_session"),
        F.col("patient_id").alias("__se1_patient"), F.col("status").alias("__se1_status"),
        F.col("description").alias("__se1_desc"), F.col("event_sequence").alias("__se1_seq"),
        F.col("start_date_time").alias("__se1_start"), F.col("end_date_time").alias("__se1_end"),
        F.col("event_exeon").alias("__se1_exe"), F.col("actual_schdate").alias("__se1_actual"),
        F.col("fk_codelst_covertype").alias("__se1_cover"), F.col("creator").alias("__se1_creator"),
        F.col("last_modified_by").alias("__se1_modby"), F.col("created_on").alias("__se1_created"),
        F.col("last_modified_date").alias("__se1_modified"))
    ses = src["sch_eventstat"].filter(F.col("eventstat_enddt").isNull()).select(
        F.col("pk_eventstat").alias("__ses_pk"), F.col("fk_event").alias("__ses_event"),
        F.col("eventstat").alias("__ses_stat"), F.col("eventstat_enddt").alias("__ses_end"),
        F.col("creator").alias("__ses_creator"), F.col("last_modified_by").alias("__ses_modby"),
        F.col("created_on").alias("__ses_created"), F.col("last_modified_date").alias("__ses_modified"))

    # the scheduled events of a hot calendar are dealt over sub-keys; the
    # calendars (one row per status) are the side that is repeated
    calendars = ea.join(sps, F.col("__ea_id") == F.col("__sps_event"), "inner")
    se1 = watched(se1)
    events = se1.join(ses, F.col("__se1_id") == F.col("__ses_event"), "inner")
    scheduled = src["sch_events1"].select(F.col("session_id").alias("__se1_session"), F.col("event_id").alias("__se1_id"))
    df = expand_left(calendars, events, "__ea_id", "__se1_session", "__se1_id", keys=scheduled)
    df = df.filter(F.col("__se1_session").isNotNull())

    for fk, p in [("__sps_stat", "__calstat"), ("__se1_cover", "__cover"), ("__ses_stat", "__estat")]:
        df = lookup(df, sch, (fk, "pk_codelst"),
                    {"codelst_subtyp": f"{p}_sub", "codelst_desc": f"{p}_desc"})
    df = lookup(df, src["person"], ("__se1_patient", "pk_person"),
                {"pk_person": "pkPerson_p", "person_code": "personCode_p",
                 "person_fname": "patFirst_p", "person_mname": "patMiddle_p",
                 "person_lname": "patLast_p", "person_dob": "birthDt_p"})
    df = lookup(df, src["er_study"], ("__ea_chain", "pk_study"),
                {"pk_study": "pkStudyID_st", "study_number": "studyNumber_st",
                 "study_title": "studyTitle_st"})
    df = lookup_roles(df, users, "pk_user", {
        fk: _names(p) for fk, p in [
            ("__ea_creator", "__ea_cu"), ("__ea_modby", "__ea_mu"), ("__se1_creator", "__se1_cu"),
            ("__se1_modby", "__se1_mu"), ("__ses_creator", "__ses_cu"), ("__ses_modby", "__ses_mu"),
            ("__sps_creator", "__sps_cu"), ("__sps_modby", "__sps_mu")]})

    return df.select(
        F.col("__ea_id").alias("pkEventID_ea"),
        "pkStudyID_st",
        F.col("__sps_pk").alias("pkProtStat_sps"),
        F.col("__se1_id").alias("pkEventID_se1"),
        F.col("__ses_pk").alias("pkEventStat_ses"),
        "studyNumber_st", "studyTitle_st",
        fn.label(F.col("__ea_type") == CALENDAR_EVENT_TYPE, "Calendar",
                 "Event associated to calendar").alias("eventTypeDefined_ea"),
        F.col("__ea_name").alias("scheduleName_ea"),
        fn.clip("__ea_desc", 200).alias("scheduleDesc_ea"),
        F.col("__sps_dt").alias("protStatDT_sps"),
        fn.clip("__calstat_sub", 4).alias("calStatSubtype_sps_lu"),
        fn.clip("__calstat_desc", 200).alias("calStatDesc_sps_lu"),
        F.col("__sps_note").alias("protStatNote_sps"),
        fn.label(F.col("__se1_status") == CURRENT_SCHEDULE_STATUS, "Current Schedule",
                 "Past Schedule").alias("statusDesc_se1"),
        F.col("__se1_desc").alias("eventDesc_se1"),
        F.col("__se1_seq").alias("eventSequence_se1"),
        F.col("__se1_start").alias("startDT_se1"),
        F.col("__se1_end").alias("endDT_se1"),
        F.col("__se1_exe").alias("eventExeDT_se1"),
        F.col("__se1_actual").alias("actualSchDT_se1"),
        fn.clip("__cover_sub", 4).alias("EventCoverageSubtype_se1_lu"),
        fn.clip("__cover_desc", 200).alias("EventCoverageDesc_se1_lu"),
        "pkPerson_p", "personCode_p", "patFirst_p", "patMiddle_p", "patLast_p", "birthDt_p",
        F.col("__ses_end").alias("eventStatEndDT_ses"),
        fn.clip("__estat_sub", 4).alias("eventStatSubtype_ses_lu"),
        fn.clip("__estat_desc", 200).alias("eventStatDesc_ses_lu"),
        F.col("__ea_created").alias("createDt_ea"),
        F.col("__ea_cu_first").alias("createByFName_ea"),
        F.col("__ea_cu_last").alias("createByLName_ea"),
        F.col("__ea_modified").alias("modDt_ea"),
        F.col("__ea_mu_first").alias("modByFName_ea"),
        F.col("__ea_mu_last").alias("modByLName_ea"),
        F.col("__se1_created").alias("createDt_se1"),
        F.col("__se1_cu_first").alias("createByFName_se1"),
        F.col("__se1_cu_last").alias("createByLName_se1"),
        F.col("__se1_modified").alias("modDt_se1"),
        F.col("__se1_mu_first").alias("modByFName_se1"),
        F.col("__se1_mu_last").alias("modByLName_se1"),
        F.col("__ses_created").alias("createDt_ses"),
        F.col("__ses_cu_first").alias("createByFName_ses"),
        F.col("__ses_cu_last").alias("createByLName_ses"),
        F.col("__ses_modified").alias("modDt_ses"),
        F.col("__ses_mu_first").alias("modByFName_ses"),
        F.col("__ses_mu_last").alias("modByLName_ses"),
        F.col("__sps_created").alias("createDt_sps"),
        F.col("__sps_cu_first").alias("createByFName_sps"),
        F.col("__sps_cu_last").alias("createByLName_sps"),
        F.col("__sps_modified").alias("modDt_sps"),
        F.col("__sps_mu_first").alias("modByFName_sps"),
        F.col("__sps_mu_last").alias("modByLName_sps"),
        fn.run_stamp(run_ts).alias("xDMrunDt"),
    )
