"""M1 ``dm_study`` and M2 ``dm_study_current``.

M1: one row per study x status record x (regulatory-coordinator team row) x
(EAV slot fan-out).  Plan shape:

* code lists, sites and users are narrow lookups, which Spark broadcasts while
  their bytes allow it (the user roles of a side share one join beyond that);
  the status side (status x site x site-type x users x
  study-site) is assembled on the status table before it meets the study;
* status records and team rows join by ``expand_left``, which deals the rows
  of a hot study over several tasks; the study's own columns have their values
  before these joins repeat them;
* the EAV table is scanned once, aggregated once per study and exploded slot by
  slot (``eav_slots``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart.operators import eav_slots, exclude_active, expand_left, lookup, lookup_roles, string_list
from trialmart.quality import watched
from trialmart.sources import SourceSet

# Fixed code values of the source system (type ids of study identifiers and
# of team roles) - these must equal the trial system's code keys.
EAV_SLOTS = {
    "nci_number": 6068,
    "program_code": 7109,
    "alliance_open": 8004,
    "ncorp_open": 8151,
    "ncorp_accrual_type": 12085,
    "acuity": 11065,
    "treatment_line": 9183,
    "clinical_working_group": 8576,
    "total_target": 12133,
    "additional_info": 8295,
    "irb_number": 8258,
    "irb_other": 8259,
}
RESEARCH_CATEGORY_TYPES = {7110: "OBS", 7111: "INT", 7112: "OTH INT", 8089: "ANC/COR"}
INTERVENTIONAL_TYPES = [7111, 7112]
TREATMENT_STUDY_TYPE = "TRE"
REGULATORY_COORDINATOR_ROLE = 8132
DEFAULT_TEAM_USER_TYPE = "D"

USER_NAME = {"usr_lastname": "last", "usr_firstname": "first"}


def _user_cols(prefix: str) -> dict[str, str]:
    return {"usr_lastname": f"{prefix}_last", "usr_firstname": f"{prefix}_first"}


def disease_site_names(src: SourceSet) -> DataFrame:
    """Distinct disease-site names per study joined by `` | `` (AGG-01 side input)."""
    named = lookup(src["er_studydiseasesite"], src["er_codelst"],
                   ("study_disease_site", "pk_codelst"), {"codelst_desc": "__disease"})
    return (string_list(named, "fk_study", "__disease", out="diseaseSiteNames_st_lu")
            .withColumnRenamed("fk_study", "__dn_study"))


def _status_side(src: SourceSet) -> DataFrame:
    """Study status records with their site, codes, users and study-site row."""
    codes, users, sites = src["er_codelst"], src["er_user"], src["er_site"]
    stst = src["er_studystat"]
    stst = lookup(stst, codes, ("fk_codelst_studystat", "pk_codelst"), {"codelst_desc": "__stat_desc"})
    stst = lookup(stst, codes, ("outcome", "pk_codelst"), {"codelst_desc": "__out_desc"})
    stst = lookup(stst, sites, ("fk_site", "pk_site"),
                  {"pk_site": "__s_pk", "site_name": "__s_name", "fk_codelst_type": "__s_type"})
    stst = lookup(stst, codes, ("__s_type", "pk_codelst"), {"codelst_desc": "__stype_desc"})
    stst = lookup_roles(stst, users, "pk_user", {
        fk: _user_cols(role) for fk, role in [
            ("fk_user_docby", "__docby"), ("studystat_assignedto", "__assigned"),
            ("creator", "__ststcreator"), ("last_modified_by", "__ststmodby")]})
    stst = lookup(stst, codes, ("fk_codelst_revboard", "pk_codelst"), {"codelst_desc": "__revbrd_desc"})
    stst = lookup(stst, src["er_studysites"], [("fk_study", "fk_study"), ("__s_pk", "fk_site")],
                  {"pk_studysites": "__stsi_pk", "studysite_lsamplesize": "__stsi_lss",
                   "studysite_enrcount": "__stsi_enr"})
    return stst.select(
        F.col("fk_study").alias("__stst_study"),
        F.col("__s_pk").alias("pkSite_s"),
        F.col("pk_studystat").alias("pkStudyStat_stst"),
        F.col("__stsi_pk").alias("pkStudySites_stsi"),
        F.col("__s_name").alias("organization_stst"),
        fn.clip("__stype_desc", 25).alias("siteType_stst_lu"),
        fn.clip("__stat_desc", 25).alias("orgStudyStatus_stst_lu"),
        F.col("__docby_last").alias("documentByLast_stst_lu"),
        F.col("__docby_first").alias("documentByFirst_stst_lu"),
        F.col("__assigned_last").alias("assignToLast_stst_lu"),
        F.col("__assigned_first").alias("assignToFirst_stst_lu"),
        F.col("current_stat").alias("__stst_current"),
        F.col("studystat_hspn").alias("__stst_hspn"),
        fn.date_key("studystat_date").alias("statusValidFromDt_stst"),
        fn.date_key("studystat_endt").alias("statusEndDt_stst"),
        fn.date_key("studystat_validt").alias("statusValidUntilDt_stst"),
        fn.date_key("studystat_meetdt").alias("statusMeetingDt_stst"),
        fn.clip("__revbrd_desc", 25).alias("reviewBoard_stst"),
        fn.clip("__out_desc", 100).alias("outcome_stst_lu"),
        fn.clip("studystat_note", 2000).alias("statusNote_stst"),
        fn.to_unsigned(F.trim(F.col("__stsi_lss"))).alias("sampleSizeLocal_stsi"),
        fn.to_unsigned("__stsi_enr").alias("enrolledCount_stsi"),
        fn.date_key("created_on").alias("createDt_stst"),
        F.col("__ststcreator_last").alias("createByLast_stst_lu"),
        F.col("__ststcreator_first").alias("createByFirst_stst_lu"),
        fn.date_key("last_modified_date").alias("modDt_stst"),
        F.col("__ststmodby_last").alias("modByLast_stst_lu"),
        F.col("__ststmodby_first").alias("modByFirst_stst_lu"),
    )


def _coordinators(src: SourceSet) -> DataFrame:
    return src["er_studyteam"].filter(
        (F.col("fk_codelst_tmrole") == REGULATORY_COORDINATOR_ROLE)
        & (F.col("study_team_usr_type") == DEFAULT_TEAM_USER_TYPE))


def _team_side(src: SourceSet) -> DataFrame:
    """Primary regulatory coordinator rows per study (right-side filter in ON)."""
    team = lookup(_coordinators(src), src["er_user"], ("fk_user", "pk_user"), _user_cols("__regcoord"))
    return team.select(F.col("fk_study").alias("__sttm_study"),
                       F.col("pk_studyteam").alias("pkStudyTeam_sttm"),
                       F.col("__regcoord_last").alias("regCoordPrimLast_sttm_lu"),
                       F.col("__regcoord_first").alias("regCoordPrimFirst_sttm_lu"))


def _slot(type_id: int, out: str) -> dict:
    return {"types": [type_id], "columns": {"studyid_id": out}}


def build_study(src: SourceSet, run_ts=None) -> DataFrame:
    """M1 ``dm_study`` (91 columns)."""
    codes, users = src["er_codelst"], src["er_user"]
    st = watched(src["er_study"])

    for fk, out in [("fk_codelst_sponsor", "__sponsor"), ("fk_codelst_phase", "__phase"),
                    ("fk_codelst_restype", "__restype"), ("fk_codelst_scope", "__scope"),
                    ("fk_codelst_type", "__type"), ("fk_codelst_purpose", "__purpose"),
                    ("fk_codelst_tarea", "__tarea"), ("study_division", "__division"),
                    ("fk_codelst_blind", "__blind")]:
        st = lookup(st, codes, (fk, "pk_codelst"), {"codelst_desc": out})
    st = lookup_roles(st, users, "pk_user", {
        fk: _user_cols(role) for fk, role in [
            ("fk_author", "__author"), ("study_coordinator", "__coord"), ("study_prinv", "__pi"),
            ("creator", "__creator"), ("last_modified_by", "__modby")]})

    # parent study and associated study (text key read the lenient way)
    numbers = src["er_study"].select("pk_study", "study_number")
    st = lookup(st, numbers, ("study_parentid", "pk_study"), {"study_number": "__parent_number"})
    st = st.withColumn("__assoc_key", fn.to_unsigned("study_assoc"))
    st = lookup(st, numbers, ("__assoc_key", "pk_study"), {"study_number": "__assoc_number"})

    st = st.join(disease_site_names(src), F.col("pk_study") == F.col("__dn_study"), "left")

    slots = {name: _slot(t, f"__stid_{name}") for name, t in EAV_SLOTS.items()}
    slots["research_category"] = {"types": list(RESEARCH_CATEGORY_TYPES), "value": "Y",
                                  "columns": {"fk_codelst_idtype": "__clreas_type"}}
    st = eav_slots(st, src["er_studyid"], "pk_study", slots)
    st = lookup(st, src["ref_clinical_working_group"], ("__stid_clinical_working_group", "value"),
                {"description": "__rcwg_desc", "report_sort": "__rcwg_sort"})

    # every study column gets its value here, before the fan-out joins repeat the study's row
    clreas = F.col("__clreas_type")
    study_type = F.col("__type")
    cpdm = fn.study_category(clreas, study_type, INTERVENTIONAL_TYPES, TREATMENT_STUDY_TYPE)

    st = st.select(
        F.col("pk_study").alias("pkStudy_st"),
        F.col("study_number").alias("studyNumber_st"),
        F.col("__creator_last").alias("enteredByLast_st_lu"),
        F.col("__creator_first").alias("enteredByFirst_st_lu"),
        F.col("__pi_last").alias("piLast_st_lu"),
        F.col("__pi_first").alias("piFirst_st_lu"),
        fn.flag("study_maj_auth", "Y").alias("piMajorAuthFlag_st"),
        F.col("study_otherprinv").alias("piOther_st"),
        F.col("__coord_last").alias("studyContactLast_st_lu"),
        F.col("__coord_first").alias("studyContactFirst_st_lu"),
        F.col("study_title").alias("title_st"),
        F.col("nct_number").alias("nctNumber_st"),
        fn.cut("__purpose", 25).alias("primaryPurpose_st_lu"),
        F.col("study_prodname").alias("agentOrDevice_st"),
        fn.clip("__division", 25).alias("division_st_lu"),
        fn.clip("__tarea", 50).alias("therapeuticArea_st_lu"),
        "diseaseSiteNames_st_lu",
        F.col("study_nsamplsize").alias("sampleSizeNational_st"),
        F.col("study_samplsize").alias("sampleSizeStudy_st"),
        F.col("study_dur").alias("duration_st"),
        F.col("study_durunit").alias("durationUnit_st"),
        F.col("study_estbegindt").alias("studyEstBeginDt_st"),
        fn.clip("__phase", 50).alias("phase_st_lu"),
        fn.clip("__restype", 50).alias("researchType_st_lu"),
        fn.clip("__scope", 25).alias("studyScope_st_lu"),
        fn.clip("__type", 25).alias("studyType_st_lu"),
        F.col("__parent_number").alias("studyNumberParent_st_lu"),
        F.col("__assoc_number").alias("studyNumberAssoc_st_lu"),
        fn.clip("__blind", 10).alias("blindingOption_st_lu"),
        fn.cut("__sponsor", 50).alias("sponsor_st_lu"),
        F.col("study_sponsor").alias("sponsor_st"),
        F.col("study_sponsorid").alias("sponsorID_st"),
        F.col("study_contact").alias("sponsorContact_st"),
        fn.clip("__stid_irb_number", 10).alias("irb_stid"),
        fn.clip("__stid_irb_other", 100).alias("irbOther_stid"),
        F.col("nci_trial_identifier").alias("nciTrialId_st"),
        fn.clip("__stid_nci_number", 100).alias("nciNumber_stid"),
        fn.clip("__stid_alliance_open", 1).alias("allianceOpen_stid"),
        fn.clip("__stid_ncorp_open", 1).alias("ncorpOpen_stid"),
        fn.clip("__stid_ncorp_accrual_type", 25).alias("ncorpAccrualType_stid"),
        fn.clip("__stid_program_code", 5).alias("programCode_stid"),
        fn.to_unsigned(F.rtrim("__stid_total_target")).alias("totalStudyTarget_stid"),
        fn.to_unsigned(F.rtrim("__stid_clinical_working_group")).alias("cwg_stid"),
        fn.clip("__rcwg_desc", 50).alias("clinicalWorkingGroup_rcwg"),
        fn.to_unsigned(F.rtrim("__rcwg_sort")).alias("clinicalWorkingGroupSort_rcwg"),
        fn.clip("__stid_treatment_line", 5).alias("treatmentLine_stid"),
        F.col("__stid_additional_info").alias("additionalInfo_stid"),
        F.col("__stid_acuity").alias("acuityScore_stid"),
        fn.code_map(clreas, RESEARCH_CATEGORY_TYPES, default=None).alias("clinicalResearchCat_stid_lu"),
        cpdm.alias("cpdmCategory_stid_lu"),
        F.col("__author_last").alias("authorLast_st_lu"),
        F.col("__author_first").alias("authorFirst_st_lu"),
        F.col("study_actualdt").alias("studyStartDt_st"),
        F.col("study_end_date").alias("studyEndDt_st"),
        F.col("__creator_last").alias("createByLast_st_lu"),
        F.col("__creator_first").alias("createByFirst_st_lu"),
        fn.date_key("created_on").alias("createDt_st"),
        F.col("__modby_last").alias("modByLast_st_lu"),
        F.col("__modby_first").alias("modByFirst_st_lu"),
        fn.date_key("last_modified_date").alias("modDt_st"),
    )

    # fan-out joins last; one study may hold a large share of either side
    coordinators = _coordinators(src).select(F.col("fk_study").alias("__sttm_study"),
                                             F.col("pk_studyteam").alias("pkStudyTeam_sttm"))
    st = expand_left(st, _team_side(src), "pkStudy_st", "__sttm_study", "pkStudyTeam_sttm", keys=coordinators)
    records = src["er_studystat"].select(F.col("fk_study").alias("__stst_study"),
                                         F.col("pk_studystat").alias("pkStudyStat_stst"))
    st = expand_left(st, _status_side(src), "pkStudy_st", "__stst_study", "pkStudyStat_stst", keys=records,
                     clustered=True)

    return st.select(
        "pkStudy_st", "pkSite_s", "pkStudyStat_stst", "pkStudySites_stsi", "pkStudyTeam_sttm",
        "studyNumber_st", "enteredByLast_st_lu", "enteredByFirst_st_lu", "piLast_st_lu", "piFirst_st_lu",
        "piMajorAuthFlag_st", "piOther_st", "studyContactLast_st_lu", "studyContactFirst_st_lu",
        "title_st", "nctNumber_st", "primaryPurpose_st_lu", "agentOrDevice_st", "division_st_lu",
        "therapeuticArea_st_lu", "diseaseSiteNames_st_lu", "sampleSizeNational_st", "sampleSizeStudy_st",
        "duration_st", "durationUnit_st", "studyEstBeginDt_st", "phase_st_lu", "researchType_st_lu",
        "studyScope_st_lu", "studyType_st_lu", "studyNumberParent_st_lu", "studyNumberAssoc_st_lu",
        "blindingOption_st_lu", "sponsor_st_lu", "sponsor_st", "sponsorID_st", "sponsorContact_st",
        "irb_stid", "irbOther_stid", "nciTrialId_st", "nciNumber_stid", "allianceOpen_stid",
        "ncorpOpen_stid", "ncorpAccrualType_stid", "programCode_stid", "totalStudyTarget_stid",
        "cwg_stid", "clinicalWorkingGroup_rcwg", "clinicalWorkingGroupSort_rcwg", "treatmentLine_stid",
        "additionalInfo_stid", "acuityScore_stid", "clinicalResearchCat_stid_lu", "cpdmCategory_stid_lu",
        "authorLast_st_lu", "authorFirst_st_lu", "studyStartDt_st", "studyEndDt_st", "organization_stst",
        "siteType_stst_lu", "orgStudyStatus_stst_lu", "documentByLast_stst_lu",
        "documentByFirst_stst_lu", "assignToLast_stst_lu", "assignToFirst_stst_lu",
        # flags are computed after the left join: no status row gives 'N'
        fn.flag("__stst_current").alias("statusCurrentFlag_stst"),
        fn.flag("__stst_hspn").alias("statusOrgSpecCurRpt_stst"),
        "statusValidFromDt_stst", "statusEndDt_stst", "statusValidUntilDt_stst", "statusMeetingDt_stst",
        "reviewBoard_stst", "outcome_stst_lu", "statusNote_stst", "sampleSizeLocal_stsi",
        "enrolledCount_stsi", "regCoordPrimLast_sttm_lu", "regCoordPrimFirst_sttm_lu",
        "createByLast_st_lu", "createByFirst_st_lu", "createDt_st", "modByLast_st_lu",
        "modByFirst_st_lu", "modDt_st", "createDt_stst", "createByLast_stst_lu", "createByFirst_stst_lu",
        "modDt_stst", "modByLast_stst_lu", "modByFirst_stst_lu",
        fn.run_stamp(run_ts).alias("xDMrunDt"),
    )


def build_study_current(study: DataFrame, src: SourceSet, run_ts=None) -> DataFrame:
    """M2 ``dm_study_current`` from the study mart (70 columns).

    Current status rows only, minus actively excluded studies, with four
    reference lookups; DISTINCT (the run stamp is added after it).
    """
    dms = study.filter(F.col("statusCurrentFlag_stst") == "Y")
    dms = exclude_active(dms, src["ref_study_exclusions"], "pkStudy_st")
    refs = [("ref_program_code", "programCode_stid", "__rpc"),
            ("ref_research_category", "clinicalResearchCat_stid_lu", "__rrc"),
            ("ref_study_type", "studyType_st_lu", "__rst"),
            ("ref_treatment_line", "treatmentLine_stid", "__rtl")]
    for table, fk, p in refs:
        dms = lookup(dms, src[table], (fk, "value"),
                     {"description": f"{p}_desc", "report_sort": f"{p}_sort"})
    out = dms.select(
        "pkStudy_st", "pkSite_s", "pkStudyStat_stst", "studyNumber_st",
        fn.last_first("piLast_st_lu", "piFirst_st_lu").alias("studyPI_st"),
        fn.last_initial("piLast_st_lu", "piFirst_st_lu").alias("studyPIDT4_st"),
        "title_st", "nctNumber_st", "cpdmCategory_stid_lu", "primaryPurpose_st_lu",
        "therapeuticArea_st_lu", "diseaseSiteNames_st_lu", "sampleSizeNational_st",
        "duration_st", "durationUnit_st",
        fn.fallback("sponsor_st_lu", "sponsor_st").alias("fundingSource_st"),
        "sponsorID_st", "phase_st_lu", "researchType_st_lu", "studyScope_st_lu",
        "studyType_st_lu",
        F.col("__rst_desc").alias("studyTypeName_rst"),
        F.col("__rst_sort").alias("studyTypeNameSort_rst"),
        "irb_stid", "irbOther_stid", "nciNumber_stid", "allianceOpen_stid",
        "ncorpOpen_stid", "ncorpAccrualType_stid", "clinicalResearchCat_stid_lu",
        F.col("__rrc_desc").alias("researchCategoryName_rst"),
        F.col("__rrc_sort").alias("researchCategoryNameSort_rst"),
        "programCode_stid",
        F.col("__rpc_desc").alias("programName_rpc"),
        F.col("__rpc_sort").alias("programNameSort_rpc"),
        "totalStudyTarget_stid", "cwg_stid", "clinicalWorkingGroup_rcwg",
        "clinicalWorkingGroupSort_rcwg", "treatmentLine_stid",
        F.col("__rtl_desc").alias("treatmentLineName_rtl"),
        F.col("__rtl_sort").alias("treatmentLineNameSort_rtl"),
        "additionalInfo_stid", "acuityScore_stid", "studyStartDt_st", "studyEndDt_st",
        fn.full_name("authorFirst_st_lu", "authorLast_st_lu").alias("authorName_st"),
        "createDt_st",
        fn.full_name("createByFirst_st_lu", "createByLast_st_lu").alias("createByName_st"),
        "modDt_st",
        fn.full_name("modByFirst_st_lu", "modByLast_st_lu").alias("modByName_st"),
        "organization_stst", "siteType_stst_lu", "orgStudyStatus_stst_lu",
        "statusValidFromDt_stst", "statusValidUntilDt_stst", "sampleSizeLocal_stsi",
        "enrolledCount_stsi", "createDt_stst",
        fn.full_name("createByFirst_stst_lu", "createByLast_stst_lu").alias("createByName_stst"),
        "modDt_stst",
        fn.full_name("modByFirst_stst_lu", "modByLast_stst_lu").alias("modByName_stst"),
        "outcome_stst_lu", "statusEndDt_stst", "statusMeetingDt_stst", "statusNote_stst",
        "studyContactFirst_st_lu", "studyContactLast_st_lu",
        fn.full_name("studyContactFirst_st_lu", "studyContactLast_st_lu").alias("contactName_stst"),
    ).distinct()
    return out.withColumn("xDMrunDt", fn.run_stamp(run_ts))
