"""M3 ``dm_patient``: active patient-protocols x status records x facility.

Plan shape: the patient-protocol table drives; code lists, sites and users
are lookups that Spark broadcasts while their bytes allow it, the user roles of
a table share one join beyond that; status records, facility rows
and the person master are the large sides.  All of them join on the person key
alone, with study or site compared inside a person, so every side is exchanged
once and the widening rows stay where they are (a person has few protocols, and
its records of other studies are passed over while it is at hand).  The
additional-race list is pre-aggregated per person (distinct pairs first,
so the aggregation is partial map-side) before it is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart.operators import lookup, lookup_roles, string_list
from trialmart.quality import watched
from trialmart.sources import SourceSet

# Fixed code values of the source system.
ACTIVE_PROTOCOL_STAT = 1
DISEASE_TYPE_ID = 8101
ACCESS_RIGHTS = {0: "Revoked", 7: "Granted"}


def _user_cols(prefix: str) -> dict[str, str]:
    return {"usr_lastname": f"{prefix}_last", "usr_firstname": f"{prefix}_first"}


def _equal_inside(a: str, b: str):
    """``a = b`` as a condition that is checked inside the groups of a join's keys, not made a key."""
    return (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))


def additional_race(src: SourceSet) -> DataFrame:
    """Distinct additional-race descriptions per person joined by `` | ``."""
    races = src["er_person_add_race"].filter(fn.not_blank("person_add_race"))
    races = races.withColumn("__race_key", fn.to_unsigned("person_add_race"))
    races = lookup(races, src["er_codelst"], ("__race_key", "pk_codelst"),
                   {"codelst_desc": "__race_desc"})
    return (string_list(races, "fk_person", "__race_desc", out="raceAdditional_p_lu")
            .withColumnRenamed("fk_person", "__race_person"))


def build_patient(src: SourceSet, run_ts=None) -> DataFrame:
    """M3 ``dm_patient`` (93 columns)."""
    codes, users, sites = src["er_codelst"], src["er_user"], src["er_site"]

    pp = watched(src["er_patprot"].filter(F.col("patprot_stat") == ACTIVE_PROTOCOL_STAT))
    pp = lookup(pp, src["er_study"].select("pk_study", "study_number"), ("fk_study", "pk_study"),
                {"pk_study": "__st_pk", "study_number": "__st_number"})
    pp = lookup(pp, sites, ("fk_site_enrolling", "pk_site"),
                {"site_name": "__enroll_site", "fk_codelst_type": "__enroll_site_type"})
    pp = lookup(pp, codes, ("__enroll_site_type", "pk_codelst"), {"codelst_desc": "__stype"})
    pp = lookup_roles(pp, users, "pk_user", {
        fk: _user_cols(role) for fk, role in [
            ("fk_user", "__enroll"), ("fk_userassto", "__assign"), ("patprot_physician", "__phys"),
            ("creator", "__ppcreate"), ("last_modified_by", "__ppmod")]})
    pp = lookup(pp, codes, ("fk_codelstloc", "pk_codelst"), {"codelst_desc": "__treatloc"})
    pp = lookup(pp, sites, ("patprot_treatingorg", "pk_site"), {"site_name": "__treatorg"})
    pp = lookup(pp, codes, ("fk_codelst_ptst_dth_stdrel", "pk_codelst"), {"codelst_desc": "__dthrel"})
    pp = lookup(pp, codes, ("patprot_othr_dis_code", "pk_codelst"), {"codelst_desc": "__othdis"})

    # patient study status records: joined on person and the *looked-up* study key
    pss = src["er_patstudystat"]
    pss = lookup(pss, codes, ("fk_codelst_stat", "pk_codelst"), {"codelst_desc": "__pss_stat"})
    pss = lookup(pss, codes, ("screening_outcome", "pk_codelst"), {"codelst_desc": "__pss_scrout"})
    pss = lookup(pss, codes, ("patstudystat_reason", "pk_codelst"), {"codelst_desc": "__pss_reason"})
    pss = lookup_roles(pss, users, "pk_user", {
        fk: _user_cols(role) for fk, role in [
            ("screened_by", "__screener"), ("creator", "__psscreate"), ("last_modified_by", "__pssmod")]})
    pss = pss.select(
        F.col("fk_per").alias("__pss_per"), F.col("fk_study").alias("__pss_study"),
        F.col("pk_patstudystat").alias("pkPatStudyStat_pps"),
        F.col("screen_number").alias("screenNumber_pss"),
        F.col("__screener_last").alias("screenByLast_pss_lu"),
        F.col("__screener_first").alias("screenByFirst_pss_lu"),
        fn.clip("__pss_scrout", 250).alias("screenOutcome_pss_lu"),
        fn.clip("__pss_stat", 50).alias("status_pss_lu"),
        fn.date_key("patstudystat_date").alias("statusDt_pss"),
        fn.date_key("patstudystat_endt").alias("statusEndDt_pss"),
        F.col("current_stat").alias("__pss_current"),
        fn.clip("__pss_reason", 250).alias("statusReason_pps_lu"),
        fn.clip("patstudystat_note", 250).alias("statusNote_pps_lu"),
        F.col("inform_consent_ver").alias("consentVersion_pss"),
        fn.date_key("created_on").alias("createDt_pss"),
        F.col("__psscreate_last").alias("createByLast_pss_lu"),
        F.col("__psscreate_first").alias("createByFirst_pss_lu"),
        fn.date_key("last_modified_date").alias("modDt_pss"),
        F.col("__pssmod_last").alias("modByLast_pss_lu"),
        F.col("__pssmod_first").alias("modByFirst_pss_lu"),
    )

    pf = lookup(src["er_patfacility"], users, ("patfacility_provider", "pk_user"),
                _user_cols("__prov"))
    pf = pf.select(
        F.col("fk_per").alias("__pf_per"), F.col("fk_site").alias("pkSiteFacility_s"),
        F.col("pat_facilityid").alias("facilityID_pf"),
        F.col("pat_accessright").alias("__pf_access"),
        F.col("patfacility_default").alias("__pf_default"),
        F.col("__prov_last").alias("providerLast_pf"),
        F.col("__prov_first").alias("providerFirst_pf"),
        F.col("patfacility_otherprovider").alias("providerOther_pf"),
        fn.date_key("patfacility_regdate").alias("registerDt_pf"),
    )

    person = src["person"]
    for fk, out in [("fk_codelst_pstat", "__pstat"), ("fk_codelst_pat_dth_cause", "__dthcause"),
                    ("fk_codelst_gender", "__gender"), ("fk_codelst_ethnicity", "__ethnicity"),
                    ("fk_codelst_race", "__race")]:
        person = lookup(person, codes, (fk, "pk_codelst"), {"codelst_desc": out})
    person = person.withColumn(
        "__eth_key", F.when(fn.not_blank("person_add_ethnicity"),
                            fn.to_unsigned(F.rtrim("person_add_ethnicity"))))
    person = lookup(person, codes, ("__eth_key", "pk_codelst"), {"codelst_desc": "__eth_add"})
    person = lookup(person, sites, ("fk_site", "pk_site"), {"site_name": "__regsite"})
    person = lookup_roles(person, users, "pk_user", {
        fk: _user_cols(role) for fk, role in [
            ("person_regby", "__regby"), ("creator", "__pcreate"), ("last_modified_by", "__pmod")]})
    disease = lookup(src["pat_perid"].filter(F.col("fk_codelst_idtype") == DISEASE_TYPE_ID),
                     src["ref_disease_site"], ("perid_id", "value"),
                     {"description": "diseaseType_pid_lu"})
    person = person.join(disease.select(F.col("fk_per").alias("__pid_per"), "diseaseType_pid_lu"),
                         F.col("pk_person") == F.col("__pid_per"), "left")
    person = person.join(additional_race(src), F.col("pk_person") == F.col("__race_person"), "left")
    person = person.select(
        F.col("pk_person").alias("pkPerson_p"),
        F.col("fk_site").alias("pkSiteRegistered_s"),
        F.col("person_code").alias("personCode_p"),
        fn.clip("person_lname", 30).alias("patLast_p"),
        fn.clip("person_fname", 30).alias("patFirst_p"),
        fn.clip("person_mname", 20).alias("patMiddle_p"),
        fn.date_key("person_dob").alias("birthDt_p"),
        fn.clip("__pstat", 20).alias("survivalStatus_p_lu"),
        fn.date_key("person_deathdt").alias("deathDt_p"),
        fn.clip("__dthcause", 10).alias("deathCause_p_lu"),
        fn.clip("cause_of_death_other", 200).alias("deathCauseOther_p"),
        fn.cut("__gender", 20).alias("gender_p"),
        fn.cut("__ethnicity", 20).alias("ethnicity_p"),
        fn.cut("__eth_add", 20).alias("ethnicityAdditional_p_lu"),
        fn.cut("__race", 50).alias("race_p_lu"),
        "raceAdditional_p_lu",
        fn.clip("person_city", 100).alias("patCity_p"),
        fn.clip("person_state", 100).alias("patState_p"),
        fn.clip("person_county", 100).alias("patCounty_p"),
        fn.clip("person_zip", 20).alias("patZip_p"),
        fn.clip("person_country", 100).alias("patCountry_p"),
        fn.clip("__regsite", 50).alias("registerOrg_p_lu"),
        fn.date_key("person_regdate").alias("registerDt_p"),
        F.col("__regby_last").alias("registerByLast_p_lu"),
        F.col("__regby_first").alias("registerByFirst_p_lu"),
        fn.date_key("created_on").alias("createDt_p"),
        F.col("__pcreate_last").alias("createByLast_p_lu"),
        F.col("__pcreate_first").alias("createByFirst_p_lu"),
        fn.date_key("last_modified_date").alias("modDt_p"),
        F.col("__pmod_last").alias("modByLast_p_lu"),
        F.col("__pmod_first").alias("modByFirst_p_lu"),
        "diseaseType_pid_lu",
        fn.clip("person_address1", 100).alias("patAddress1_p"),
        fn.clip("person_address2", 100).alias("patAddress2_p"),
    )

    # for an equality of study or site as a second key, Spark would exchange the joined rows before each join
    df = pp.join(pss, (F.col("fk_per") == F.col("__pss_per")) & _equal_inside("__st_pk", "__pss_study"), "left")
    df = df.join(pf, (F.col("fk_per") == F.col("__pf_per"))
                 & _equal_inside("fk_site_enrolling", "pkSiteFacility_s"), "left")
    df = df.join(person, F.col("fk_per") == F.col("pkPerson_p"), "left")

    return df.select(
        F.col("pk_patprot").alias("pkPatProt_pp"),
        F.col("fk_study").alias("pkStudy_st"),
        "pkPerson_p", "pkSiteRegistered_s",
        F.col("fk_site_enrolling").alias("pkSiteEnrolled_s"),
        "pkSiteFacility_s", "pkPatStudyStat_pps",
        F.col("__st_number").alias("studyNumber_st"),
        fn.clip("patprot_patstdid", 50).alias("patStudyId_pp"),
        fn.date_key("patprot_enroldt").alias("enroll_Dt_pp"),
        F.col("__enroll_last").alias("enrollByLast_pp_lu"),
        F.col("__enroll_first").alias("enrollByFirst_pp_lu"),
        fn.clip("__enroll_site", 50).alias("enrollOrg_pp_lu"),
        fn.clip("__stype", 25).alias("siteType_stst_lu"),
        fn.flag("patprot_stat").alias("enrollmentIsActiveFlag_pp"),
        F.col("__assign_last").alias("assignToLast_pp_lu"),
        F.col("__assign_first").alias("assignToFirst_pp_lu"),
        F.col("__phys_last").alias("physicianLast_pp_lu"),
        F.col("__phys_first").alias("physicianFirst_pp_lu"),
        fn.cut("__treatloc", 50).alias("treatmentLoc_pp_lu"),
        F.col("__treatorg").alias("treatmentOrg_pp_lu"),
        F.col("__othdis").alias("diseaseCodeOther_pp_lu"),
        fn.flag("patprot_consign").alias("consentSignedFlag_pp"),
        fn.date_key("patprot_consigndt").alias("consentSignedDt_pp"),
        fn.date_key("patprot_discdt").alias("discontinueDt_pp"),
        fn.clip("patprot_reason", 250).alias("discontinueReason_pp"),
        fn.date_key("patprot_start").alias("startDt_pp"),
        fn.date_key("date_of_death").alias("deathDt_pp"),
        fn.clip("__dthrel", 250).alias("deathStudyRelated_pp_lu"),
        fn.clip("death_std_rltd_other", 250).alias("deathStudyRelatedOther_pp"),
        fn.date_key("created_on").alias("createDt_pp"),
        F.col("__ppcreate_last").alias("createByLast_pp_lu"),
        F.col("__ppcreate_first").alias("createByFirst_pp_lu"),
        fn.date_key("last_modified_date").alias("modDt_pp"),
        F.col("__ppmod_last").alias("modByLast_pp_lu"),
        F.col("__ppmod_first").alias("modByFirst_pp_lu"),
        "screenNumber_pss", "screenByLast_pss_lu", "screenByFirst_pss_lu",
        "screenOutcome_pss_lu", "status_pss_lu", "statusDt_pss", "statusEndDt_pss",
        # CASE columns are computed after the left joins (no match -> ELSE value)
        fn.flag("__pss_current").alias("statusIsCurrentFlag_pps"), "statusReason_pps_lu", "statusNote_pps_lu",
        "consentVersion_pss", "createDt_pss", "createByLast_pss_lu", "createByFirst_pss_lu",
        "modDt_pss", "modByLast_pss_lu", "modByFirst_pss_lu",
        "facilityID_pf",
        fn.code_map("__pf_access", ACCESS_RIGHTS, default="").alias("accessRight_pf"),
        fn.flag("__pf_default").alias("facilityIsDefaultFlag_pf"), "providerLast_pf",
        "providerFirst_pf", "providerOther_pf", "registerDt_pf",
        "personCode_p", "patLast_p", "patFirst_p", "patMiddle_p", "birthDt_p",
        "survivalStatus_p_lu", "deathDt_p", "deathCause_p_lu", "deathCauseOther_p",
        "gender_p", "ethnicity_p", "ethnicityAdditional_p_lu", "race_p_lu",
        "raceAdditional_p_lu", "patCity_p", "patState_p", "patCounty_p", "patZip_p",
        "patCountry_p", "registerOrg_p_lu", "registerDt_p", "registerByLast_p_lu",
        "registerByFirst_p_lu", "createDt_p", "createByLast_p_lu", "createByFirst_p_lu",
        "modDt_p", "modByLast_p_lu", "modByFirst_p_lu", "diseaseType_pid_lu",
        fn.run_stamp(run_ts).alias("xDMrunDt"),
        "patAddress1_p", "patAddress2_p",
    )
