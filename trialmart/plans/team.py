"""M5 ``dm_study_team``: every team member with role, site, parent site,
account state and the per-study count of active primary roles.

The primary-role count is a filtered ``groupBy(study).count`` (partial
aggregation map-side) joined back with a left join, so studies without a
qualifying row get NULL, not 0.  The primary-role *flag* ignores member
status while the count requires Active - both kept as in the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart import functions as fn
from trialmart.operators import exclude_active, filtered_count, lookup, lookup_roles
from trialmart.quality import watched
from trialmart.sources import SourceSet

# Fixed code values: primary team roles (principal investigator, primary
# research / regulatory / data coordinator, primary lab technician) and the
# labels of user account status and type.
PRIMARY_ROLES = [9, 8130, 8132, 8211, 12087]
ACTIVE_MEMBER = "Active"
ACCOUNT_STATUS = {"A": "Active", "D": "Deactivated", "B": "Blocked"}
ACCOUNT_TYPE = {"N": "Non-System", "S": "System", "X": "Deleted", "P": "Portal"}


def primary_role_counts(team: DataFrame) -> DataFrame:
    return filtered_count(team, "fk_study", "pk_studyteam",
                          F.col("fk_codelst_tmrole").isin(PRIMARY_ROLES)
                          & (F.col("studyteam_status") == ACTIVE_MEMBER),
                          "PrimaryRole_CNT").withColumnRenamed("fk_study", "__cnt_study")


def build_study_team(src: SourceSet, run_ts=None) -> DataFrame:
    """M5 ``dm_study_team`` (41 columns)."""
    users, sites, codes = src["er_user"], src["er_site"], src["er_codelst"]
    team = src["er_studyteam"]

    df = watched(exclude_active(team, src["ref_study_exclusions"], "fk_study"))
    df = df.join(primary_role_counts(team), F.col("fk_study") == F.col("__cnt_study"), "left")
    df = lookup(df, src["er_study"], ("fk_study", "pk_study"),
                {"pk_study": "__st_pk", "study_number": "__st_number",
                 "study_otherprinv": "__st_otherpi", "study_title": "__st_title",
                 "study_coordinator": "__st_coord", "study_prinv": "__st_pi"})
    df = lookup_roles(df, users, "pk_user", {
        "__st_coord": {"usr_firstname": "__coord_first", "usr_lastname": "__coord_last"},
        "__st_pi": {"usr_firstname": "__pi_first", "usr_lastname": "__pi_last"},
        "fk_user": {"pk_user": "__u_pk", "fk_siteid": "__u_site", "usr_firstname": "__u_first",
                    "usr_lastname": "__u_last", "usr_stat": "__u_stat", "usr_type": "__u_type",
                    "created_on": "__u_created", "creator": "__u_creator"},
        "creator": {"usr_firstname": "__tc_first", "usr_lastname": "__tc_last"},
        "last_modified_by": {"usr_firstname": "__tm_first", "usr_lastname": "__tm_last"}})
    df = lookup(df, sites, ("__u_site", "pk_site"),
                {"pk_site": "__s_pk", "site_parent": "__s_parent", "site_name": "__s_name",
                 "fk_codelst_type": "__s_type"})
    df = lookup(df, src["er_studysites"], [("fk_study", "fk_study"), ("__s_pk", "fk_site")],
                {"studysite_lsamplesize": "__stsi_lss", "created_on": "__stsi_created",
                 "creator": "__stsi_creator", "last_modified_by": "__stsi_modby",
                 "last_modified_on": "__stsi_modified"})
    # these keys come from the lookups above
    df = lookup_roles(df, users, "pk_user", {
        "__u_creator": {"usr_firstname": "__uc_first", "usr_lastname": "__uc_last"},
        "__stsi_creator": {"usr_firstname": "__stsic_first", "usr_lastname": "__stsic_last"},
        "__stsi_modby": {"usr_firstname": "__stsim_first", "usr_lastname": "__stsim_last"}})
    df = lookup(df, codes, ("__s_type", "pk_codelst"), {"codelst_desc": "__stype"})
    df = lookup(df, sites, ("__s_parent", "pk_site"), {"site_name": "__sparent_name"})
    df = lookup(df, codes, ("fk_codelst_tmrole", "pk_codelst"), {"codelst_desc": "__role"})

    return df.select(
        F.col("pk_studyteam").alias("pkStudyTeam_sttm"),
        F.col("__st_pk").alias("pkStudy_st"),
        F.col("__u_pk").alias("pkUser_sttmUser"),
        F.col("__u_site").alias("fkSiteID_sttmUser"),
        F.col("__s_parent").alias("fkSiteParent_s"),
        F.col("__st_number").alias("studyNumber_st"),
        F.col("__pi_first").alias("piFirst_st_lu"),
        F.col("__pi_last").alias("piLast_st_lu"),
        fn.full_name("__pi_first", "__pi_last").alias("piName_st_lu"),
        F.col("__st_otherpi").alias("piOther_st"),
        F.col("__coord_first").alias("contactFirst_st_lu"),
        F.col("__coord_last").alias("contactLast_st_lu"),
        fn.full_name("__coord_first", "__coord_last").alias("contactName_st_lu"),
        F.col("__st_title").alias("title_st"),
        F.col("__u_first").alias("First_sttm_lu"),
        F.col("__u_last").alias("Last_sttm_lu"),
        fn.full_name("__u_first", "__u_last").alias("Name_sttm_lu"),
        fn.clip("__role", 50).alias("Role_sttm_lu"),
        fn.label(F.col("study_team_usr_type") == "S", "Super User", "Default").alias("UserType_sttm"),
        fn.label(F.col("study_siteflag") == "S", "Specified Organzations",
                 "Access to All Child Organizations").alias("SiteFlag_sttm"),
        fn.clip("studyteam_status", 25).alias("Status_sttm"),
        fn.clip("study_team_rights", 50).alias("Rights_sttm"),
        fn.clip("__stype", 25).alias("siteType_stst_lu"),
        fn.clip("__s_name", 50).alias("Organization_s"),
        fn.to_unsigned("__stsi_lss").alias("sampleSizeLocal_stsi"),
        fn.clip("__sparent_name", 50).alias("OrganizationParent_s"),
        fn.label(F.col("fk_codelst_tmrole").isin(PRIMARY_ROLES), "Y", "N").alias("PrimaryRole_sttm"),
        "PrimaryRole_CNT",
        fn.code_map("__u_stat", ACCOUNT_STATUS, default="").alias("VelosAcctStatus_u"),
        fn.code_map("__u_type", ACCOUNT_TYPE, default="").alias("VelosAcctType_u"),
        F.col("__u_created").alias("createDt_u"),
        fn.full_name("__uc_first", "__uc_last").alias("createByName_u_lu"),
        F.col("__stsi_created").alias("createDt_stsi"),
        fn.full_name("__stsic_first", "__stsic_last").alias("createByName_stsi_lu"),
        F.col("__stsi_modified").alias("modDt_stsi"),
        fn.full_name("__stsim_first", "__stsim_last").alias("modByName_stsi_lu"),
        F.col("created_on").alias("createDt_sttm"),
        fn.full_name("__tc_first", "__tc_last").alias("createByName_sttm_lu"),
        F.col("last_modified_date").alias("modDt_sttm"),
        fn.full_name("__tm_first", "__tm_last").alias("modByName_sttm_lu"),
        fn.run_stamp(run_ts).alias("xDMrunDt"),
    )
