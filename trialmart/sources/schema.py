"""Declared schemas of the source tables (FIXTURES.md section 1) and their unique keys."""

from __future__ import annotations

from trialmart.contracts import declared

_DDL = {
    "er_codelst": """
        pk_codelst bigint, codelst_desc string""",
    "sch_codelst": """
        pk_codelst bigint, codelst_subtyp string, codelst_desc string""",
    "er_site": """
        pk_site bigint, site_name string, fk_codelst_type bigint, site_parent bigint""",
    "er_user": """
        pk_user bigint, usr_firstname string, usr_lastname string, usr_stat string, usr_type string,
        fk_siteid bigint, creator bigint, created_on timestamp_ntz""",
    "er_study": """
        pk_study bigint, study_number string, study_title string, nct_number string, study_maj_auth string,
        study_otherprinv string, study_prodname string, study_nsamplsize bigint, study_samplsize bigint,
        study_dur bigint, study_durunit string, study_estbegindt timestamp_ntz, study_assoc string,
        study_parentid bigint, study_sponsor string, study_sponsorid string, study_contact string,
        nci_trial_identifier string, study_actualdt timestamp_ntz, study_end_date timestamp_ntz,
        study_coordinator bigint, study_prinv bigint, fk_author bigint, creator bigint, last_modified_by bigint,
        created_on timestamp_ntz, last_modified_date timestamp_ntz, fk_codelst_sponsor bigint,
        fk_codelst_phase bigint, fk_codelst_restype bigint, fk_codelst_scope bigint, fk_codelst_type bigint,
        fk_codelst_purpose bigint, fk_codelst_tarea bigint, fk_codelst_blind bigint, study_division bigint""",
    "er_studystat": """
        pk_studystat bigint, fk_study bigint, fk_site bigint, status_type bigint, fk_codelst_studystat bigint,
        outcome bigint, fk_codelst_revboard bigint, current_stat bigint, studystat_hspn bigint,
        studystat_date timestamp_ntz, studystat_endt timestamp_ntz, studystat_validt timestamp_ntz,
        studystat_meetdt timestamp_ntz, studystat_note string, fk_user_docby bigint,
        studystat_assignedto bigint, creator bigint, last_modified_by bigint, created_on timestamp_ntz,
        last_modified_date timestamp_ntz""",
    "er_studysites": """
        pk_studysites bigint, fk_study bigint, fk_site bigint, studysite_lsamplesize string,
        studysite_enrcount string, creator bigint, last_modified_by bigint, created_on timestamp_ntz,
        last_modified_on timestamp_ntz""",
    "er_studyteam": """
        pk_studyteam bigint, fk_study bigint, fk_user bigint, fk_codelst_tmrole bigint,
        study_team_usr_type string, studyteam_status string, study_siteflag string, study_team_rights string,
        creator bigint, last_modified_by bigint, created_on timestamp_ntz, last_modified_date timestamp_ntz""",
    "er_studyid": """
        fk_study bigint, fk_codelst_idtype bigint, studyid_id string""",
    "er_studydiseasesite": """
        pkstudydiseasesite bigint, fk_study bigint, study_disease_site bigint""",
    "person": """
        pk_person bigint, fk_site bigint, person_code string, person_lname string, person_fname string,
        person_mname string, person_dob timestamp_ntz, person_deathdt timestamp_ntz,
        cause_of_death_other string, person_add_ethnicity string, person_city string, person_state string,
        person_county string, person_zip string, person_country string, person_address1 string,
        person_address2 string, person_regdate timestamp_ntz, person_regby bigint, fk_codelst_pstat bigint,
        fk_codelst_pat_dth_cause bigint, fk_codelst_gender bigint, fk_codelst_ethnicity bigint,
        fk_codelst_race bigint, creator bigint, last_modified_by bigint, created_on timestamp_ntz,
        last_modified_date timestamp_ntz""",
    "er_person_add_race": """
        pkpersonaddrace bigint, fk_person bigint, person_add_race string""",
    "pat_perid": """
        fk_per bigint, fk_codelst_idtype bigint, perid_id string""",
    "er_patprot": """
        pk_patprot bigint, fk_per bigint, fk_study bigint, fk_site_enrolling bigint, patprot_stat bigint,
        patprot_patstdid string, patprot_enroldt timestamp_ntz, patprot_consign bigint,
        patprot_consigndt timestamp_ntz, patprot_discdt timestamp_ntz, patprot_reason string,
        patprot_start timestamp_ntz, date_of_death timestamp_ntz, death_std_rltd_other string, fk_user bigint,
        fk_userassto bigint, patprot_physician bigint, fk_codelstloc bigint, patprot_treatingorg bigint,
        fk_codelst_ptst_dth_stdrel bigint, patprot_othr_dis_code bigint, creator bigint,
        last_modified_by bigint, created_on timestamp_ntz, last_modified_date timestamp_ntz""",
    "er_patstudystat": """
        pk_patstudystat bigint, fk_per bigint, fk_study bigint, fk_codelst_stat bigint, current_stat bigint,
        patstudystat_date timestamp_ntz, patstudystat_endt timestamp_ntz, patstudystat_reason bigint,
        patstudystat_note string, inform_consent_ver string, screen_number string, screened_by bigint,
        screening_outcome bigint, creator bigint, last_modified_by bigint, created_on timestamp_ntz,
        last_modified_date timestamp_ntz""",
    "er_patfacility": """
        fk_per bigint, fk_site bigint, pat_facilityid string, pat_accessright bigint,
        patfacility_default bigint, patfacility_provider bigint, patfacility_otherprovider string,
        patfacility_regdate timestamp_ntz""",
    "event_assoc": """
        event_id bigint, chain_id bigint, event_type string, name string, description string, creator bigint,
        last_modified_by bigint, created_on timestamp_ntz, last_modified_date timestamp_ntz""",
    "sch_protstat": """
        pk_protstat bigint, fk_event bigint, fk_codelst_calstat bigint, protstat_dt timestamp_ntz,
        protstat_note string, creator bigint, last_modified_by bigint, created_on timestamp_ntz,
        last_modified_date timestamp_ntz""",
    "sch_events1": """
        event_id bigint, session_id bigint, patient_id bigint, status bigint, description string,
        event_sequence bigint, start_date_time timestamp_ntz, end_date_time timestamp_ntz,
        event_exeon timestamp_ntz, actual_schdate timestamp_ntz, fk_codelst_covertype bigint, creator bigint,
        last_modified_by bigint, created_on timestamp_ntz, last_modified_date timestamp_ntz""",
    "sch_eventstat": """
        pk_eventstat bigint, fk_event bigint, eventstat bigint, eventstat_enddt timestamp_ntz, creator bigint,
        last_modified_by bigint, created_on timestamp_ntz, last_modified_date timestamp_ntz""",
    "mq_appointments": """
        patient_name string, mrn string, app_dttm timestamp_ntz, activity_desc string, provider_initials string,
        location string""",
    "mq_chemos": """
        patient_name string, mrn string, app_dttm timestamp_ntz, provider string, drug_name string,
        cycle_number bigint, cycle_day bigint, dlyd bigint""",
    "mq_labs": """
        patient_name string, mrn string, app_dttm timestamp_ntz, provider string, lab_name string,
        lab_code string, condition_notes string""",
    "mq_labs_90days": """
        patient_name string, mrn string, app_dttm timestamp_ntz, provider string, lab_name string,
        lab_code string, condition_notes string""",
    "ref_labs_cpts": """
        lc_idx bigint, labdesc string, labname_mq string, cpt string, cpt_additional string,
        labname_tricore string, map_status string, comments string, createdttm timestamp_ntz,
        moddttm timestamp_ntz""",
    "ref_program_code": """
        value string, description string, report_sort bigint""",
    "ref_research_category": """
        value string, description string, report_sort bigint""",
    "ref_study_type": """
        value string, description string, report_sort bigint""",
    "ref_treatment_line": """
        value string, description string, report_sort bigint""",
    "ref_clinical_working_group": """
        value string, description string, report_sort string""",
    "ref_disease_site": """
        value string, description string""",
    "ref_study_exclusions": """
        pk_study bigint, is_active string""",
}

SOURCE_SCHEMAS = {name: declared(ddl) for name, ddl in _DDL.items()}

#: Dimensions that the marts join as if their key were unique; checked before a nightly run.
UNIQUE_KEYS = {
    "er_codelst": ["pk_codelst"], "sch_codelst": ["pk_codelst"], "er_site": ["pk_site"], "er_user": ["pk_user"],
    "er_study": ["pk_study"], "person": ["pk_person"],
}
