"""Declared contracts of the marts M1-M10: the columns consumers read, by name, type and order."""

from __future__ import annotations

from trialmart.contracts import declared

_DDL = {
    "study": """
        pkStudy_st bigint, pkSite_s bigint, pkStudyStat_stst bigint, pkStudySites_stsi bigint,
        pkStudyTeam_sttm bigint, studyNumber_st string, enteredByLast_st_lu string, enteredByFirst_st_lu string,
        piLast_st_lu string, piFirst_st_lu string, piMajorAuthFlag_st string, piOther_st string,
        studyContactLast_st_lu string, studyContactFirst_st_lu string, title_st string, nctNumber_st string,
        primaryPurpose_st_lu string, agentOrDevice_st string, division_st_lu string,
        therapeuticArea_st_lu string, diseaseSiteNames_st_lu string, sampleSizeNational_st bigint,
        sampleSizeStudy_st bigint, duration_st bigint, durationUnit_st string, studyEstBeginDt_st timestamp_ntz,
        phase_st_lu string, researchType_st_lu string, studyScope_st_lu string, studyType_st_lu string,
        studyNumberParent_st_lu string, studyNumberAssoc_st_lu string, blindingOption_st_lu string,
        sponsor_st_lu string, sponsor_st string, sponsorID_st string, sponsorContact_st string, irb_stid string,
        irbOther_stid string, nciTrialId_st string, nciNumber_stid string, allianceOpen_stid string,
        ncorpOpen_stid string, ncorpAccrualType_stid string, programCode_stid string,
        totalStudyTarget_stid bigint, cwg_stid bigint, clinicalWorkingGroup_rcwg string,
        clinicalWorkingGroupSort_rcwg bigint, treatmentLine_stid string, additionalInfo_stid string,
        acuityScore_stid string, clinicalResearchCat_stid_lu string, cpdmCategory_stid_lu string,
        authorLast_st_lu string, authorFirst_st_lu string, studyStartDt_st timestamp_ntz,
        studyEndDt_st timestamp_ntz, organization_stst string, siteType_stst_lu string,
        orgStudyStatus_stst_lu string, documentByLast_stst_lu string, documentByFirst_stst_lu string,
        assignToLast_stst_lu string, assignToFirst_stst_lu string, statusCurrentFlag_stst string,
        statusOrgSpecCurRpt_stst string, statusValidFromDt_stst string, statusEndDt_stst string,
        statusValidUntilDt_stst string, statusMeetingDt_stst string, reviewBoard_stst string,
        outcome_stst_lu string, statusNote_stst string, sampleSizeLocal_stsi bigint, enrolledCount_stsi bigint,
        regCoordPrimLast_sttm_lu string, regCoordPrimFirst_sttm_lu string, createByLast_st_lu string,
        createByFirst_st_lu string, createDt_st string, modByLast_st_lu string, modByFirst_st_lu string,
        modDt_st string, createDt_stst string, createByLast_stst_lu string, createByFirst_stst_lu string,
        modDt_stst string, modByLast_stst_lu string, modByFirst_stst_lu string, xDMrunDt timestamp_ntz""",
    "study_current": """
        pkStudy_st bigint, pkSite_s bigint, pkStudyStat_stst bigint, studyNumber_st string, studyPI_st string,
        studyPIDT4_st string, title_st string, nctNumber_st string, cpdmCategory_stid_lu string,
        primaryPurpose_st_lu string, therapeuticArea_st_lu string, diseaseSiteNames_st_lu string,
        sampleSizeNational_st bigint, duration_st bigint, durationUnit_st string, fundingSource_st string,
        sponsorID_st string, phase_st_lu string, researchType_st_lu string, studyScope_st_lu string,
        studyType_st_lu string, studyTypeName_rst string, studyTypeNameSort_rst bigint, irb_stid string,
        irbOther_stid string, nciNumber_stid string, allianceOpen_stid string, ncorpOpen_stid string,
        ncorpAccrualType_stid string, clinicalResearchCat_stid_lu string, researchCategoryName_rst string,
        researchCategoryNameSort_rst bigint, programCode_stid string, programName_rpc string,
        programNameSort_rpc bigint, totalStudyTarget_stid bigint, cwg_stid bigint,
        clinicalWorkingGroup_rcwg string, clinicalWorkingGroupSort_rcwg bigint, treatmentLine_stid string,
        treatmentLineName_rtl string, treatmentLineNameSort_rtl bigint, additionalInfo_stid string,
        acuityScore_stid string, studyStartDt_st timestamp_ntz, studyEndDt_st timestamp_ntz,
        authorName_st string, createDt_st string, createByName_st string, modDt_st string, modByName_st string,
        organization_stst string, siteType_stst_lu string, orgStudyStatus_stst_lu string,
        statusValidFromDt_stst string, statusValidUntilDt_stst string, sampleSizeLocal_stsi bigint,
        enrolledCount_stsi bigint, createDt_stst string, createByName_stst string, modDt_stst string,
        modByName_stst string, outcome_stst_lu string, statusEndDt_stst string, statusMeetingDt_stst string,
        statusNote_stst string, studyContactFirst_st_lu string, studyContactLast_st_lu string,
        contactName_stst string, xDMrunDt timestamp_ntz""",
    "patient": """
        pkPatProt_pp bigint, pkStudy_st bigint, pkPerson_p bigint, pkSiteRegistered_s bigint,
        pkSiteEnrolled_s bigint, pkSiteFacility_s bigint, pkPatStudyStat_pps bigint, studyNumber_st string,
        patStudyId_pp string, enroll_Dt_pp string, enrollByLast_pp_lu string, enrollByFirst_pp_lu string,
        enrollOrg_pp_lu string, siteType_stst_lu string, enrollmentIsActiveFlag_pp string,
        assignToLast_pp_lu string, assignToFirst_pp_lu string, physicianLast_pp_lu string,
        physicianFirst_pp_lu string, treatmentLoc_pp_lu string, treatmentOrg_pp_lu string,
        diseaseCodeOther_pp_lu string, consentSignedFlag_pp string, consentSignedDt_pp string,
        discontinueDt_pp string, discontinueReason_pp string, startDt_pp string, deathDt_pp string,
        deathStudyRelated_pp_lu string, deathStudyRelatedOther_pp string, createDt_pp string,
        createByLast_pp_lu string, createByFirst_pp_lu string, modDt_pp string, modByLast_pp_lu string,
        modByFirst_pp_lu string, screenNumber_pss string, screenByLast_pss_lu string,
        screenByFirst_pss_lu string, screenOutcome_pss_lu string, status_pss_lu string, statusDt_pss string,
        statusEndDt_pss string, statusIsCurrentFlag_pps string, statusReason_pps_lu string,
        statusNote_pps_lu string, consentVersion_pss string, createDt_pss string, createByLast_pss_lu string,
        createByFirst_pss_lu string, modDt_pss string, modByLast_pss_lu string, modByFirst_pss_lu string,
        facilityID_pf string, accessRight_pf string, facilityIsDefaultFlag_pf string, providerLast_pf string,
        providerFirst_pf string, providerOther_pf string, registerDt_pf string, personCode_p string,
        patLast_p string, patFirst_p string, patMiddle_p string, birthDt_p string, survivalStatus_p_lu string,
        deathDt_p string, deathCause_p_lu string, deathCauseOther_p string, gender_p string, ethnicity_p string,
        ethnicityAdditional_p_lu string, race_p_lu string, raceAdditional_p_lu string, patCity_p string,
        patState_p string, patCounty_p string, patZip_p string, patCountry_p string, registerOrg_p_lu string,
        registerDt_p string, registerByLast_p_lu string, registerByFirst_p_lu string, createDt_p string,
        createByLast_p_lu string, createByFirst_p_lu string, modDt_p string, modByLast_p_lu string,
        modByFirst_p_lu string, diseaseType_pid_lu string, xDMrunDt timestamp_ntz, patAddress1_p string,
        patAddress2_p string""",
    "calendar": """
        pkEventID_ea bigint, pkStudyID_st bigint, pkProtStat_sps bigint, pkEventID_se1 bigint,
        pkEventStat_ses bigint, studyNumber_st string, studyTitle_st string, eventTypeDefined_ea string,
        scheduleName_ea string, scheduleDesc_ea string, protStatDT_sps timestamp_ntz,
        calStatSubtype_sps_lu string, calStatDesc_sps_lu string, protStatNote_sps string, statusDesc_se1 string,
        eventDesc_se1 string, eventSequence_se1 bigint, startDT_se1 timestamp_ntz, endDT_se1 timestamp_ntz,
        eventExeDT_se1 timestamp_ntz, actualSchDT_se1 timestamp_ntz, EventCoverageSubtype_se1_lu string,
        EventCoverageDesc_se1_lu string, pkPerson_p bigint, personCode_p string, patFirst_p string,
        patMiddle_p string, patLast_p string, birthDt_p timestamp_ntz, eventStatEndDT_ses timestamp_ntz,
        eventStatSubtype_ses_lu string, eventStatDesc_ses_lu string, createDt_ea timestamp_ntz,
        createByFName_ea string, createByLName_ea string, modDt_ea timestamp_ntz, modByFName_ea string,
        modByLName_ea string, createDt_se1 timestamp_ntz, createByFName_se1 string, createByLName_se1 string,
        modDt_se1 timestamp_ntz, modByFName_se1 string, modByLName_se1 string, createDt_ses timestamp_ntz,
        createByFName_ses string, createByLName_ses string, modDt_ses timestamp_ntz, modByFName_ses string,
        modByLName_ses string, createDt_sps timestamp_ntz, createByFName_sps string, createByLName_sps string,
        modDt_sps timestamp_ntz, modByFName_sps string, modByLName_sps string, xDMrunDt timestamp_ntz""",
    "study_team": """
        pkStudyTeam_sttm bigint, pkStudy_st bigint, pkUser_sttmUser bigint, fkSiteID_sttmUser bigint,
        fkSiteParent_s bigint, studyNumber_st string, piFirst_st_lu string, piLast_st_lu string,
        piName_st_lu string, piOther_st string, contactFirst_st_lu string, contactLast_st_lu string,
        contactName_st_lu string, title_st string, First_sttm_lu string, Last_sttm_lu string,
        Name_sttm_lu string, Role_sttm_lu string, UserType_sttm string, SiteFlag_sttm string,
        Status_sttm string, Rights_sttm string, siteType_stst_lu string, Organization_s string,
        sampleSizeLocal_stsi bigint, OrganizationParent_s string, PrimaryRole_sttm string,
        PrimaryRole_CNT bigint, VelosAcctStatus_u string, VelosAcctType_u string, createDt_u timestamp_ntz,
        createByName_u_lu string, createDt_stsi timestamp_ntz, createByName_stsi_lu string,
        modDt_stsi timestamp_ntz, modByName_stsi_lu string, createDt_sttm timestamp_ntz,
        createByName_sttm_lu string, modDt_sttm timestamp_ntz, modByName_sttm_lu string, xDMrunDt timestamp_ntz""",
    "accruals": """
        pkStudy_st bigint, studyNumber_st string, title_st string, studyPI_st string, studyPIDT4_st string,
        primaryPurpose_st_lu string, diseaseSiteNames_st_lu string, therapeuticArea_st_lu string,
        phase_st_lu string, researchType_st_lu string, studyType_st_lu string, studyTypeName_rst string,
        studyTypeNameSort_rst bigint, cpdmCategory_stid_lu string, sampleSizeNational_st bigint,
        totalStudyTarget_stid bigint, ncorpOpen_stid string, ncorpAccrualType_stid string,
        pkPatStudyStat_pps bigint, pkSiteFacility_s bigint, siteType_stst_lu string, registerOrg_p_lu string,
        enrollOrg_pp_lu string, treatmentOrg_pp_lu string, enroll_Dt_pp string, enrollByName_pp string,
        assignToName_pp string, physicianName_pp string, pkSite_s bigint, organization_stst string,
        orgStudyStatus_stst_lu string, statusValidFromDt_stst string, statusValidUntilDt_stst string,
        sampleSizeLocal_stsi bigint, enrolledCount_stsi bigint, patStudyId_pp string, status_pss_lu string,
        statusDt_pss string, clinicalResearchCat_stid_lu string, researchCategoryName_rst string,
        researchCategoryNameSort_rst bigint, programCode_stid string, programName_rpc string,
        programNameSort_rpc bigint, cwg_stid bigint, clinicalWorkingGroup_rcwg string,
        clinicalWorkingGroupSort_rcwg bigint, treatmentLine_stid string, treatmentLineName_rtl string,
        treatmentLineNameSort_rtl bigint, createDt_st string, createByName_st string, modDt_st string,
        modByName_st string, createDt_stst string, createByName_stst string, modDt_stst string,
        modByName_stst string, createDt_pp string, createByName_pp string, modDt_pp string, modByName_pp string,
        createDt_pss string, createByName_pss string, modDt_pss string, modByName_pss string, createDt_p string,
        createByName_p string, modDt_p string, modByName_p string, xDMrunDt timestamp_ntz""",
    "enrollments": """
        pkStudy_st bigint, studyNumber_st string, title_st string, studyPI_st string, studyPIDT4_st string,
        primaryPurpose_st_lu string, diseaseSiteNames_st_lu string, therapeuticArea_st_lu string,
        phase_st_lu string, researchType_st_lu string, studyType_st_lu string, studyTypeName_rst string,
        studyTypeNameSort_rst bigint, cpdmCategory_stid_lu string, sampleSizeNational_st bigint,
        totalStudyTarget_stid bigint, ncorpOpen_stid string, ncorpAccrualType_stid string,
        pkPatStudyStat_pps bigint, pkSiteFacility_s bigint, siteType_stst_lu string, registerOrg_p_lu string,
        enrollOrg_pp_lu string, treatmentOrg_pp_lu string, enroll_Dt_pp string, enrollByName_pp string,
        assignToName_pp string, physicianName_pp string, pkSite_s bigint, organization_stst string,
        orgStudyStatus_stst_lu string, statusValidFromDt_stst string, statusValidUntilDt_stst string,
        sampleSizeLocal_stsi bigint, enrolledCount_stsi bigint, patStudyId_pp string, patName_p string,
        personCode_p string, birthDt_p string, race_p_lu string, raceAdditional_p_lu string, ethnicity_p string,
        ethnicityAdditional_p_lu string, gender_p string, status_pss_lu string, statusDt_pss string,
        survivalStatus_p_lu string, statusReason_pps_lu string, statusNote_pps_lu string,
        screenOutcome_pss_lu string, patZip_p string, registerDt_pf string, diseaseType_pid_lu string,
        diseaseCodeOther_pp_lu string, clinicalResearchCat_stid_lu string, researchCategoryName_rst string,
        researchCategoryNameSort_rst bigint, programCode_stid string, programName_rpc string,
        programNameSort_rpc bigint, cwg_stid bigint, clinicalWorkingGroup_rcwg string,
        clinicalWorkingGroupSort_rcwg bigint, treatmentLine_stid string, treatmentLineName_rtl string,
        treatmentLineNameSort_rtl bigint, createDt_st string, createByName_st string, modDt_st string,
        modByName_st string, createDt_stst string, createByName_stst string, modDt_stst string,
        modByName_stst string, createDt_pp string, createByName_pp string, modDt_pp string, modByName_pp string,
        createDt_pss string, createByName_pss string, modDt_pss string, modByName_pss string, createDt_p string,
        createByName_p string, modDt_p string, modByName_p string, xDMrunDt timestamp_ntz""",
    "statuses": """
        pkStudy_st bigint, studyNumber_st string, title_st string, studyPI_st string, studyPIDT4_st string,
        primaryPurpose_st_lu string, diseaseSiteNames_st_lu string, therapeuticArea_st_lu string,
        phase_st_lu string, researchType_st_lu string, studyType_st_lu string, studyTypeName_rst string,
        studyTypeNameSort_rst bigint, cpdmCategory_stid_lu string, sampleSizeNational_st bigint,
        totalStudyTarget_stid bigint, ncorpOpen_stid string, ncorpAccrualType_stid string, pkPatProt_pp bigint,
        pkPatStudyStat_pps bigint, pkSiteFacility_s bigint, siteType_stst_lu string, registerOrg_p_lu string,
        enrollOrg_pp_lu string, treatmentOrg_pp_lu string, treatmentLoc_pp_lu string, enroll_Dt_pp string,
        enrollByName_pp string, assignToName_pp string, physicianName_pp string, pkSite_s bigint,
        organization_stst string, orgStudyStatus_stst_lu string, statusValidFromDt_stst string,
        statusValidUntilDt_stst string, sampleSizeLocal_stsi bigint, enrolledCount_stsi bigint,
        patStudyId_pp string, patName_p string, personCode_p string, birthDt_p string, race_p_lu string,
        raceAdditional_p_lu string, ethnicity_p string, ethnicityAdditional_p_lu string, gender_p string,
        status_pss_lu string, statusDt_pss string, statusEndDt_pss string, statusIsCurrentFlag_pps string,
        survivalStatus_p_lu string, statusReason_pps_lu string, statusNote_pps_lu string,
        screenOutcome_pss_lu string, patZip_p string, registerDt_pf string, diseaseType_pid_lu string,
        diseaseCodeOther_pp_lu string, clinicalResearchCat_stid_lu string, researchCategoryName_rst string,
        researchCategoryNameSort_rst bigint, programCode_stid string, programName_rpc string,
        programNameSort_rpc bigint, cwg_stid bigint, clinicalWorkingGroup_rcwg string,
        clinicalWorkingGroupSort_rcwg bigint, treatmentLine_stid string, treatmentLineName_rtl string,
        treatmentLineNameSort_rtl bigint, createDt_st string, createByName_st string, modDt_st string,
        modByName_st string, createDt_stst string, createByName_stst string, modDt_stst string,
        modByName_stst string, createDt_pp string, createByName_pp string, modDt_pp string, modByName_pp string,
        createDt_pss string, createByName_pss string, modDt_pss string, modByName_pss string, createDt_p string,
        createByName_p string, modDt_p string, modByName_p string, xDMrunDt timestamp_ntz""",
    "lab_refs": """
        lc_idx bigint, labdesc string, labname_mq string, cpt string, cpt_additional string,
        labname_tricore string, map_status string, comments string, createDtTm timestamp_ntz,
        modDtTm timestamp_ntz""",
    "worklist": """
        studyNumber_st string, studyTitle_st string, patStudyId_pp string, patName_p string,
        PatientName_mq string, MRN_mq string, ApptDate_mq timestamp_ntz, Activity_mq string, Provider_mq string,
        Location_mq string, DrugName_mq string, LabName_mq string, LabCode_mq string, LabNotes_mq string,
        CycleInfo_mq string, Source_mq string, cpt string, cpt_additional string, labname_tricore string,
        map_status string, scheduleName_ea string, xDMrunDt timestamp_ntz""",
}

MART_SCHEMAS = {name: declared(ddl) for name, ddl in _DDL.items()}
