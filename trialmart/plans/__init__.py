"""Mart builders M1-M10 and a lazy, dependency-ordered build of all of them.

``MartBuild`` composes the marts as one family of lazy plans.  For a
scheduled run use ``trialmart.sinks.run_nightly``, which publishes each mart
and re-reads it from storage before dependants use it (the source system
materialises its marts the same way); that also cuts lineage so a lost
executor only recomputes the current mart.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.operators import heavy_keys
from trialmart.plans.accrual import build_accruals, build_enrollments, build_statuses
from trialmart.plans.calendar import build_calendar
from trialmart.plans.patient import build_patient
from trialmart.plans.study import build_study, build_study_current
from trialmart.plans.team import build_study_team
from trialmart.plans.worklist import (build_worklist, current_calendar_names, emr_activity,
                                      industrial_patients, register_new_codes)
from trialmart.session import materialised
from trialmart.sources import SourceSet

__all__ = [
    "MartBuild", "build_study", "build_study_current", "build_patient", "build_calendar",
    "build_study_team", "build_accruals", "build_enrollments", "build_statuses",
    "register_new_codes", "build_worklist",
]


class MartBuild:
    """All marts over one ``SourceSet`` with one run stamp."""

    def __init__(self, src: SourceSet, run_ts: _dt.datetime | str | None = None,
                 lab_code_mode: str = "faithful", collation: str | None = None):
        if run_ts is None:
            run_ts = _dt.datetime.now().replace(microsecond=0)
        self.src = src
        self.run_ts = run_ts
        self.lab_code_mode = lab_code_mode
        self.collation = collation

    @cached_property
    def study(self) -> DataFrame:
        return build_study(self.src, self.run_ts)

    @cached_property
    def study_current(self) -> DataFrame:
        return build_study_current(self.study, self.src, self.run_ts)

    @cached_property
    def patient(self) -> DataFrame:
        return build_patient(self.src, self.run_ts)

    @cached_property
    def calendar(self) -> DataFrame:
        return build_calendar(self.src, self.run_ts)

    @cached_property
    def study_team(self) -> DataFrame:
        return build_study_team(self.src, self.run_ts)

    @cached_property
    def heavy_studies(self) -> DataFrame:
        """Studies with a large share of the protocols and patient status records that M3 joins."""
        studies = [self.src[t].select(F.col("fk_study").alias("pkStudy_st")) for t in ("er_patprot", "er_patstudystat")]
        return heavy_keys(studies[0].union(studies[1]), "pkStudy_st")

    @cached_property
    def accruals(self) -> DataFrame:
        return build_accruals(self.study_current, self.patient, self.run_ts, heavy=self.heavy_studies)

    @cached_property
    def enrollments(self) -> DataFrame:
        return build_enrollments(self.study_current, self.patient, self.run_ts, heavy=self.heavy_studies)

    @cached_property
    def statuses(self) -> DataFrame:
        return build_statuses(self.study_current, self.patient, self.run_ts, heavy=self.heavy_studies)

    @cached_property
    def lab_refs(self) -> DataFrame:
        return register_new_codes(self.src["mq_labs_90days"], self.src["ref_labs_cpts"],
                                  self.run_ts, self.lab_code_mode, self.collation)

    @cached_property
    def worklist(self) -> DataFrame:
        patients = industrial_patients(self.study_current, self.patient, self.collation, keep=materialised)
        names = materialised(current_calendar_names(self.calendar, self.collation))
        activity = emr_activity(self.src["mq_appointments"], self.src["mq_chemos"],
                                self.src["mq_labs"], patients, self.collation)
        return build_worklist(activity, patients, self.lab_refs, names, self.run_ts, self.collation)

    MARTS = ["study", "study_current", "patient", "calendar", "study_team", "accruals",
             "enrollments", "statuses", "lab_refs", "worklist"]
