"""Mart invariants at sf0.001."""

import pytest

from tests.conftest import SMOKE
from trialmart.plans import MartBuild
from trialmart.plans.accrual import PHI_COLUMNS
from trialmart.plans.worklist import register_new_codes
from trialmart.sources import from_testdata

WIDTHS = {"study": 91, "study_current": 70, "patient": 93, "calendar": 57, "study_team": 41,
          "accruals": 71, "enrollments": 87, "statuses": 91, "lab_refs": 10, "worklist": 22}


@pytest.fixture(scope="module")
def marts(spark):
    return MartBuild(from_testdata(spark, SMOKE), run_ts="2024-02-01 06:00:00")


def test_contract_widths(marts):
    for name, width in WIDTHS.items():
        assert len(getattr(marts, name).columns) == width, name


def test_accruals_deidentified_and_not_wider_than_enrollments(marts):
    assert not set(marts.accruals.columns) & set(PHI_COLUMNS)
    assert marts.accruals.count() <= marts.enrollments.count()


def test_enrollment_statuses_are_in_statuses(marts):
    keys = ["pkStudy_st", "pkPatStudyStat_pps"]
    missing = marts.enrollments.select(*keys).subtract(marts.statuses.select(*keys))
    assert missing.count() == 0


def test_new_codes_anti_mode_is_idempotent(spark):
    src = from_testdata(spark, SMOKE, ["mq_labs_90days", "ref_labs_cpts"])
    once = register_new_codes(src["mq_labs_90days"], src["ref_labs_cpts"], mode="anti")
    twice = register_new_codes(src["mq_labs_90days"], once.cache(),
                               mode="anti")
    assert once.count() == twice.count()
    keys = [r[0] for r in once.select("lc_idx").collect()]
    assert len(keys) == len(set(keys))
