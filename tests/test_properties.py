"""Invariants on the supplied tables."""

import os

import pytest
from pyspark.sql import functions as F

from tutela.catalog.bindings import Bound
from tutela.plans import evaluation, facts

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")


@pytest.fixture(scope="module")
def bound(spark):
    return Bound(spark, FOLDER)


def test_clean_and_quarantine_cover_staging(bound):
    key = ["student_id", "unit_code", "term_code"]
    clean, rejected = bound.clean.select(*key), bound.rejected.select(*key)
    assert clean.join(rejected, key, "left_semi").count() == 0
    together = clean.distinct().union(rejected.distinct()).distinct()
    staged = bound.enrolments.select(*key).distinct()
    assert together.exceptAll(staged).count() == 0 == staged.exceptAll(together).count()


def test_survivors_are_final(bound):
    m = bound.survivors
    chained = m.join(m.select(F.col("duplicate_id").alias("surviving_id")), "surviving_id",
                     "left_semi")
    assert m.count() > 0 and chained.count() == 0
    assert m.select("duplicate_id").distinct().count() == m.count()
    assert bound.dim_student.groupBy("student_id").count().filter("count > 1").count() == 0


def test_every_alert_has_one_lifecycle(bound):
    df = bound.fact_alert
    states = {facts.ACTIONED, facts.COVERED, facts.OPEN, facts.MONITORED}
    assert df.count() == bound.alerts.count() == df.select("alert_id").distinct().count()
    assert {r[0] for r in df.select("lifecycle_status").distinct().collect()} <= states


def test_matched_share_is_a_share(bound):
    r = evaluation.both_estimates(bound.cells).first()
    assert 0 <= r.matched_share <= 1 and r.n_strata >= 0
