"""Fact tables. Every fact carries the surviving student id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.functions import certified_load, day_diff, pass_flag, passed_load
from tutela.plans.identity import remap

# --- fixed values: alert lifecycle and case source -------------------------
ACTIONED = "Actioned - case opened"
COVERED = "Covered by same-term case"
OPEN = "Open - awaiting triage"
MONITORED = "Monitored - no contact"
EARLY_ALERT = "Early alert"
# ---------------------------------------------------------------------------


def fact_enrolment(clean: DataFrame, survivors: DataFrame) -> DataFrame:
    return remap(clean, survivors).withColumns({
        "passed": pass_flag("grade"),
        "eftsl_certified": certified_load("enrolment_status", "eftsl"),
        "eftsl_passed": passed_load("grade", "eftsl")})


def fact_engagement(activity: DataFrame, students: DataFrame, survivors: DataFrame) -> DataFrame:
    """Weekly activity of known students (duplicate ids are known)."""
    known = activity.join(students.select("student_id"), "student_id", "left_semi")
    return remap(known, survivors)


def fact_case(cases: DataFrame, survivors: DataFrame) -> DataFrame:
    return remap(cases, survivors).withColumn("days_open", day_diff("closed_date", "opened_date"))


def fact_alert(alerts: DataFrame, cases: DataFrame, terms: DataFrame,
               survivors: DataFrame) -> DataFrame:
    """Alerts with what became of them. ``cases`` is the case fact.

    The lowest case id linked to an alert is its follow-up, chosen together
    with its attributes by one aggregate; any early-alert case of the same
    student and term covers the other alerts.
    """
    follow_up = (cases.filter(F.col("linked_alert_id").isNotNull())
                 .groupBy(F.col("linked_alert_id").alias("alert_id"))
                 .agg(F.min_by(F.struct("case_id", "opened_date", "contact_outcome", "status"),
                               "case_id").alias("__case")))
    covered = (cases.filter(F.col("source") == EARLY_ALERT).select("student_id", "term_code")
               .distinct().withColumn("__covered", F.lit(True)))
    current = terms.select("term_code", F.col("is_current").alias("__current"))
    out = (remap(alerts, survivors).join(follow_up, "alert_id", "left")
           .join(covered, ["student_id", "term_code"], "left")
           .join(current, "term_code", "inner"))
    case = F.col("__case")
    return out.select(
        "alert_id", "student_id", "term_code", "week_number", "raised_date", "reason_code",
        case["case_id"].alias("actioned_case_id"),
        case["opened_date"].alias("actioned_date"),
        case["contact_outcome"].alias("contact_outcome"),
        case["status"].alias("case_status"),
        F.when(case["case_id"].isNotNull(), ACTIONED).when(F.col("__covered"), COVERED)
        .when(F.col("__current"), OPEN).otherwise(MONITORED).alias("lifecycle_status"),
        day_diff(case["opened_date"], "raised_date").alias("days_to_action"))


def is_contacted():
    return F.col("lifecycle_status").isin(ACTIONED, COVERED)
