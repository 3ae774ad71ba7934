"""Are alerting and outreach even-handed across equity cohorts?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutela.operators.sets import label_rows
from tutela.plans.dimensions import cohort_tests
from tutela.sources import lookup

# --- fixed values ----------------------------------------------------------
BASE = "Non-equity"
ALL = "All domestic"
GAP_LIMIT_PP = 3.0
# ---------------------------------------------------------------------------


def fairness(enrol: DataFrame, students: DataFrame, rows: DataFrame, terms: DataFrame,
             base: str = BASE) -> DataFrame:
    """One row per cohort, also for empty ones.

    Student-terms and alerted student-terms are unique per student and term
    before they meet the students; the cohorts are labelled in the same pass.
    Ratios to a base without alerts are NULL.
    """
    past = terms.filter(~F.col("is_current")).select("term_code")
    cohorts = cohort_tests()
    dom = students.filter(F.col("citizenship") == "Domestic").select(
        "student_id", "mode", "low_ses", "first_nations", "disability", "regional_remote")
    enrolled = enrol.join(past, "term_code", "left_semi").select("student_id", "term_code") \
        .distinct().join(dom, "student_id")
    alerted = rows.select("student_id", "contacted", "retained_next_term").join(dom, "student_id")
    size = label_rows(enrolled, cohorts, "cohort").groupBy("cohort").agg(
        F.count(F.lit(1)).alias("student_terms"))
    arm = F.col("contacted")
    outcome = F.col("retained_next_term")
    alerts = label_rows(alerted, cohorts, "cohort").groupBy("cohort").agg(
        F.count(F.lit(1)).alias("alerted_n"), F.bround(F.avg(arm), 4).alias("contact_rate_given_alert"),
        F.bround(F.avg(F.when(arm == 1, outcome)), 4).alias("retained_next_term_contacted"),
        F.bround(F.avg(F.when(arm == 0, outcome)), 4).alias("retained_next_term_uncontacted"))
    names = lookup(students.sparkSession, [(c,) for c in cohorts], "cohort string")
    table = (names.join(size, "cohort", "left").join(alerts, "cohort", "left")
             .fillna(0, ["student_terms", "alerted_n"])
             .withColumn("alert_rate", F.bround(
                 F.col("alerted_n") / F.greatest("student_terms", F.lit(1)), 4)))
    # the table has one row per cohort name, so one task can compare them all
    everyone = Window.partitionBy()

    def base_value(col: str):
        return F.max(F.when(F.col("cohort") == base, F.col(col))).over(everyone)

    base_rate, base_contact = base_value("alert_rate"), base_value("contact_rate_given_alert")
    return table.select(
        "cohort", "student_terms", "alert_rate", "contact_rate_given_alert",
        "retained_next_term_contacted", "retained_next_term_uncontacted", "alerted_n",
        F.bround(F.try_divide(F.col("alert_rate"), base_rate), 2)
        .alias("alert_rate_ratio_vs_nonequity"),
        F.bround((F.col("contact_rate_given_alert") - base_contact) * 100, 1)
        .alias("contact_rate_gap_pp_vs_nonequity"))


def fair_verdict(audit: DataFrame, limit_pp: float = GAP_LIMIT_PP) -> DataFrame:
    """PASS while no cohort's contact rate is further than the limit from the base."""
    worst = audit.filter(F.col("cohort") != ALL).agg(
        F.max(F.abs("contact_rate_gap_pp_vs_nonequity")).alias("max_gap_pp"))
    return worst.withColumn("verdict", F.when(F.col("max_gap_pp") <= limit_pp, "PASS")
                            .otherwise("REVIEW REQUIRED"))
