"""Decision tables.

Facts are reduced to one row per student and grouping column before they meet
the student dimension. A student with any share of the fact rows then takes
part in the join with a handful of rows, and a distinct student count becomes a
plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions import rounded, safe_ratio, term_year
from tutela.functions.scalars import WITHDRAWN_PRE_CENSUS
from tutela.operators.aggregates import any_of, distinct_text, share, sum_when
from tutela.operators.joins import first_per_item, latest_value, with_flag, with_next
from tutela.operators.sets import label_rows
from tutela.operators.windows import last_weeks, sequence_terms
from tutela.plans.dimensions import NOT_APPLICABLE, cohort_tests
from tutela.plans.facts import is_contacted

# --- fixed values: triage tiers --------------------------------------------
P1 = "P1 - multiple signals, not yet contacted"
P2 = "P2 - single signal, not yet contacted"
P3 = "P3 - support in progress"
P4 = "P4 - resolved / monitoring"
ACTIVE_CASES = ("Open", "In progress")
# ---------------------------------------------------------------------------


def terms_ordered(terms: DataFrame) -> DataFrame:
    return sequence_terms(terms).select("term_code", "term_seq", "is_current")


# ---------------------------------------------------------------- executive --
def exact(c) -> Column:
    """A load or mark in millionths: sums of them do not depend on the order of rows. A number that
    has no place there (not finite, or of more than twelve digits before the point) is NULL."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("decimal(18,6)")


def mart_executive(enrol: DataFrame, students: DataFrame, programs: DataFrame) -> DataFrame:
    """Loads and marks are added as fixed-point numbers, so the same rows give the same table to the
    last bit, however they are partitioned."""
    valid = F.col("mark").between(0, 100)
    per_student = enrol.groupBy("student_id", "term_code", "campus_code").agg(
        F.sum(exact("eftsl_certified")).alias("cert"), F.sum(exact("eftsl_passed")).alias("pass"),
        F.sum(exact(F.when(valid, F.col("mark")))).alias("marks"),
        F.count_if(valid).alias("n_marks"),
        sum_when(F.col("enrolment_status") == WITHDRAWN_PRE_CENSUS).alias("withdrawn"))
    rows = (per_student.join(students.select("student_id", "mode", "program_code"), "student_id")
            .join(programs.select("program_code", "field"), "program_code"))

    def total(c: str) -> Column:
        return F.sum(c).cast("double")

    return rows.groupBy("term_code", "campus_code", "mode", "field").agg(
        F.count("student_id").alias("headcount"),
        rounded(total("cert"), 1).alias("eftsl_certified"),
        rounded(total("pass"), 1).alias("eftsl_passed"),
        rounded(safe_ratio(total("pass"), total("cert")), 4).alias("success_rate"),
        rounded(safe_ratio(total("marks"), F.sum("n_marks")), 1).alias("avg_mark"),
        F.sum("withdrawn").alias("withdrawals_pre_census"))


# ---------------------------------------------------------------- retention --
def presence(enrol: DataFrame) -> DataFrame:
    return enrol.select("student_id", term_year("term_code").alias("year")).distinct()


def retention_flag(students: DataFrame, present: DataFrame, max_year: int) -> DataFrame:
    """Domestic commencers and whether they completed or were there exactly one
    year later."""
    dom = students.filter((F.col("citizenship") == "Domestic")
                          & (F.col("commencing_year") <= max_year))
    came_back = present.select("student_id", (F.col("year") - 1).alias("commencing_year"))
    seen = with_flag(dom, came_back, ["student_id", "commencing_year"], "__back")
    kept = (F.col("student_status") == "completed") | F.col("__back")
    return seen.withColumn("retained_y1", F.when(kept, 1).otherwise(0)).drop("__back")


def retention(flagged: DataFrame) -> DataFrame:
    """Rate per cohort and commencing year; the cohorts overlap."""
    return (label_rows(flagged, cohort_tests(), "cohort")
            .groupBy("cohort", "commencing_year")
            .agg(F.count(F.lit(1)).alias("students"),
                 rounded(F.avg("retained_y1"), 4).alias("retention_rate")))


# ------------------------------------------------------------------ funding --
def nbf(students: DataFrame, rates: DataFrame, cases: DataFrame) -> DataFrame:
    funded = students.filter(F.col("nbf_category") != NOT_APPLICABLE).select(
        "student_id", "commencing_year", "nbf_category")
    helped = with_flag(funded, cases, ["student_id"], "helped")
    # the rate depends on the category alone, so it joins the totals
    totals = helped.groupBy("commencing_year", "nbf_category").agg(
        F.count(F.lit(1)).alias("commencing_students"),
        sum_when(F.col("helped")).alias("students_with_support_case"),
        rounded(share(F.col("helped")), 4).alias("support_coverage"))
    return totals.join(rates, "nbf_category").select(
        "commencing_year", "nbf_category", "indicative_rate", "commencing_students",
        (F.col("commencing_students") * F.col("indicative_rate")).alias("indicative_funding"),
        "students_with_support_case", "support_coverage")


def seheef(cases: DataFrame, students: DataFrame) -> DataFrame:
    """Activity acquittal: cases, students and the share of contacts reached."""
    by = ["year", "seheef_activity", "seheef_life_stage", "case_type"]
    per_student = (cases.withColumn("year", term_year("term_code"))
                   .groupBy("student_id", *by)
                   .agg(F.count(F.lit(1)).alias("n"),
                        sum_when(F.col("contact_outcome").startswith("Reached")).alias("reached")))
    return (per_student.join(students.select("student_id", "nbf_equity_cohort"), "student_id")
            .groupBy(*by, "nbf_equity_cohort")
            .agg(F.sum("n").alias("cases"), F.count(F.lit(1)).alias("students"),
                 rounded(safe_ratio(F.sum("reached"), F.sum("n")), 4).alias("reach_rate")))


# ------------------------------------------------------------------- triage --
def current_alerts(alerts: DataFrame) -> DataFrame:
    """Current-term alerts, one row per student."""
    return alerts.groupBy("student_id").agg(
        F.min("week_number").alias("first_alert_week"),
        F.max("week_number").alias("latest_alert_week"),
        F.count(F.lit(1)).alias("alert_count"),
        distinct_text("reason_code").alias("reasons"),
        any_of(is_contacted()).alias("contacted"),
        F.max("case_status").alias("case_status"),
        F.max("contact_outcome").alias("contact_outcome"))


def recent_activity(activity: DataFrame, weeks: int = 2) -> DataFrame:
    return (last_weeks(activity, "week_number", weeks).groupBy("student_id")
            .agg(F.sum("logins").alias("logins_last2wk"),
                 F.sum("missed").alias("missed_last2wk")))


def priority_tier():
    waiting = F.col("contacted") == 0
    return (F.when(waiting & (F.col("alert_count") >= 2), P1).when(waiting, P2)
            .when(F.col("case_status").isin(*ACTIVE_CASES), P3).otherwise(P4))


def in_current(df: DataFrame, terms: DataFrame) -> DataFrame:
    now = terms.filter("is_current").select("term_code")
    return df.join(now, "term_code", "left_semi")


def triage(alerts: DataFrame, activity: DataFrame, students: DataFrame, programs: DataFrame,
           cases: DataFrame, advisors: DataFrame, terms: DataFrame) -> DataFrame:
    """The current caseload, one row per alerted student still enrolled.

    All inputs are aggregated by student id and joined on it, so they share one
    partitioning. A student keeps the advisor of the latest current case, else
    gets the first advisor covering the home campus.
    """
    now = terms.filter("is_current").select("term_code")
    people = students.filter(F.col("student_status") != "discontinued").join(
        programs.select("program_code", "program_name"), "program_code")
    coverage = first_per_item(advisors, "covered_campuses", "home_campus_code", "advisor_id",
                              "campus_advisor")
    own = latest_value(in_current(cases, terms), "student_id", "advisor_id",
                       ["opened_date", "case_id"], "case_advisor")
    out = (current_alerts(in_current(alerts, terms)).join(people, "student_id")
           .join(recent_activity(in_current(activity, terms)), "student_id", "left")
           .join(own, "student_id", "left")
           .join(coverage, "home_campus_code", "left"))
    return out.select(
        "student_id", "student_name", "program_code", "program_name", "home_campus_code", "mode",
        "attendance_type", "nbf_equity_cohort", "first_nations", "disability",
        (F.col("commencing_term") == now.scalar()).alias("is_commencing"),
        "first_alert_week", "latest_alert_week", "alert_count", "reasons", "contacted",
        "case_status", "contact_outcome",
        F.coalesce("logins_last2wk", F.lit(0)).alias("logins_last2wk"),
        F.coalesce("missed_last2wk", F.lit(0)).alias("missed_last2wk"),
        priority_tier().alias("priority_tier"),
        F.coalesce("case_advisor", "campus_advisor").alias("advisor_id"))


# ------------------------------------------------- effectiveness evaluation --
def alerted_terms(alerts: DataFrame) -> DataFrame:
    """Per student-term the first alert week, the reasons raised in it and
    whether the student was contacted at any time in the term.

    Alerts are added up per week and then reduced by an ordered aggregate, in
    place of a self join.
    """
    key = ["student_id", "term_code"]
    weekly = alerts.groupBy(*key, "week_number").agg(
        F.count(F.lit(1)).alias("n"), any_of(is_contacted()).alias("contacted"))
    return weekly.groupBy(*key).agg(
        F.min("week_number").alias("alert_week"),
        F.min_by("n", "week_number").alias("reasons_at_alert"),
        F.max("contacted").alias("contacted"))


def before_alert(alerted: DataFrame, activity: DataFrame) -> DataFrame:
    """Engagement up to the first alert: logins of that and the week before,
    items missed in earlier weeks."""
    key = ["student_id", "term_code"]
    weekly = activity.groupBy(*key, "week_number").agg(
        F.sum("logins").alias("logins"), F.sum("missed").alias("missed"))
    up_to = weekly.join(alerted.select(*key, "alert_week"), key).filter(
        F.col("week_number") <= F.col("alert_week"))
    return up_to.groupBy(*key).agg(
        F.sum(F.when(F.col("week_number") >= F.col("alert_week") - 1, F.col("logins")))
        .alias("logins_2wk_at_alert"),
        F.sum(F.when(F.col("week_number") < F.col("alert_week"), F.col("missed"))
              .otherwise(F.lit(0))).alias("pre_missed"))


def effect_input(alerts: DataFrame, activity: DataFrame, students: DataFrame, enrol: DataFrame,
                 terms: DataFrame, strict_outcome: bool = False) -> DataFrame:
    """Past alerted student-terms with what was known at the alert and the outcome.

    By default a completed student counts as retained after every term; with
    ``strict_outcome`` only presence in the next term counts.
    """
    order = terms_ordered(terms)
    past = alerts.join(order.filter(~F.col("is_current")).select("term_code"), "term_code",
                       "left_semi")
    alerted = alerted_terms(past)
    known = before_alert(alerted, activity)
    seen = enrol.select("student_id", "term_code").distinct().join(
        order.select("term_code", "term_seq"), "term_code")
    rows = (alerted.join(known, ["student_id", "term_code"], "left")
            .join(order.select("term_code", "term_seq"), "term_code")
            .join(students.select("student_id", "mode", "nbf_equity_cohort", "commencing_term",
                                  "student_status"), "student_id"))
    rows = with_next(rows, seen, "student_id", "term_seq", "__next")
    kept = F.col("__next") if strict_outcome else (
        (F.col("student_status") == "completed") | F.col("__next"))
    return rows.select(
        "student_id", "term_code", "alert_week", "reasons_at_alert", "contacted",
        F.coalesce("logins_2wk_at_alert", F.lit(0)).alias("logins_2wk_at_alert"),
        F.coalesce("pre_missed", F.lit(0)).alias("pre_missed"),
        (F.col("mode") == "Online").alias("online"),
        (F.col("nbf_equity_cohort") == "Yes").alias("nbf_equity"),
        (F.col("commencing_term") == F.col("term_code")).alias("first_term"),
        F.when(kept, 1).otherwise(0).alias("retained_next_term"))


# -------------------------------------------------------------------- trend --
def trend(activity: DataFrame, students: DataFrame) -> DataFrame:
    """Weekly engagement by mode and equity cohort."""
    weekly = activity.groupBy("student_id", "term_code", "week_number").agg(
        F.sum("logins").alias("logins"), F.count("logins").alias("n"),
        F.sum("missed").alias("missed"), F.sum("items_due").alias("due"))
    rows = weekly.join(students.select("student_id", "mode", "nbf_equity_cohort"), "student_id")
    return rows.groupBy("term_code", "week_number", "mode", "nbf_equity_cohort").agg(
        F.count(F.lit(1)).alias("students"),
        rounded(safe_ratio(F.sum("logins"), F.sum("n")), 2).alias("avg_logins"),
        rounded(safe_ratio(F.sum("missed"), F.sum("due")), 4).alias("missed_rate"))
