"""Diagnostic shares to compare with published sector figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.functions import clip, safe_ratio, term_year
from tutela.operators.aggregates import any_of, sum_when, value_share
from tutela.operators.joins import merge_suffixed
from tutela.operators.sets import label_rows, stack
from tutela.plans.dimensions import cohort_tests
from tutela.plans.facts import is_contacted

# --- fixed values ----------------------------------------------------------
GRADED = ("HD", "DI", "CR", "PA", "NN")
PLAN_AGREED = "Reached - support plan agreed"
# ---------------------------------------------------------------------------


def years_present(enrol: DataFrame) -> DataFrame:
    """First and last year each student is enrolled in."""
    year = term_year("term_code")
    return enrol.groupBy("student_id").agg(F.min(year).alias("first_year"),
                                           F.max(year).alias("last_year"))


def any_later_retention(students: DataFrame, enrol: DataFrame, max_year: int) -> DataFrame:
    """Retention counted as presence in any later year, by eight groups.

    Looser than the mart, which asks for exactly the next year.
    """
    tests = {**cohort_tests(), "On-campus": F.col("mode") == "On-campus"}
    dom = students.filter((F.col("citizenship") == "Domestic")
                          & (F.col("commencing_year") <= max_year))
    rows = merge_suffixed(dom, years_present(enrol), ["student_id"], "left", "_e")
    back = F.coalesce((F.col("last_year") > F.col("commencing_year")), F.lit(False)) \
        | (F.col("student_status") == "completed")
    return (label_rows(rows.withColumn("__back", back), tests, "cohort").groupBy("cohort")
            .agg(F.count(F.lit(1)).alias("students"), sum_when(F.col("__back")).alias("retained"))
            .withColumn("retention", F.round(safe_ratio("retained", "students"), 4)))


def grade_shares(enrol: DataFrame) -> DataFrame:
    graded = enrol.filter(F.col("grade").isin(*GRADED))
    return value_share(graded, "grade").withColumn("share", F.round("share", 3))


def mark_summary(enrol: DataFrame) -> DataFrame:
    """Mean of the clamped marks of graded units, and counts of withdrawals."""
    graded = F.col("grade").isin(*GRADED)
    mark = F.when(graded, clip("mark", 0.0, 100.0))
    return enrol.agg(
        F.round(safe_ratio(F.sum(mark), F.count(mark)), 1).alias("mean_mark"),
        F.count_if(F.col("grade") == "WW").alias("withdrawn_pre"),
        F.count_if(F.col("grade") == "WN").alias("withdrawn_post"),
        F.count_if(graded).alias("graded"))


def student_term_outreach(activity: DataFrame, alerts: DataFrame, cases: DataFrame) -> DataFrame:
    """Per student-term: alerted, contacted, reached, support plan agreed."""
    key = ["student_id", "term_code"]
    told = alerts.groupBy(*key).agg(any_of(is_contacted()).alias("contacted"))
    talked = cases.filter(F.col("source") == "Early alert").groupBy(*key).agg(
        any_of(F.col("contact_outcome").startswith("Reached")).alias("reached"),
        any_of(F.col("contact_outcome") == PLAN_AGREED).alias("effect"))
    return (activity.select(*key).distinct()
            .join(told.withColumn("alerted", F.lit(1)), key, "left").join(talked, key, "left")
            .fillna(0, ["alerted", "contacted", "reached", "effect"]))


def outreach_shares(per_term: DataFrame) -> DataFrame:
    alerted = F.col("alerted") == 1
    of_alerted = {c: F.round(F.avg(F.when(alerted, F.col(c))), 4).alias(c)
                  for c in ("contacted", "reached", "effect")}
    return per_term.agg(F.count(F.lit(1)).alias("student_terms"),
                        F.round(F.avg("alerted"), 4).alias("alerted"), *of_alerted.values())


def discontinued_by_contact(per_term: DataFrame, students: DataFrame) -> DataFrame:
    rows = per_term.filter(F.col("alerted") == 1).join(
        students.select("student_id", "student_status"), "student_id")
    gone = F.col("student_status") == "discontinued"
    return rows.groupBy("contacted").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(safe_ratio(sum_when(gone), F.count(F.lit(1))), 4).alias("discontinued"))


def realism(students: DataFrame, enrol: DataFrame, activity: DataFrame, alerts: DataFrame,
            cases: DataFrame, max_year: int) -> DataFrame:
    """All figures as (section, label, value)."""
    def tidy(df, section, label, value):
        return df.select(F.lit(section).alias("section"), label.cast("string").alias("label"),
                         value.cast("double").alias("value"))

    terms = student_term_outreach(activity, alerts, cases)
    marks, shares = mark_summary(enrol), outreach_shares(terms)
    out = [tidy(any_later_retention(students, enrol, max_year), "retention",
                F.col("cohort"), F.col("retention")),
           tidy(grade_shares(enrol), "grade", F.col("grade"), F.col("share")),
           tidy(discontinued_by_contact(terms, students), "discontinued",
                F.when(F.col("contacted") == 1, "contacted").otherwise("not contacted"),
                F.col("discontinued"))]
    for section, df in (("marks", marks), ("outreach", shares)):
        listed = F.inline(F.array(*[F.struct(F.lit(c).alias("label"),
                                             F.col(c).cast("double").alias("value"))
                                    for c in df.columns]))
        out.append(df.select(listed).select(F.lit(section).alias("section"), "label", "value"))
    return stack(out)
