"""The report visuals as queries over the metric registry.

Page names follow the five report pages; each visual is a category by series
table of measures, a card (one row) or a list of mart columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.functions.scalars import tier_colour
from tutela.operators.aggregates import pivot_sum
from tutela.operators.filters import page_filter
from tutela.operators.ranking import report_order
from tutela.plans.metrics import Model, mean_of, sum_of

FUNDED_YEAR = 2026  # fixed value: the funded commencing cohort
NBF = "mart_nbf_funding"


def nbf_page(year: int = FUNDED_YEAR) -> dict[str, list[int]]:
    return {f"{NBF}.commencing_year": [year]}


# ---------------------------------------------------------------- executive --
def exec_cards(m: Model) -> DataFrame:
    return m.evaluate(["headcount", "success_rate", "eftsl_certified", "average_mark",
                       "pre_census_withdrawals"])


def success_term_mode(m: Model) -> DataFrame:
    return m.evaluate(["success_rate"], by=["dim_term.term_code", "dim_student.mode"])


def success_campus(m: Model) -> DataFrame:
    return report_order(m.evaluate(["success_rate"], by=["dim_campus.campus_name"]),
                        "-success_rate", "campus_name")


def program_matrix(m: Model) -> DataFrame:
    return m.evaluate(["headcount", "success_rate", "average_mark", "pre_census_withdrawals"],
                      by=["dim_program.field", "dim_program.program_name"], levels=True)


# ------------------------------------------------------------------- equity --
def equity_cards(m: Model, year: int = FUNDED_YEAR) -> DataFrame:
    return m.evaluate(["nbf_indicative_funding", "nbf_commencing_students",
                       "nbf_support_coverage", "cases_opened"], where=nbf_page(year))


def retention_cohort(m: Model) -> DataFrame:
    return m.evaluate(["retention_rate"], by=["mart_retention_cohort.cohort"])


def retention_trend(m: Model) -> DataFrame:
    return m.evaluate(["retention_rate"], by=["mart_retention_cohort.commencing_year",
                                              "mart_retention_cohort.cohort"])


def nbf_table(m: Model, year: int = FUNDED_YEAR) -> DataFrame:
    return m.evaluate(
        [("commencing_students", sum_of(f"{NBF}.commencing_students")),
         ("indicative_funding", sum_of(f"{NBF}.indicative_funding")),
         ("support_coverage", mean_of(f"{NBF}.support_coverage"))],
        by=[f"{NBF}.nbf_category", f"{NBF}.indicative_rate"], where=nbf_page(year))


def seheef_matrix(m: Model, years: list[int]) -> DataFrame:
    return pivot_sum(m.tables["mart_seheef_activity"], ["seheef_activity", "seheef_life_stage"],
                     "year", years, cases="cases", students="students")


# ------------------------------------------------------------------- triage --
TRIAGE_COLUMNS = ["priority_tier", "student_name", "student_id", "program_name",
                  "home_campus_code", "mode", "reasons", "latest_alert_week", "logins_last2wk",
                  "missed_last2wk", "nbf_equity_cohort", "case_status", "advisor_id"]


def triage_cards(m: Model) -> DataFrame:
    return m.evaluate(["students_on_list", "p1_students", "alert_action_rate",
                       "median_days_to_action"])


def triage_table(m: Model) -> DataFrame:
    """The caseload, most urgent first, with the colour of its tier."""
    rows = m.tables["mart_triage_current"].select(*TRIAGE_COLUMNS)
    return report_order(rows.withColumn("tier_colour", tier_colour("priority_tier")),
                        "priority_tier", "student_id")


def triage_tiers(m: Model) -> DataFrame:
    return m.tables["mart_triage_current"].select("priority_tier").distinct()


def triage_advisors(m: Model) -> DataFrame:
    return m.tables["dim_advisor"].select("advisor_name").distinct()


def triage_slicers(m: Model) -> DataFrame:
    """Both slicers of the page: the tiers present and the advisors with somebody
    on the list, as a role sees them."""
    listed = m.tables["mart_triage_current"]
    busy = m.tables["dim_advisor"].join(listed.select("advisor_id"), "advisor_id", "left_semi")
    names = triage_advisors(m.scoped({"dim_advisor": busy})).select(
        F.lit("advisor_name").alias("slicer"), F.col("advisor_name").alias("value"))
    return triage_tiers(m).select(
        F.lit("priority_tier").alias("slicer"), F.col("priority_tier").alias("value")) \
        .unionByName(names)


def caseload(m: Model) -> DataFrame:
    return m.evaluate(["students_on_list"], by=["mart_triage_current.advisor_id"])


# ------------------------------------------------------------ effectiveness --
RESULTS = "mart_effectiveness_results"


def effect_table(m: Model) -> DataFrame:
    return m.evaluate(
        [(c, sum_of(f"{RESULTS}.{c}")) for c in ("estimate_pp", "ci_low_pp", "ci_high_pp")],
        by=[f"{RESULTS}.estimator", f"{RESULTS}.note"])


def effect_bar(m: Model) -> DataFrame:
    return m.evaluate([("estimate_pp", sum_of(f"{RESULTS}.estimate_pp"))],
                      by=[f"{RESULTS}.estimator"])


def engagement(m: Model) -> DataFrame:
    return m.evaluate([("avg_logins", mean_of("mart_engagement_trend.avg_logins"))],
                      by=["mart_engagement_trend.week_number", "mart_engagement_trend.mode"])


def effect_cards(m: Model) -> DataFrame:
    return m.evaluate(["alerts_raised", "alerts_actioned", "reach_rate"])


# ------------------------------------------------------------- data quality --
ISSUES = ("issues", "mart_dq_summary.issues")


def dq_card(m: Model) -> DataFrame:
    return m.evaluate([(ISSUES[0], sum_of(ISSUES[1]))])


def dq_table(m: Model) -> DataFrame:
    return m.evaluate([(ISSUES[0], sum_of(ISSUES[1]))],
                      by=[f"mart_dq_summary.{c}" for c in ("rule_id", "severity", "table_name")])


def dq_bar(m: Model) -> DataFrame:
    return m.evaluate([(ISSUES[0], sum_of(ISSUES[1]))], by=["mart_dq_summary.rule_id"])


VISUALS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (
        exec_cards, success_term_mode, success_campus, program_matrix, equity_cards,
        retention_cohort, retention_trend, nbf_table, seheef_matrix, triage_cards, triage_table,
        triage_tiers, triage_advisors, caseload, effect_table, effect_bar, engagement,
        effect_cards, dq_card, dq_table, dq_bar)}


#: Visuals of one page over the same tables.
PAGES: dict[str, tuple[Callable[[Model], DataFrame], ...]] = {
    "executive": (exec_cards, success_term_mode, success_campus, program_matrix),
    "triage": (triage_cards, caseload),
    "effectiveness": (effect_cards, engagement)}


def page(m: Model, name: str, write: Callable[[DataFrame, str], DataFrame] | None = None) \
        -> dict[str, DataFrame]:
    """The visuals of a page, all from one reduction of each table (``Model.for_page``)."""
    model = m.for_page(PAGES[name], write)
    return {visual.__name__: visual(model) for visual in PAGES[name]}


def headline(retention_mart: DataFrame, triage_mart: DataFrame, nbf_mart: DataFrame,
             year: int = FUNDED_YEAR) -> DataFrame:
    """The handful of figures printed after a run, as (metric, label, value)."""
    kept = retention_mart.filter(F.col("cohort") == "All domestic").select(
        F.lit("retention").alias("metric"), F.col("commencing_year").cast("string").alias("label"),
        F.col("retention_rate").alias("value"))
    size = triage_mart.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("triage_size").alias("metric"), F.lit("current").alias("label"), "value")
    tiers = triage_mart.groupBy(F.col("priority_tier").alias("label")).agg(
        F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("tier").alias("metric"), "label", "value")
    funding = page_filter(nbf_mart, "commencing_year", [year]).agg(
        F.coalesce(F.sum("indicative_funding"), F.lit(0)).cast("double").alias("value")).select(
        F.lit("funding").alias("metric"), F.lit(str(year)).alias("label"), "value")
    return kept.unionByName(size).unionByName(tiers).unionByName(funding)
