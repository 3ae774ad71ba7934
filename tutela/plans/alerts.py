"""Reason-coded alert rules over weekly activity.

Only activity columns enter the rules; who a student is never does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.operators.windows import rolling_sum, running_sums

# --- fixed values: reason codes in order of evaluation ----------------------
INACTIVITY = "INACTIVITY_14D"
NON_SUBMISSION = "NON_SUBMISSION"
LOW_ONTIME = "LOW_ONTIME_RATE"
REASONS = (INACTIVITY, NON_SUBMISSION, LOW_ONTIME)
# ---------------------------------------------------------------------------
COUNTS = ("logins", "items_due", "submitted_on_time", "missed")


@dataclass(frozen=True)
class Thresholds:
    """Policy limits; the on-time floor is a fraction num/den so that the test
    compares whole numbers."""

    first_week: int = 3
    last_week: int = 11
    inactivity_logins: int = 2
    missed_items: int = 3
    ontime_from_week: int = 6
    ontime_min_due: int = 3
    ontime_num: int = 4
    ontime_den: int = 10


def with_signals(activity: DataFrame, collapse: bool = True) -> DataFrame:
    """Activity with rolling and running totals per student-term.

    ``collapse`` first adds up rows of the same week, so that a window never
    holds more rows than the term has weeks; leave it out only for a feed that
    is already unique per student, term and week.
    """
    part = ["student_id", "term_code"]
    rows = activity.select(*part, "week_number", *COUNTS)
    if collapse:
        rows = rows.groupBy(*part, "week_number").agg(*[F.sum(c).alias(c) for c in COUNTS])
    out = rolling_sum(rows, part, "week_number", "logins", "logins_2wk")
    return running_sums(out, part, "week_number", {
        "cum_due": "items_due", "cum_on_time": "submitted_on_time", "cum_missed": "missed"})


def rule_tests(t: Thresholds) -> dict[str, Column]:
    return {
        INACTIVITY: F.col("logins_2wk") <= t.inactivity_logins,
        NON_SUBMISSION: F.col("cum_missed") >= t.missed_items,
        LOW_ONTIME: ((F.col("week_number") >= t.ontime_from_week)
                     & (F.col("cum_due") >= t.ontime_min_due)
                     & (F.col("cum_on_time") * t.ontime_den < F.col("cum_due") * t.ontime_num)),
    }


def alert_rules(activity: DataFrame, terms: DataFrame, thresholds: Thresholds = Thresholds(),
                collapse: bool = True) -> DataFrame:
    """First week each rule holds per student-term, as alert rows.

    One aggregate yields the first firing of all three rules at once, on the
    partitioning the windows already have. ``raised_date`` is two days into
    the week. The id is built from the keys and sorts in order of firing.
    """
    t = thresholds
    signals = with_signals(activity, collapse).filter(
        F.col("week_number").between(t.first_week, t.last_week))
    tests = rule_tests(t)
    firsts = signals.groupBy("student_id", "term_code").agg(*[
        F.min(F.when(test, F.col("week_number"))).alias(reason)
        for reason, test in tests.items()])
    fired = firsts.select("student_id", "term_code", F.inline(F.filter(F.array(*[
        F.struct(F.col(r).cast("int").alias("week_number"), F.lit(r).alias("reason_code"),
                 F.lit(i).alias("rule_no")) for i, r in enumerate(tests, 1)]),
        lambda x: x["week_number"].isNotNull())))
    dated = fired.join(terms.select("term_code", "term_start"), "term_code", "inner")
    return dated.select(
        alert_key().alias("alert_id"), "student_id", "term_code", "week_number",
        raised_date().alias("raised_date"), "reason_code")


def alert_key() -> Column:
    return F.concat_ws("-", F.col("student_id").cast("string"), F.col("term_code"),
                       F.lpad(F.col("week_number").cast("string"), 2, "0"),
                       F.col("rule_no").cast("string"))


def raised_date() -> Column:
    return F.date_add(F.col("term_start"), 7 * (F.col("week_number") - 1) + 2)


def severity(alerts: DataFrame, activity: DataFrame, thresholds: Thresholds = Thresholds(),
             collapse: bool = True) -> DataFrame:
    """What an advisor sees on the day of the first alert: how many reasons
    came together and whether the student was inactive."""
    key = ["student_id", "term_code"]
    # per week first, then the earliest week by an ordered aggregate
    first = (alerts.groupBy(*key, "week_number").agg(F.count(F.lit(1)).alias("reasons"))
             .groupBy(*key).agg(F.min("week_number").alias("alert_week"),
                                F.min_by("reasons", "week_number").alias("reasons_at_alert")))
    logins = with_signals(activity, collapse).select(*key, "week_number", "logins_2wk")
    return (first.join(logins.withColumnRenamed("week_number", "alert_week"),
                       [*key, "alert_week"], "left")
            .select(*key, "alert_week", "reasons_at_alert",
                    (F.col("logins_2wk") <= thresholds.inactivity_logins).alias("low_login")))
