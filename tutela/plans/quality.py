"""Validation rules, issue log, quarantine, constraint checks.

All rules over one table run in one pass: each row emits a struct per rule it
breaks, and the lookups (known student, known campus) are shared.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions import composite_key, number_text
from tutela.operators.joins import apart
from tutela.operators.sets import emit_rows, stack

# --- fixed values: rule names, severities and limits -----------------------
MALFORMED_ROW = "R00_malformed_record"
DUPLICATE = "R01_duplicate_student"
MARK = "R02_mark_out_of_range"
CAMPUS = "R03_unknown_campus"
FLAG = "R04_missing_equity_flag"
DOB = "R05_dob_implausible"
ORPHAN_ENROLMENT = "R06_orphan_enrolment"
ORPHAN_ACTIVITY = "R07_orphan_activity"
QUARANTINED = "quarantined_enrolment_rows"
FATAL, WARN = "FATAL", "WARN"
STUDENTS, ENROLMENTS, ACTIVITY = "banner_students", "banner_enrolments", "canvas_activity"
MARK_RANGE = (0, 100)
DOB_RANGE = (date(1936, 1, 1), date(2011, 1, 1))
# ---------------------------------------------------------------------------
ISSUE_COLUMNS = ["rule_id", "severity", "table_name", "row_key", "detail"]
ENROLMENT_KEY = ("student_id", "unit_code", "term_code")


def issue(rule: str, severity: str, table: str, key: Column, detail: Column) -> Column:
    values = [F.lit(rule), F.lit(severity), F.lit(table), key.cast("string"),
              detail.cast("string")]
    return F.struct(*[v.alias(n) for v, n in zip(values, ISSUE_COLUMNS)])


def malformed_issues(records: DataFrame) -> DataFrame:
    """One issue for each record of an extract that does not fit its header."""
    return records.select(
        F.lit(MALFORMED_ROW).alias("rule_id"), F.lit(FATAL).alias("severity"), "table_name",
        "row_key", F.col("record").alias("detail"))


# ----------------------------------------------------------------- students --
def duplicate_issues(survivors: DataFrame) -> DataFrame:
    detail = F.concat(F.lit("merged into "), F.col("surviving_id").cast("string"))
    return emit_rows(survivors, [
        (F.lit(True), issue(DUPLICATE, FATAL, STUDENTS, F.col("duplicate_id"), detail))])


def flag_missing() -> Column:
    return (F.col("first_nations") == "Unknown") | (F.col("disability") == "Unknown")


def dob_implausible() -> Column:
    dob = F.col("dob")
    return dob.isNull() | (dob < F.lit(DOB_RANGE[0])) | (dob > F.lit(DOB_RANGE[1]))


def student_issues(students: DataFrame, rules: Sequence[str] = (FLAG, DOB)) -> DataFrame:
    """Missing equity flags (the first one is named) and doubtful birth dates."""
    which = F.when(F.col("first_nations") == "Unknown", "first_nations_flag") \
        .otherwise("disability_flag")
    checks = {
        FLAG: (flag_missing(), which),
        DOB: (dob_implausible() if "dob" in students.columns else F.lit(False),
              F.coalesce(F.col("dob").cast("string"), F.lit("unparseable"))
              if "dob" in students.columns else F.lit(None)),
    }
    return emit_rows(students, [
        (checks[r][0], issue(r, WARN, STUDENTS, F.col("student_id"), checks[r][1]))
        for r in rules])


# --------------------------------------------------------------- enrolments --
def judge_enrolments(enrolments: DataFrame, students: DataFrame, canonical: DataFrame) -> DataFrame:
    """Staged enrolments with one true/false column per fatal rule.

    ``canonical`` holds the valid campus codes. Students are looked up before
    duplicates are dropped: a duplicate id is still a known person.

    Only the different ids meet the student table. What joins the rows is the
    list of unknown ids, normally short enough for the planner to send to every
    task, so the rows themselves are not moved.
    """
    strangers = apart(enrolments.select("student_id").distinct().join(
        students.select("student_id"), "student_id", "left_anti")).withColumn(
        "__stranger", F.lit(True))
    known = enrolments.join(strangers, "student_id", "left")
    codes = canonical.select(F.col("canonical").alias("campus_code")).distinct() \
        .withColumn("__campus", F.lit(True))
    both = known.join(codes, "campus_code", "left")
    low, high = MARK_RANGE
    return both.withColumns({
        "bad_mark": F.coalesce((F.col("mark") < low) | (F.col("mark") > high), F.lit(False)),
        "bad_campus": F.col("campus_code").isNotNull() & F.col("__campus").isNull(),
        "orphan": F.col("student_id").isNull() | F.col("__stranger").isNotNull(),
    }).drop("__stranger", "__campus")


def enrolment_issues(judged: DataFrame,
                     rules: Sequence[str] = (MARK, CAMPUS, ORPHAN_ENROLMENT)) -> DataFrame:
    key = composite_key(*ENROLMENT_KEY)
    checks = {
        MARK: ("bad_mark", F.concat(F.lit("mark="), number_text("mark"))),
        CAMPUS: ("bad_campus", F.concat(F.lit("campus_code="), F.col("campus_code_raw"))),
        ORPHAN_ENROLMENT: ("orphan", F.lit("no student record")),
    }
    return emit_rows(judged, [
        (F.col(checks[r][0]), issue(r, FATAL, ENROLMENTS, key, checks[r][1])) for r in rules])


def quarantine(judged: DataFrame) -> DataFrame:
    """Rejected rows with the first rule they break."""
    rule = (F.when(F.col("bad_mark"), MARK).when(F.col("bad_campus"), CAMPUS)
            .when(F.col("orphan"), ORPHAN_ENROLMENT))
    return (judged.withColumn("reject_rule", rule).filter(F.col("reject_rule").isNotNull())
            .drop("bad_mark", "bad_campus", "orphan"))


def clean(enrolments: DataFrame, rejected: DataFrame,
          keys: Sequence[str] = ENROLMENT_KEY) -> DataFrame:
    """Rows sharing no key with a rejected one.

    A key is rejected as a whole; a rejected row with a missing key part
    matches nothing and stays.
    """
    bad = apart(rejected.select(*keys).distinct())
    return enrolments.join(bad, list(keys), "left_anti")


# ----------------------------------------------------------------- activity --
def activity_issues(activity: DataFrame, students: DataFrame) -> DataFrame:
    lost = activity.join(students.select("student_id"), "student_id", "left_anti")
    key = composite_key("student_id", "term_code", "week_number")
    return emit_rows(lost, [
        (F.lit(True), issue(ORPHAN_ACTIVITY, FATAL, ACTIVITY, key, F.lit("no student record")))])


# -------------------------------------------------------------------- totals --
def issue_log(survivors: DataFrame, students: DataFrame, judged: DataFrame, activity: DataFrame,
              all_students: DataFrame) -> DataFrame:
    return stack([duplicate_issues(survivors), enrolment_issues(judged),
                  student_issues(students), activity_issues(activity, all_students)])


def summarise(issues: DataFrame, rejected: DataFrame) -> DataFrame:
    """Findings per rule plus one row for the quarantine (present even if empty)."""
    rules = issues.groupBy("rule_id", "severity", "table_name").agg(
        F.count(F.lit(1)).alias("issues"))
    held = rejected.agg(F.count(F.lit(1)).alias("issues")).select(
        F.lit(QUARANTINED).alias("rule_id"), F.lit(FATAL).alias("severity"),
        F.lit(ENROLMENTS).alias("table_name"), "issues")
    return stack([rules, held])


def findings_total(summary: DataFrame, count_quarantine: bool = True) -> DataFrame:
    """All findings. The quarantine row repeats rows already counted by rule, so
    it can be left out."""
    if not count_quarantine:
        summary = summary.filter(F.col("rule_id") != QUARANTINED)
    return summary.agg(F.sum("issues").alias("findings"))


def integrity(fact: DataFrame, dim: DataFrame, key: str = "student_id") -> DataFrame:
    """Number of fact rows whose key the dimension does not hold."""
    lost = fact.join(dim.select(key), key, "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("orphans"))


def assert_no_orphans(fact: DataFrame, dim: DataFrame, key: str = "student_id") -> None:
    n = integrity(fact, dim, key).first()["orphans"]
    if n:
        raise ValueError(f"{n} rows refer to an unknown {key}")


def stamp(issues: DataFrame) -> DataFrame:
    return issues.withColumn("loaded_at", F.current_timestamp())


# --------------------------------------------------------------- constraints --
def check_constraints(df: DataFrame, table: str, pk: Sequence[str] = (),
                      fks: Sequence[tuple[str, DataFrame, str]] = (),
                      required: Sequence[str] = (),
                      checks: dict[str, Column] | None = None) -> DataFrame:
    """Declared constraints as issue rows.

    * primary key: one row per value held more than once
    * foreign key ``(column, table, key)``: one row per row with a known value
      that the other table lacks
    * required and check columns: one row per broken row; as in SQL a check
      that is unknown counts as met
    """
    key = composite_key(*[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in pk]) \
        if pk else F.lit(None)
    found = []
    row_rules = [(F.col(c).isNull(), issue(f"NN_{c}", FATAL, table, key, F.lit("missing")))
                 for c in required]
    row_rules += [(~test, issue(f"CK_{name}", FATAL, table, key, F.lit("check failed")))
                  for name, test in (checks or {}).items()]
    if row_rules:
        found.append(emit_rows(df, row_rules))
    if pk:
        twice = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
        text = F.concat(F.col("__n").cast("string"), F.lit(" rows"))
        found.append(emit_rows(twice, [
            (F.lit(True), issue(f"PK_{'_'.join(pk)}", FATAL, table, key, text))]))
    for col, ref, ref_key in fks:
        keys = ref.select(F.col(ref_key).alias(col))
        lost = df.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")
        text = F.concat(F.lit(f"{col}="), F.col(col).cast("string"))
        found.append(emit_rows(lost, [
            (F.lit(True), issue(f"FK_{col}", FATAL, table, key, text))]))
    return stack(found)
