"""Text extracts to typed staging frames.

Bad values of doubtful columns become NULL and are left to the rules; columns
that must be right (week numbers, counters) stop the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.functions import (full_name, mixed_date, null_if_empty, proper_case, strict, strip,
                              to_date, to_double, tri_state, upper_trim)
from tutela.operators.joins import left_lookup

EXTRACTS = {
    "banner_students": [
        "student_id", "first_name", "last_name", "dob", "gender", "citizenship", "postcode",
        "state", "campus_code", "program_code", "commencing_term", "attendance_type", "mode",
        "age_group", "basis_of_admission", "atar", "first_nations_flag", "disability_flag",
        "nesb_flag", "student_status", "status_term"],
    "banner_enrolments": [
        "student_id", "unit_code", "term_code", "campus_code", "enrolment_status", "grade",
        "mark", "eftsl", "census_date"],
    "canvas_activity": [
        "student_id", "term_code", "week_number", "week_start", "logins", "page_views",
        "items_due", "submitted_on_time", "submitted_late", "missed"],
    "crm_cases": [
        "case_id", "student_id", "term_code", "opened_date", "source", "case_type",
        "seheef_activity", "seheef_life_stage", "advisor_id", "contact_channel",
        "contact_outcome", "status", "closed_date", "linked_alert_id"],
    "alerts_history": [
        "alert_id", "student_id", "term_code", "week_number", "raised_date", "reason_code"],
    "ref_postcode_ses": ["postcode", "state", "ses_quartile", "remoteness"],
    "ref_units": ["unit_code", "unit_name", "program_code", "year_level", "eftsl"],
    "ref_advisors": ["advisor_id", "advisor_name", "campuses"],
}
FLAGS = {"first_nations_flag": "first_nations", "disability_flag": "disability",
         "nesb_flag": "nesb"}
COUNTERS = ["week_number", "logins", "page_views", "items_due", "submitted_on_time",
            "submitted_late", "missed"]


def stage_students(raw: DataFrame) -> DataFrame:
    changed = {
        "student_id": strip("student_id"), "first_name": proper_case("first_name"),
        "last_name": strip("last_name"), "dob": mixed_date("dob"), "atar": to_double("atar"),
        "campus_code": upper_trim("campus_code"), **{f: tri_state(f) for f in FLAGS},
    }
    names = {"campus_code": "campus_code_raw", **FLAGS}
    return raw.withColumns(changed).withColumnsRenamed(names)


def resolve_campus(df: DataFrame, synonyms: DataFrame, raw: str = "campus_code_raw",
                   name: str = "campus_code", known: str | None = None) -> DataFrame:
    """Canonical code where the spelling is listed, else the spelling itself.

    ``known`` adds whether the result is a canonical code; NULL for a missing
    code, which no rule can call wrong.
    """
    out = (left_lookup(df, F.col(raw), synonyms.select("variant", "canonical"), "variant")
           .withColumn(name, F.coalesce("canonical", raw)).drop("canonical"))
    if known:
        codes = (synonyms.select(F.col("canonical").alias(name)).distinct()
                 .withColumn(known, F.lit(True)))
        out = (out.join(codes, name, "left")
               .withColumn(known, F.when(F.col(name).isNotNull(),
                                         F.coalesce(F.col(known), F.lit(False)))))
    return out


def stage_enrolments(raw: DataFrame, synonyms: DataFrame) -> DataFrame:
    df = raw.withColumns({
        "student_id": strip("student_id"), "campus_code_raw": upper_trim("campus_code"),
        "mark": to_double("mark"), "eftsl": to_double("eftsl"),
        "census_date": to_date("census_date")}).drop("campus_code")
    return resolve_campus(df, synonyms).select(
        "student_id", "unit_code", "term_code", "campus_code", "campus_code_raw",
        "enrolment_status", "grade", "mark", "eftsl", "census_date")


def stage_activity(raw: DataFrame) -> DataFrame:
    return raw.withColumns({**{c: strict(c, "int") for c in COUNTERS},
                            "week_start": strict("week_start", "date")})


def stage_cases(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"opened_date": to_date("opened_date"),
                            "closed_date": to_date("closed_date"),
                            "linked_alert_id": null_if_empty("linked_alert_id")})


def stage_alerts(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"week_number": strict("week_number", "int"),
                            "raised_date": to_date("raised_date")})


def stage_postcodes(raw: DataFrame) -> DataFrame:
    return raw.withColumn("ses_quartile", strict("ses_quartile", "int"))


def stage_units(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"year_level": strict("year_level", "int"),
                            "eftsl": strict("eftsl", "double")})


def stage_advisors(raw: DataFrame) -> DataFrame:
    return raw.select("advisor_id", "advisor_name", F.col("campuses").alias("covered_campuses"))


def with_student_name(df: DataFrame) -> DataFrame:
    return df.withColumn("student_name", full_name("first_name", "last_name"))
