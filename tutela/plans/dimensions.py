"""Conformed dimensions. Socio-economic and regional status always come from
the postcode, never from the student record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions import default_to, full_name, term_year

# --- fixed values: funding category names and the preparedness score --------
BOTH = "Low SES + First Nations"
FIRST_NATIONS = "First Nations"
LOW_SES_PREPARED = "Low SES (high preparedness)"
LOW_SES = "Low SES"
NOT_APPLICABLE = "Not applicable"
PREPARED_SCORE = 80
# ---------------------------------------------------------------------------


def _domestic() -> Column:
    return F.col("citizenship") == "Domestic"


def _yes_no(test: Column) -> Column:
    return F.when(test, "Yes").otherwise("No")


def low_ses() -> Column:
    return _yes_no(_domestic() & (F.col("ses_quartile") == 1))


def regional_remote() -> Column:
    return _yes_no(_domestic() & F.col("remoteness").isin("Regional", "Remote"))


def equity_cohort() -> Column:
    return _yes_no(_domestic() & ((F.col("ses_quartile") == 1) | (F.col("first_nations") == "Yes")))


def funding_category() -> Column:
    """First match wins; an unknown citizenship is not ruled out."""
    poorest = F.col("ses_quartile") == 1
    first_nations = F.col("first_nations") == "Yes"
    prepared = default_to("atar", 0.0) >= PREPARED_SCORE
    return (F.when(F.col("citizenship") != "Domestic", NOT_APPLICABLE)
            .when(poorest & first_nations, BOTH)
            .when(first_nations, FIRST_NATIONS)
            .when(poorest & prepared, LOW_SES_PREPARED)
            .when(poorest, LOW_SES)
            .otherwise(NOT_APPLICABLE))


def dim_student(students: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Surviving students with derived attributes; one row per student."""
    places = postcodes.select("postcode", "ses_quartile", "remoteness")
    out = students.join(places, "postcode", "left").withColumns({
        "commencing_year": term_year("commencing_term"),
        "low_ses": low_ses(), "regional_remote": regional_remote(),
        "nbf_equity_cohort": equity_cohort(), "nbf_category": funding_category()})
    if "student_name" not in out.columns:
        out = out.withColumn("student_name", full_name("first_name", "last_name"))
    return out.withColumnRenamed("campus_code_raw", "home_campus_code")


DIM_STUDENT_COLUMNS = [
    "student_id", "first_name", "last_name", "student_name", "dob", "gender", "citizenship",
    "postcode", "state", "home_campus_code", "program_code", "commencing_term",
    "commencing_year", "attendance_type", "mode", "age_group", "basis_of_admission", "atar",
    "first_nations", "disability", "nesb", "ses_quartile", "remoteness", "low_ses",
    "regional_remote", "nbf_equity_cohort", "nbf_category", "student_status", "status_term"]

# declared column defaults of the production table
DEFAULTS = {"first_nations": "Unknown", "disability": "Unknown", "nesb": "Unknown",
            "low_ses": "No", "regional_remote": "No", "nbf_equity_cohort": "No",
            "nbf_category": NOT_APPLICABLE}


def with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({c: default_to(c, v) for c, v in DEFAULTS.items() if c in df.columns})


# ------------------------------------------------------------------ cohorts --
def cohort_tests() -> dict[str, Column]:
    """Overlapping reporting cohorts of domestic students."""
    return {
        "All domestic": F.lit(True),
        "Low SES": F.col("low_ses") == "Yes",
        "First Nations": F.col("first_nations") == "Yes",
        "Disability": F.col("disability") == "Yes",
        "Regional/remote": F.col("regional_remote") == "Yes",
        "Online": F.col("mode") == "Online",
        "Non-equity": ((F.col("low_ses") == "No") & (F.col("first_nations") == "No")
                       & (F.col("disability") == "No") & (F.col("regional_remote") == "No")),
    }
