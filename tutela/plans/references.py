"""Reference rows of the institution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tutela.sources import lookup

# --- fixed values ----------------------------------------------------------
# variant spelling -> campus code
CAMPUS_SYNONYMS = [
    ("NSY", "NSY"), ("NORTH SYDNEY", "NSY"), ("NTH SYDNEY", "NSY"),
    ("STR", "STR"), ("STRATHFIELD", "STR"), ("STRATH", "STR"),
    ("BLK", "BLK"), ("BLACKTOWN", "BLK"),
    ("MEL", "MEL"), ("MELBOURNE", "MEL"), ("MELB", "MEL"),
    ("BAL", "BAL"), ("BALLARAT", "BAL"),
    ("BRI", "BRI"), ("BRISBANE", "BRI"), ("BRIS", "BRI"),
    ("CAN", "CAN"), ("CANBERRA", "CAN"),
    ("ONL", "ONL"), ("ONLINE", "ONL"),
]
# term, first day, census day, teaching weeks, year, half, is it the current one
TERMS = [
    ("2023S1", "2023-02-27", "2023-03-24", 13, 2023, "S1", False),
    ("2023S2", "2023-07-24", "2023-08-18", 13, 2023, "S2", False),
    ("2024S1", "2024-02-26", "2024-03-22", 13, 2024, "S1", False),
    ("2024S2", "2024-07-22", "2024-08-16", 13, 2024, "S2", False),
    ("2025S1", "2025-02-24", "2025-03-21", 13, 2025, "S1", False),
    ("2025S2", "2025-07-21", "2025-08-15", 13, 2025, "S2", False),
    ("2026S1", "2026-02-23", "2026-03-20", 13, 2026, "S1", True),
]
CAMPUSES = [
    ("NSY", "North Sydney", "NSW"), ("STR", "Strathfield", "NSW"),
    ("BLK", "Blacktown", "NSW"), ("MEL", "Melbourne", "VIC"),
    ("BAL", "Ballarat", "VIC"), ("BRI", "Brisbane", "QLD"),
    ("CAN", "Canberra", "ACT"), ("ONL", "Online", "MULTI"),
]
PROGRAMS = [
    ("BNURS", "Bachelor of Nursing", "Health"),
    ("BEDPR", "Bachelor of Education (Primary)", "Education"),
    ("BEDSE", "Bachelor of Education (Secondary)", "Education"),
    ("BPHYS", "Bachelor of Physiotherapy", "Health"),
    ("BOCCT", "Bachelor of Occupational Therapy", "Health"),
    ("BSOCW", "Bachelor of Social Work", "Health"),
    ("BPSYC", "Bachelor of Psychological Science", "Health"),
    ("BEXSC", "Bachelor of Exercise and Sports Science", "Health"),
    ("BPARA", "Bachelor of Paramedicine", "Health"),
    ("BBUSI", "Bachelor of Business Administration", "Business"),
    ("BINFT", "Bachelor of Information Technology", "STEM"),
    ("BLAWS", "Bachelor of Laws", "Law"),
    ("BARTS", "Bachelor of Arts", "Arts"),
]
# funding category -> indicative rate per commencing student
FUNDING_RATES = [
    ("Low SES", 4124),
    ("Low SES (high preparedness)", 1535),
    ("First Nations", 4860),
    ("Low SES + First Nations", 5819),
    ("Not applicable", 0),
]
# ---------------------------------------------------------------------------

TERM_SCHEMA = ("term_code string, term_start string, census_date string, teaching_weeks int, "
               "year int, semester string, is_current boolean")


def term_rows(spark: SparkSession, rows=TERMS) -> DataFrame:
    terms = lookup(spark, rows, TERM_SCHEMA)
    return terms.withColumns({c: terms[c].cast("date") for c in ("term_start", "census_date")})


def synonym_rows(spark: SparkSession, rows=CAMPUS_SYNONYMS) -> DataFrame:
    return lookup(spark, rows, "variant string, canonical string")


def campus_rows(spark: SparkSession, rows=CAMPUSES) -> DataFrame:
    return lookup(spark, rows, "campus_code string, campus_name string, state string")


def program_rows(spark: SparkSession, rows=PROGRAMS) -> DataFrame:
    return lookup(spark, rows, "program_code string, program_name string, field string")


def rate_rows(spark: SparkSession, rows=FUNDING_RATES) -> DataFrame:
    return lookup(spark, rows, "nbf_category string, indicative_rate int")
