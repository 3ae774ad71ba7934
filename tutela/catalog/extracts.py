"""The supplied tables as the institution's text extracts, for whole runs.

Every column of every extract is filled, with blanks, mixed spellings and date formats, numbers that
are none, and people that nobody knows. The thirty days of activity are the last three half-years
(``TERM_OF``), a day standing for a week, so one calendar serves enrolments and activity.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.catalog.bindings import (DAYS, HALF_YEARS, PROGRAMS, TABLE_SCHEMAS, Bound,
                                     calendar_day, half_year, person)
from tutela.plans import references, staging
from tutela.plans.build import References, build_version
from tutela.session import scratch_path, shared_dir
from tutela.sources import Store, write_table
from tutela.sources.publication import Files, Version

TERM_OF = {"2024T1": "2000S2", "2024T2": "2001S1", "2024T3": "2001S2"}
RUN_MAX_YEAR = 2000
REASONS = ("INACTIVITY_14D", "NON_SUBMISSION", "LOW_ONTIME_RATE")


def _text(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _choice(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _half_year_of(term: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(t) for pair in TERM_OF.items() for t in pair)), term)


def _students(b: Bound) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1930-01-01").cast("date"), (key % 12 * 2000).cast("int"))
    first = b.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        half_year(F.min("o_orderdate")).alias("commencing_term"))
    c = b.table("customer").join(first, "c_custkey", "left").join(
        b.regions, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        F.concat(F.lit(" "), _text(key), F.lit(" ")).alias("student_id"),
        F.concat(F.lit("  "), F.when(key % 2 == 0, F.lower("c_mktsegment"))
                 .otherwise(F.col("c_mktsegment"))).alias("first_name"),
        F.concat(F.lit("N"), _text("c_nationkey"), F.lit(" ")).alias("last_name"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "31/02/2020")
        .when(key % 3 == 0, F.date_format(born, "dd/MM/yyyy")).otherwise(_text(born)).alias("dob"),
        _choice(key, "F", "M", "X").alias("gender"),
        F.when(F.col("c_nationkey") % 10 == 0, "International").otherwise("Domestic")
        .alias("citizenship"),
        _text("c_nationkey").alias("postcode"), F.left("r_name", F.lit(2)).alias("state"),
        F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")).alias("campus_code"),
        F.col("c_mktsegment").alias("program_code"), "commencing_term",
        _choice(key, "Part-time", "Full-time", "Full-time").alias("attendance_type"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Online").otherwise("On-campus").alias("mode"),
        _choice(key, "u25", "25+").alias("age_group"),
        _choice(key, "School", "VET", "Mature age", "Other").alias("basis_of_admission"),
        F.when(key % 5 == 1, "75F").when(key % 5 == 2, "").when(key % 5 == 3, "n/a")
        .otherwise(_text("c_acctbal")).alias("atar"),
        _choice(key, "N", "Y", "N", "N", "").alias("first_nations_flag"),
        _choice(key, "N", "N", "Y", "N", "N", "N", "?").alias("disability_flag"),
        _choice(key, "Y", "N").alias("nesb_flag"),
        _choice(key, "completed", "discontinued", "active", "active").alias("student_status"),
        F.when(key % 4 == 1, F.col("commencing_term")).alias("status_term"))


def _enrolments(b: Bound) -> DataFrame:
    order = b.table("orders").select(
        "o_orderkey", person(F.col("o_custkey")).alias("student_id"),
        half_year(F.col("o_orderdate")).alias("term_code"),
        (F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")).alias("running"))
    b.share("places")
    place = b.places.select("s_suppkey", "n_name")
    rows = (b.table("lineitem").join(place, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(order, F.col("l_orderkey") == F.col("o_orderkey")))
    q, running = F.col("l_quantity"), F.col("running")
    gone = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return rows.select(
        _text("student_id").alias("student_id"), _text("l_partkey").alias("unit_code"),
        "term_code", F.concat(F.lower("n_name"), F.lit(" ")).alias("campus_code"),
        F.when(gone, "Withdrawn pre-census").when(running, "In progress").otherwise("Completed")
        .alias("enrolment_status"),
        F.when(gone, "WW").when(running, "IP").when(q >= 41.5, "HD").when(q >= 36.5, "DI")
        .when(q >= 31.5, "CR").when(q >= 24, "PA").otherwise("NN").alias("grade"),
        F.when(~running, _text(q * 2 + 2)).alias("mark"), F.lit("0.125").alias("eftsl"),
        F.concat(F.left("term_code", F.lit(4)), F.when(F.col("term_code").endswith("S1"), "-02-01")
                 .otherwise("-08-01")).alias("census_date"))


def _activity(b: Bound) -> DataFrame:
    return b.activity.select(
        _text("student_id").alias("student_id"),
        _half_year_of(F.col("term_code")).alias("term_code"), "week_number", "week_start",
        "logins", (F.col("logins") * 3 + F.col("week_number")).alias("page_views"), "items_due",
        "submitted_on_time", "submitted_late", "missed")


def _events(b: Bound, kind: str) -> DataFrame:
    day = calendar_day("ts")
    inside = b.table("events").filter(F.col("event_type") == kind).filter(day.between(1, DAYS))
    return inside.select(
        "event_id", "value", _text(person(F.col("user_id"))).alias("student_id"), "user_id",
        _choice(F.floor((day - 1) / 10), *TERM_OF.values()).alias("term_code"),
        ((day - 1) % 10 + 1).alias("week_number"), F.col("ts").cast("date").alias("day"))


def _alerts(b: Bound) -> DataFrame:
    return _events(b, "error").select(
        F.concat(F.lit("A"), _text("event_id")).alias("alert_id"), "student_id", "term_code",
        "week_number", F.col("day").alias("raised_date"),
        _choice(F.col("event_id"), *REASONS).alias("reason_code"))


def _cases(b: Bound) -> DataFrame:
    first = _alerts(b).groupBy("student_id", "term_code").agg(F.min("alert_id").alias("first"))
    e, value = F.col("event_id"), F.col("value")
    rows = _events(b, "signup").join(first, ["student_id", "term_code"], "left")
    early = e % 4 == 0
    return rows.select(
        F.concat(F.lit("C"), _text(e)).alias("case_id"), "student_id", "term_code",
        F.col("day").alias("opened_date"),
        F.when(early, "Early alert").when(e % 4 < 3, "Self-referral").otherwise("Staff referral")
        .alias("source"),
        F.concat(F.lit("Type "), _text(e % 4)).alias("case_type"),
        F.concat(F.lit("Activity "), _text(e % 5)).alias("seheef_activity"),
        F.concat(F.lit("Stage "), _text(e % 3)).alias("seheef_life_stage"),
        F.concat(F.lit("ADV"), F.lpad(_text(F.col("user_id") % 11 + 1), 2, "0"))
        .alias("advisor_id"),
        _choice(e, "Phone", "Email", "").alias("contact_channel"),
        _choice(e, "Reached - support plan agreed", "Voicemail left", "Service provided")
        .alias("contact_outcome"),
        F.when(value < 20, "Open").when(value < 50, "In progress").otherwise("Closed")
        .alias("status"),
        F.when(value >= 50, F.date_add("day", F.floor("value").cast("int") % 21))
        .alias("closed_date"),
        F.when(early, F.col("first")).alias("linked_alert_id"))


def _units(b: Bound) -> DataFrame:
    key = F.col("p_partkey")
    return b.table("part").select(
        _text(key).alias("unit_code"), F.col("p_name").alias("unit_name"),
        _choice(key, *(p[0] for p in PROGRAMS), "RETIRED").alias("program_code"),
        (key % 3 + 1).alias("year_level"), F.lit("0.125").alias("eftsl"))


def _postcodes(b: Bound) -> DataFrame:
    return b.postcodes.join(b.regions, F.col("postcode") == F.col("n_nationkey")).select(
        _text("postcode").alias("postcode"), F.left("r_name", F.lit(2)).alias("state"),
        "ses_quartile", "remoteness")


FRAMES = {"banner_students": _students, "banner_enrolments": _enrolments,
          "canvas_activity": _activity, "crm_cases": _cases, "alerts_history": _alerts,
          "ref_postcode_ses": _postcodes, "ref_units": _units,
          "ref_advisors": lambda b: b.advisors.select(
              "advisor_id", "advisor_name", F.col("covered_campuses").alias("campuses"))}


def run_references(b: Bound) -> References:
    campuses = b.table("region").select(
        F.col("r_name").alias("campus_code"), F.concat(F.lit("Campus "), F.col("r_name"))
        .alias("campus_name"), F.left("r_name", F.lit(2)).alias("state"))
    return References(references.term_rows(b.spark, HALF_YEARS), b.synonyms, campuses, b.programs,
                      b.rates)


_written: dict[tuple[str, str], tuple[dict, str]] = {}


def write_extracts(b: Bound) -> str:
    """The extracts below one folder, written once for tables that have not changed."""
    key = b.spark.sparkContext.applicationId, b.folder
    now = Files(b.spark, b.folder).fingerprint(f"{t}.parquet" for t in TABLE_SCHEMAS)
    have = _written.get(key)
    if have is None or have[0] != now:
        folder = scratch_path(b.spark, "extracts")
        for name, frame in FRAMES.items():
            write_table(frame(b).select(*staging.EXTRACTS[name]), f"{folder}/{name}.csv", "csv")
        have = _written[key] = now, folder
    return have[1]


def run_store(b: Bound, name: str) -> Store:
    """One for each folder of tables, in the folder that is dropped with the application."""
    place = hashlib.md5(b.folder.encode()).hexdigest()[:12]
    app = b.spark.sparkContext.applicationId
    return Store(b.spark, f"{shared_dir(b.spark)}/tutela/{app}/{name}-{place}")


def run_version(b: Bound, *wanted: str) -> Version:
    """The warehouse of a whole run over the extracts; queries of one session share it. A query that
    reads a few tables of it names them, and the run goes no further than these need."""
    return build_version(b.spark, write_extracts(b), run_store(b, "warehouse"), run_references(b),
                         RUN_MAX_YEAR, wanted=wanted or None)
