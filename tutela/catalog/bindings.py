"""The supplied tables in the shape of the institution's sources.

Customers are students, line items are enrolments, events are activity and
cases. Two calendars are used: half-years 1995S1..2001S2 for enrolments, and
three ten-day terms of January 2024 for activity, one day standing for a week.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tutela.operators.joins import apart
from tutela.plans import (alerts, dimensions, evaluation, facts, fairness, identity, marts, quality,
                          references, staging)
from tutela.plans.metrics import Model
from tutela.session import drop, keep
from tutela.sources import lookup

HALF_YEARS = [(f"{y}S{h}", f"{y}-{'01' if h == 1 else '07'}-01", f"{y}-{'02' if h == 1 else '08'}-01",
               26, y, f"S{h}", (y, h) == (2001, 2)) for y in range(1995, 2002) for h in (1, 2)]
TEN_DAYS = [("2024T1", "2024-01-01", "2024-01-04", 10, 2024, "T1", False),
            ("2024T2", "2024-01-11", "2024-01-14", 10, 2024, "T2", False),
            ("2024T3", "2024-01-21", "2024-01-24", 10, 2024, "T3", True)]
DAYS, TERM_DAYS = 30, 10
PROGRAMS = [("AUTOMOBILE", "Automobile program", "Engineering"),
            ("BUILDING", "Building program", "Engineering"),
            ("FURNITURE", "Furniture program", "Design"),
            ("HOUSEHOLD", "Household program", "Design"),
            ("MACHINERY", "Machinery program", "Engineering")]
ADVISORS = [(f"ADV{i:02d}", f"Advisor {i}", campuses, f"adv{i:02d}@example.org")
            for i, campuses in enumerate([
                "AFRICA|AMERICA", "AFRICA|ASIA", "AMERICA|ASIA", "EUROPE", "EUROPE|MIDDLE EAST",
                "ASIA|EUROPE", "MIDDLE EAST", "AFRICA", "ASIA", "AMERICA"], 1)]
# declared, so that opening a table costs no job that reads footers
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
THRESHOLDS = alerts.Thresholds(first_week=3, last_week=10, inactivity_logins=0, missed_items=6,
                               ontime_from_week=6, ontime_min_due=3, ontime_num=2, ontime_den=10)
MATCH_KEYS = ("postcode", "program_code", "match_band")
MAX_YEAR = 2000
NBF_YEAR = 1995
CASE_TERM = "2024T"
# every fiftieth id of the facts belongs to nobody: it is moved beyond all customers
STRANGER, SHIFT = (50, 49), 10 ** 12


def half_year(day) -> Column:
    return F.concat(F.year(day).cast("string"), F.when(F.month(day) <= 6, "S1").otherwise("S2"))


def person(key: Column) -> Column:
    """The student of a fact row; one class of ids is sent where no customer is."""
    every, rest = STRANGER
    return F.when(key % every == rest, key + SHIFT).otherwise(key)


def calendar_day(ts) -> Column:
    """Days since the calendar's first day, from 1; below 1 or above ``DAYS`` is outside."""
    return F.date_diff(F.to_date(ts), F.lit(TEN_DAYS[0][1]).cast("date")) + 1


def ten_day_term(day) -> Column:
    return F.concat(F.lit(CASE_TERM), (F.floor((day - 1) / TERM_DAYS) + 1).cast("string"))


class frame:
    """A frame built on first use; written once if a plan declared it shared."""

    def __init__(self, build):
        self.build, self.__doc__ = build, build.__doc__

    def __set_name__(self, owner, name):
        self.name = name

    def __get__(self, bound, owner=None):
        if bound is None:
            return self
        df = self.build(bound)
        if self.name in bound.shared:
            df = keep(df, self.name, bound.written)
        bound.__dict__[self.name] = df
        return df


class Bound:
    """Lazily bound frames of one folder of tables.

    A frame with several consumers in one query is declared with ``share`` by
    the frame that brings them together. It is then written once, where
    otherwise each consumer would scan and join the source tables again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.shared: set[str] = set()
        self.written: list[str] = []
        self._tables: dict[str, DataFrame] = {}

    def share(self, *names: str) -> None:
        self.shared.update(names)

    def read_from(self, name: str, df: DataFrame) -> None:
        """From now on the frame is read from ``df``, a table that it was written to."""
        self.__dict__[name] = df

    def close(self) -> None:
        """Remove what was written for this folder's frames; they cannot be read any more."""
        for path in self.written:
            drop(self.spark, path)
        self.written.clear()

    def together(self, *names: str, after: str) -> None:
        """Write shared frames that build on ``after`` but not on each other at the
        same time, so that one with few tasks does not keep the cluster waiting."""
        self.share(after, *names)
        getattr(self, after)
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(lambda n: getattr(self, n)),
                          names))

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(
                f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # ------------------------------------------------------------ references --
    @frame
    def terms(self) -> DataFrame:
        return references.term_rows(self.spark, HALF_YEARS)

    @frame
    def tterms(self) -> DataFrame:
        return references.term_rows(self.spark, TEN_DAYS)

    @frame
    def programs(self) -> DataFrame:
        return references.program_rows(self.spark, PROGRAMS)

    @frame
    def rates(self) -> DataFrame:
        return references.rate_rows(self.spark)

    @frame
    def advisors(self) -> DataFrame:
        return lookup(self.spark, ADVISORS, "advisor_id string, advisor_name string, "
                                            "covered_campuses string, upn string")

    @frame
    def regions(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name")

    @frame
    def postcodes(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("postcode"), (key % 4 + 1).alias("ses_quartile"),
            F.when(key % 5 == 0, "Regional").when(key % 5 == 1, "Remote")
            .otherwise("Metropolitan").alias("remoteness"))

    @frame
    def synonyms(self) -> DataFrame:
        return self.regions.filter("n_nationkey < 24").select(
            F.upper(F.trim("n_name")).alias("variant"), F.col("r_name").alias("canonical"))

    # --------------------------------------------------------------- students --
    @frame
    def raw_students(self) -> DataFrame:
        """Customers as a text extract with all the usual noise."""
        key = F.col("c_custkey")
        day = F.date_add(F.lit("1970-01-01").cast("date"), (key % 9000).cast("int"))
        c = self.table("customer").join(self.regions, F.col("c_nationkey") == F.col("n_nationkey"))
        return c.select(
            F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("student_id"),
            F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "), F.col("c_name"), F.lit(" "))
            .alias("first_name"),
            F.concat(F.col("c_name"), F.lit(" ")).alias("last_name"),
            F.when(key % 97 == 0, None).when(key % 5 == 0, "31/02/2020")
            .when(key % 5 == 1, F.date_format(day, "dd/MM/yyyy"))
            .when(key % 5 == 2, day.cast("string")).when(key % 5 == 3, "2020")
            .otherwise("").alias("dob"),
            F.concat(F.lower("n_name"), F.lit(" ")).alias("campus_code"),
            F.when(key % 5 == 0, F.col("c_acctbal").cast("string")).when(key % 5 == 1, "75F")
            .when(key % 5 == 2, "").when(key % 5 == 3, "n/a").otherwise(" 12.5 ").alias("atar"),
            F.when(key % 4 == 0, "Y").when(key % 4 == 1, "N").when(key % 4 == 2, "")
            .alias("first_nations_flag"))

    @frame
    def students(self) -> DataFrame:
        """Staged students: all customers."""
        key = F.col("c_custkey")
        first = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            half_year(F.min("o_orderdate")).alias("commencing_term"))
        out = self.table("customer").join(first, "c_custkey", "left").join(
            self.regions, F.col("c_nationkey") == F.col("n_nationkey"))
        return out.select(
            key.alias("student_id"), F.substring("c_name", 1, 8).alias("first_name"),
            F.substr("c_name", F.lit(10)).alias("last_name"),
            F.when(key % 97 != 0, F.date_add(F.lit("1930-01-01").cast("date"),
                                             (key * 37 % 33000).cast("int"))).alias("dob"),
            F.col("c_mktsegment").alias("program_code"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Online").otherwise("On-campus")
            .alias("mode"),
            F.when(F.col("c_nationkey") % 10 == 0, "International").otherwise("Domestic")
            .alias("citizenship"),
            F.col("c_nationkey").alias("postcode"),
            F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 100).alias("atar"),
            F.when(key % 30 == 1, "Yes").when(key % 37 == 1, "Unknown").otherwise("No")
            .alias("first_nations"),
            F.when(key % 11 == 1, "Yes").when(key % 41 == 1, "Unknown").otherwise("No")
            .alias("disability"),
            F.when(key % 5 == 0, "Yes").otherwise("No").alias("nesb"),
            F.when(key % 4 == 0, "Part-time").otherwise("Full-time").alias("attendance_type"),
            F.when(key % 7 == 0, "completed").when(key % 7 == 1, "discontinued")
            .otherwise("active").alias("student_status"),
            F.col("r_name").alias("campus_code_raw"),
            F.floor(F.col("c_acctbal") / 1000).alias("match_band"), "commencing_term")

    @frame
    def active_ids(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus = 'P'").select(
            F.col("o_custkey").alias("student_id"))

    @frame
    def survivors(self) -> DataFrame:
        self.share("students")
        return identity.survivorship(self.students, self.active_ids, MATCH_KEYS)

    @frame
    def students_dedup(self) -> DataFrame:
        return identity.drop_duplicates_by(self.students, self.survivors)

    @frame
    def dim_student(self) -> DataFrame:
        self.share("students")
        return dimensions.dim_student(self.students_dedup, self.postcodes)

    # ------------------------------------------------------------- enrolments --
    @frame
    def places(self) -> DataFrame:
        """Suppliers with their nation as spelt and as a campus. Shared, because the planner takes
        the product of both sides as the size of a join: unless it sees the true one, all
        line items are moved to meet a small table."""
        place = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            "s_suppkey", "n_name", F.upper(F.trim("n_name")).alias("campus_code_raw"))
        return staging.resolve_campus(place, self.synonyms)

    @frame
    def enrolments(self) -> DataFrame:
        # spelling and term belong to the supplier and the order, so they are
        # settled there, before the rows of the line items multiply them
        self.share("places")
        place = self.places.select("s_suppkey", "campus_code_raw", "campus_code")
        order = self.table("orders").select(
            "o_orderkey", person(F.col("o_custkey")).alias("student_id"),
            half_year(F.col("o_orderdate")).alias("term_code"),
            (F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz")).alias("running"))
        rows = (self.table("lineitem").join(place, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(order, F.col("l_orderkey") == F.col("o_orderkey")))
        q, running = F.col("l_quantity"), F.col("running")
        gone = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        return rows.select(
            "student_id", F.col("l_partkey").alias("unit_code"), "term_code", "campus_code",
            "campus_code_raw", (q * 2 + 2).alias("mark"), F.lit(0.125).alias("eftsl"),
            F.when(gone, "Withdrawn pre-census").when(running, "In progress")
            .otherwise("Completed").alias("enrolment_status"),
            F.when(gone, "WW").when(running, "IP").when(q >= 41.5, "HD").when(q >= 36.5, "DI")
            .when(q >= 31.5, "CR").when(q >= 24, "PA").otherwise("NN").alias("grade"))

    @frame
    def judged(self) -> DataFrame:
        return quality.judge_enrolments(self.enrolments, self.students, self.synonyms)

    @frame
    def rejected(self) -> DataFrame:
        return quality.quarantine(self.judged)

    @frame
    def clean(self) -> DataFrame:
        self.share("enrolments", "students")
        return quality.clean(self.enrolments, self.rejected)

    @frame
    def fact_enrolment(self) -> DataFrame:
        self.together("survivors", "enrolments", after="students")
        return facts.fact_enrolment(self.clean, self.survivors)

    # --------------------------------------------------------------- activity --
    @frame
    def activity(self) -> DataFrame:
        """One row per user and day of the calendar, zero where nothing happened.

        Events are counted per user and day first; the thirty counts of a user
        then meet the calendar as a map, without joining users to days.
        """
        kinds = F.col("event_type")
        daily = self.table("events").groupBy("user_id", calendar_day("ts").alias("d")).agg(
            F.count_if(kinds.isin("view", "click")).alias("logins"),
            F.count_if(kinds == "purchase").alias("on_time"),
            F.count_if(kinds == "signup").alias("late"),
            F.count_if(kinds == "error").alias("missed"))
        # a day outside the calendar is counted in ``outside_calendar``, its user stays
        entry = F.when(F.col("d").between(1, DAYS), F.struct(
            "d", F.struct("logins", "on_time", "late", "missed")))
        users = daily.groupBy("user_id").agg(F.map_from_entries(F.collect_list(entry))
                                             .alias("days"))
        rows = users.select("user_id", "days",
                            F.explode(F.sequence(F.lit(1), F.lit(DAYS))).alias("d"))
        c = F.try_element_at("days", F.col("d"))
        zero = {n: F.coalesce(c[n], F.lit(0)) for n in ("logins", "on_time", "late", "missed")}
        d = F.col("d")
        return rows.select(
            person(F.col("user_id")).alias("student_id"), ten_day_term(d).alias("term_code"),
            ((d - 1) % TERM_DAYS + 1).alias("week_number"),
            F.date_add(F.lit("2024-01-01").cast("date"), d - 1).alias("week_start"),
            zero["logins"].alias("logins"),
            (zero["on_time"] + zero["late"] + zero["missed"]).alias("items_due"),
            zero["on_time"].alias("submitted_on_time"), zero["late"].alias("submitted_late"),
            zero["missed"].alias("missed"))

    @frame
    def outside_calendar(self) -> DataFrame:
        """Events of days that the calendar does not have, by kind: known, not silently lost."""
        return self.table("events").groupBy("event_type").agg(
            F.count_if(~F.coalesce(calendar_day("ts").between(1, DAYS), F.lit(False)))
            .alias("outside"), F.count(F.lit(1)).alias("events"))

    @frame
    def fact_engagement(self) -> DataFrame:
        self.share("students", "survivors")
        return facts.fact_engagement(self.activity, self.students, self.survivors)

    @frame
    def alerts(self) -> DataFrame:
        # unique per user, term and day by construction
        return alerts.alert_rules(self.activity, self.tterms, THRESHOLDS, collapse=False)

    @frame
    def case_rows(self) -> DataFrame:
        """Cases without their alerts, which most consumers do not need."""
        e = F.col("event_id")
        day = calendar_day("ts")
        ev = self.table("events").filter("event_type = 'signup'").filter(day.between(1, DAYS))
        return ev.select(
            e.alias("case_id"), person(F.col("user_id")).alias("student_id"),
            ten_day_term(day).alias("term_code"),
            F.col("ts").cast("date").alias("opened_date"),
            F.when(e % 8 == 0, "Early alert").when(e % 8 < 5, "Self-referral")
            .otherwise("Staff referral").alias("source"),
            F.concat(F.lit("Type "), (e % 4).cast("string")).alias("case_type"),
            F.concat(F.lit("Activity "), (e % 5).cast("string")).alias("seheef_activity"),
            F.concat(F.lit("Stage "), (e % 3).cast("string")).alias("seheef_life_stage"),
            F.concat(F.lit("ADV"), F.lpad((F.col("user_id") % 10 + 1).cast("string"), 2, "0"))
            .alias("advisor_id"),
            F.when(F.col("value") < 20, "Open").when(F.col("value") < 50, "In progress")
            .otherwise("Closed").alias("status"),
            F.when(e % 3 == 0, "Reached - support plan agreed").when(e % 3 == 1, "Voicemail left")
            .otherwise("Service provided").alias("contact_outcome"),
            F.when(F.col("value") >= 50, F.date_add(
                F.col("ts").cast("date"), F.floor("value").cast("int") % 21)).alias("closed_date"))

    @frame
    def cases(self) -> DataFrame:
        """Early-alert cases are linked to the first alert of the student-term."""
        self.share("activity", "alerts")
        first = self.alerts.groupBy("student_id", "term_code").agg(
            F.min("alert_id").alias("first_alert"))
        return (self.case_rows.join(apart(first), ["student_id", "term_code"], "left")
                .withColumn("linked_alert_id", F.when(F.col("source") == "Early alert",
                                                      F.col("first_alert"))).drop("first_alert"))

    @frame
    def fact_case(self) -> DataFrame:
        self.share("students", "survivors")
        return facts.fact_case(self.case_rows, self.survivors)

    @frame
    def fact_case_linked(self) -> DataFrame:
        self.share("students", "survivors", "activity", "alerts")
        return facts.fact_case(self.cases, self.survivors)

    @frame
    def fact_alert(self) -> DataFrame:
        self.share("activity", "fact_case_linked")
        self.together("survivors", "alerts", after="students")
        return facts.fact_alert(self.alerts, self.fact_case_linked, self.tterms, self.survivors)

    @frame
    def presence(self) -> DataFrame:
        """Who is there in which ten-day term: a purchase above 60."""
        day = calendar_day("ts")
        bought = self.table("events").filter("event_type = 'purchase' AND value > 60").filter(
            day.between(1, DAYS)).select(person(F.col("user_id")).alias("student_id"),
                                         ten_day_term(day).alias("term_code")).distinct()
        return identity.remap(bought, self.survivors)

    # ------------------------------------------------------------------- marts --
    @frame
    def executive(self) -> DataFrame:
        self.share("students", "survivors")
        return marts.mart_executive(self.fact_enrolment, self.dim_student, self.programs)

    @frame
    def retention_flags(self) -> DataFrame:
        self.share("students", "survivors")
        return marts.retention_flag(self.dim_student, marts.presence(self.fact_enrolment), MAX_YEAR)

    @frame
    def retention(self) -> DataFrame:
        return marts.retention(self.retention_flags)

    @frame
    def nbf(self) -> DataFrame:
        self.share("students", "survivors")
        return marts.nbf(self.dim_student, self.rates, self.fact_case)

    @frame
    def seheef(self) -> DataFrame:
        self.share("students", "survivors")
        return marts.seheef(self.fact_case, self.dim_student)

    @frame
    def triage(self) -> DataFrame:
        self.share("activity", "alerts", "students", "survivors")
        return marts.triage(self.fact_alert, self.fact_engagement, self.dim_student, self.programs,
                            self.fact_case, self.advisors, self.tterms)

    @frame
    def effect_input(self) -> DataFrame:
        self.share("activity", "alerts", "students", "survivors")
        return marts.effect_input(self.fact_alert, self.fact_engagement, self.dim_student,
                                  self.presence, self.tterms)

    @frame
    def trend(self) -> DataFrame:
        self.share("students", "survivors")
        return marts.trend(self.fact_engagement, self.dim_student)

    @frame
    def issues(self) -> DataFrame:
        self.together("survivors", "enrolments", after="students")
        return quality.issue_log(self.survivors, self.students_dedup, self.judged, self.activity,
                                 self.students)

    @frame
    def dq_summary(self) -> DataFrame:
        self.share("students", "survivors", "enrolments", "judged")
        return quality.summarise(self.issues, self.rejected)

    @frame
    def fairness(self) -> DataFrame:
        self.share("activity", "alerts", "students", "survivors")
        return fairness.fairness(self.fact_engagement, self.dim_student, self.effect_input,
                                 self.tterms)

    @frame
    def cells(self) -> DataFrame:
        return evaluation.cells(self.effect_input)

    def results(self) -> DataFrame:
        return evaluation.results(self.effect_input)

    # ------------------------------------------------------------------- model --
    @property
    def dim_term(self) -> DataFrame:
        return self.terms.unionByName(self.tterms)

    @property
    def dim_campus(self) -> DataFrame:
        name = F.col("r_name")
        return self.table("region").select(name.alias("campus_code"), name.alias("campus_name"))

    @property
    def dim_unit(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("unit_code"),
                                         F.col("p_name").alias("unit_name"))

    @property
    def model(self) -> Model:
        return Model(ModelTables(self))


MODEL_FRAMES = {
    "dim_student": "dim_student", "dim_term": "dim_term", "dim_campus": "dim_campus",
    "dim_program": "programs", "dim_advisor": "advisors", "dim_unit": "dim_unit",
    "fact_enrolment": "fact_enrolment", "fact_engagement_week": "fact_engagement",
    "fact_case": "fact_case", "fact_alert": "fact_alert", "mart_triage_current": "triage",
    "mart_retention_cohort": "retention", "mart_nbf_funding": "nbf",
    "mart_seheef_activity": "seheef", "mart_engagement_trend": "trend",
    "mart_dq_summary": "dq_summary", "mart_executive": "executive"}


class ModelTables(Mapping):
    """Model tables by name, bound when first asked for."""

    def __init__(self, bound: Bound):
        self.bound = bound

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self.bound, MODEL_FRAMES[name])

    def __iter__(self) -> Iterator[str]:
        return iter(MODEL_FRAMES)

    def __len__(self) -> int:
        return len(MODEL_FRAMES)
