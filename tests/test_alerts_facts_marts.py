import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tutela.plans import alerts, dimensions, facts, marts, references

TERMS = [("T1", "2024-01-01", "2024-01-10", 13, 2024, "S1", False),
         ("T2", "2024-07-01", "2024-07-10", 13, 2024, "S2", True)]
NO_MAP = "duplicate_id string, surviving_id string"
A = "student_id string, term_code string, week_number int, week_start date, logins int, " \
    "page_views int, items_due int, submitted_on_time int, submitted_late int, missed int"


@pytest.fixture(scope="module")
def terms(spark):
    return references.term_rows(spark, TERMS)


@pytest.fixture(scope="module")
def survivors(spark):
    return spark.createDataFrame([("dup", "s1")], NO_MAP)


def weekly_rules(rows, t):
    """Brute force: walk each student-term week by week."""
    out = set()
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), {})[r[2]] = r
    for (sid, term), weeks in groups.items():
        due = ontime = missed = 0
        fired = set()
        for w in sorted(weeks):
            r = weeks[w]
            due, ontime, missed = due + r[6], ontime + r[7], missed + r[9]
            two = r[4] + (weeks[w - 1][4] if w - 1 in weeks else 0)
            tests = {alerts.INACTIVITY: two <= t.inactivity_logins,
                     alerts.NON_SUBMISSION: missed >= t.missed_items,
                     alerts.LOW_ONTIME: w >= 6 and due >= 3 and ontime * 10 < 4 * due}
            for reason, hit in tests.items():
                if t.first_week <= w <= t.last_week and hit and reason not in fired:
                    fired.add(reason)
                    out.add((sid, term, w, reason))
    return out


def make_activity(seed, students=60):
    rnd = random.Random(seed)
    rows = []
    for s in range(students):
        for term, start in (("T1", date(2024, 1, 1)), ("T2", date(2024, 7, 1))):
            for w in range(1, rnd.choice([4, 8, 13]) + 1):
                due = rnd.choice([0, 0, 1, 2])
                on = rnd.randint(0, due)
                late = rnd.randint(0, due - on)
                rows.append((f"s{s}", term, w, start + timedelta(days=7 * (w - 1)),
                             rnd.choice([0, 0, 1, 2, 5]), 0, due, on, late, due - on - late))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_alert_rules_match_a_weekly_walk(spark, terms, seed):
    rows = make_activity(seed)
    t = alerts.Thresholds()
    got = alerts.alert_rules(spark.createDataFrame(rows, A), terms, t).collect()
    assert {(r.student_id, r.term_code, r.week_number, r.reason_code) for r in got} \
        == weekly_rules(rows, t)
    assert len({r.alert_id for r in got}) == len(got)
    for r in got[:20]:
        start = date(2024, 1, 1) if r.term_code == "T1" else date(2024, 7, 1)
        assert r.raised_date == start + timedelta(days=7 * (r.week_number - 1) + 2)


def test_rules_read_activity_columns_only(spark, terms):
    """Who a student is must not enter the rules."""
    df = spark.createDataFrame(make_activity(3), A).withColumn("first_nations", F.lit("Yes"))
    used = alerts.with_signals(df).columns
    assert set(used) == {"student_id", "term_code", "week_number", *alerts.COUNTS, "logins_2wk",
                         "cum_due", "cum_on_time", "cum_missed"}


def test_hot_student_week_is_reduced_before_the_window(spark, terms):
    """A third of all rows repeat one student's weeks."""
    rows = make_activity(4, 30)
    hot = [("hot", "T1", 1 + i % 13, date(2024, 1, 1), 0, 0, 0, 0, 0, 0) for i in range(600)]
    got = alerts.alert_rules(spark.createDataFrame(rows + hot, A), terms).filter(
        "student_id = 'hot'").collect()
    assert [(r.week_number, r.reason_code) for r in got] == [(3, alerts.INACTIVITY)]


def test_severity(spark):
    rows = [("a", "T1", w, date(2024, 1, 1), 0, 0, 2, 0, 0, 2) for w in range(1, 9)]
    act = spark.createDataFrame(rows, A)
    raised = alerts.alert_rules(act, references.term_rows(spark, TERMS))
    got = alerts.severity(raised, act).collect()
    assert [tuple(r) for r in got] == [("a", "T1", 3, 2, True)]


C = "case_id string, student_id string, term_code string, opened_date date, source string, " \
    "case_type string, seheef_activity string, seheef_life_stage string, advisor_id string, " \
    "contact_channel string, contact_outcome string, status string, closed_date date, " \
    "linked_alert_id string"


def case(cid, sid, term="T1", opened=date(2024, 2, 1), source="Early alert", advisor="ADV01",
         outcome="Voicemail left", status="Closed", closed=None, alert=None):
    return (cid, sid, term, opened, source, "Type", "Activity", "Stage", advisor, "Phone", outcome,
            status, closed, alert)


@pytest.fixture(scope="module")
def fact_case(spark, survivors):
    return facts.fact_case(spark.createDataFrame([
        case("C2", "s1", alert="A1", opened=date(2024, 1, 1)),
        case("C1", "dup", alert="A1", opened=date(2024, 1, 20), closed=date(2024, 1, 18),
             outcome="Reached - declined support"),
        case("C3", "s2", term="T2", opened=date(2024, 7, 5), advisor="ADV05", status="Open"),
        case("C4", "s2", term="T2", opened=date(2024, 7, 5), advisor="ADV07", status="Open"),
        case("C5", "s3", term="T2", source="Self-referral")], C), survivors)


@pytest.fixture(scope="module")
def fact_alert(spark, fact_case, terms, survivors):
    raised = spark.createDataFrame([
        ("A1", "dup", "T1", 4, date(2024, 1, 24), "R1"), ("A2", "s1", "T1", 4, date(2024, 1, 24), "R2"),
        ("A3", "s3", "T1", 5, date(2024, 2, 1), "R1"), ("A4", "s3", "T2", 5, date(2024, 8, 1), "R1"),
        ("A5", "s2", "T2", 5, date(2024, 8, 1), "R2"), ("A6", "s3", "T2", 6, date(2024, 8, 8), "R2"),
        ("A7", "s4", "T9", 6, date(2024, 8, 8), "R2")],
        "alert_id string, student_id string, term_code string, week_number int, raised_date date, "
        "reason_code string")
    return facts.fact_alert(raised, fact_case, terms, survivors)


def test_alert_lifecycle(fact_alert):
    got = {r.alert_id: (r.student_id, r.lifecycle_status, r.actioned_case_id, r.days_to_action)
           for r in fact_alert.collect()}
    assert got == {
        "A1": ("s1", facts.ACTIONED, "C1", -4),         # the lowest case id, a negative delay
        "A2": ("s1", facts.COVERED, None, None),
        "A3": ("s3", facts.MONITORED, None, None),
        "A4": ("s3", facts.OPEN, None, None),           # a self-referral does not cover
        "A5": ("s2", facts.COVERED, None, None),
        "A6": ("s3", facts.OPEN, None, None)}           # an unknown term drops the alert


def test_days_open(fact_case):
    assert {r.case_id: r.days_open for r in fact_case.collect()} == {
        "C1": -2, "C2": None, "C3": None, "C4": None, "C5": None}


P = "student_id string, first_name string, last_name string, program_code string, mode string, " \
    "citizenship string, postcode string, atar double, first_nations string, disability string, " \
    "student_status string, commencing_term string, attendance_type string, campus_code_raw string"


def person(sid, citizenship="Domestic", postcode="1", atar=None, fn="No", dis="No",
           status="active", term="2024S1", mode="On-campus", campus="NSY"):
    return (sid, "A", "B", "BNURS", mode, citizenship, postcode, atar, fn, dis, status, term,
            "Full-time", campus)


@pytest.fixture(scope="module")
def postcodes(spark):
    return spark.createDataFrame([("1", 1, "Regional"), ("2", 3, "Metropolitan")],
                                 "postcode string, ses_quartile int, remoteness string")


def test_derived_attributes(spark, postcodes):
    df = dimensions.dim_student(spark.createDataFrame([
        person("a"), person("b", fn="Yes"), person("c", atar=80.0), person("d", postcode="2"),
        person("e", postcode="2", fn="Yes"), person("f", citizenship="International", fn="Yes"),
        person("g", citizenship=None), person("h", postcode="9")], P), postcodes)
    got = {r.student_id: (r.low_ses, r.regional_remote, r.nbf_equity_cohort, r.nbf_category)
           for r in df.collect()}
    assert got == {
        "a": ("Yes", "Yes", "Yes", "Low SES"), "b": ("Yes", "Yes", "Yes", "Low SES + First Nations"),
        "c": ("Yes", "Yes", "Yes", "Low SES (high preparedness)"),
        "d": ("No", "No", "No", "Not applicable"), "e": ("No", "No", "Yes", "First Nations"),
        "f": ("No", "No", "No", "Not applicable"),
        "g": ("No", "No", "No", "Low SES"),             # unknown citizenship falls through
        "h": ("No", "No", "No", "Not applicable")}


def test_executive_without_certified_load(spark, postcodes):
    students = dimensions.dim_student(spark.createDataFrame([person("a"), person("b")], P), postcodes)
    enrol = spark.createDataFrame(
        [("a", "T", "NSY", 0.0, 0.0, None, "Withdrawn pre-census"),
         ("b", "T", "STR", 0.25, 0.125, 70.0, "Completed"),
         ("b", "T", "STR", 0.25, 0.0, 105.0, "Completed"),
         ("zz", "T", "STR", 9.0, 9.0, 50.0, "Completed")],
        "student_id string, term_code string, campus_code string, eftsl_certified double, "
        "eftsl_passed double, mark double, enrolment_status string")
    got = {r.campus_code: r for r in marts.mart_executive(
        enrol, students, references.program_rows(spark)).collect()}
    assert got["NSY"].success_rate is None and got["NSY"].avg_mark is None
    assert got["NSY"].withdrawals_pre_census == 1
    assert (got["STR"].headcount, got["STR"].success_rate, got["STR"].avg_mark) == (1, 0.25, 70.0)


def test_retention_asks_for_the_next_year(spark, postcodes):
    students = dimensions.dim_student(spark.createDataFrame([
        person("a", term="2023S1"), person("b", term="2023S1"), person("c", term="2023S2"),
        person("d", term="2023S1", status="completed"), person("e", term="2026S1"),
        person("f", term="2023S1", citizenship="International")], P), postcodes)
    seen = spark.createDataFrame([("a", 2024), ("b", 2025), ("e", 2027), ("f", 2024)],
                                 "student_id string, year int")
    flags = marts.retention_flag(students, seen, 2025)
    assert {r.student_id: r.retained_y1 for r in flags.collect()} == {"a": 1, "b": 0, "c": 0, "d": 1}
    mart = {r.cohort: (r.students, r.retention_rate) for r in marts.retention(flags).collect()}
    assert mart == {"All domestic": (4, 0.5), "Low SES": (4, 0.5), "Regional/remote": (4, 0.5)}


def test_triage(spark, postcodes, fact_alert, fact_case, terms):
    students = dimensions.dim_student(spark.createDataFrame([
        person("s1"), person("s2"), person("s3", campus="CAN"),
        person("s4", status="discontinued")], P), postcodes)
    act = spark.createDataFrame([("s3", "T2", 8, 5, 1), ("s3", "T2", 7, 2, 1), ("s3", "T2", 6, 9, 9)],
                                "student_id string, term_code string, week_number int, "
                                "logins int, missed int")
    advisors = spark.createDataFrame([("ADV08", "BRI|CAN"), ("ADV01", "NSY|STR")],
                                     "advisor_id string, covered_campuses string")
    got = {r.student_id: r for r in marts.triage(
        fact_alert, act, students, references.program_rows(spark), fact_case, advisors,
        terms).collect()}
    assert set(got) == {"s2", "s3"}
    # equal dates: the higher case id decides; no activity reads as zero
    assert (got["s2"].advisor_id, got["s2"].logins_last2wk) == ("ADV07", 0)
    assert got["s2"].priority_tier == marts.P4            # covered, but no case of its own alert
    # a self-referral in the term gives s3 its advisor
    assert (got["s3"].advisor_id, got["s3"].priority_tier) == ("ADV01", marts.P1)
    assert (got["s3"].logins_last2wk, got["s3"].reasons, got["s3"].alert_count) == (7, "R1, R2", 2)


def test_effect_input(spark, postcodes, fact_alert, terms):
    students = dimensions.dim_student(spark.createDataFrame([
        person("s1", term="T1"), person("s3", status="completed", mode="Online")], P), postcodes)
    act = spark.createDataFrame(
        [("s1", "T1", w, w, 1) for w in range(1, 9)],
        "student_id string, term_code string, week_number int, logins int, missed int")
    enrol = spark.createDataFrame([("s1", "T2")], "student_id string, term_code string")
    got = {r.student_id: r for r in marts.effect_input(
        fact_alert, act, students, enrol, terms).collect()}
    a = got["s1"]
    assert (a.alert_week, a.reasons_at_alert, a.contacted) == (4, 2, 1)
    assert (a.logins_2wk_at_alert, a.pre_missed, a.first_term, a.retained_next_term) == (7, 3, True, 1)
    b = got["s3"]
    assert (b.logins_2wk_at_alert, b.pre_missed, b.online, b.retained_next_term) == (0, 0, True, 1)
    strict = {r.student_id: r.retained_next_term for r in marts.effect_input(
        fact_alert, act, students, enrol, terms, strict_outcome=True).collect()}
    assert strict == {"s1": 1, "s3": 0}


def test_trend_counts_a_student_once_per_week(spark, postcodes):
    students = dimensions.dim_student(spark.createDataFrame([person("a"), person("b")], P), postcodes)
    act = spark.createDataFrame([("a", "T1", 1, 4, 0, 0), ("a", "T1", 1, 2, 0, 0),
                                 ("b", "T1", 1, 3, 0, 0)],
                                "student_id string, term_code string, week_number int, "
                                "logins int, missed int, items_due int")
    got = [tuple(r) for r in marts.trend(act, students).collect()]
    assert got == [("T1", 1, "On-campus", "Yes", 2, 3.0, None)]
