from datetime import date

import pytest
from pyspark.sql import functions as F

from tutela.plans import quality, references, reports, scoring, security, staging
from tutela.plans.metrics import (MEASURES, RELATIONSHIPS, Model, default_summary, mean_of, path,
                                  sum_of)


@pytest.fixture(scope="module")
def model(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)
    return Model({
        "dim_student": df([("a", "Online", "P1"), ("b", "On-campus", "P1"), ("c", "Online", "P9")],
                          "student_id string, mode string, program_code string"),
        "dim_program": df([("P1", "Health", "Nursing")],
                          "program_code string, field string, program_name string"),
        "dim_term": df([("T1", False), ("T2", True)], "term_code string, is_current boolean"),
        "dim_campus": df([("NSY", "North Sydney")], "campus_code string, campus_name string"),
        "dim_advisor": df([("ADV01", "Mia", "mia@x"), ("ADV09", "Amira", "amira@x")],
                          "advisor_id string, advisor_name string, upn string"),
        "fact_enrolment": df(
            [("a", "T1", "NSY", "HD", 90.0, 0.125, 0.125, "Completed"),
             ("a", "T1", "NSY", "IP", None, 0.125, 0.0, "In progress"),
             ("b", "T1", "XXX", None, 105.0, 0.125, 0.0, "Completed"),
             ("zz", "T2", "NSY", "NN", 20.0, 0.125, 0.0, "Withdrawn pre-census")],
            "student_id string, term_code string, campus_code string, grade string, mark double, "
            "eftsl_certified double, eftsl_passed double, enrolment_status string"),
        "fact_alert": df(
            [("a", "T2", "Open - awaiting triage", None), ("a", "T1", "Open - awaiting triage", 3),
             ("b", "T2", "Actioned - case opened", 5), ("b", "T2", "Covered by same-term case", 3)],
            "student_id string, term_code string, lifecycle_status string, days_to_action int"),
        "fact_case": df([("1", "ADV01", "Early alert", "Reached - x", 4),
                         ("2", "ADV09", "Self-referral", "was reached", None),
                         ("3", None, "Early alert", None, 9)],
                        "case_id string, advisor_id string, source string, "
                        "contact_outcome string, days_open int"),
        "mart_retention_cohort": df(
            [("Non-equity", 2023, 0.8), ("Low SES", 2023, 0.7), ("Non-equity", 2024, 0.9)],
            "cohort string, commencing_year int, retention_rate double"),
        "mart_triage_current": df(
            [("a", "P2 - x", "ADV01"), ("b", "P1 - y", "ADV09"), ("b", "P1 - y", None)],
            "student_id string, priority_tier string, advisor_id string"),
        "mart_nbf_funding": df([(2026, "Low SES", 4124, 2, 8248, 1, 0.5),
                                (2025, "Low SES", 4124, 9, 37116, 9, 1.0)],
                               "commencing_year int, nbf_category string, indicative_rate int, "
                               "commencing_students bigint, indicative_funding bigint, "
                               "students_with_support_case bigint, support_coverage double"),
    })


def test_cards_over_one_table(model):
    r = reports.exec_cards(model).first()
    assert (r.headcount, r.success_rate, r.eftsl_certified, r.average_mark,
            r.pre_census_withdrawals) == (3, pytest.approx(1 / 3), 0.5, 55.0, 1)


def test_in_progress_stays_in_the_other_rate(model):
    r = model.evaluate(["success_rate_all", "success_rate"]).first()
    assert (r.success_rate_all, r.success_rate) == (0.25, pytest.approx(1 / 3))


def test_unmatched_rows_form_a_blank_group(model, rows):
    got = rows(model.evaluate(["headcount"], by=["dim_program.field"]))
    assert got == [("Health", 2), (None, 1)]


def test_matrix_has_subtotals(model, rows):
    got = rows(reports.program_matrix(model).select("field", "program_name", "level", "headcount"))
    assert got == [("Health", "Nursing", 0, 2), ("Health", None, 1, 2), (None, None, 0, 1),
                   (None, None, 1, 1), (None, None, 2, 3)]


def test_measures_of_two_tables_side_by_side(model, rows):
    got = rows(model.evaluate(["headcount", "alerts_raised"], by=["dim_term.term_code"]))
    assert got == [("T1", 2, 1), ("T2", 1, 3)]
    r = model.evaluate(["headcount", "alerts_raised"]).first()
    assert tuple(r) == (3, 4)


def test_alert_measures(model):
    r = model.evaluate(["alerts_raised", "alerts_actioned", "alert_action_rate",
                        "median_days_to_action", "open_alerts_current"]).first()
    assert tuple(r) == (4, 2, 0.5, 3.0, 1)


def test_case_measures(model):
    r = model.evaluate(["cases_opened", "reach_rate", "median_days_case_open"]).first()
    assert tuple(r) == (3, 1.0, 6.5)


def test_triage_measures(model, rows):
    r = model.evaluate(["students_on_list", "p1_students", "tier_colour"]).first()
    assert tuple(r) == (2, 1, "#F2B8B5")
    assert rows(reports.caseload(model)) == [("ADV01", 1), ("ADV09", 1), (None, 1)]


def test_filters_reach_related_tables_only(model):
    r = model.evaluate(["headcount", "nbf_commencing_students"],
                       where={"dim_student.mode": ["Online"]}).first()
    assert tuple(r) == (1, 11)
    assert reports.equity_cards(model).first().nbf_indicative_funding == 8248
    assert reports.nbf_table(model).first().support_coverage == 0.5


def test_retention_gap_replaces_the_cohort_filter(model, rows):
    by = ["mart_retention_cohort.cohort", "mart_retention_cohort.commencing_year"]
    got = rows(model.evaluate(["retention_gap"], by=by))
    assert got == [("Low SES", 2023, pytest.approx(-0.1)), ("Non-equity", 2023, 0.0),
                   ("Non-equity", 2024, 0.0)]
    only = model.evaluate(["retention_gap"],
                          where={"mart_retention_cohort.cohort": ["Low SES"]}).first()
    assert only.retention_gap == pytest.approx(0.7 - 0.85)


def test_roles(model):
    def n(role, table):
        return security.scoped_model(model, security.role_predicate(role)).tables[table].count()
    assert [n("Manager", t) for t in ("fact_case", "mart_triage_current", "dim_advisor")] == [3, 3, 2]
    assert [n("Advisor_ADV01", t) for t in ("fact_case", "mart_triage_current", "dim_advisor")] \
        == [1, 1, 1]
    assert n("Advisor_ADV01", "fact_enrolment") == 4


def test_signed_in_user(model):
    cases, advisors = model.tables["fact_case"], model.tables["dim_advisor"]
    assert security.restrict_for_user(cases, advisors, "amira@x").count() == 1
    assert security.restrict_for_user(cases, advisors, "Mia", by="advisor_name").count() == 1
    assert security.restrict_for_user(cases, advisors, "nobody@x").count() == 0
    assert security.restrict_for_user(cases, advisors, "boss@x", is_manager=True).count() == 3
    assert security.restrict_for_user(cases, advisors).count() == 0    # the session's own user


def test_default_summaries_and_ad_hoc_measures(model):
    assert default_summary("mart_nbf_funding", "commencing_students", "bigint") == "sum"
    assert default_summary("mart_nbf_funding", "indicative_rate", "int") == "none"
    assert default_summary("dim_student", "atar", "double") == "none"
    assert default_summary("fact_case", "status", "string") == "none"
    r = model.evaluate([("s", sum_of("mart_nbf_funding.commencing_students")),
                        ("m", mean_of("mart_nbf_funding.support_coverage"))]).first()
    assert tuple(r) == (11, 0.75)


def test_registry_is_complete():
    assert len(RELATIONSHIPS) == 14 and len(MEASURES) == 25 and len(reports.VISUALS) == 21
    assert [s[2] for s in path("fact_alert", "dim_program")] == ["dim_student", "dim_program"]


# ------------------------------------------------------------------- scoring --
@pytest.fixture(scope="module")
def raw(spark):
    people = spark.range(1, 2001).select(
        F.col("id").cast("string").alias("student_id"),
        F.concat(F.lit("Name"), F.col("id")).alias("first_name"), F.lit("Last").alias("last_name"),
        F.lit("2000-03-04").alias("dob"), F.lit("P").alias("program_code"),
        F.lit("2024S1").alias("commencing_term"), F.lit("NSY").alias("campus_code"),
        F.lit("80").alias("atar"), F.lit("N").alias("first_nations_flag"),
        F.lit("N").alias("disability_flag"), F.lit("N").alias("nesb_flag"),
        F.lit("completed").alias("student_status"))
    units = spark.range(1, 2001).select(
        F.col("id").cast("string").alias("student_id"), F.lit("U1").alias("unit_code"),
        F.lit("2024S1").alias("term_code"),
        F.element_at(F.array(*[F.lit(c) for c in ("NSY", "MEL", "BRI", "STR", "CAN")]),
                     (F.col("id") % 5 + 1).cast("int")).alias("campus_code"),
        F.lit("Completed").alias("enrolment_status"), F.lit("PA").alias("grade"),
        F.when(F.col("id") % 10 > 0, "60.0").alias("mark"), F.lit("0.125").alias("eftsl"),
        F.lit("2024-03-01").alias("census_date"))
    return people, units


RATES = dict.fromkeys(scoring.RATES, 0.2)


def test_injection_is_logged_repeatable_and_near_its_rate(raw):
    people, units, log = scoring.inject_all(*raw, RATES, seed=3)
    n = {r.defect_type: r["count"] for r in log.groupBy("defect_type").count().collect()}
    assert set(n) == set(scoring.RATES)
    assert 300 < n["duplicate_student"] < 500 and 300 < n["name_whitespace_case"] < 600
    assert people.count() == 2000 + n["duplicate_student"]
    again = scoring.inject_all(*raw, RATES, seed=3)[2]
    assert log.exceptAll(again).count() == 0 == again.exceptAll(log).count()
    assert people.select("student_id").distinct().count() == people.count()
    marks = {r.mark for r in units.select("mark").distinct().collect()}
    assert marks == {"60.0", "105.0", "-1.0", None}


def test_rules_catch_what_was_injected(spark, raw):
    people, units, log = scoring.inject_all(*raw, RATES, seed=3)
    from tutela.plans import dimensions, identity
    students = staging.stage_students(people)
    synonyms = references.synonym_rows(spark)
    enrol = staging.stage_enrolments(units, synonyms)
    survivors = identity.survivorship(students, enrol)
    dedup = identity.drop_duplicates_by(students, survivors)
    judged = quality.judge_enrolments(enrol, students, synonyms)
    act = spark.createDataFrame([], "student_id string, term_code string, week_number int")
    issues = quality.issue_log(survivors, dedup, judged, act, students)
    got = {r.defect_type: r for r in scoring.catch_rate(log, issues, dedup).collect()}
    for kind in ("duplicate_student", "mark_out_of_range", "campus_code_variant",
                 "name_whitespace_case", "dob_format_dmy"):
        assert got[kind].handled == got[kind].injected > 0, kind
    # flags blanked on a duplicate row vanish with it, so the true ratio is below one
    flags = got["missing_equity_flag"]
    assert 0.7 < flags.share < 1
    assert got["TOTAL"].injected == log.count()
    assert dimensions.PREPARED_SCORE == 80 and date(2000, 3, 4) == dedup.first().dob


def test_unhandled_state_counts_all_or_nothing(spark):
    log = spark.createDataFrame([("name_whitespace_case", "t", "1", "x"),
                                 ("name_whitespace_case", "t", "2", "x"),
                                 ("dob_format_dmy", "t", "2", "x"),
                                 ("campus_code_variant", "t", "k", "x")],
                                "defect_type string, table string, row_key string, detail string")
    issues = spark.createDataFrame([("R03_unknown_campus", "k")], "rule_id string, row_key string")
    dim = spark.createDataFrame([(" Ann", date(2000, 1, 1))], "first_name string, dob date")
    got = {r.defect_type: (r.injected, r.handled) for r in scoring.catch_rate(log, issues, dim).collect()}
    assert got == {"name_whitespace_case": (2, 0), "dob_format_dmy": (1, 1),
                   "campus_code_variant": (1, 0), "TOTAL": (4, 1),
                   # of these nothing was injected
                   "duplicate_student": (0, 0), "missing_equity_flag": (0, 0),
                   "mark_out_of_range": (0, 0)}
    noted = {r.defect_type: r.share for r in scoring.catch_rate(log, issues, dim).collect()}
    assert noted["mark_out_of_range"] == 1 and noted["name_whitespace_case"] == 0
    unknown = spark.createDataFrame([("Ann", None)], "first_name string, dob date")
    turned = {r.defect_type: r.handled for r in scoring.catch_rate(log, issues, unknown).collect()}
    assert turned["name_whitespace_case"] == 2 and turned["dob_format_dmy"] == 0


def test_pivot_loses_no_value(spark):
    from tutela.operators.aggregates import pivot_sum
    df = spark.createDataFrame([("a", 1, 2), ("a", 9, 5), ("a", None, 7)],
                               "k string, y int, v int")
    got = pivot_sum(df, ["k"], "y", [1, 2], v="v").first()
    assert (got.v_1, got.v_2, got.v_other) == (2, None, 12)
    with pytest.raises(Exception, match="unlisted"):
        pivot_sum(df, ["k"], "y", [1, 2], rest=None, v="v").collect()


def test_group_sizes_count_missing_keys_and_can_be_split(spark):
    from tutela.operators.joins import with_group_size
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "k string, n int")
    got = sorted(tuple(r)[2] for r in with_group_size(df, ["k", "n"], "size").collect())
    assert got == [1, 2, 2]
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
                                      .alias("k"), F.repeat(F.lit("x"), 200).alias("pad"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = with_group_size(rows, ["k"], "size")
        assert out.count() == 40_000
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution()
        out.collect()
        assert "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_calendar_goes_by_date(spark):
    from tutela.catalog import bindings
    got = spark.sql("SELECT stack(4, timestamp_ntz'2024-01-01 05:00', timestamp_ntz'2024-01-31', "
                    "timestamp_ntz'2024-02-01', timestamp_ntz'2023-12-31') AS ts").select(
        bindings.calendar_day("ts")).collect()
    assert [r[0] for r in got] == [1, 31, 32, 0]
