"""All visuals of a page from one reduction of each table."""

import pytest
from pyspark.sql import functions as F

from tutela.plans import reports
from tutela.plans.metrics import MEASURES, Model, Reduced
from tutela.session import keep


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")
    n = 3000
    frames = {
        "fact_enrolment": spark.range(n).select(
            F.when(F.col("id") < 1000, "s1").otherwise(F.concat(F.lit("s"), F.col("id") % 97))
            .alias("student_id"),
            F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("T"), F.col("id") % 4))
            .alias("term_code"),
            F.concat(F.lit("C"), F.col("id") % 3).alias("campus_code"),
            F.lit(0.125).alias("eftsl_certified"),
            F.when(F.col("id") % 5 == 0, 0.0).otherwise(0.125).alias("eftsl_passed"),
            F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 120).cast("double"))
            .alias("mark"),
            F.when(F.col("id") % 11 == 0, "IP").otherwise("PA").alias("grade"),
            F.when(F.col("id") % 13 == 0, "Withdrawn pre-census").otherwise("Completed")
            .alias("enrolment_status")),
        "fact_alert": spark.range(n).select(
            F.concat(F.lit("s"), F.col("id") % 97).alias("student_id"),
            F.concat(F.lit("T"), F.col("id") % 4).alias("term_code"),
            F.when(F.col("id") % 3 == 0, F.col("id") % 20).alias("days_to_action"),
            F.when(F.col("id") % 3 == 0, "Actioned - case opened")
            .otherwise("Open - awaiting triage").alias("lifecycle_status")),
        "mart_triage_current": spark.range(90).select(
            F.concat(F.lit("s"), "id").alias("student_id"),
            F.concat(F.lit("ADV"), F.col("id") % 4).alias("advisor_id"),
            F.concat(F.lit("P"), F.col("id") % 3 + 1, F.lit(" - x")).alias("priority_tier")),
        "dim_student": spark.range(95).select(
            F.concat(F.lit("s"), "id").alias("student_id"), F.when(F.col("id") % 2 == 0, "Online")
            .otherwise("On-campus").alias("mode"),
            F.concat(F.lit("P"), F.col("id") % 5).alias("program_code")),
        "dim_program": spark.range(4).select(
            F.concat(F.lit("P"), "id").alias("program_code"), F.concat(F.lit("N"), "id")
            .alias("program_name"), F.concat(F.lit("F"), F.col("id") % 2).alias("field")),
        "dim_term": spark.range(4).select(F.concat(F.lit("T"), "id").alias("term_code"),
                                          (F.col("id") == 3).alias("is_current")),
        "dim_campus": spark.range(2).select(F.concat(F.lit("C"), "id").alias("campus_code"),
                                            F.concat(F.lit("N"), "id").alias("campus_name"))}
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}, str(folder)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["executive", "triage"])
def test_a_page_equals_its_visuals_and_scans_each_fact_once(tables, rows, name):
    frames, folder = tables
    written = []

    def write(df, home):
        written.append(plan(df))
        return keep(df, home)
    found = reports.page(Model(frames), name, write)
    facts = {"executive": ["fact_enrolment"],
             "triage": ["mart_triage_current", "fact_alert"]}[name]
    assert len(written) == len(facts)
    for fact in facts:
        assert sum(p.count(f"{folder}/{fact}]") for p in written) == 1
    for visual in reports.PAGES[name]:
        shared = found[visual.__name__]
        assert not any(f"{folder}/{fact}]" in plan(shared) for fact in facts)
        assert rows(shared) == rows(visual(Model(frames))), visual.__name__


def test_all_measures_of_a_table_from_one_reduction(tables, rows):
    frames, _ = tables
    names = [n for n, m in MEASURES.items() if m.table == "fact_alert"]

    def by_mode(m):
        return m.evaluate(names, by=["dim_student.mode"])

    def current(m):
        return m.evaluate(names, where={"dim_term.is_current": [True]})
    model = Model(frames).for_page([by_mode, current])
    assert isinstance(model.reduced["fact_alert"], Reduced)
    for visual in (by_mode, current):
        assert rows(visual(model)) == rows(visual(Model(frames)))

    def other(m):  # needs a key that the page did not ask for: the table itself answers
        return m.evaluate(["alerts_raised"], by=["fact_alert.lifecycle_status"])
    assert rows(other(model)) == rows(other(Model(frames)))


def test_a_role_does_not_see_what_was_reduced_for_all(tables, rows):
    frames, _ = tables
    model = Model(frames).for_page(reports.PAGES["triage"])
    mine = {"mart_triage_current": frames["mart_triage_current"].filter("advisor_id = 'ADV1'")}
    assert rows(reports.caseload(model.scoped(mine))) == rows(
        reports.caseload(Model(frames).scoped(mine)))
    empty = {n: df.limit(0) for n, df in frames.items()}
    got = reports.page(Model(empty), "executive")
    assert got["exec_cards"].first().headcount == 0 and got["success_campus"].count() == 0
