"""Layout by student, functions and row filter for SQL users, sums free of order."""

import getpass

import pytest
from pyspark.sql import functions as F

from tutela import functions as fn
from tutela.functions import sql
from tutela.plans import marts, security
from tutela.sources.by_student import hot_keys, read_by_student, write_by_student


def facts(spark, n=4000, hot=0.4):
    """Rows of 300 students, one of them with a share of all."""
    return spark.range(n).select(
        F.when(F.col("id") < n * hot, "s7").otherwise(F.concat(F.lit("s"), F.col("id") % 300))
        .alias("student_id"), (F.col("id") % 7).alias("term"), F.col("id").alias("v"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_joins_and_windows_by_student_move_nothing(spark, tmp_path, no_broadcast):
    even = write_by_student(facts(spark, hot=0), f"{tmp_path}/f", 8, order=["term"])
    people = write_by_student(spark.range(400).select(
        F.concat(F.lit("s"), "id").alias("student_id"), F.col("id").alias("age")),
        f"{tmp_path}/d", 8)
    assert even.keys == () and people.keys == ()
    joined = even.join(people).groupBy("student_id", "age").agg(F.sum("v").alias("v"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert joined.agg(F.count("*"), F.sum("v")).first()[:] == (300, sum(range(4000)))
    last = even.per_student(lambda d: d.groupBy("student_id").agg(F.max_by("v", "term").alias("x")))
    assert "Exchange" not in last._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        even.join(write_by_student(facts(spark, 10, 0), f"{tmp_path}/o", 4))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_student_is_kept_apart_and_nothing_is_lost(spark, tmp_path, how, rows):
    df = facts(spark).unionByName(spark.createDataFrame(
        [(None, 1, -1), ("nobody", 1, -2)], "student_id string, term bigint, v bigint"))
    people = spark.range(400).select(F.concat(F.lit("s"), "id").alias("student_id"),
                                     F.col("id").alias("age"))
    fact = write_by_student(df, f"{tmp_path}/f", 8, order=["term"])
    dim = write_by_student(people, f"{tmp_path}/d", 8)
    assert fact.keys == ("s7",) == hot_keys(df, "student_id", 8)
    assert fact.hot.count() > 1600 and fact.even.filter("student_id = 's7'").count() == 0
    assert rows(fact.rows()) == rows(df)
    assert rows(fact.join(dim, how)) == rows(df.join(people, "student_id", how))
    if how != "left_anti":
        assert rows(dim.join(fact, how)) == rows(people.join(df, "student_id", how))
    count = fact.per_student(lambda d: d.groupBy("student_id").count())
    assert rows(count) == rows(df.groupBy("student_id").count())
    again = read_by_student(spark, f"{tmp_path}/f", df.schema, 8, fact.keys, order=["term"])
    assert rows(again.rows()) == rows(df)
    empty = write_by_student(df.limit(0), f"{tmp_path}/e", 8)
    assert empty.rows().count() == 0 and empty.keys == ()


# ----------------------------------------------------------------- functions --
TEXTS = [None, "", " ", "  mary ANN ", "Y", "N", "y", "75F", "7.5", " 12 ", "n/a", "31/12/1999",
         "31/02/2020", "1/2/2003", "1999-12-31", "1999", "1999-1-2", " 2001-03-04 ", "2023S1",
         "éCOLE o'NEIL", "HD", "NN", "WN", "IP", "1e3", "Withdrawn pre-census", "Completed"]


def test_sql_functions_say_what_the_columns_say(spark):
    names = sql.register(spark)
    spark.createDataFrame([(t, i / 3) for i, t in enumerate(TEXTS)], "s string, x double") \
        .createOrReplaceTempView("texts")
    columns = {
        "proper_case(s)": fn.proper_case("s"), "upper_trim(s)": fn.upper_trim("s"),
        "full_name(s, upper_trim(s))": fn.full_name("s", fn.upper_trim("s")),
        "tri_state(s)": fn.tri_state("s"), "number_or_null(s)": fn.to_double("s"),
        "iso_date(s)": fn.to_date("s"), "mixed_date(s)": fn.mixed_date("s"),
        "pass_flag(s)": fn.pass_flag("s"), "certified_load(s, x)": fn.certified_load("s", "x"),
        "passed_load(s, x)": fn.passed_load("s", "x"),
        "safe_ratio(x, x - 1)": fn.safe_ratio(F.col("x"), F.col("x") - 1)}
    assert {c.split("(")[0] for c in columns} | {"term_year"} == set(names)
    for text, column in columns.items():
        by_text = [r[0] for r in spark.sql(f"SELECT {text} FROM texts").collect()]
        assert by_text == [r[0] for r in spark.table("texts").select(column).collect()], text
    assert spark.sql("SELECT term_year('2023S1')").first()[0] == 2023
    plan = spark.sql("SELECT proper_case(s) FROM texts")._jdf.queryExecution().executedPlan()
    assert "upper(" in plan.toString() and "proper_case(" not in plan.toString().split("AS")[0]


def test_surviving_ids_by_sql(spark):
    sql.register_surviving(spark, spark.createDataFrame(
        [("2", "1"), ("3", "1")], "duplicate_id string, surviving_id string"))
    got = spark.sql("SELECT surviving(id) FROM VALUES ('1'), ('2'), ('9'), (NULL) AS t(id)")
    assert sorted(str(r[0]) for r in got.collect()) == ["1", "1", "9", "None"]


# ---------------------------------------------------------------- row filter --
def test_sql_users_see_their_rows_and_the_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(i, "A" if i % 3 else None if i % 2 else "B") for i in range(30)],
                          "case_id bigint, advisor_id string").write.parquet(f"{tmp_path}/c")
    cases = spark.read.parquet(f"{tmp_path}/c")
    me = spark.sql("SELECT current_user()").first()[0]
    assert me == getpass.getuser()

    def seen(*grants):
        security.declare_restricted(spark, "my_cases", cases, spark.createDataFrame(
            list(grants), "principal string, advisor_id string"))
        return spark.sql("SELECT * FROM my_cases()")
    assert {r.advisor_id for r in seen((me, "A"), ("other", "B")).collect()} == {"A"}
    assert seen((me, "B")).count() == cases.filter("advisor_id = 'B'").count()
    assert seen((me, None)).count() == 30
    assert seen(("other", None), ("third", "A")).count() == 0 and seen().count() == 0
    with pytest.raises(ValueError):
        seen((me, "A"), (me, "B"))
    one = seen((me, "A"))
    one.collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "DataFilters: [((advisor_id" in scan, scan


# ---------------------------------------------------------------- exact sums --
def test_executive_mart_does_not_depend_on_partitions(spark):
    n = 3000
    enrol = spark.createDataFrame(
        [(f"s{i % 50}", "T", "C", (i * 7919 % 1000) / 997, (i * 104729 % 1000) / 991,
          (i * 31 % 1000) / 9.7, "Completed") for i in range(n)],
        "student_id string, term_code string, campus_code string, eftsl_certified double, "
        "eftsl_passed double, mark double, enrolment_status string")
    people = spark.createDataFrame([(f"s{i}", "m", "P") for i in range(50)],
                                   "student_id string, mode string, program_code string")
    programs = spark.createDataFrame([("P", "F")], "program_code string, field string")
    seen = {repr(marts.mart_executive(enrol.orderBy(F.rand(k)).repartition(k), people, programs)
                 .collect()) for k in (1, 3, 7, 16)}
    assert len(seen) == 1
    row = marts.mart_executive(enrol, people, programs).first()
    exact = sum(round((i * 7919 % 1000) / 997, 6) for i in range(n))
    assert row.eftsl_certified == round(exact, 1) and row.headcount == 50
    odd = enrol.limit(2).withColumn("eftsl_certified", F.lit(float("nan")))
    assert marts.mart_executive(odd, people, programs).first().eftsl_certified is None
