from datetime import date

import pytest
from pyspark.sql import functions as F

from tutela.operators import filters, joins
from tutela.plans import identity, quality, references

S = "student_id string, first_name string, last_name string, dob date, program_code string, " \
    "commencing_term string"
D = date(2000, 1, 1)


@pytest.fixture(scope="module")
def people(spark):
    data = [("1", "Ann", "A", D, "P", "T"), ("2", "Ann", "A", D, "P", "T"),
            ("3", "Ann", "A", D, "P", "T"),                       # three-way, none active
            ("4", "Bob", "B", D, "P", "T"), ("5", "Bob", "B", D, "P", "T"),
            ("6", "Bob", "B", D, "P", "T"),                       # one active: 6
            ("7", "Cat", "C", D, "P", "T"), ("8", "Cat", "C", D, "P", "T"),
            ("9", "Cat", "C", D, "P", "T"),                       # two active: 8, 9
            ("10", "Dan", "D", None, "P", "T"), ("11", "Dan", "D", None, "P", "T"),
            ("12", "Eve", "E", D, "P", "T"), (None, "Fay", "F", D, "P", "T")]
    return spark.createDataFrame(data, S)


@pytest.fixture(scope="module")
def active(spark):
    return spark.createDataFrame([("6",), ("8",), ("9",), ("9",), ("11",)], "student_id string")


def test_survivorship(people, active, rows):
    got = dict(rows(identity.survivorship(people, active)))
    assert got == {"2": "1", "3": "1", "4": "6", "5": "6", "7": "8", "9": "8", "10": "11"}


def test_map_never_leads_to_a_duplicate(people, active, rows):
    got = dict(rows(identity.survivorship(people, active)))
    assert not set(got) & set(got.values())


def test_dedup_and_remap(spark, people, active, rows):
    m = identity.survivorship(people, active)
    left = {r[0] for r in identity.drop_duplicates_by(people, m).select("student_id").collect()}
    assert left == {"1", "6", "8", "11", "12"}
    facts = spark.createDataFrame([("4", 1), ("6", 2), (None, 3)], "student_id string, x int")
    assert rows(identity.remap(facts, m)) == [("6", 1), ("6", 2), (None, 3)]


def test_survivorship_with_one_huge_group(spark, rows):
    """A third of all people share one key; nothing is lost and nothing is gathered."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("student_id"),
        F.when(F.col("id") < n // 3, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("k"))
    active = spark.range(500, 501).select(F.col("id").alias("student_id"))
    m = identity.survivorship(df, active, ["k"])
    assert m.count() == n // 3 - 1
    assert [r[0] for r in m.select("surviving_id").distinct().collect()] == [500]
    assert "Window" not in m._jdf.queryExecution().executedPlan().toString()


E = "student_id string, unit_code string, term_code string, campus_code string, " \
    "campus_code_raw string, enrolment_status string, grade string, mark double, eftsl double"


@pytest.fixture(scope="module")
def judged(spark, people):
    def row(sid, unit, campus, mark):
        return (sid, unit, "T1", campus, campus, "Completed", "PA", mark, 0.125)
    data = [row("1", "U0", "NSY", 0.0), row("1", "U1", "NSY", 100.0), row("1", "U2", "NSY", -1.0),
            row("1", "U3", "NSY", 105.0), row("1", "U4", None, 50.0), row("1", "U5", "XXX", 50.0),
            row("1", "U6", "XXX", 105.0), row("99", "U7", "NSY", 50.0),
            row("99", None, "NSY", 50.0), row("1", "U8", "NSY", 105.0), row("1", "U8", "NSY", 60.0),
            row("2", "U9", "NSY", None), row("1", "UN", "NSY", float("nan"))]
    df = spark.createDataFrame(data, E)
    return quality.judge_enrolments(df, people, references.synonym_rows(spark))


def test_rules_and_quarantine(judged):
    got = {(r.rule_id, r.row_key, r.detail) for r in quality.enrolment_issues(judged).collect()}
    assert ("R02_mark_out_of_range", "1|U2|T1", "mark=-1.0") in got
    assert ("R03_unknown_campus", "1|U6|T1", "campus_code=XXX") in got
    assert ("R02_mark_out_of_range", "1|U6|T1", "mark=105.0") in got
    assert ("R06_orphan_enrolment", None, "no student record") in got   # NULL unit: NULL key
    assert not any(k and ("|U4|" in k or "|U0|" in k or "|U1|" in k or "|U9|" in k)
                   for _, k, _ in got)
    rule = {(r.student_id, r.unit_code): r.reject_rule
            for r in quality.quarantine(judged).collect()}
    assert rule[("1", "U6")] == "R02_mark_out_of_range"
    assert rule[("1", "U5")] == "R03_unknown_campus"
    assert rule[("99", None)] == "R06_orphan_enrolment"
    assert rule[("1", "UN")] == "R02_mark_out_of_range"     # NaN sorts above every number


def test_clean_works_by_key(judged):
    rejected = quality.quarantine(judged)
    clean = quality.clean(judged, rejected)
    kept = sorted((r.student_id, str(r.unit_code)) for r in clean.collect())
    # both U8 rows go; the rejected row without a unit matches nothing and stays
    assert kept == [("1", "U0"), ("1", "U1"), ("1", "U4"), ("2", "U9"), ("99", "None")]


def test_student_rules(spark):
    df = spark.createDataFrame(
        [("1", "Unknown", "Unknown", "Yes", D), ("2", "No", "Unknown", "No", None),
         ("3", "No", "No", "Unknown", date(1935, 12, 31)), ("4", "No", "No", "No", date(2011, 1, 1))],
        "student_id string, first_nations string, disability string, nesb string, dob date")
    got = {(r.rule_id[:3], r.row_key, r.detail) for r in quality.student_issues(df).collect()}
    assert got == {("R04", "1", "first_nations_flag"), ("R04", "2", "disability_flag"),
                   ("R05", "2", "unparseable"), ("R05", "3", "1935-12-31")}


def test_summary_has_a_quarantine_row_even_if_empty(judged):
    none = judged.filter("false")
    s = quality.summarise(quality.enrolment_issues(none), quality.quarantine(none)).collect()
    assert [(r.rule_id, r.issues) for r in s] == [("quarantined_enrolment_rows", 0)]
    full = quality.summarise(quality.enrolment_issues(judged), quality.quarantine(judged))
    both = quality.findings_total(full).first()[0]
    assert both - quality.findings_total(full, False).first()[0] == \
        quality.quarantine(judged).count()


def test_integrity_assertion(judged, people):
    with pytest.raises(ValueError, match="2 rows"):
        quality.assert_no_orphans(judged, people)


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 500), (2, None, None), (3, "z", 7)],
                               "id int, ref string, mark int")
    ref = spark.createDataFrame([("a",)], "ref string")
    got = sorted((r.rule_id, r.row_key) for r in quality.check_constraints(
        df, "t", pk=["id"], fks=[("ref", ref, "ref")], required=["ref"],
        checks={"mark": F.col("mark").between(0, 100)}).collect())
    assert got == [("CK_mark", "1"), ("FK_ref", "3"), ("NN_ref", "2"), ("PK_id", "1")]


@pytest.mark.parametrize("ref,want", [
    ([("a",)], ["b"]), ([("a",), (None,)], []), ([], [None, "a", "b"])])
def test_not_in_three_valued(spark, ref, want):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    r = spark.createDataFrame(ref, "y string")
    got = [row[0] for row in filters.not_in(df, "x", r, "y").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_orphans_count_missing_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    ref = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in joins.orphans(df, ref, ["k"]).collect()] == [None]


def test_hot_groups_are_split_at_run_time(spark, rows):
    """A third of all people carry one key: the join back to the group must not
    end in one task."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 300_000
        df = spark.range(n, numPartitions=8).select(
            F.col("id").alias("student_id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
            .alias("k"))
        m = identity.survivorship(df, spark.range(1).select(F.col("id").alias("student_id")), ["k"])
        assert len(m.collect()) == n // 3 - 1
        assert "skew=true" in m._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
