import csv
import json

import pytest
from pyspark.sql import functions as F

from tutela import sources
from tutela.plans import build, staging
from tutela.sources.text import malformed_records, well_formed


def test_text_csv(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('id,name,note\n007,"O""Brien, Ann",""\n8,  Bo ,\n', encoding="utf-8")
    for cols in (None, ["id", "name", "note"]):
        got = [tuple(r) for r in sources.read_text_csv(spark, str(p), cols).collect()]
        assert got == [("007", 'O"Brien, Ann', None), ("8", "  Bo ", None)]
    with pytest.raises(Exception):
        sources.read_text_csv(spark, str(p), ["id", "other", "note"]).collect()


def test_records_that_do_not_fit_are_kept_apart_or_stop_the_job(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('id,name\n1,a\n2,b,c\n3\n4,"two\nlines"\n', encoding="utf-8")
    with pytest.raises(Exception):
        sources.read_text_csv(spark, str(p), ["id", "name"]).collect()
    raw = sources.read_text_csv(spark, str(p), ["id", "name"], malformed=True)
    bad = malformed_records(raw, "x").collect()
    assert [("2", "2,b,c"), ("3", "3")] == [(r.row_key, r.record) for r in bad][:2]
    assert 'lines"' in [r.record for r in bad]  # the second half of the broken line
    raw = sources.read_text_csv(spark, str(p), ["id", "name"], multi_line=True, malformed=True)
    assert [tuple(r) for r in well_formed(raw).collect()] == [("1", "a"), ("4", "two\nlines")]
    assert {r.row_key for r in malformed_records(raw, "x").collect()} == {"2", "3"}


def test_a_second_run_leaves_no_partition_of_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([("T1", 1), ("T2", 2)], "term_code string, n int")
    assert sources.write_table(two, path, partition_by=["term_code"]) == 2
    one = two.filter("term_code = 'T1'")
    assert sources.write_table(one, path, partition_by=["term_code"], only_partitions=True) == 1
    assert spark.read.parquet(path).count() == 2
    assert sources.write_table(one, path, partition_by=["term_code"]) == 1
    assert spark.read.parquet(path).count() == 1


def test_typed_csv_selects_by_header(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b,c\n1,75F,2024-01-02\nx,3.5,2024\n")
    got = sources.read_typed_csv(spark, str(p), {"c": "date", "b": "double", "a": "bigint"})
    assert got.dtypes == [("c", "date"), ("b", "double"), ("a", "bigint")]
    assert [(str(r.c), r.b, r.a) for r in got.collect()] == [("2024-01-02", None, 1),
                                                             ("None", 3.5, None)]


def test_csv_round_trip_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'say "hi", you'), (None, "b")], "x string, y string")
    assert sources.write_table(df, str(tmp_path / "t"), "csv") == 2
    back = sources.read_text_csv(spark, str(tmp_path / "t"), ["x", "y"])
    assert set(map(tuple, back.collect())) == {(" a ", 'say "hi", you'), (None, "b")}


def test_layout_prunes_partitions(spark, tmp_path):
    df = spark.range(100).select(F.concat(F.lit("T"), F.col("id") % 4).alias("term_code"),
                                 F.lit("x").alias("lifecycle_status"), "id")
    assert sources.write_tables({"fact_alert": df}, str(tmp_path)) == {"fact_alert": 100}
    one = spark.read.parquet(f"{tmp_path}/fact_alert").filter("term_code = 'T1'")
    assert one.count() == 25
    assert "PartitionFilters: [isnotnull(term_code" in \
        one._jdf.queryExecution().executedPlan().toString()


def test_manifest(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text(json.dumps({"seed": 7, "students": 3, "injected_effect":
                             {"p_effect_if_reached": 0.65}}, indent=2))
    r = sources.read_manifest(spark, str(p)).first()
    assert (r.seed, r.students, r.injected_effect.p_effect_if_reached) == (7, 3, 0.65)


# ------------------------------------------------------------- the whole run --
def write_extract(folder, name, rows):
    with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(staging.EXTRACTS[name])
        w.writerows(rows)


def student(sid, first, dob, status="active", campus="NSY", term="2025S1", fn="N"):
    return [sid, first, "Lee", dob, "F", "Domestic", "2000", "NSW", campus, "BNURS", term,
            "Full-time", "On-campus", "u25", "School", "85", fn, "N", "", status, ""]


def unit(sid, code, term, campus="NSY", mark="60", status="Completed", grade="PA"):
    return [sid, code, term, campus, status, grade, mark, "0.125", "2025-03-21"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    src = tmp_path_factory.mktemp("raw")
    write_extract(src, "banner_students", [
        student("1001", "  ANN", "2000-01-02"), student("1002", "Ann ", "02/01/2000"),   # one person
        student("1003", "Bob", "31/02/2020", fn=""), student("1004", "Cy", "1999-05-06", "completed")])
    write_extract(src, "banner_enrolments", [
        unit("1001", "U1", "2025S1"), unit("1001", "U1", "2026S1", " nth sydney ", "", "In progress", "IP"),
        unit("1003", "U1", "2025S1", "Melb"), unit("1003", "U2", "2025S1", mark="105"),
        unit("1003", "U3", "2025S1", "Mars"), unit("9999", "U1", "2025S1"),
        unit("1004", "U1", "2025S1", grade="WW", status="Withdrawn pre-census", mark="")])
    write_extract(src, "canvas_activity", [
        [s, t, w, "2026-02-23", 1, 5, 1, 0, 0, 1] for s in ("1002", "1003", "8888")
        for t in ("2025S1", "2026S1") for w in range(1, 9)])
    write_extract(src, "alerts_history", [
        ["A1", "1002", "2025S1", 3, "2025-03-12", "INACTIVITY_14D"],
        ["A2", "1003", "2025S1", 3, "2025-03-12", "NON_SUBMISSION"],
        ["A3", "1003", "2026S1", 4, "2026-03-18", "NON_SUBMISSION"]])
    write_extract(src, "crm_cases", [
        ["C1", "1002", "2025S1", "2025-03-20", "Early alert", "T", "Academic support",
         "Participation", "ADV01", "Phone", "Reached - declined support", "Closed", "2025-03-30", "A1"]])
    write_extract(src, "ref_postcode_ses", [["2000", "NSW", 1, "Regional"]])
    write_extract(src, "ref_units", [["U1", "Unit", "BNURS", 1, "0.125"]])
    write_extract(src, "ref_advisors", [["ADV01", "Mia", "NSY|STR"]])
    out = tmp_path_factory.mktemp("out")
    counts = build.build(spark, str(src), f"{out}/wh", f"{out}/dq")
    return counts, lambda layer, name: spark.read.parquet(f"{out}/{layer}/{name}")


def test_run_counts(run):
    counts, _ = run
    assert counts["dim_student"] == 3 and counts["fact_enrolment"] == 4
    assert counts["fact_engagement_week"] == 32 and counts["rej_enrolments"] == 3
    assert counts["mart_triage_current"] == 1 and counts["mart_effectiveness_input"] == 2


def test_run_issue_log(run):
    _, read = run
    got = sorted((r.rule_id[:3], r.row_key) for r in read("dq", "dq_issues").collect())
    assert [g for g in got if g[0] != "R07"] == [
        ("R01", "1002"), ("R02", "1003|U2|2025S1"), ("R03", "1003|U3|2025S1"), ("R04", "1003"),
        ("R05", "1003"), ("R06", "9999|U1|2025S1")]
    assert sum(g[0] == "R07" for g in got) == 16
    assert read("dq", "dq_issues").filter("loaded_at IS NULL").count() == 0


def test_run_follows_the_survivor(run):
    _, read = run
    assert {r.student_id for r in read("wh", "fact_case").collect()} == {"1001"}
    alerts = {r.alert_id: (r.student_id, r.lifecycle_status) for r in read("wh", "fact_alert").collect()}
    assert alerts == {"A1": ("1001", "Actioned - case opened"), "A2": ("1003", "Monitored - no contact"),
                      "A3": ("1003", "Open - awaiting triage")}
    campuses = {(r.student_id, r.term_code): r.campus_code
                for r in read("wh", "fact_enrolment").collect()}
    assert campuses[("1001", "2026S1")] == "NSY" and campuses[("1003", "2025S1")] == "MEL"


def test_run_outcomes(run):
    _, read = run
    eff = {r.student_id: (r.contacted, r.retained_next_term)
           for r in read("wh", "mart_effectiveness_input").collect()}
    assert eff == {"1001": (1, 0), "1003": (0, 0)}      # next term is 2025S2
    flags = {(r.cohort, r.students, r.retention_rate)
             for r in read("wh", "mart_retention_cohort").collect()}
    assert ("All domestic", 3, 0.6667) in flags
    dq = {r.rule_id[:11]: r.issues for r in read("wh", "mart_dq_summary").collect()}
    assert dq["quarantined"] == 3


def test_shared_folder_comes_from_the_session():
    from types import SimpleNamespace

    from tutela.session import shared_dir

    def session(conf, master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)),
                               sparkContext=SimpleNamespace(master=master))
    assert shared_dir(session({"spark.checkpoint.dir": "s3a://b/ck/"}, "yarn")) == "s3a://b/ck"
    assert "tutela" in shared_dir(session({}, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session({}, "spark://host"))


def test_kept_tables_lie_in_the_shared_folder(spark):
    from tutela.session import keep, shared_dir
    kept = keep(spark.range(5), "five")
    assert kept.count() == 5
    assert shared_dir(spark) in kept.inputFiles()[0]


def test_partitioned_write_gathers_rows_by_partition(spark, tmp_path):
    df = spark.range(1000, numPartitions=16).select(
        F.when(F.col("id") % 3 > 0, "T1").otherwise("T2").alias("term_code"), "id")
    sources.write_table(df, str(tmp_path / "t"), partition_by=["term_code"])
    files = spark.read.parquet(str(tmp_path / "t")).inputFiles()
    assert len(files) == 2


def test_audit_of_the_warehouse(run):
    from tutela.plans.constraints import RULES, audit
    _, read = run
    tables = {n: read("dq" if n == "dq_issues" else "wh", n) for n in RULES}
    assert audit(tables).collect() == []
    broken = {**tables,
              "dim_advisor": tables["dim_advisor"].unionByName(tables["dim_advisor"]),
              "dim_campus": tables["dim_campus"].filter("campus_code <> 'MEL'"),
              "fact_enrolment": tables["fact_enrolment"].withColumn(
                  "mark", F.when(F.col("mark").isNotNull(), 101.0))}
    got = {(r.rule_id, r.table_name) for r in audit(broken).collect()}
    assert got == {("PK_advisor_id", "dim_advisor"), ("FK_campus_code", "fact_enrolment"),
                   ("CK_mark", "fact_enrolment")}


def test_shared_frames_go_when_their_owner_is_done(spark):
    import os

    from tutela.catalog.bindings import Bound
    from tutela.session import drop
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("supplied tables not present")
    first, second = Bound(spark, folder), Bound(spark, folder)
    for b in (first, second):
        b.share("students")
        b.students.count()
    mine, theirs = (b.written[0].removeprefix("file:") for b in (first, second))
    assert os.path.isdir(mine)
    first.close()
    assert not os.path.isdir(mine) and os.path.isdir(theirs) and second.students.count() > 0
    with pytest.raises(ValueError):
        drop(spark, folder)
