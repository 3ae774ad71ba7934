"""Published versions, resumable runs, the audit, and the analyses that follow."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tutela.plans import analysis, build, constraints
from tutela.sources import Store, table_digest
from tutela.sources.publication import Files

FOLDER = "/root/testdata/sf0.001"
supplied = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")


# -------------------------------------------------------------------- digest --
SCHEMA = "a string, b bigint, c double, d boolean, e date, at timestamp"
ROWS = [("x|y", 1, 0.12346, True, None, None), ("x\\|y", None, -2.5, False, None, None),
        (None, 1, float("nan"), None, None, None), ("\\N", 1, float("inf"), None, None, None),
        ("", 7, 1e40, None, None, None), (None, 1, None, None, None, None)]


def plain_digest(rows):
    def text(v):
        if v is None:
            return "\\N"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            if v != v or abs(v) >= 1e30:
                return "nan" if v != v else "inf"
            return str(round(v * 10_000))
        return str(v).replace("\\", "\\\\").replace("|", "\\|")
    texts = ["|".join(map(text, r[:5])) for r in rows]
    return str(sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts))


def test_digest_counts_rows_whatever_their_order(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = table_digest(df, "t").first()
    assert (got.table_name, got.rows, got.digest) == ("t", 6, plain_digest(ROWS))
    other = df.orderBy(F.rand(3)).repartition(5).select("at", "e", "d", "c", "b", "a")
    assert table_digest(other, "t").first() == got
    assert table_digest(df.unionByName(df), "t").first().digest == plain_digest(ROWS * 2)
    assert table_digest(df.filter("b > 99"), "t").first()[1:] == (0, "0")


def test_rows_that_look_alike_have_other_digests(spark):
    def one(*row):
        return table_digest(spark.createDataFrame([row], "a string, b string"), "t").first().digest
    assert len({one("a|b", "c"), one("a", "b|c"), one("a\\", "b"), one(None, "x"), one("\\N", "x"),
                one("", "x"), one("x", None)}) == 7


# --------------------------------------------------------------- publication --
def frame(spark, n, plus=0):
    return spark.range(n).select((F.col("id") + plus).alias("n"))


def test_a_run_that_fails_between_two_tables_changes_nothing_for_readers(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.current()
    run = store.begin({"day": 1})
    run.stage("a", "x", lambda: {"one": frame(spark, 3)})
    run.stage("b", "y", lambda: {"two": frame(spark, 4)})
    run.publish()

    def fails():
        raise RuntimeError("lost")
    second = store.begin({"day": 2})
    second.stage("a", "x", lambda: {"one": frame(spark, 30)})
    with pytest.raises(RuntimeError):
        second.stage("b", "y", lambda: {"two": frame(spark, 40), "three": fails()})
    old = store.current()
    assert {n: old.read(n).count() for n in old.tables} == {"one": 3, "two": 4}
    assert old.broken() == [] and set(old.layer("y")) == {"two"}

    again = store.begin({"day": 2})  # takes up where it stopped
    got = again.stage("a", "x", lambda: pytest.fail("built twice"))
    again.stage("b", "y", lambda: {"two": got["one"].unionByName(frame(spark, 10, 30))})
    assert again.version == second.version and again.skipped == ["a"] and again.done == ["b"]
    assert store.current().version == old.version  # not before the manifest is there
    new = again.publish()
    assert {n: new.read(n).count() for n in new.tables} == {"one": 30, "two": 40}
    assert store.current().version == new.version and old.read("two").count() == 4


def test_a_published_run_costs_nothing_and_old_ones_can_go(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for day in (1, 2, 3, 4):
        run = store.begin({"day": day})
        run.stage("a", "x", lambda d=day: {"one": frame(spark, d)})
        if day != 2:  # never published
            run.publish()
    run = store.begin({"day": 4})
    run.stage("a", "x", lambda: pytest.fail("built twice"))
    assert run.publish().version == "v00000004" and store.versions() == [
        "v00000001", "v00000003", "v00000004"]
    assert store.prune(keep=2) == ["v00000001", "v00000002"]
    assert store.versions() == ["v00000003", "v00000004"]
    assert sorted(os.listdir(tmp_path / "tables")) == ["v00000003", "v00000004"]
    assert store.current().read("one").count() == 4


def test_a_table_cut_off_by_a_lost_task_is_written_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run = store.begin({})
    spoilt = f"{tmp_path}/tables/{run.version}/x/one"
    frame(spark, 99).write.parquet(spoilt)  # what a run left that ended while it wrote
    run.stage("a", "x", lambda: {"one": frame(spark, 2)})
    version = run.publish()
    assert version.read("one").count() == 2 and version.broken() == []
    frame(spark, 2, 5).write.mode("overwrite").parquet(spoilt)
    assert version.broken() == ["one"]


def test_small_files_appear_whole_and_once(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    files.write_new("a/b.json", "é")
    assert files.read("a/b.json") == "é" and files.read("a/c.json") is None
    with pytest.raises(FileExistsError):
        files.write_new("a/b.json", "other")
    assert files.read("a/b.json") == "é" and files.list("a") == ["b.json"]
    files.write_new("a/b.json", "new", replace=True)
    assert files.read("a/b.json") == "new" and files.list("none") == []
    before = files.fingerprint(["a"])
    files.write_new("a/d.json", "")
    assert files.fingerprint(["a"]) != before


# --------------------------------------------------------------------- audit --
RULES = {
    "dim": constraints.Rules(("k",), ("name",)),
    "fact": constraints.Rules(("k", "n"), ("v",), {"k": "dim"}, {"v": "v < 10"}),
    "loose": constraints.Rules((), ("v",)),
}


def audited(spark, dim, fact, loose=()):
    tables = {"dim": spark.createDataFrame(dim, "k string, name string"),
              "fact": spark.createDataFrame(fact, "k string, n int, v int"),
              "loose": spark.createDataFrame(list(loose), "v int")}
    return tables, sorted((r.table_name, r.rule_id, r.row_key, r.detail, r.rows)
                          for r in constraints.audit(tables, RULES).collect())


def test_audit_names_each_broken_rule(spark):
    _, found = audited(
        spark, [("a", "A"), ("b", None), ("b", "B"), (None, "N"), ("x|y", "X")],
        [("a", 1, 5), ("a", 1, 50), ("z", 1, None), ("z", 2, 1), (None, 3, 1), ("x|y", 1, 1),
         ("x", 1, 2), ("\\N", 1, 1)], [(None,), (None,), (1,)])
    assert found == sorted([
        ("dim", "PK_k", "b", "2 rows", 2), ("dim", "NN_name", "b", "missing", 1),
        ("dim", "NN_k", "\\N", "missing", 1), ("fact", "PK_k_n", "a|1", "2 rows", 2),
        ("fact", "CK_v", "a|1", "check failed", 1), ("fact", "NN_v", "z|1", "missing", 1),
        ("fact", "NN_k", "\\N|3", "missing", 1), ("fact", "FK_k", "z", "k=z", 2),
        ("fact", "FK_k", "x", "k=x", 1), ("fact", "FK_k", "\\\\N", "k=\\\\N", 1),
        ("loose", "NN_v", "", "missing", 2)])


def test_audit_scans_each_table_once_and_lists_met_rules(spark, tmp_path):
    tables, found = audited(spark, [("a", "A")], [("a", i, 1) for i in range(5000)])
    assert found == []
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in tables}
    plan = constraints.audit(read, RULES)._jdf.queryExecution().executedPlan().toString()
    for name in tables:
        assert plan.count(f"{tmp_path}/{name}]") == 1, plan
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("partial_") >= 1  # keys are counted before they move
    rows = constraints.audit_summary(read, RULES).collect()
    assert {(r.table_name, r.rule_id) for r in rows} == set(constraints.rule_list(read, RULES))
    assert {(r.broken_keys, r.broken_rows) for r in rows} == {(0, 0)} and len(rows) == 10
    empty = {n: df.limit(0) for n, df in read.items()}
    assert constraints.audit(empty, RULES).collect() == []
    assert constraints.audit({"fact": read["fact"]}, RULES).collect() == []  # nothing to refer to


# ------------------------------------------------------- whole run, analyses --
@pytest.fixture(scope="module")
def bound(spark):
    from tutela.catalog.bindings import Bound
    return Bound(spark, FOLDER)


@supplied
def test_a_run_that_breaks_off_goes_on_and_analyses_follow(spark, bound, tmp_path, monkeypatch):
    from tutela.catalog.extracts import RUN_MAX_YEAR, run_references, write_extracts
    source, refs = write_extracts(bound), run_references(bound)
    store = Store(spark, str(tmp_path / "wh"))

    def lost(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(build.facts, "fact_alert", lost)
        with pytest.raises(RuntimeError):
            build.build_version(spark, source, store, refs, RUN_MAX_YEAR)
    with pytest.raises(LookupError):
        store.current()
    with monkeypatch.context() as m:  # what is written is not planned again
        m.setattr(build.identity, "survivorship", lost)
        m.setattr(build.dimensions, "dim_student", lost)
        version = build.build_version(spark, source, store, refs, RUN_MAX_YEAR)
        assert version.broken() == [] and len(version.layer(build.WAREHOUSE)) == 18
    with monkeypatch.context() as m:
        m.setattr(build.marts, "mart_executive", lost)
        again = build.build_version(spark, source, store, refs, RUN_MAX_YEAR)
        assert again.version == version.version
    plain = build.build(spark, source, f"{tmp_path}/w", f"{tmp_path}/q", refs, RUN_MAX_YEAR)
    assert plain == {n: t.rows for n, t in version.tables.items()}

    results = Store(spark, str(tmp_path / "results"))
    with monkeypatch.context() as m:
        m.setattr(analysis.fairness, "fairness", lost)
        with pytest.raises(RuntimeError):
            analysis.analyse(spark, version, results, reps=20)
    with monkeypatch.context() as m:
        m.setattr(analysis.evaluation, "results", lost)
        done = analysis.analyse(spark, version, results, reps=20)
    assert set(done.tables) == {
        "constraint_report", "effectiveness_arms", "effectiveness_results",
        "effectiveness_verdict", "fairness_audit", "fairness_verdict", "headline"}
    assert done.broken() == [] and done.read("effectiveness_results").count() == 2
    with monkeypatch.context() as m:  # other choices are another version
        m.setattr(analysis, "audit_summary", lost)
        with pytest.raises(RuntimeError):
            analysis.analyse(spark, version, results, reps=30)
    assert results.current().version == done.version


# ---------------------------------------------------------------------- size --
def test_row_digests_are_made_once_a_row_from_compact_code(spark):
    from tutela.sources.digest import digest, with_row_digest
    wide = spark.range(20).select("id", *((F.col("id") / 7 - i).alias(f"d{i}") for i in range(4)), *(
        F.concat(F.lit(c * i), F.col("id").cast("string")).alias(f"s{i}")
        for i, c in enumerate("a|b\\cdefg")))
    rows = with_row_digest(wide)
    total = str(sum(r["__row_digest"] for r in rows.select("__row_digest").collect()))
    assert rows.agg(digest()).first()[0] == table_digest(wide, "t").first().digest == total
    plan = table_digest(wide, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.count("transform(") == 1


def test_digest_rounds_halves_and_large_numbers_as_before(spark):
    values = [0.00005, -0.00005, 0.00015, -0.00025, 1.00005, 99999999999.99995, 1e11, -1e12, 1.5e14,
              -0.0, 0.0, 1e-9, 4.9e-324, -0.00004999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    texts = [r[0] for r in df.select(F.round(F.col("v") * 10_000).cast("decimal(38,0)")
                                     .cast("string")).collect()]
    want = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts)
    assert table_digest(df, "t").first().digest == str(want)


def test_audit_counts_two_numbers_a_key_whatever_the_rules(spark):
    _, found = audited(spark, [("a", "A"), ("a", "B")], [("a", 1, None), ("a", 1, 50), ("c", 2, 1)])
    assert ("fact", "FK_k", "c", "k=c", 1) in found and len(found) == 5
    tables, _ = audited(spark, [("a", "A")], [("a", 1, 5)])
    plan = constraints.audit(tables, RULES)._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_" in line)
    assert partial.count("partial_") == 2


def test_line_items_are_not_moved_to_meet_their_suppliers(spark, tmp_path):
    from tutela.catalog import extracts
    from tutela.catalog.bindings import TABLE_SCHEMAS, Bound
    rows = {"nation": [(i, f"nation {i}", i % 5) for i in range(25)],
            "region": [(i, f"region {i}") for i in range(5)]}
    for name, schema in TABLE_SCHEMAS.items():
        df = spark.createDataFrame(rows.get(name, []), schema)
        if name == "supplier":
            df = spark.range(2_000).selectExpr(
                "id AS s_suppkey", "md5(string(id)) AS s_name", "int(id % 25) AS s_nationkey",
                "rand(1) AS s_acctbal")
        if name == "lineitem":
            df = spark.range(200_000).selectExpr(
                "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber",
                "double(id) AS l_quantity", "0D AS l_extendedprice", "0D AS l_discount", "0D AS l_tax",
                "'N' AS l_returnflag", "'O' AS l_linestatus",
                "timestamp_ntz'2000-01-01' AS l_shipdate")
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300k")  # more than the suppliers take
    b = Bound(spark, str(tmp_path))
    try:
        for frame in (b.enrolments, extracts._enrolments(b)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(l_suppkey" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        b.close()


def test_a_run_for_its_caller_makes_no_digests_and_a_later_one_adds_them(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = store.begin({"day": 1}, publishing=False)
    first.stage("a", "x", lambda: {"one": frame(spark, 3)})
    assert first.published() is None and first.so_far().read("one").count() == 3
    assert first.tables["one"].digest is None and store.versions() == []
    whole = store.begin({"day": 1})
    whole.stage("a", "x", lambda: pytest.fail("built twice"))
    whole.stage("b", "y", lambda: {"two": frame(spark, 4)})
    version = whole.publish()
    assert whole.skipped == ["a"] and version.broken() == []
    assert store.begin({"day": 1}, publishing=False).published().tables == version.tables
    again = store.begin({"day": 2}, publishing=False)
    again.stage("a", "x", lambda: {"one": frame(spark, 3)})
    frame(spark, 2).write.mode("overwrite").parquet(again.tables["one"].path)
    with pytest.raises(ValueError):  # other rows than were written
        store.begin({"day": 2}).stage("a", "x", lambda: pytest.fail("built twice"))


@pytest.fixture()
def two_students(spark, tmp_path):
    """Three units of customer 1 in two terms, one of customer 2."""
    from datetime import datetime

    from tutela.catalog.bindings import TABLE_SCHEMAS, Bound
    spring, autumn = datetime(2000, 2, 1), datetime(2000, 9, 1)
    rows = {"region": [(i, f"REGION {i}") for i in range(5)],
            "nation": [(i, f"NATION {i}", i % 5) for i in range(25)],
            "customer": [(i, f"Customer#{i}", i, 10.0, "BUILDING") for i in (1, 2)],
            "supplier": [(1, "s", 3, 0.0)], "part": [(i, "p", "b", "t", 1, 1.0) for i in range(4)],
            "orders": [(1, 1, "O", 1.0, spring, "1"), (2, 1, "O", 1.0, autumn, "1"),
                       (3, 2, "O", 1.0, autumn, "1")],
            "lineitem": [(o, p, 1, 1, 20.0, 1.0, 0.0, 0.0, "N", "O", spring)
                         for o, p in ((1, 1), (1, 2), (2, 3), (3, 1))],
            "events": [(i, datetime(2024, 1, 5), 1, kind, 30.0, "") for i, kind in
                       enumerate(("view", "purchase", "signup", "error"))]}
    for name, schema in TABLE_SCHEMAS.items():
        df = spark.createDataFrame(rows.get(name, []), schema)
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    bound = Bound(spark, str(tmp_path))
    yield bound
    bound.close()


def lost(*args):
    raise RuntimeError("not asked for")


def test_cleaning_by_sql_text_builds_the_survivors_and_no_more(two_students, monkeypatch):
    from tutela.catalog import run_queries
    from tutela.catalog.extracts import run_store
    with monkeypatch.context() as m:
        for module, name in ((build.facts, "fact_enrolment"), (build.quality, "judge_enrolments"),
                             (build.facts, "fact_case"), (build.marts, "mart_executive")):
            m.setattr(module, name, lost)
        got = run_queries.fn_sql_text(two_students).collect()
        assert sorted((r.student_id, r.full_name, r.year) for r in got) == [
            ("1", "Building N1", 2000), ("2", "Building N2", 2000)]
    assert run_store(two_students, "warehouse").versions() == []


def test_layout_by_student_builds_what_it_reads_and_no_more(two_students, monkeypatch):
    from tutela.catalog import run_queries
    from tutela.catalog.extracts import run_store
    with monkeypatch.context() as m:
        for module, name in ((build.quality, "issue_log"), (build.facts, "fact_case"),
                             (build.facts, "fact_engagement"), (build.marts, "mart_executive")):
            m.setattr(module, name, lost)
        got = run_queries.layout_by_student(two_students).collect()
        assert sorted((r.student_id, r.term_code, r.units, r.units_so_far) for r in got) == [
            ("1", "2000S1", 2, 2), ("1", "2000S2", 1, 3), ("2", "2000S2", 1, 1)]
    assert run_store(two_students, "warehouse").versions() == []


def test_enrolments_of_unknown_students_stop_a_run_for_its_caller_too(two_students, monkeypatch):
    from tutela.catalog.extracts import run_version
    monkeypatch.setattr(build.dimensions, "dim_student", lambda *a, was=build.dimensions.dim_student:
                        was(*a).filter("student_id <> '2'"))
    with pytest.raises(ValueError, match="1 rows"):
        run_version(two_students, "dim_student", "fact_enrolment")


def test_buckets_grow_with_the_table():
    from tutela.sources.by_student import ROWS_A_BUCKET, buckets_for
    assert [buckets_for(n, 16) for n in (0, 16 * ROWS_A_BUCKET, 16 * ROWS_A_BUCKET + 1)] == [16, 16, 17]


def test_only_texts_with_letters_meet_the_pattern_of_numbers(spark):
    from tutela.functions import to_double
    values = ["75F", "75d ", "1e5", " 12.5 ", "", None, "n/a", "NaN", "-1.0", "7.D\n", "1.5", "٣"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    plain = F.when(~F.col("v").rlike(r"[0-9.][dDfF]\s*$"), F.col("v").try_cast("double"))
    got = [(str(a), str(b)) for a, b in df.select(to_double("v"), plain).collect()]
    assert [a for a, _ in got] == [b for _, b in got]


# ------------------------------------------------------- the exported tables --
EXPORTED = {"dim_student", "dim_term", "dim_campus", "dim_program", "dim_unit", "dim_advisor",
            "fact_enrolment", "fact_engagement_week", "fact_case", "fact_alert", "mart_executive",
            "mart_retention_cohort", "mart_nbf_funding", "mart_seheef_activity",
            "mart_triage_current", "mart_effectiveness_input", "mart_dq_summary",
            "mart_engagement_trend"}


def test_the_warehouse_is_exported_whole_and_marts_read_its_facts(spark, two_students, tmp_path,
                                                                  monkeypatch):
    from tutela.catalog import base_queries, bindings
    from tutela.catalog.registry import REGISTRY
    folder, read = f"{tmp_path}/warehouse", {}
    monkeypatch.setattr(base_queries, "scratch_path", lambda spark, name: folder)
    for mart, facts in (("mart_executive", [0]), ("seheef", [0]), ("triage", [0, 1, 4])):
        def plan(*a, was=getattr(bindings.marts, mart), mart=mart, facts=facts):
            read[mart] = [{f.split("/warehouse/")[-1].split("/")[0] for f in a[i].inputFiles()}
                          for i in facts]
            return was(*a)
        monkeypatch.setattr(bindings.marts, mart, plan)
    got = {r.table_name: (r.rows, r.observed)
           for r in REGISTRY["snk_warehouse"].build(two_students).collect()}
    assert set(got) == EXPORTED == set(os.listdir(folder))
    assert all(rows == observed for rows, observed in got.values())
    assert (got["dim_student"], got["fact_enrolment"], got["fact_case"]) == ((2, 2), (4, 4), (1, 1))
    assert (got["fact_engagement_week"], got["dim_unit"]) == ((30, 30), (4, 4))
    # customer 1 has an alert in each term, but has left: in no caseload
    assert (got["fact_alert"], got["mart_triage_current"]) == ((3, 3), (0, 0))
    assert got["mart_effectiveness_input"] == (2, 2)
    assert "linked_alert_id" in spark.read.parquet(f"{folder}/fact_case").columns
    assert read == {"mart_executive": [{"fact_enrolment"}], "seheef": [{"fact_case"}],
                    "triage": [{"fact_alert"}, {"fact_engagement_week"}, {"fact_case"}]}


def test_an_exported_table_must_read_as_it_was_written(two_students, monkeypatch):
    from tutela.catalog import base_queries
    frames = {"dim_program": "programs", "dim_advisor": "advisors"}
    assert sorted(map(tuple, base_queries._written(two_students, "x", frames).collect())) == [
        ("dim_advisor", 10, 10), ("dim_program", 5, 5)]
    was = base_queries.read_tables
    monkeypatch.setattr(base_queries, "read_tables", lambda *a: {
        n: df.withColumn("field", F.lit("Design")) if "field" in df.columns else df
        for n, df in was(*a).items()})
    with pytest.raises(Exception, match="dim_program is not read as it was written"):
        base_queries._written(two_students, "x", frames).collect()


def test_tables_without_rows_are_written_and_read(spark, tmp_path):
    from tutela.sources import read_tables, write_tables
    spark.createDataFrame([("T1", 1)], "term_code string, n int").write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    tables = {"fact_alert": rows.filter("n > 1").selectExpr("*", "'x' AS lifecycle_status"),
              "mart": rows.join(rows.filter("n > 1"), "n").select("n")}
    folder = f"{tmp_path}/out"
    assert write_tables(tables, folder) == {"fact_alert": 0, "mart": 0}
    assert write_tables(tables, folder, digested=True) == {"fact_alert": (0, "0"), "mart": (0, "0")}
    for name, df in read_tables(spark, folder, tables).items():
        assert sorted(df.columns) == sorted(tables[name].columns)
        assert [tuple(r) for r in table_digest(df, name).collect()] == [(name, 0, "0")]
