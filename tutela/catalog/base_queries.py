"""Sources, scalar functions, filters, joins, aggregates, windows, sets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tutela import functions as fn
from tutela.catalog.bindings import MATCH_KEYS, MODEL_FRAMES, Bound
from tutela.catalog.registry import add, query
from tutela.operators import aggregates as ag
from tutela.operators import filters as flt
from tutela.operators import joins as jn
from tutela.operators import ranking, sets
from tutela.operators import windows as wn
from tutela.plans import alerts, identity, marts, realism
from tutela.plans.metrics import default_totals
from tutela.session import scratch_path
from tutela.sources import (lookup, read_manifest, read_tables, read_text_csv, read_typed_csv,
                            table_digest, write_table, write_tables)

RAW = ["student_id", "first_name", "last_name", "dob", "campus_code", "atar",
       "first_nations_flag"]


# ------------------------------------------------------------ sources, sinks --
@query("src_csv_text", """
    SELECT student_id, first_name, last_name, nullif(dob, '') AS dob, campus_code,
           nullif(atar, '') AS atar, nullif(first_nations_flag, '') AS first_nations_flag
    FROM v_raw""")
def src_csv_text(b: Bound):
    path = scratch_path(b.spark, "extract")
    write_table(b.raw_students.select(*RAW), path, "csv")
    return read_text_csv(b.spark, path, RAW)


@query("src_csv_typed", """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS o_custkey,
           CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS urgent
    FROM orders""")
def src_csv_typed(b: Bound):
    path = scratch_path(b.spark, "typed")
    k = F.col("o_orderkey") % 3
    write_table(b.table("orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.when(k == 0, F.col("o_custkey").cast("string")).when(k == 1, "n/a").alias("o_custkey"),
        F.when(k == 0, "true").when(k == 1, "false").otherwise("perhaps").alias("urgent")),
        path, "csv")
    return read_typed_csv(b.spark, path, {
        "o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date",
        "o_custkey": "bigint", "urgent": "boolean"})


@query("src_literal", """
    SELECT program_code, program_name, field, count(*) AS customers FROM customer
    JOIN v_programs ON c_mktsegment = program_code GROUP BY ALL""")
def src_literal(b: Bound):
    from tutela.catalog.bindings import PROGRAMS
    rows = lookup(b.spark, PROGRAMS, "program_code string, program_name string, field string")
    return b.table("customer").groupBy(F.col("c_mktsegment").alias("program_code")).agg(
        F.count(F.lit(1)).alias("customers")).join(rows, "program_code")


def _written(b: Bound, name: str, frames: dict[str, str]):
    """Frames of ``b`` written as tables, in the order given, and read back whole.

    What is planned after a table was written reads it from its files: a mart is made from the facts
    that lie beside it. Rows whose values are not those that were written stop the query.
    """
    folder, seen, back = scratch_path(b.spark, name), [], []
    for table, frame in frames.items():
        plan = {table: getattr(b, frame)}
        seen.append((table, *write_tables(plan, folder, digested=True)[table]))
        df = read_tables(b.spark, folder, plan)[table]
        for n in {frame, MODEL_FRAMES.get(table, frame)}:
            b.read_from(n, df)
        back.append(table_digest(df, table))
    rows = lookup(b.spark, seen, "table_name string, observed bigint, written string")
    same = F.when(F.col("digest") == F.col("written"), F.col("rows")).otherwise(F.raise_error(
        F.concat("table_name", F.lit(" is not read as it was written"))))
    return sets.stack(back).join(rows, "table_name").select(
        "table_name", same.alias("rows"), "observed")


def _count_sql(views: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows, count(*) AS observed FROM {v}"
        for n, v in views.items())


# every table that the institution exports; its cases are linked to their alerts
WAREHOUSE = MODEL_FRAMES | {"fact_case": "fact_case_linked",
                            "mart_effectiveness_input": "effect_input"}


@query("snk_warehouse", _count_sql({
    "dim_student": "d_student", "dim_term": "v_tt", "dim_campus": "region",
    "dim_program": "v_programs", "dim_advisor": "v_advisors", "dim_unit": "part",
    "fact_enrolment": "f_enrol", "fact_engagement_week": "f_eng", "fact_case": "f_case",
    "fact_alert": "f_alert", "mart_triage_current": "m_triage",
    "mart_retention_cohort": "m_retention", "mart_nbf_funding": "m_nbf",
    "mart_seheef_activity": "m_seheef", "mart_engagement_trend": "m_trend",
    "mart_dq_summary": "m_dq", "mart_executive": "m_executive",
    "mart_effectiveness_input": "m_effect"}))
def snk_warehouse(b: Bound):
    # with several readers among the tables, and bound before the first of them
    b.share("students", "survivors", "enrolments", "judged", "activity", "alerts")
    return _written(b, "warehouse", WAREHOUSE)


add("snk_quality", lambda b: _written(b, "quality", {
    "dq_issues": "issues", "rej_enrolments": "rejected"}),
    _count_sql({"dq_issues": "v_issues", "rej_enrolments": "v_rej"}))


@query("snk_result", "SELECT * FROM m_fair")
def snk_result(b: Bound):
    path = scratch_path(b.spark, "result")
    write_table(b.fairness, path)
    return b.spark.read.parquet(path)


@query("src_manifest", """
    SELECT CAST(42 AS BIGINT) AS seed, (SELECT count(*) FROM customer) AS students,
           (SELECT count(*) FROM lineitem) AS enrolment_rows,
           CAST(0.65 AS DOUBLE) AS p_effect_if_reached""")
def src_manifest(b: Bound):
    path = scratch_path(b.spark, "manifest")
    n = {t: b.table(t).agg(F.count(F.lit(1)).alias("n")).scalar() for t in ("customer", "lineitem")}
    one = b.table("region").agg(F.count(F.lit(1)).alias("regions"))
    doc = one.select(
        F.lit(42).alias("seed"), n["customer"].alias("students"),
        n["lineitem"].alias("enrolment_rows"),
        F.struct(F.lit(0.65).alias("p_effect_if_reached")).alias("injected_effect"))
    doc.write.json(path)
    return read_manifest(b.spark, path).select(
        "seed", "students", "enrolment_rows", "injected_effect.p_effect_if_reached")


@query("layout", """
    SELECT lifecycle_status, reason_code, count(*) AS alerts FROM f_alert
    WHERE term_code = '2024T3' GROUP BY ALL""")
def layout(b: Bound):
    """Written by term, ordered by lifecycle; the read touches one partition."""
    folder = scratch_path(b.spark, "layout")
    write_tables({"fact_alert": b.fact_alert}, folder)
    return (b.spark.read.parquet(f"{folder}/fact_alert").filter("term_code = '2024T3'")
            .groupBy("lifecycle_status", "reason_code").agg(F.count(F.lit(1)).alias("alerts")))


# ---------------------------------------------------------- scalar functions --
def _scalar(name: str, table: str, key: str, build, sql: str):
    """One function over every row of a table; ``key`` names its id column."""
    def run(b: Bound):
        src = getattr(b, table) if hasattr(Bound, table) else b.table(table)
        out = build()
        cols = out if isinstance(out, dict) else {"value": out}
        return src.select(key, *[c.alias(n) for n, c in cols.items()])
    view = {"raw_students": "v_raw", "students": "v_students", "enrolments": "v_enrol",
            "case_rows": "v_cases", "fact_case": "f_case", "triage": "m_triage",
            "effect_input": "m_effect", "activity": "v_activity"}.get(table, table)
    add(name, run, f"SELECT {key}, {sql} FROM {view}")


_scalar("fn_trim", "raw_students", "last_name", lambda: fn.strip("student_id"),
        "trim(student_id) AS value")
_scalar("fn_proper_case", "raw_students", "last_name", lambda: fn.proper_case("first_name"),
        "upper(left(trim(first_name), 1)) || lower(substr(trim(first_name), 2)) AS value")
_scalar("fn_upper_trim", "raw_students", "last_name", lambda: fn.upper_trim("campus_code"),
        "upper(trim(campus_code)) AS value")
_scalar("fn_multi_date", "raw_students", "last_name", lambda: fn.mixed_date("dob"),
        "CASE WHEN contains(dob, '/') THEN CAST(try_strptime(dob, '%d/%m/%Y') AS DATE) "
        "ELSE try_cast(dob AS DATE) END AS value")
_scalar("fn_try_cast", "raw_students", "last_name",
        lambda: {"number": fn.to_double("atar"), "day": fn.to_date("dob")},
        "try_cast(atar AS DOUBLE) AS number, "
        "CASE WHEN NOT contains(dob, '/') THEN try_cast(dob AS DATE) END AS day")
_scalar("fn_strict_cast", "orders", "o_orderkey",
        lambda: {"size": fn.strict(F.col("o_custkey").cast("string"), "int"),
                 "day": fn.strict(F.substring(F.col("o_orderdate").cast("string"), 1, 10), "date")},
        "CAST(o_custkey AS INTEGER) AS size, CAST(o_orderdate AS DATE) AS day")
_scalar("fn_tri_state", "raw_students", "last_name", lambda: fn.tri_state("first_nations_flag"),
        "CASE first_nations_flag WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Unknown' END "
        "AS value")
_scalar("fn_nullif_empty", "raw_students", "last_name", lambda: fn.null_if_empty("atar"),
        "nullif(atar, '') AS value")
_scalar("fn_term_year", "students", "student_id", lambda: fn.term_year("commencing_term"),
        "CAST(left(commencing_term, 4) AS INTEGER) AS value")
_scalar("fn_full_name", "students", "student_id",
        lambda: fn.full_name("program_code", F.col("commencing_term")),
        "program_code || ' ' || commencing_term AS value")
_scalar("fn_composite_key", "students", "student_id",
        lambda: fn.composite_key("student_id", "dob", "commencing_term"),
        "student_id || '|' || dob || '|' || commencing_term AS value")
_scalar("fn_num_to_text", "orders", "o_orderkey",
        lambda: {"small": fn.number_text("o_totalprice"),
                 "large": fn.number_text(F.col("o_orderkey") * 12345.5)},
        "CAST(o_totalprice AS VARCHAR) AS small, CAST(o_orderkey * 12345.5::DOUBLE AS VARCHAR) "
        "AS large")
_scalar("fn_day_diff", "fact_case", "case_id", lambda: fn.day_diff("closed_date", "opened_date"),
        "CAST(closed_date - opened_date AS INTEGER) AS value")
_scalar("fn_default", "students", "student_id",
        lambda: {"term": fn.default_to("commencing_term", "Unknown"),
                 "score": fn.default_to("atar", 0.0)},
        "coalesce(commencing_term, 'Unknown') AS term, coalesce(atar, 0) AS score")
_scalar("fn_clip", "customer", "c_custkey", lambda: fn.clip("c_acctbal", 0.0, 100.0),
        "CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 100 THEN 100 ELSE c_acctbal END AS value")
_scalar("fn_cut", "customer", "c_custkey",
        lambda: fn.cut("c_acctbal", (-1, 2000, 6000, 9000), ("low", "mid", "high")),
        "CASE WHEN c_acctbal <= -1 OR c_acctbal > 9000 THEN 'nan' WHEN c_acctbal <= 2000 "
        "THEN 'low' WHEN c_acctbal <= 6000 THEN 'mid' ELSE 'high' END AS value")
_scalar("fn_stratum_key", "students", "student_id",
        lambda: fn.stratum_key("mode", "citizenship", "first_nations"),
        "mode || '|' || citizenship || '|' || first_nations AS value")
_scalar("fn_prefix", "case_rows", "case_id",
        lambda: {"reached": fn.starts_with("contact_outcome", "Reached"),
                 "head": fn.left_text("contact_outcome", 2)},
        "contact_outcome LIKE 'Reached%' AS reached, left(contact_outcome, 2) AS head")
_scalar("fn_search", "part", "p_partkey", lambda: fn.search_text("p_name", "RED"),
        "coalesce(p_name ILIKE '%red%', false) AS value")
_scalar("fn_safe_ratio", "activity", "student_id",
        lambda: {"week_start": F.col("week_start"), "value": fn.safe_ratio("missed", "items_due")},
        "week_start, CAST(missed AS DOUBLE) / nullif(items_due, 0) AS value")
_scalar("fn_round", "lineitem", "l_orderkey",
        lambda: {"one": fn.rounded(F.col("l_quantity").cast("decimal(12,2)") / 8, 1)
                 .cast("double"),
                 "four": fn.rounded(F.col("l_extendedprice").cast("decimal(12,2)"), 1)
                 .cast("double")},
        "CAST(round(CAST(CAST(l_quantity AS INTEGER) * 125 AS DECIMAL(18,0)) "
        "* CAST(0.001 AS DECIMAL(6,3)), 1) AS DOUBLE) AS one, "
        "CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS four")


@query("fn_split_contains", """
    SELECT c_custkey, r_name, ('|' || covered_campuses || '|') LIKE '%|' || r_name || '|%' AS value
    FROM customer JOIN v_regions ON c_nationkey = n_nationkey
    JOIN v_advisors ON advisor_id = 'ADV' || lpad(CAST(1 + c_custkey % 10 AS VARCHAR), 2, '0')""")
def fn_split_contains(b: Bound):
    adv = F.concat(F.lit("ADV"), F.lpad((F.col("c_custkey") % 10 + 1).cast("string"), 2, "0"))
    rows = b.table("customer").join(b.regions, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.join(b.advisors, adv == F.col("advisor_id")).select(
        "c_custkey", "r_name", fn.has_item("covered_campuses", F.col("r_name")).alias("value"))


@query("fn_list_min", """
    SELECT c_nationkey, min(c_mktsegment) AS value FROM customer GROUP BY c_nationkey""")
def fn_list_min(b: Bound):
    return ag.ordered_list(b.table("customer"), ["c_nationkey"], "c_mktsegment", "segments").select(
        "c_nationkey", fn.list_min("segments").alias("value"))


GRADE_SQL = "SELECT DISTINCT enrolment_status, grade, eftsl, {} AS value FROM v_enrol"


def _grade(value: Column):
    return lambda b: b.enrolments.select("enrolment_status", "grade", "eftsl",
                                         value().alias("value")).distinct()


add("fn_bucket_grade", _grade(lambda: fn.pass_flag("grade")), GRADE_SQL.format(
    "CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN true "
    "WHEN grade IN ('NN', 'WN') THEN false END"))
add("fn_cert_load", _grade(lambda: fn.certified_load("enrolment_status", "eftsl")),
    GRADE_SQL.format("CASE WHEN enrolment_status = 'Withdrawn pre-census' THEN 0 ELSE eftsl END"))
add("fn_pass_load", _grade(lambda: fn.passed_load("grade", "eftsl")), GRADE_SQL.format(
    "CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN eftsl ELSE 0 END"))


@query("fn_switch", """
    SELECT program_code, CASE left(min(priority_tier), 2) WHEN 'P1' THEN '#F2B8B5' WHEN 'P2'
           THEN '#F7E1A0' WHEN 'P3' THEN '#BFE3DC' ELSE '#E6E6E6' END AS value
    FROM m_triage GROUP BY program_code""")
def fn_switch(b: Bound):
    return b.triage.groupBy("program_code").agg(
        fn.tier_colour(F.min("priority_tier")).alias("value"))


# -------------------------------------------------------------------- filters --
add("flt_range", lambda b: flt.outside_range(b.enrolments, "mark", 0, 100).select(
    "student_id", "unit_code", "mark"),
    "SELECT student_id, unit_code, mark FROM v_enrol WHERE mark NOT BETWEEN 0 AND 100")
add("flt_not_in_sub", lambda b: flt.not_in(
    b.enrolments, "campus_code", b.synonyms, "canonical").select(
    "student_id", "unit_code", "campus_code"),
    "SELECT student_id, unit_code, campus_code FROM v_enrol "
    "WHERE campus_code NOT IN (SELECT canonical FROM v_syn)")
add("flt_in_sub", lambda b: flt.in_set(
    b.activity, "term_code", b.tterms.filter("is_current"), "term_code").select(
    "student_id", "week_number", "logins"),
    "SELECT student_id, week_number, logins FROM v_activity "
    "WHERE term_code IN (SELECT term_code FROM v_tterms WHERE is_current)")
add("flt_date_bounds", lambda b: flt.date_outside(
    b.students, "dob", date(1936, 1, 1), date(2011, 1, 1)).select("student_id", "dob"),
    "SELECT student_id, dob FROM v_students "
    "WHERE dob IS NULL OR dob NOT BETWEEN DATE '1936-01-01' AND DATE '2011-01-01'")
add("flt_ne", lambda b: flt.differs(b.students, "commencing_term", "1995S1").select(
    "student_id", "commencing_term"),
    "SELECT student_id, commencing_term FROM v_students WHERE commencing_term <> '1995S1'")
add("flt_having", lambda b: flt.repeated_keys(
    b.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL "
    "HAVING count(*) > 1")
add("flt_page", lambda b: flt.page_filter(b.nbf, "commencing_year", [1995]),
    "SELECT * FROM m_nbf WHERE commencing_year = 1995")


@query("flt_rls", "SELECT * FROM m_triage WHERE advisor_id = 'ADV01'")
def flt_rls(b: Bound):
    from tutela.plans.security import restrict, role_predicate
    return restrict(b.triage, b.advisors, role_predicate("Advisor_ADV01"))


# ---------------------------------------------------------------------- joins --
add("jn_left_lookup", lambda b: jn.left_lookup(
    b.table("nation"), F.upper(F.trim("n_name")), b.synonyms, "variant").join(
    b.table("customer"), F.col("c_nationkey") == F.col("n_nationkey")).select(
    "c_custkey", "n_name", "canonical"),
    "SELECT c_custkey, n_name, canonical FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN v_syn ON variant = upper(trim(n_name))")
add("jn_inner_star", lambda b: jn.star(
    b.fact_enrolment.select("student_id", "unit_code", "term_code", "eftsl_passed"),
    (jn.apart(b.dim_student.select("student_id", "mode", "program_code")), "student_id"),
    (b.programs, "program_code")).groupBy("field", "mode", "term_code").agg(
    F.count(F.lit(1)).alias("rows"), F.sum("eftsl_passed").alias("passed")),
    "SELECT field, mode, term_code, count(*) AS rows, sum(eftsl_passed) AS passed FROM f_enrol "
    "JOIN (SELECT student_id, mode, program_code FROM d_student) USING (student_id) "
    "JOIN v_programs USING (program_code) GROUP BY ALL")
add("jn_using", lambda b: b.dim_student.join(b.rates, ["nbf_category"]).select(
    "student_id", "nbf_category", "indicative_rate"),
    "SELECT student_id, nbf_category, indicative_rate FROM d_student JOIN v_rates "
    "USING (nbf_category)")
add("jn_left_isnull", lambda b: jn.orphans(b.enrolments, b.students, ["student_id"]).select(
    "student_id", "unit_code", "term_code"),
    "SELECT e.student_id, unit_code, term_code FROM v_enrol e LEFT JOIN v_students s "
    "ON e.student_id = s.student_id WHERE s.student_id IS NULL")
add("jn_anti", lambda b: b.clean.select("student_id", "unit_code", "term_code", "mark"),
    "SELECT student_id, unit_code, term_code, mark FROM v_enrol e WHERE NOT EXISTS "
    "(SELECT 1 FROM v_rej r WHERE r.student_id = e.student_id AND r.unit_code = e.unit_code "
    "AND r.term_code = e.term_code)")
add("jn_semi", lambda b: b.activity.join(b.students.select("student_id"), "student_id",
                                         "left_semi").select("student_id", "week_start", "logins"),
    "SELECT student_id, week_start, logins FROM v_activity "
    "WHERE student_id IN (SELECT student_id FROM v_students)")
add("jn_exists", lambda b: jn.with_flag(
    b.students.select("student_id"), b.active_ids, ["student_id"], "active"),
    "SELECT student_id, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' "
    "AND o_custkey = student_id) AS active FROM v_students")
add("jn_scalar_sub", lambda b: identity.remap(
    b.table("orders").select(F.col("o_custkey").alias("student_id"), "o_orderkey"), b.survivors),
    "SELECT coalesce((SELECT surviving_id FROM v_map WHERE duplicate_id = o_custkey), o_custkey) "
    "AS student_id, o_orderkey FROM orders")
add("jn_scalar_top1", lambda b: jn.latest_value(
    b.fact_case, "student_id", "advisor_id", ["opened_date", "case_id"], "advisor"),
    "SELECT DISTINCT student_id, (SELECT advisor_id FROM f_case c WHERE c.student_id = f.student_id"
    " ORDER BY opened_date DESC, case_id DESC LIMIT 1) AS advisor FROM f_case f")
add("jn_scalar_global", lambda b: wn.last_weeks(
    b.activity.filter("term_code = '2024T3'"), "week_number", 2).select(
    "student_id", "week_number", "logins"),
    "SELECT student_id, week_number, logins FROM v_activity WHERE term_code = '2024T3' AND "
    "week_number >= (SELECT max(week_number) - 1 FROM v_activity WHERE term_code = '2024T3')")
add("jn_contains", lambda b: b.students.select("student_id", "campus_code_raw").join(
    jn.first_per_item(b.advisors, "covered_campuses", "campus_code_raw", "advisor_id", "advisor"),
    "campus_code_raw", "left"),
    "SELECT student_id, campus_code_raw, (SELECT min(advisor_id) FROM v_advisors WHERE "
    "list_contains(string_split(covered_campuses, '|'), campus_code_raw)) AS advisor "
    "FROM v_students")


@query("jn_equi_range", """
    SELECT student_id, term_code, count(*) AS weeks, CAST(sum(logins) AS BIGINT) AS logins
    FROM v_alerted JOIN f_eng USING (student_id, term_code) WHERE f_eng.week_number <= alert_week
    GROUP BY ALL""")
def jn_equi_range(b: Bound):
    past = b.fact_alert.filter("term_code <> '2024T3'")
    rows = jn.equi_range(marts.alerted_terms(past), b.fact_engagement,
                         ["student_id", "term_code"], "week_number", "alert_week")
    return rows.groupBy("student_id", "term_code").agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("logins").alias("logins"))


add("jn_self", lambda b: wn.with_group_min(
    b.fact_alert, ["student_id", "term_code"], "week_number", "first_week").select(
    "alert_id", "week_number", "first_week"),
    "SELECT alert_id, week_number, (SELECT min(week_number) FROM f_alert o WHERE o.student_id = "
    "f.student_id AND o.term_code = f.term_code) AS first_week FROM f_alert f")


@query("jn_next_seq", """
    SELECT student_id, term_code, EXISTS (
        SELECT 1 FROM f_enrol n JOIN v_terms t ON t.term_code = n.term_code
        WHERE n.student_id = e.student_id AND t.term_start =
              (SELECT min(term_start) FROM v_terms WHERE term_start >
               (SELECT term_start FROM v_terms WHERE term_code = e.term_code))) AS came_back
    FROM (SELECT DISTINCT student_id, term_code FROM f_enrol) e""")
def jn_next_seq(b: Bound):
    seq = marts.terms_ordered(b.terms).select("term_code", "term_seq")
    seen = b.fact_enrolment.select("student_id", "term_code").distinct().join(seq, "term_code")
    return jn.with_next(seen, seen, "student_id", "term_seq", "came_back").select(
        "student_id", "term_code", "came_back")


@query("jn_list_eq", """
    SELECT student_id, members FROM v_students
    JOIN (SELECT postcode, program_code, match_band, count(*) AS members FROM v_students
          GROUP BY ALL) g ON g.postcode IS NOT DISTINCT FROM v_students.postcode
     AND g.program_code IS NOT DISTINCT FROM v_students.program_code
     AND g.match_band IS NOT DISTINCT FROM v_students.match_band""")
def jn_list_eq(b: Bound):
    """Members of one duplicate group meet through the group's keys, not its list of ids."""
    keys = list(MATCH_KEYS)
    return jn.with_group_size(b.students.select("student_id", *keys), keys, "members").select(
        "student_id", "members")


add("jn_multi_left", lambda b: b.fact_alert.select(
    "alert_id", "actioned_case_id", "actioned_date", "lifecycle_status"),
    "SELECT alert_id, actioned_case_id, actioned_date, lifecycle_status FROM f_alert")
add("jn_merge", lambda b: jn.merge_suffixed(
    b.students.select("student_id", "mode", "program_code"),
    b.activity.groupBy("student_id").agg(F.sum("logins").alias("program_code")),
    ["student_id"], "left", "_a"),
    "SELECT s.student_id, mode, program_code, CAST(l AS BIGINT) AS program_code_a FROM v_students s"
    " LEFT JOIN (SELECT student_id, sum(logins) AS l FROM v_activity GROUP BY student_id) a "
    "ON a.student_id = s.student_id")
add("jn_relationship", lambda b: b.model.evaluate(
    ["eftsl_certified"], by=["dim_program.field", "dim_campus.campus_name"]),
    "SELECT field, r.r_name AS campus_name, sum(eftsl_certified) AS eftsl_certified FROM f_enrol e "
    "LEFT JOIN d_student s ON s.student_id = e.student_id "
    "LEFT JOIN v_programs p ON p.program_code = s.program_code "
    "LEFT JOIN region r ON r.r_name = e.campus_code GROUP BY field, r.r_name")

# ----------------------------------------------------------------- aggregates --
add("ag_group_all", lambda b: ag.group_rest(
    b.enrolments.select("enrolment_status", "grade", "campus_code"), rows=F.count(F.lit(1))),
    "SELECT enrolment_status, grade, campus_code, count(*) AS rows FROM v_enrol GROUP BY ALL")
add("ag_count", lambda b: b.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
    F.count(F.lit(1)).alias("rows")),
    "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY ALL")
add("ag_count_distinct", lambda b: b.enrolments.groupBy("term_code").agg(
    F.countDistinct("student_id").alias("students")),
    "SELECT term_code, count(DISTINCT student_id) AS students FROM v_enrol GROUP BY term_code")
for _name, _agg in (("sum", F.sum), ("avg", F.avg), ("min", F.min), ("max", F.max)):
    add(f"ag_{_name}", lambda b, agg=_agg: b.table("lineitem").groupBy("l_returnflag").agg(
        agg("l_quantity").alias("quantity"), agg("l_linenumber").alias("line")),
        f"SELECT l_returnflag, {_name}(l_quantity) AS quantity, "
        + (f"CAST({_name}(l_linenumber) AS BIGINT)" if _name == "sum"
           else f"{_name}(l_linenumber)") + " AS line FROM lineitem GROUP BY l_returnflag")
add("ag_conditional", lambda b: b.enrolments.groupBy("term_code").agg(
    ag.sum_when(F.col("grade") == "WW").alias("withdrawn"),
    ag.share(F.col("grade").isin("HD", "DI")).alias("top_share")),
    "SELECT term_code, count(*) FILTER (WHERE grade = 'WW') AS withdrawn, "
    "avg(CASE WHEN grade IN ('HD', 'DI') THEN 1.0::DOUBLE ELSE 0 END) AS top_share "
    "FROM v_enrol GROUP BY term_code")
add("ag_filter", lambda b: b.table("orders").groupBy("o_orderpriority").agg(
    F.count_if(F.col("o_orderstatus") == "P").alias("pending")),
    "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending FROM orders "
    "GROUP BY o_orderpriority")
add("ag_flag_max", lambda b: b.table("orders").groupBy("o_custkey").agg(
    ag.any_of(F.col("o_orderstatus") == "P").alias("pending")),
    "SELECT o_custkey, max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS pending "
    "FROM orders GROUP BY o_custkey")
add("ag_max_text", lambda b: b.fact_case.groupBy("student_id").agg(
    F.max("status").alias("status"), F.max("contact_outcome").alias("outcome")),
    "SELECT student_id, max(status) AS status, max(contact_outcome) AS outcome FROM f_case "
    "GROUP BY student_id")
add("ag_string_agg", lambda b: b.fact_alert.groupBy("student_id", "term_code").agg(
    ag.distinct_text("reason_code").alias("reasons")),
    "SELECT student_id, term_code, string_agg(DISTINCT reason_code, ', ' ORDER BY reason_code) "
    "AS reasons FROM f_alert GROUP BY student_id, term_code")
add("ag_list", lambda b: ag.ordered_list(
    b.table("orders"), ["o_custkey"], "o_orderpriority", "priorities").select(
    "o_custkey", F.array_join("priorities", ";").alias("priorities")),
    "SELECT o_custkey, array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority), "
    "';') AS priorities FROM orders GROUP BY o_custkey")
add("ag_distinct", lambda b: b.fact_enrolment.select("student_id", "term_code").distinct(),
    "SELECT DISTINCT student_id, term_code FROM f_enrol")
add("ag_min_id", lambda b: b.fact_case_linked.filter("linked_alert_id IS NOT NULL")
    .groupBy("linked_alert_id").agg(F.min("case_id").alias("case_id")),
    "SELECT linked_alert_id, min(case_id) AS case_id FROM f_case "
    "WHERE linked_alert_id IS NOT NULL GROUP BY linked_alert_id")


def _ship_days(b: Bound):
    return b.table("lineitem").join(
        b.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_returnflag", F.datediff("l_shipdate", "o_orderdate").alias("days"))


add("ag_median", lambda b: ag.median_of(_ship_days(b), ["l_returnflag"], "days", "median_days"),
    "SELECT l_returnflag, median(date_diff('day', o_orderdate, l_shipdate)) AS median_days "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag")
add("ag_percentile", lambda b: ag.interval_of(_ship_days(b), ["l_returnflag"], "days"),
    "SELECT l_returnflag, quantile_cont(date_diff('day', o_orderdate, l_shipdate), 0.025) "
    "AS ci_low, quantile_cont(date_diff('day', o_orderdate, l_shipdate), 0.975) AS ci_high "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag")
add("ag_weighted_mean", lambda b: b.table("lineitem").groupBy("l_linestatus").agg(
    ag.weighted_mean(F.col("l_linenumber"), F.col("l_quantity")).alias("line")),
    "SELECT l_linestatus, sum(l_linenumber * l_quantity) / sum(l_quantity) AS line FROM lineitem "
    "GROUP BY l_linestatus")
add("ag_value_share", lambda b: ag.value_share(b.enrolments, "grade"),
    "SELECT grade, count(*) AS rows, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
    "FROM v_enrol GROUP BY grade")
add("ag_minmax_year", lambda b: realism.years_present(b.enrolments),
    "SELECT student_id, min(CAST(left(term_code, 4) AS INTEGER)) AS first_year, "
    "max(CAST(left(term_code, 4) AS INTEGER)) AS last_year FROM v_enrol GROUP BY student_id")
add("ag_rollup_matrix", lambda b: ag.rollup_levels(
    b.fact_enrolment.groupBy("student_id").agg(F.sum("eftsl_passed").alias("passed"))
    .join(b.dim_student.select("student_id", "program_code"), "student_id")
    .join(b.programs, "program_code"), ["field", "program_name"],
    F.count("student_id").alias("headcount"), F.sum("passed").alias("passed")),
    "SELECT field, program_name, CAST(grouping(field) + grouping(program_name) AS INTEGER) "
    "AS level, count(DISTINCT student_id) AS headcount, sum(eftsl_passed) AS passed FROM f_enrol "
    "JOIN (SELECT student_id, program_code FROM d_student) USING (student_id) "
    "JOIN v_programs USING (program_code) GROUP BY ROLLUP (field, program_name)")
SHIP_YEARS = list(range(1995, 2003))
add("ag_pivot", lambda b: ag.pivot_sum(
    b.table("lineitem").withColumn("year", F.year("l_shipdate")), ["l_returnflag"], "year",
    SHIP_YEARS, rest=None, quantity="l_quantity", lines="l_linenumber"),
    "SELECT l_returnflag, " + ", ".join(
        f"sum(l_quantity) FILTER (WHERE year(l_shipdate) = {y}) AS quantity_{y}, "
        f"CAST(sum(l_linenumber) FILTER (WHERE year(l_shipdate) = {y}) AS BIGINT) AS lines_{y}"
        for y in SHIP_YEARS) + " FROM lineitem GROUP BY l_returnflag")
add("ag_summarize_default", lambda b: default_totals(b.executive, "mart_executive"),
    "SELECT CAST(sum(headcount) AS BIGINT) AS headcount, sum(eftsl_certified) AS eftsl_certified, "
    "sum(eftsl_passed) AS eftsl_passed, round(sum(success_rate), 6) AS success_rate, "
    "round(sum(avg_mark), 6) AS avg_mark, "
    "CAST(sum(withdrawals_pre_census) AS BIGINT) AS withdrawals_pre_census FROM m_executive")

# -------------------------------------------------------------------- windows --
add("wn_row_number", lambda b: b.table("orders").select(
    "o_orderkey", fn.term_year(F.date_format("o_orderdate", "yyyy")).alias("year"),
    F.when(F.month("o_orderdate") <= 6, "S1").otherwise("S2").alias("semester")).join(
    wn.sequence_terms(b.terms).select("year", "semester", "term_seq"), ["year", "semester"])
    .select("o_orderkey", "term_seq"),
    "SELECT o_orderkey, term_seq FROM orders JOIN (SELECT year, semester, CAST(row_number() OVER "
    "(ORDER BY term_start) AS INTEGER) AS term_seq FROM v_terms) t ON t.year = year(o_orderdate) "
    "AND semester = CASE WHEN month(o_orderdate) <= 6 THEN 'S1' ELSE 'S2' END")
add("wn_rolling2", lambda b: wn.rolling_sum(
    b.activity, ["student_id", "term_code"], "week_number", "logins", "logins_2wk").select(
    "student_id", "term_code", "week_number", "logins_2wk"),
    "SELECT student_id, term_code, week_number, logins_2wk FROM v_signals")
add("wn_cumulative", lambda b: wn.running_sums(
    b.activity, ["student_id", "term_code"], "week_number",
    {"cum_due": "items_due", "cum_on_time": "submitted_on_time", "cum_missed": "missed"}).select(
    "student_id", "term_code", "week_number", "cum_due", "cum_on_time", "cum_missed"),
    "SELECT student_id, term_code, week_number, cum_due, cum_on_time, cum_missed FROM v_signals")
add("wn_first_true", lambda b: wn.first_where(
    alerts.with_signals(b.activity, collapse=False), ["student_id", "term_code"], "week_number",
    F.col("cum_missed") >= 4, "week"),
    "SELECT student_id, term_code, min(week_number) AS week FROM v_signals WHERE cum_missed >= 4 "
    "GROUP BY student_id, term_code")
add("wn_group_min", lambda b: wn.with_group_min(
    b.alerts, ["student_id", "term_code"], "week_number", "alert_week").select(
    "alert_id", "alert_week"),
    "SELECT alert_id, min(week_number) OVER (PARTITION BY student_id, term_code) AS alert_week "
    "FROM v_alerts")
add("wn_last_n", lambda b: marts.recent_activity(b.activity.filter("term_code = '2024T3'")),
    "SELECT student_id, CAST(sum(logins) AS BIGINT) AS logins_last2wk, "
    "CAST(sum(missed) AS BIGINT) AS missed_last2wk FROM v_activity "
    "WHERE term_code = '2024T3' AND week_number >= 9 GROUP BY student_id")

# ------------------------------------------------------------ ordering, sets --
add("so_list_order", lambda b: b.table("lineitem").groupBy("l_suppkey").agg(
    F.array_join(F.array_sort(F.collect_set("l_linenumber")), "|").alias("lines")),
    "SELECT l_suppkey, array_to_string(list(DISTINCT l_linenumber ORDER BY l_linenumber), '|') "
    "AS lines FROM lineitem GROUP BY l_suppkey")
add("so_top1", lambda b: jn.latest_value(
    b.table("orders"), "o_custkey", "o_totalprice", ["o_orderdate", "o_orderkey"], "price"),
    "SELECT o_custkey, o_totalprice AS price FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
add("so_report", lambda b: ranking.report_order(
    b.triage.select("priority_tier", "student_id", "advisor_id"), "priority_tier", "student_id"),
    "SELECT priority_tier, student_id, advisor_id FROM m_triage "
    "ORDER BY priority_tier, student_id")


@query("se_union_all", "SELECT student_id, cohort FROM v_cohorts")
def se_union_all(b: Bound):
    from tutela.plans.dimensions import cohort_tests
    dom = b.dim_student.filter("citizenship = 'Domestic'")
    return sets.label_rows(dom, cohort_tests(), "cohort").select("student_id", "cohort")


add("se_union_summary", lambda b: b.dq_summary, "SELECT * FROM m_dq")
add("se_append", lambda b: b.issues.groupBy("rule_id", "detail").agg(
    F.count(F.lit(1)).alias("rows"), F.min("row_key").alias("first_key")),
    "SELECT rule_id, detail, count(*) AS rows, min(row_key) AS first_key FROM v_issues "
    "GROUP BY ALL")

