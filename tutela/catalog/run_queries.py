"""Whole runs: extracts to a published warehouse, compared table by table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tutela.catalog.bindings import NBF_YEAR, Bound
from tutela.catalog.extracts import run_store, run_version, write_extracts
from tutela.catalog.plan_queries import ESTIMATES, HEADLINE, VERDICT
from tutela.catalog.registry import REGISTRY, add, query
from tutela.catalog.run_views import RUN_TABLES, digest_sql, layer_sql, renamed
from tutela.functions import sql
from tutela.operators.sets import stack
from tutela.plans import reports, security
from tutela.plans.analysis import analyse
from tutela.plans.constraints import KEYS, RULES, audit_summary
from tutela.plans.staging import EXTRACTS
from tutela.session import keep, scratch_path
from tutela.sources import read_text_csv, table_digest
from tutela.sources.by_student import buckets_for, write_by_student


def _layer(b: Bound, layer: str):
    """Rows and digest of the tables as they are read back from the published version."""
    version = run_version(b)
    return stack([table_digest(version.read(t), t) for t in RUN_TABLES[layer]])


for _layer_name in RUN_TABLES:
    add(f"run_{_layer_name}", lambda b, n=_layer_name: _layer(b, n), layer_sql(_layer_name))


# --------------------------------------------------------------- constraints --
_VIEW = {t: v for layer in RUN_TABLES.values() for t, (v, _) in layer.items()}


def _rule_sql(table: str) -> list[str]:
    """One statement for each declared rule: how many keys break it, in how many rows."""
    r, view, out = RULES[table], _VIEW[table], []
    # no part of these keys holds the separator
    key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in r.key) or "''"

    def say(rule: str, keys: str, rows: str, where: str) -> None:
        out.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule_id, {keys} AS broken_keys, "
                   f"CAST({rows} AS BIGINT) AS broken_rows FROM {where}")

    if r.key:
        say(f"PK_{'_'.join(r.key)}", "count(*)", "coalesce(sum(n), 0)",
            f"(SELECT count(*) AS n FROM {view} GROUP BY {', '.join(r.key)} HAVING count(*) > 1)")
    for c in dict.fromkeys((*r.key, *r.required)):
        say(f"NN_{c}", f"count(DISTINCT {key})", "count(*)", f"{view} WHERE {c} IS NULL")
    for name, test in r.checks.items():
        say(f"CK_{name}", f"count(DISTINCT {key})", "count(*)", f"{view} WHERE NOT ({test})")
    for c, target in r.refs.items():
        say(f"FK_{c}", f"count(DISTINCT {c})", "count(*)",
            f"{view} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {KEYS[target]} "
            f"FROM {_VIEW[target]} WHERE {KEYS[target]} IS NOT NULL)")
    return out


def _audited(b: Bound):
    version = run_version(b)
    return audit_summary({t: version.read(t) for t in RULES})


add("run_audit", _audited, " UNION ALL ".join(s for t in RULES for s in _rule_sql(t)))


# ------------------------------------------------------------------ analyses --
#: table -> (SQL, columns that are no random draws)
ANALYSES = {
    "effectiveness_arms": (
        "SELECT count(*) AS alerted_terms, count(*) FILTER (WHERE contacted = 1) AS contacted, "
        "count(*) FILTER (WHERE contacted = 0) AS uncontacted FROM r_effect",
        "alerted_terms contacted uncontacted"),
    "effectiveness_results": (renamed(ESTIMATES), "estimator estimate_pp note"),
    "effectiveness_verdict": (renamed(VERDICT), "naive_pp matched_pp verdict naive_sign"),
    "fairness_audit": (
        "SELECT * FROM r_m_fair",
        "cohort student_terms alert_rate contact_rate_given_alert retained_next_term_contacted "
        "retained_next_term_uncontacted alerted_n alert_rate_ratio_vs_nonequity "
        "contact_rate_gap_pp_vs_nonequity"),
    "fairness_verdict": (
        "SELECT max(abs(contact_rate_gap_pp_vs_nonequity)) AS max_gap_pp, CASE WHEN "
        "max(abs(contact_rate_gap_pp_vs_nonequity)) <= 3.0 THEN 'PASS' ELSE 'REVIEW REQUIRED' "
        "END AS verdict FROM r_m_fair WHERE cohort <> 'All domestic'", "max_gap_pp verdict"),
    "headline": (renamed(HEADLINE), "metric label value"),
}


def _analysed(b: Bound):
    done = analyse(b.spark, run_version(b), run_store(b, "results"), funded_year=NBF_YEAR)
    return stack([table_digest(done.read(t).select(*columns.split()), t)
                  for t, (_, columns) in ANALYSES.items()])


add("run_analysis", _analysed, " UNION ALL ".join(
    digest_sql(t, f"({text})", columns) for t, (text, columns) in ANALYSES.items()))


# ------------------------------------------------------- layout, SQL surface --
BUCKETS = 16


@query("layout_by_student", """
    SELECT student_id, mode, term_code, count(*) AS units, CAST(sum(count(*)) OVER (
               PARTITION BY student_id ORDER BY term_code) AS BIGINT) AS units_so_far,
           first(commencing_term) AS commencing_term
    FROM r_f_enrol JOIN (SELECT student_id, mode, commencing_term FROM r_dim_student)
         USING (student_id) GROUP BY student_id, mode, term_code""")
def layout_by_student(b: Bound):
    """Terms of each student with the units so far: join, groups and window within buckets."""
    version = run_version(b, "dim_student", "fact_enrolment")
    path = scratch_path(b.spark, "by-student")
    buckets = buckets_for(version.tables["fact_enrolment"].rows, BUCKETS)
    people = write_by_student(version.read("dim_student").select(
        "student_id", "mode", "commencing_term"), f"{path}/dim_student", buckets)
    # one row a unit, without the columns that nobody reads here
    units = write_by_student(version.read("fact_enrolment").select("student_id", "term_code"),
                             f"{path}/fact_enrolment", buckets, order=["term_code"])
    terms = units.join(people).groupBy("student_id", "mode", "term_code").agg(
        F.count(F.lit(1)).alias("units"), F.first("commencing_term").alias("commencing_term"))
    so_far = Window.partitionBy("student_id").orderBy("term_code")
    return terms.withColumn("units_so_far", F.sum("units").over(so_far))


@query("fn_sql_text", """
    SELECT student_id, full_name, dob, flag, year FROM (
        SELECT c_custkey AS k, coalesce(surviving_id, s.student_id) AS student_id,
               first_name || ' ' || last_name AS full_name, dob, first_nations AS flag,
               CAST(left(commencing_term, 4) AS INTEGER) AS year
        FROM r_students s JOIN customer ON CAST(c_custkey AS VARCHAR) = s.student_id
        LEFT JOIN r_map ON duplicate_id = s.student_id)""")
def fn_sql_text(b: Bound):
    """The student extract cleaned and remapped by SQL text alone."""
    source, version = write_extracts(b), run_version(b, "student_id_survivorship")
    sql.register(b.spark)
    sql.register_surviving(b.spark, version.read("student_id_survivorship"))
    read_text_csv(b.spark, f"{source}/banner_students.csv",
                  EXTRACTS["banner_students"]).createOrReplaceTempView("raw_student_text")
    return b.spark.sql("""
        SELECT surviving(trim(student_id)) AS student_id,
               full_name(proper_case(first_name), trim(last_name)) AS full_name,
               mixed_date(dob) AS dob, tri_state(first_nations_flag) AS flag,
               term_year(commencing_term) AS year FROM raw_student_text""")


@query("rl_sql", """
    SELECT 'advisor' AS who, case_id, advisor_id FROM r_f_case WHERE advisor_id = 'ADV03'
    UNION ALL SELECT 'manager', case_id, advisor_id FROM r_f_case""")
def rl_sql(b: Bound):
    """What the user who runs this sees as an advisor and as a manager, by SQL text."""
    cases = run_version(b, "fact_case").read("fact_case")
    mine = b.advisors.select(
        F.when(F.col("advisor_id") == "ADV03", F.current_user()).otherwise(F.col("upn"))
        .alias("principal"), "advisor_id")
    boss = mine.select("principal", F.when(F.col("advisor_id") != "ADV03", F.col("advisor_id"))
                       .alias("advisor_id"))
    security.declare_restricted(b.spark, "advisor_cases", cases, mine)
    security.declare_restricted(b.spark, "manager_cases", cases, boss)
    return b.spark.sql("""
        SELECT 'advisor' AS who, case_id, advisor_id FROM advisor_cases()
        UNION ALL SELECT 'manager', case_id, advisor_id FROM manager_cases()""")


# ----------------------------------------------------------- pages of visuals --
#: visual -> (columns of its groups, measures)
VISUALS = {
    "exec_cards": ("", "headcount success_rate eftsl_certified average_mark "
                       "pre_census_withdrawals"),
    "success_term_mode": ("term_code mode", "success_rate"),
    "success_campus": ("campus_name", "success_rate"),
    "program_matrix": ("field program_name level", "headcount success_rate average_mark "
                                                   "pre_census_withdrawals"),
    "triage_cards": ("", "students_on_list p1_students alert_action_rate median_days_to_action"),
    "caseload": ("advisor_id", "students_on_list"),
    "effect_cards": ("", "alerts_raised alerts_actioned reach_rate"),
    "engagement": ("week_number mode", "avg_logins"),
}


def _long(visual: str, df):
    groups, measures = (c.split() for c in VISUALS[visual])
    label = F.concat_ws("|", F.lit(""), *(F.coalesce(F.col(c).cast("string"), F.lit("-"))
                                          for c in groups))
    rows = F.array(*(F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), 6)
                              .alias("value")) for m in measures))
    return df.select(F.lit(visual).alias("visual"), label.alias("label"), F.inline(rows))


def _long_sql(visual: str) -> str:
    groups, measures = (c.split() for c in VISUALS[visual])
    label = " || ".join(["''", *(f"'|' || coalesce(CAST({c} AS VARCHAR), '-')" for c in groups)])
    return " UNION ALL ".join(
        f"SELECT '{visual}' AS visual, {label} AS label, '{m}' AS measure, "
        f"round(CAST({m} AS DOUBLE), 6) AS value FROM ({REGISTRY[f'rp_{visual}'].sql})"
        for m in measures)


def _page(b: Bound, name: str):
    found = reports.page(b.model, name, lambda df, home: keep(df, f"page-{home}", b.written))
    return stack([_long(visual, df) for visual, df in found.items()])


for _page_name, _visuals in reports.PAGES.items():
    add(f"rp_page_{_page_name}", lambda b, n=_page_name: _page(b, n),
        " UNION ALL ".join(_long_sql(v.__name__) for v in _visuals))
