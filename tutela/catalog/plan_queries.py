"""Quality rules, dimensions, facts, marts, analyses, metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tutela.catalog.bindings import (HALF_YEARS, MATCH_KEYS, MAX_YEAR, NBF_YEAR, TEN_DAYS,
                                     THRESHOLDS, Bound)
from tutela.catalog.registry import add, query
from tutela.catalog.views import VIEWS
from tutela.functions import mixed_date, proper_case, tri_state, upper_trim
from tutela.operators.sets import stack
from tutela.plans import (alerts, evaluation, fairness, identity, marts, quality, realism,
                          references, reports, scoring, security, staging)
from tutela.session import keep

# ------------------------------------------------------------------- quality --
add("dq_survivorship", lambda b: identity.survivorship(b.students, b.active_ids, MATCH_KEYS),
    "SELECT * FROM v_map")
add("dq_dedup", lambda b: b.students_dedup.select("student_id", *MATCH_KEYS),
    "SELECT student_id, postcode, program_code, match_band FROM v_dedup")
add("dq_remap", lambda b: identity.remap(b.activity, b.survivors).groupBy("student_id").agg(
    F.count(F.lit(1)).alias("rows"), F.sum("logins").alias("logins")),
    "SELECT coalesce(surviving_id, student_id) AS student_id, count(*) AS rows, "
    "CAST(sum(logins) AS BIGINT) AS logins FROM v_activity LEFT JOIN v_map "
    "ON duplicate_id = student_id GROUP BY 1")
_RULE = "SELECT * FROM v_issues WHERE rule_id = '{}'"
add("dq_R01", lambda b: quality.duplicate_issues(b.survivors), _RULE.format(quality.DUPLICATE))
for _id, _rule in (("dq_R02", quality.MARK), ("dq_R03", quality.CAMPUS),
                   ("dq_R06", quality.ORPHAN_ENROLMENT)):
    add(_id, lambda b, r=_rule: quality.enrolment_issues(b.judged, [r]), _RULE.format(_rule))
for _id, _rule in (("dq_R04", quality.FLAG), ("dq_R05", quality.DOB)):
    add(_id, lambda b, r=_rule: quality.student_issues(b.students_dedup, [r]), _RULE.format(_rule))
add("dq_R07", lambda b: quality.activity_issues(b.activity, b.students),
    _RULE.format(quality.ORPHAN_ACTIVITY))
add("dq_quarantine", lambda b: b.rejected.select(
    "student_id", "unit_code", "term_code", "campus_code", "mark", "reject_rule"),
    "SELECT student_id, unit_code, term_code, campus_code, mark, reject_rule FROM v_rej")
add("dq_clean", lambda b: b.clean, "SELECT * FROM v_clean")
add("dq_summary", lambda b: b.dq_summary, "SELECT * FROM m_dq")
add("dq_integrity", lambda b: quality.integrity(b.enrolments, b.dim_student),
    "SELECT count(*) AS orphans FROM v_enrol WHERE student_id NOT IN "
    "(SELECT student_id FROM d_student)")


@query("dq_constraints", """
    SELECT 'NN_grade' AS rule_id, 'FATAL' AS severity, 'enrolments' AS table_name,
           student_id || '|' || unit_code || '|' || term_code AS row_key, 'missing' AS detail
    FROM v_enrol WHERE nullif(grade, 'IP') IS NULL
    UNION ALL
    SELECT 'CK_mark', 'FATAL', 'enrolments', student_id || '|' || unit_code || '|' || term_code,
           'check failed' FROM v_enrol WHERE mark NOT BETWEEN 0 AND 100
    UNION ALL
    SELECT 'CK_status', 'FATAL', 'enrolments', student_id || '|' || unit_code || '|' || term_code,
           'check failed' FROM v_enrol WHERE enrolment_status = 'In progress'
    UNION ALL
    SELECT 'PK_student_id_unit_code_term_code', 'FATAL', 'enrolments',
           student_id || '|' || unit_code || '|' || term_code, count(*) || ' rows'
    FROM v_enrol GROUP BY student_id, unit_code, term_code HAVING count(*) > 1
    UNION ALL
    SELECT 'FK_student_id', 'FATAL', 'enrolments', student_id || '|' || unit_code || '|'
           || term_code, 'student_id=' || student_id
    FROM v_enrol WHERE student_id NOT IN (SELECT student_id FROM v_students)
    UNION ALL
    SELECT 'FK_term_code', 'FATAL', 'enrolments', student_id || '|' || unit_code || '|'
           || term_code, 'term_code=' || term_code
    FROM v_enrol WHERE term_code NOT IN (SELECT term_code FROM v_terms)""")
def dq_constraints(b: Bound):
    b.share("enrolments", "students")
    rows = b.enrolments.withColumn("grade", F.nullif(F.col("grade"), F.lit("IP")))
    return quality.check_constraints(
        rows, "enrolments", pk=["student_id", "unit_code", "term_code"],
        fks=[("student_id", b.students, "student_id"), ("term_code", b.terms, "term_code")],
        required=["grade"],
        checks={"mark": F.col("mark").between(0, 100),
                "status": F.col("enrolment_status").isin("Completed", "Withdrawn pre-census")})


@query("dq_log_time", "SELECT rule_id, count(*) AS rows, true AS stamped FROM v_issues "
                      "GROUP BY rule_id")
def dq_log_time(b: Bound):
    return quality.stamp(b.issues).groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("loaded_at").isNotNull())
        .alias("stamped"))


# Defects are drawn from md5 digests, which any engine can recompute.
SEED = 11
_RATES = {"duplicate_student": 0.05, "missing_equity_flag": 0.10, "campus_code_variant": 0.10,
          "mark_out_of_range": 0.05, "name_whitespace_case": 0.10, "dob_format_dmy": 0.10}


def _digest(kind: str, key: str) -> str:
    return f"md5('{kind}|{SEED}|' || {key})"


def _hit(kind: str, key: str) -> str:
    return f"left({_digest(kind, key)}, 8) < '{int(_RATES[kind] * 16 ** 8):08x}'"


def _coin(kind: str, key: str) -> str:
    return f"substr({_digest(kind, key)}, 9, 1) < '8'"


_KEY3 = "student_id || '|' || unit_code || '|' || term_code"
_SPELLINGS = {"NSY": "AFRICA", "MEL": "AMERICA", "BRI": "ASIA", "STR": "EUROPE"}


def _variant_sql() -> str:
    arms = []
    for code, words in scoring.VARIANTS.items():
        listed = "[" + ", ".join(f"'{w}'" for w in words) + "]"
        n = f"CAST('0x' || substr({_digest('campus_code_variant', _KEY3)}, 10, 6) AS BIGINT)"
        arms.append(f"WHEN '{code}' THEN {listed}[1 + {n} % {len(words)}]")
    return "CASE campus " + " ".join(arms) + " END"


_CAMPUS_SQL = "CASE campus_code " + " ".join(
    f"WHEN '{r}' THEN '{c}'" for c, r in _SPELLINGS.items()) + " ELSE campus_code END"


def _defect_tables(b: Bound):
    b.share("students", "enrolments")  # every kind of defect reads them
    people = b.students.withColumns({
        "first_nations_flag": F.left("first_nations", F.lit(1)),
        "disability_flag": F.left("disability", F.lit(1)),
        "dob": F.col("dob").cast("string")})
    codes = None
    for code, region in _SPELLINGS.items():
        test = F.col("campus_code") == region
        codes = F.when(test, code) if codes is None else codes.when(test, code)
    rows = b.enrolments.withColumn("campus_code", F.coalesce(codes, "campus_code"))
    return people, rows


@query("dq_inject", f"""
    SELECT 'duplicate_student' AS defect_type, 'banner_students' AS "table",
           CAST(student_id + (SELECT max(student_id) FROM v_students) AS VARCHAR) AS row_key,
           'duplicate of ' || student_id AS detail
    FROM v_students WHERE {_hit('duplicate_student', 'student_id')}
    UNION ALL
    SELECT 'missing_equity_flag', 'banner_students', CAST(student_id AS VARCHAR),
           CASE WHEN {_coin('missing_equity_flag', 'student_id')} THEN 'first_nations_flag'
                ELSE 'disability_flag' END
    FROM v_students WHERE {_hit('missing_equity_flag', 'student_id')}
    UNION ALL
    SELECT 'campus_code_variant', 'banner_enrolments', {_KEY3},
           campus || ' -> ' || {_variant_sql()}
    FROM (SELECT *, {_CAMPUS_SQL} AS campus FROM v_enrol)
    WHERE campus IN ('NSY', 'MEL', 'BRI', 'STR') AND {_hit('campus_code_variant', _KEY3)}
    UNION ALL
    SELECT 'mark_out_of_range', 'banner_enrolments', {_KEY3},
           CASE WHEN {_coin('mark_out_of_range', _KEY3)} THEN '105.0' ELSE '-1.0' END
    FROM v_enrol WHERE mark IS NOT NULL AND {_hit('mark_out_of_range', _KEY3)}
    UNION ALL
    SELECT 'name_whitespace_case', 'banner_students', CAST(student_id AS VARCHAR), 'first_name'
    FROM v_students WHERE {_hit('name_whitespace_case', 'student_id')}
    UNION ALL
    SELECT 'dob_format_dmy', 'banner_students', CAST(student_id AS VARCHAR), CAST(dob AS VARCHAR)
    FROM v_students WHERE dob IS NOT NULL AND {_hit('dob_format_dmy', 'student_id')}""")
def dq_inject(b: Bound):
    people, rows = _defect_tables(b)
    logs = []
    for kind in scoring.RATES:
        df = people if kind in scoring.STUDENT_KINDS else rows
        logs.append(scoring.inject(df, kind, _RATES[kind], SEED)[1])
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out


def _damaged(b: Bound):
    """Students and enrolments with all six kinds of defect, each written once, and the log."""
    people, rows = _defect_tables(b)
    people, rows, log = scoring.inject_all(people, rows, _RATES, SEED)
    return keep(people, "damaged-students"), keep(rows, "damaged-enrolments"), log


_NOISY = (f"CASE WHEN {_hit('name_whitespace_case', 'student_id')} THEN CASE WHEN "
          f"{_coin('name_whitespace_case', 'student_id')} THEN '  ' || upper(first_name) "
          "ELSE first_name || ' ' END ELSE first_name END")
_FLAG_HIT, _FLAG_COIN = (f("missing_equity_flag", "student_id") for f in (_hit, _coin))
VIEWS |= {
    "x_copies": f"""
        SELECT * REPLACE (student_id + (SELECT max(student_id) FROM v_students) AS student_id)
        FROM v_students WHERE {_hit('duplicate_student', 'student_id')}""",
    "x_all": "SELECT * FROM v_students UNION ALL SELECT * FROM x_copies",
    "x_people": f"""
        SELECT student_id, {_NOISY} AS first_name,
               CASE WHEN dob IS NOT NULL AND {_hit('dob_format_dmy', 'student_id')}
                    THEN strftime(dob, '%d/%m/%Y') ELSE CAST(dob AS VARCHAR) END AS dob,
               CASE WHEN {_FLAG_HIT} AND {_FLAG_COIN} THEN '' ELSE left(first_nations, 1) END
                   AS first_nations_flag,
               CASE WHEN {_FLAG_HIT} AND NOT {_FLAG_COIN} THEN '' ELSE left(disability, 1) END
                   AS disability_flag
        FROM x_all""",
    "x_map": VIEWS["v_map"].replace("v_students", "x_all"),
    "x_dim": """
        SELECT student_id, upper(left(name, 1)) || lower(substr(name, 2)) AS first_name,
               CASE WHEN dob LIKE '%/%' THEN CAST(try_strptime(trim(dob), '%d/%m/%Y') AS DATE)
                    ELSE try_cast(dob AS DATE) END AS dob,
               CASE first_nations_flag WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Unknown' END
                   AS first_nations,
               CASE disability_flag WHEN 'Y' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Unknown' END
                   AS disability
        FROM (SELECT *, trim(first_name) AS name FROM x_people)
        WHERE student_id NOT IN (SELECT duplicate_id FROM x_map)""",
    "x_rows": f"""
        SELECT student_id, unit_code, term_code,
               CASE WHEN mark IS NOT NULL AND {_hit('mark_out_of_range', _KEY3)}
                    THEN CASE WHEN {_coin('mark_out_of_range', _KEY3)} THEN 105.0 ELSE -1.0 END
                    ELSE mark END AS mark,
               CASE WHEN campus IN ('NSY', 'MEL', 'BRI', 'STR')
                         AND {_hit('campus_code_variant', _KEY3)}
                    THEN {_variant_sql()} ELSE campus END AS campus_code
        FROM (SELECT *, {_CAMPUS_SQL} AS campus FROM v_enrol)""",
}


@query("dq_damaged_students", "SELECT * FROM x_people")
def dq_damaged_students(b: Bound):
    return _damaged(b)[0].select("student_id", "first_name", "dob", "first_nations_flag",
                                 "disability_flag")


@query("dq_damaged_enrolments", "SELECT student_id, unit_code, term_code, "
                                "CAST(mark AS DOUBLE) AS mark, campus_code FROM x_rows")
def dq_damaged_enrolments(b: Bound):
    return _damaged(b)[1].select("student_id", "unit_code", "term_code", "mark", "campus_code")


_KNOWN_SPELLINGS = ", ".join(f"'{v}'" for v in (
    *(variant for variant, _ in references.CAMPUS_SYNONYMS), "MIDDLE EAST"))


@query("dq_catch_rate", f"""
    SELECT coalesce(defect_type, 'TOTAL') AS defect_type, count(*) AS injected,
           count(*) FILTER (WHERE ok) AS handled,
           round(count(*) FILTER (WHERE ok) / count(*)::DOUBLE, 4) AS share
    FROM (SELECT 'mark_out_of_range' AS defect_type, {_KEY3} IN (
                     SELECT {_KEY3} FROM x_rows WHERE mark NOT BETWEEN 0 AND 100) AS ok
          FROM v_enrol WHERE mark IS NOT NULL AND {_hit('mark_out_of_range', _KEY3)}
          UNION ALL
          SELECT 'campus_code_variant', {_KEY3} NOT IN (SELECT {_KEY3} FROM x_rows
              WHERE upper(trim(campus_code)) NOT IN ({_KNOWN_SPELLINGS}))
          FROM (SELECT *, {_CAMPUS_SQL} AS campus FROM v_enrol)
          WHERE campus IN ('NSY', 'MEL', 'BRI', 'STR') AND {_hit('campus_code_variant', _KEY3)}
          UNION ALL
          SELECT 'duplicate_student', student_id IN (SELECT duplicate_id FROM x_map) FROM x_copies
          UNION ALL
          SELECT 'missing_equity_flag', student_id IN (SELECT student_id FROM x_dim
              WHERE 'Unknown' IN (first_nations, disability))
          FROM x_all WHERE {_FLAG_HIT}
          UNION ALL
          SELECT 'name_whitespace_case', (SELECT count(*) = 0 FROM x_dim
              WHERE first_name LIKE ' %' OR first_name LIKE '% ')
          FROM x_all WHERE {_hit('name_whitespace_case', 'student_id')}
          UNION ALL
          SELECT 'dob_format_dmy', (SELECT count(*) = 0 FROM x_dim WHERE dob IS NULL)
          FROM x_all WHERE dob IS NOT NULL AND {_hit('dob_format_dmy', 'student_id')})
    GROUP BY ROLLUP (defect_type)""")
def dq_catch_rate(b: Bound):
    """Damage with all six kinds, stage, find survivors, judge, and look up every defect.

    Birth dates that were never known stay unknown, so the all-or-nothing check of birth dates
    fails on these tables; flags of people merged into others are not logged again.
    """
    people, rows, injected = _damaged(b)
    staged = people.withColumns({
        "first_name": proper_case("first_name"), "dob": mixed_date("dob"),
        "first_nations": tri_state("first_nations_flag"),
        "disability": tri_state("disability_flag")})
    survivors = keep(identity.survivorship(staged, b.active_ids, MATCH_KEYS), "survivors")
    dim = identity.drop_duplicates_by(staged, survivors)
    synonyms = references.synonym_rows(b.spark, [*references.CAMPUS_SYNONYMS,
                                                 ("MIDDLE EAST", "MIDDLE EAST")])
    resolved = staging.resolve_campus(rows.drop("campus_code_raw").withColumn(
        "campus_code_raw", upper_trim("campus_code")).drop("campus_code"), synonyms)
    judged = quality.judge_enrolments(resolved, staged, synonyms)
    issues = stack([quality.duplicate_issues(survivors),
                    quality.student_issues(dim, [quality.FLAG]),
                    quality.enrolment_issues(judged, [quality.MARK, quality.CAMPUS])])
    return scoring.catch_rate(injected, issues, dim)


add("dq_calendar", lambda b: b.outside_calendar,
    "SELECT event_type, count(*) FILTER (WHERE NOT coalesce(CAST(ts AS DATE) BETWEEN "
    "DATE '2024-01-01' AND DATE '2024-01-30', false)) AS outside, count(*) AS events "
    "FROM events GROUP BY event_type")

# ---------------------------------------------------------------- dimensions --
add("dm_term", lambda b: b.fact_enrolment.groupBy("term_code").agg(
    F.count(F.lit(1)).alias("rows")).join(b.terms, "term_code").select(
    "term_code", "term_start", "year", "semester", "is_current", "rows"),
    "SELECT term_code, term_start, year, semester, is_current, count(*) AS rows FROM f_enrol "
    "JOIN v_terms USING (term_code) GROUP BY ALL")
add("dm_campus", lambda b: b.fact_enrolment.groupBy("campus_code").agg(
    F.count(F.lit(1)).alias("rows")).join(b.dim_campus, "campus_code"),
    "SELECT campus_code, r_name AS campus_name, count(*) AS rows FROM f_enrol "
    "JOIN region ON r_name = campus_code GROUP BY ALL")
add("dm_program", lambda b: b.dim_student.groupBy("program_code").agg(
    F.count(F.lit(1)).alias("students")).join(b.programs, "program_code"),
    "SELECT program_code, program_name, field, count(*) AS students FROM d_student "
    "JOIN v_programs USING (program_code) GROUP BY ALL")
add("dm_rates", lambda b: b.dim_student.groupBy("nbf_category").agg(
    F.count(F.lit(1)).alias("students")).join(b.rates, "nbf_category"),
    "SELECT nbf_category, indicative_rate, count(*) AS students FROM d_student "
    "JOIN v_rates USING (nbf_category) GROUP BY ALL")
add("dm_advisor", lambda b: b.fact_case.groupBy("advisor_id").agg(
    F.count(F.lit(1)).alias("cases")).join(b.advisors, "advisor_id").select(
    "advisor_id", "advisor_name", "covered_campuses", "cases"),
    "SELECT advisor_id, advisor_name, covered_campuses, count(*) AS cases FROM f_case "
    "JOIN v_advisors USING (advisor_id) GROUP BY ALL")
add("dm_unit", lambda b: b.dim_unit,
    "SELECT p_partkey AS unit_code, p_name AS unit_name FROM part")
for _id, _col in (("dm_low_ses", "low_ses"), ("dm_regional", "regional_remote"),
                  ("dm_equity", "nbf_equity_cohort"), ("dm_nbf_category", "nbf_category")):
    add(_id, lambda b, c=_col: b.dim_student.select("student_id", c),
        f"SELECT student_id, {_col} FROM d_student")
add("dm_student", lambda b: b.dim_student, "SELECT * FROM d_student")

# --------------------------------------------------------------- facts, marts --
add("fa_enrolment", lambda b: b.fact_enrolment, "SELECT * FROM f_enrol")
add("fa_engagement", lambda b: b.fact_engagement, "SELECT * FROM f_eng")
add("fa_case", lambda b: b.fact_case_linked, "SELECT * FROM f_case")
add("fa_alert", lambda b: b.fact_alert, "SELECT * FROM f_alert")
add("mt_terms", lambda b: b.fact_enrolment.groupBy("term_code").agg(
    F.count(F.lit(1)).alias("rows")).join(marts.terms_ordered(b.terms), "term_code"),
    "SELECT term_code, term_seq, is_current, count(*) AS rows FROM f_enrol JOIN (SELECT term_code, "
    "is_current, CAST(row_number() OVER (ORDER BY term_start) AS INTEGER) AS term_seq "
    "FROM v_terms) USING (term_code) GROUP BY ALL")
add("mt_executive", lambda b: b.executive, "SELECT * FROM m_executive")
add("mt_presence", lambda b: marts.presence(b.fact_enrolment),
    "SELECT DISTINCT student_id, CAST(left(term_code, 4) AS INTEGER) AS year FROM f_enrol")
add("mt_retention_flag", lambda b: b.retention_flags.select(
    "student_id", "commencing_year", "retained_y1"),
    "SELECT student_id, commencing_year, retained_y1 FROM v_flags")
add("mt_retention", lambda b: b.retention, "SELECT * FROM m_retention")
add("mt_nbf", lambda b: b.nbf, "SELECT * FROM m_nbf")
add("mt_seheef", lambda b: b.seheef, "SELECT * FROM m_seheef")
add("mt_triage", lambda b: b.triage, "SELECT * FROM m_triage")
add("mt_effect_input", lambda b: b.effect_input, "SELECT * FROM m_effect")
add("mt_dq", lambda b: b.dq_summary, "SELECT * FROM m_dq")
add("mt_trend", lambda b: b.trend, "SELECT * FROM m_trend")

# ------------------------------------------------------------------- analyses --
add("an_naive", lambda b: evaluation.naive(b.cells).select(
    F.round("estimate", 9).alias("estimate")),
    "SELECT round(avg(retained_next_term) FILTER (WHERE contacted = 1) "
    "- avg(retained_next_term) FILTER (WHERE contacted = 0), 9) AS estimate FROM m_effect")
add("an_strata", lambda b: b.cells, "SELECT stratum, contacted, outcome, n FROM v_cells")
add("an_cem", lambda b: evaluation.cem(b.cells).select(
    F.round("estimate", 9).alias("estimate"), "n_strata",
    F.round("matched_share", 9).alias("matched_share")),
    "SELECT round(estimate, 9) AS estimate, n_strata, round(matched_share, 9) AS matched_share "
    "FROM v_matched")


ESTIMATES = (
    "SELECT 'Naive difference' AS estimator, round_even(100 * "
    "(avg(retained_next_term) FILTER (WHERE contacted = 1) "
    "- avg(retained_next_term) FILTER (WHERE contacted = 0)), 2) AS estimate_pp, "
    "'Biased: contacted students are selected for severity' AS note FROM m_effect UNION ALL "
    "SELECT 'Coarsened exact matching', round_even(100 * estimate, 2), n_strata || ' strata; ' "
    "|| CAST(round_even(100 * matched_share, 0) AS INTEGER) || '% of treated matched' "
    "FROM v_matched")
# Intervals are random draws: what is compared is that they are complete and hold the estimate.
_POINTS = ("SELECT 'Naive difference' AS estimator, "
           "avg(retained_next_term) FILTER (WHERE contacted = 1) "
           "- avg(retained_next_term) FILTER (WHERE contacted = 0) AS estimate, n_strata, "
           "matched_share FROM m_effect CROSS JOIN v_matched GROUP BY n_strata, matched_share "
           "UNION ALL SELECT 'Coarsened exact matching', estimate, n_strata, matched_share "
           "FROM v_matched")


def _holds(low: str, mid: str, high: str):
    return (F.col(low) <= F.col(mid)) & (F.col(mid) <= F.col(high)) & (F.col(low) < F.col(high))


add("an_bootstrap", lambda b: evaluation.bootstrap(b.cells).select(
    "estimator", F.round("estimate", 9).alias("estimate"), "n_strata",
    F.round("matched_share", 9).alias("matched_share"),
    _holds("ci_low", "estimate", "ci_high").alias("in_order"),
    (F.col("replicates") == evaluation.REPLICATES).alias("complete")),
    "SELECT estimator, round(estimate, 9) AS estimate, n_strata, "
    f"round(matched_share, 9) AS matched_share, true AS in_order, true AS complete FROM ({_POINTS})")
add("an_results", lambda b: b.results().select(
    "estimator", "estimate_pp", "note",
    _holds("ci_low_pp", "estimate_pp", "ci_high_pp").alias("in_order")),
    f"SELECT *, true AS in_order FROM ({ESTIMATES})")
add("an_estimates", lambda b: evaluation.estimates(b.effect_input), ESTIMATES)
VERDICT = (
    "SELECT naive_pp, matched_pp, CASE WHEN matched_pp > 0 AND matched_pp > naive_pp "
    "THEN 'RECOVERED' ELSE 'NOT RECOVERED' END AS verdict, "
    "CASE WHEN naive_pp < 0 THEN 'wrong' ELSE 'attenuated' END AS naive_sign "
    "FROM (SELECT (SELECT round_even(100 * (avg(retained_next_term) FILTER (WHERE contacted = 1) "
    "- avg(retained_next_term) FILTER (WHERE contacted = 0)), 2) FROM m_effect) AS naive_pp, "
    "(SELECT round_even(100 * estimate, 2) FROM v_matched) AS matched_pp)")
add("an_verdict", lambda b: evaluation.verdict(evaluation.estimates(b.effect_input)), VERDICT)
add("an_fairness", lambda b: b.fairness, "SELECT * FROM m_fair")
add("an_fair_verdict", lambda b: fairness.fair_verdict(b.fairness),
    "SELECT max(abs(contact_rate_gap_pp_vs_nonequity)) AS max_gap_pp, CASE WHEN "
    "max(abs(contact_rate_gap_pp_vs_nonequity)) <= 3.0 THEN 'PASS' ELSE 'REVIEW REQUIRED' END "
    "AS verdict FROM m_fair WHERE cohort <> 'All domestic'")
HEADLINE = f"""
    SELECT 'retention' AS metric, CAST(commencing_year AS VARCHAR) AS label,
           retention_rate AS value FROM m_retention WHERE cohort = 'All domestic'
    UNION ALL SELECT 'triage_size', 'current', CAST(count(*) AS DOUBLE) FROM m_triage
    UNION ALL SELECT 'tier', priority_tier, CAST(count(*) AS DOUBLE) FROM m_triage
              GROUP BY priority_tier
    UNION ALL SELECT 'funding', '{NBF_YEAR}', CAST(coalesce(sum(indicative_funding), 0) AS DOUBLE)
              FROM m_nbf WHERE commencing_year = {NBF_YEAR}"""
add("an_headline", lambda b: reports.headline(b.retention, b.triage, b.nbf, NBF_YEAR), HEADLINE)

_OUTREACH = """
    SELECT k.student_id, k.term_code, CASE WHEN a.student_id IS NULL THEN 0 ELSE 1 END AS alerted,
           coalesce(a.contacted, 0) AS contacted, coalesce(c.reached, 0) AS reached,
           coalesce(c.effect, 0) AS effect
    FROM (SELECT DISTINCT student_id, term_code FROM f_eng) k
    LEFT JOIN (SELECT student_id, term_code, max(CASE WHEN lifecycle_status LIKE 'Actioned%'
                      OR lifecycle_status LIKE 'Covered%' THEN 1 ELSE 0 END) AS contacted
               FROM f_alert GROUP BY student_id, term_code) a
      ON a.student_id = k.student_id AND a.term_code = k.term_code
    LEFT JOIN (SELECT student_id, term_code,
                      max(CASE WHEN contact_outcome LIKE 'Reached%' THEN 1 ELSE 0 END) AS reached,
                      max(CASE WHEN contact_outcome = 'Reached - support plan agreed' THEN 1
                          ELSE 0 END) AS effect
               FROM f_case WHERE source = 'Early alert' GROUP BY student_id, term_code) c
      ON c.student_id = k.student_id AND c.term_code = k.term_code"""
def _realism(b: Bound):
    # each is read by several of the sections
    b.share("fact_enrolment", "fact_engagement", "fact_alert", "dim_student")
    return realism.realism(b.dim_student, b.fact_enrolment, b.fact_engagement, b.fact_alert,
                           b.fact_case, MAX_YEAR)


add("an_realism", _realism, f"""
    SELECT 'retention' AS section, cohort AS label, round(avg(CASE WHEN back THEN 1.0::DOUBLE
           ELSE 0 END), 4) AS value
    FROM (SELECT d.student_id, d.mode, d.student_status = 'completed'
                 OR coalesce(e.last_year > d.commencing_year, false) AS back
          FROM d_student d LEFT JOIN (SELECT student_id, max(CAST(left(term_code, 4) AS INTEGER))
               AS last_year FROM f_enrol GROUP BY student_id) e ON e.student_id = d.student_id
          WHERE d.citizenship = 'Domestic' AND d.commencing_year <= {MAX_YEAR})
    JOIN (SELECT * FROM v_cohorts UNION ALL SELECT student_id, 'On-campus' FROM d_student
          WHERE mode = 'On-campus') USING (student_id) GROUP BY cohort
    UNION ALL
    SELECT 'grade', grade, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) FROM f_enrol
    WHERE grade IN ('HD', 'DI', 'CR', 'PA', 'NN') GROUP BY grade
    UNION ALL
    SELECT 'discontinued', CASE contacted WHEN 1 THEN 'contacted' ELSE 'not contacted' END,
           round(avg(CASE WHEN student_status = 'discontinued' THEN 1.0::DOUBLE ELSE 0 END), 4)
    FROM ({_OUTREACH}) JOIN (SELECT student_id, student_status FROM d_student) USING (student_id)
    WHERE alerted = 1 GROUP BY contacted
    UNION ALL
    SELECT 'marks', label, value FROM (
        SELECT round(avg(CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA', 'NN')
                         THEN least(greatest(mark, 0), 100) END), 1) AS mean_mark,
               CAST(count(*) FILTER (WHERE grade = 'WW') AS DOUBLE) AS withdrawn_pre,
               CAST(count(*) FILTER (WHERE grade = 'WN') AS DOUBLE) AS withdrawn_post,
               CAST(count(*) FILTER (WHERE grade IN ('HD', 'DI', 'CR', 'PA', 'NN')) AS DOUBLE)
                   AS graded FROM f_enrol)
    UNPIVOT (value FOR label IN (mean_mark, withdrawn_pre, withdrawn_post, graded))
    UNION ALL
    SELECT 'outreach', label, value FROM (
        SELECT CAST(count(*) AS DOUBLE) AS student_terms, round(avg(o.alerted), 4) AS alerted,
               round(avg(o.contacted) FILTER (WHERE o.alerted = 1), 4) AS contacted,
               round(avg(o.reached) FILTER (WHERE o.alerted = 1), 4) AS reached,
               round(avg(o.effect) FILTER (WHERE o.alerted = 1), 4) AS effect
        FROM ({_OUTREACH}) o)
    UNPIVOT (value FOR label IN (student_terms, alerted, contacted, reached, effect))""")
add("an_alert_rules", lambda b: b.alerts, "SELECT * FROM v_alerts")
add("an_severity", lambda b: alerts.severity(b.alerts, b.activity, THRESHOLDS, collapse=False),
    "SELECT student_id, term_code, alert_week, reasons_at_alert, logins_2wk <= 0 AS low_login "
    "FROM (SELECT student_id, term_code, min(week_number) AS alert_week, count(*) FILTER "
    "(WHERE week_number = first_week) AS reasons_at_alert FROM (SELECT *, min(week_number) OVER "
    "(PARTITION BY student_id, term_code) AS first_week FROM v_alerts) "
    "GROUP BY student_id, term_code) f LEFT JOIN (SELECT student_id, term_code, week_number AS "
    "alert_week, logins_2wk FROM v_signals) USING (student_id, term_code, alert_week)")

# ------------------------------------------------------------------- measures --


# query names that are shorter than the measure's
_SHORT = {
    "eftsl_certified": "eftsl_cert", "eftsl_passed": "eftsl_pass",
    "success_rate_all": "success_all", "success_rate": "success_graded",
    "average_mark": "avg_mark", "pre_census_withdrawals": "withdrawals",
    "alert_action_rate": "action_rate", "median_days_to_action": "median_days_action",
    "open_alerts_current": "open_current", "p1_students": "p1", "students_on_list": "on_list",
    "cases_opened": "cases", "reach_rate": "reach", "median_days_case_open": "median_days_open",
    "nbf_indicative_funding": "nbf_funding", "nbf_commencing_students": "nbf_students",
    "nbf_support_coverage": "nbf_coverage", "avg_weekly_logins": "avg_logins",
    "missed_item_rate": "missed_rate",
}


def _measure(name: str, by: list[str], select: str, source: str, group: str):
    names = [x.split(".")[1] for x in by]
    add(f"ms_{_SHORT.get(name, name)}", lambda b: b.model.evaluate([name], by=by),
        f"SELECT {', '.join(f'{g} AS {n}' for g, n in zip(group.split(', '), names))}, "
        f"{select} AS {name} FROM {source} GROUP BY ALL")


_E = ("f_enrol e LEFT JOIN d_student s ON s.student_id = e.student_id "
      "LEFT JOIN v_tt t ON t.term_code = e.term_code")
_EBY, _EG = ["dim_student.mode", "dim_term.year"], "s.mode, t.year"
_measure("headcount", _EBY, "count(DISTINCT e.student_id)", _E, _EG)
_measure("eftsl_certified", _EBY, "sum(eftsl_certified)", _E, _EG)
_measure("eftsl_passed", _EBY, "sum(eftsl_passed)", _E, _EG)
_measure("success_rate_all", _EBY, "sum(eftsl_passed) / nullif(sum(eftsl_certified), 0)", _E, _EG)
_measure("success_rate", _EBY, "sum(eftsl_passed) / nullif(sum(eftsl_certified) FILTER "
         "(WHERE grade IS DISTINCT FROM 'IP'), 0)", _E, _EG)
_measure("average_mark", _EBY, "avg(mark) FILTER (WHERE mark BETWEEN 0 AND 100)", _E, _EG)
_measure("pre_census_withdrawals", _EBY,
         "count(*) FILTER (WHERE enrolment_status = 'Withdrawn pre-census')", _E, _EG)
_A = ("f_alert a LEFT JOIN d_student s ON s.student_id = a.student_id "
      "LEFT JOIN v_programs p ON p.program_code = s.program_code "
      "LEFT JOIN v_tt t ON t.term_code = a.term_code")
_ABY, _AG = ["dim_program.field", "fact_alert.reason_code"], "p.field, a.reason_code"
_DONE = "lifecycle_status LIKE 'Actioned%' OR lifecycle_status LIKE 'Covered%'"
_measure("alerts_raised", _ABY, "count(*)", _A, _AG)
_measure("alerts_actioned", _ABY, f"count(*) FILTER (WHERE {_DONE})", _A, _AG)
_measure("alert_action_rate", _ABY, f"count(*) FILTER (WHERE {_DONE}) / count(*)::DOUBLE", _A, _AG)
_measure("median_days_to_action", _ABY, "median(days_to_action)", _A, _AG)
_measure("open_alerts_current", _ABY,
         "count(*) FILTER (WHERE lifecycle_status = 'Open - awaiting triage' AND t.is_current)",
         _A, _AG)
_T = ("m_triage m LEFT JOIN d_student s ON s.student_id = m.student_id "
      "LEFT JOIN v_advisors a ON a.advisor_id = m.advisor_id")
_TBY, _TG = ["dim_advisor.advisor_name", "dim_student.mode"], "a.advisor_name, s.mode"
_measure("p1_students", _TBY,
         "count(DISTINCT m.student_id) FILTER (WHERE left(priority_tier, 2) = 'P1')", _T, _TG)
_measure("students_on_list", _TBY, "count(DISTINCT m.student_id)", _T, _TG)
_measure("tier_colour", _TBY, "CASE left(min(priority_tier), 2) WHEN 'P1' THEN '#F2B8B5' "
         "WHEN 'P2' THEN '#F7E1A0' WHEN 'P3' THEN '#BFE3DC' ELSE '#E6E6E6' END", _T, _TG)
_C = ("f_case c LEFT JOIN v_advisors a ON a.advisor_id = c.advisor_id "
      "LEFT JOIN v_tt t ON t.term_code = c.term_code")
_CBY, _CG = ["dim_advisor.advisor_name", "dim_term.semester"], "a.advisor_name, t.semester"
_measure("cases_opened", _CBY, "count(*)", _C, _CG)
_measure("reach_rate", _CBY, "count(*) FILTER (WHERE contact_outcome ILIKE '%reached%') / "
         "nullif(count(*) FILTER (WHERE source = 'Early alert'), 0)::DOUBLE", _C, _CG)
_measure("median_days_case_open", _CBY, "median(days_open)", _C, _CG)
_NBY, _NG = ["mart_nbf_funding.commencing_year"], "commencing_year"
_measure("nbf_indicative_funding", _NBY, "CAST(sum(indicative_funding) AS BIGINT)", "m_nbf", _NG)
_measure("nbf_commencing_students", _NBY, "CAST(sum(commencing_students) AS BIGINT)", "m_nbf", _NG)
_measure("nbf_support_coverage", _NBY, "sum(students_with_support_case) / "
         "nullif(sum(commencing_students), 0)::DOUBLE", "m_nbf", _NG)
_RBY, _RG = ["mart_retention_cohort.cohort"], "cohort"
add("ms_retention", lambda b: b.model.evaluate(["retention_rate"], by=_RBY).withColumn(
    "retention_rate", F.round("retention_rate", 9)),
    "SELECT cohort, round(avg(retention_rate), 9) AS retention_rate FROM m_retention "
    "GROUP BY cohort")
add("ms_retention_gap", lambda b: b.model.evaluate(
    ["retention_gap"], by=["mart_retention_cohort.cohort",
                           "mart_retention_cohort.commencing_year"]).withColumn(
    "retention_gap", F.round("retention_gap", 9)),
    "SELECT cohort, commencing_year, round(retention_rate - (SELECT n.retention_rate "
    "FROM m_retention n WHERE n.cohort = 'Non-equity' AND n.commencing_year = m.commencing_year), "
    "9) AS retention_gap FROM m_retention m")
_W = ("f_eng w LEFT JOIN d_student s ON s.student_id = w.student_id")
_WBY, _WG = ["dim_student.mode", "fact_engagement_week.week_number"], "s.mode, w.week_number"
_measure("avg_weekly_logins", _WBY, "avg(logins)", _W, _WG)
_measure("missed_item_rate", _WBY, "sum(missed) / nullif(CAST(sum(items_due) AS DOUBLE), 0)",
         _W, _WG)


# ------------------------------------------------------------------- security --
@query("rl_role", """
    SELECT advisor_id, count(*) AS cases, (SELECT count(*) FROM m_triage
           WHERE advisor_id = 'ADV09') AS on_list FROM f_case WHERE advisor_id = 'ADV09'
    GROUP BY advisor_id""")
def rl_role(b: Bound):
    seen = security.scoped_model(b.model, security.role_predicate("Advisor_ADV09_Online"))
    listed = seen.tables["mart_triage_current"].agg(F.count(F.lit(1)).alias("on_list"))
    return seen.tables["fact_case"].groupBy("advisor_id").agg(
        F.count(F.lit(1)).alias("cases")).withColumn("on_list", listed.scalar())


add("rl_user", lambda b: security.restrict_for_user(
    b.fact_case, b.advisors, "adv03@example.org").select("case_id", "advisor_id"),
    "SELECT case_id, advisor_id FROM f_case JOIN v_advisors USING (advisor_id) "
    "WHERE upn = 'adv03@example.org'")
add("rl_manager", lambda b: security.restrict_for_user(
    b.fact_case, b.advisors, "boss@example.org", is_manager=True).select("case_id", "advisor_id"),
    "SELECT case_id, advisor_id FROM f_case")

# -------------------------------------------------------------------- reports --
_SUCCESS = ("sum(eftsl_passed) / nullif(sum(eftsl_certified) FILTER "
            "(WHERE grade IS DISTINCT FROM 'IP'), 0) AS success_rate")
_MARK = "avg(mark) FILTER (WHERE mark BETWEEN 0 AND 100) AS average_mark"
_GONE = ("count(*) FILTER (WHERE enrolment_status = 'Withdrawn pre-census') "
         "AS pre_census_withdrawals")
add("rp_exec_cards", lambda b: reports.exec_cards(b.model),
    f"SELECT count(DISTINCT student_id) AS headcount, {_SUCCESS}, "
    f"sum(eftsl_certified) AS eftsl_certified, {_MARK}, {_GONE} FROM f_enrol")
add("rp_success_term_mode", lambda b: reports.success_term_mode(b.model),
    f"SELECT t.term_code, s.mode, {_SUCCESS} FROM {_E} GROUP BY t.term_code, s.mode")
add("rp_success_campus", lambda b: reports.success_campus(b.model),
    f"SELECT r_name AS campus_name, {_SUCCESS} FROM f_enrol LEFT JOIN region "
    "ON r_name = campus_code GROUP BY r_name")
add("rp_program_matrix", lambda b: reports.program_matrix(b.model),
    "SELECT field, program_name, CAST(grouping(field) + grouping(program_name) AS INTEGER) "
    f"AS level, count(DISTINCT e.student_id) AS headcount, {_SUCCESS}, {_MARK}, {_GONE} "
    "FROM f_enrol e LEFT JOIN d_student s ON s.student_id = e.student_id "
    "LEFT JOIN v_programs p ON p.program_code = s.program_code "
    "GROUP BY ROLLUP (field, program_name)")
add("rp_equity_cards", lambda b: reports.equity_cards(b.model, NBF_YEAR),
    "SELECT CAST(sum(indicative_funding) AS BIGINT) AS nbf_indicative_funding, "
    "CAST(sum(commencing_students) AS BIGINT) AS nbf_commencing_students, "
    "sum(students_with_support_case) / sum(commencing_students)::DOUBLE AS nbf_support_coverage, "
    "(SELECT count(*) FROM f_case) AS cases_opened FROM m_nbf "
    f"WHERE commencing_year = {NBF_YEAR}")
add("rp_retention_cohort", lambda b: reports.retention_cohort(b.model).withColumn(
    "retention_rate", F.round("retention_rate", 9)),
    "SELECT cohort, round(avg(retention_rate), 9) AS retention_rate FROM m_retention "
    "GROUP BY cohort")
add("rp_retention_trend", lambda b: reports.retention_trend(b.model),
    "SELECT commencing_year, cohort, retention_rate FROM m_retention")
add("rp_nbf_table", lambda b: reports.nbf_table(b.model, NBF_YEAR),
    "SELECT nbf_category, indicative_rate, CAST(sum(commencing_students) AS BIGINT) "
    "AS commencing_students, CAST(sum(indicative_funding) AS BIGINT) AS indicative_funding, "
    "avg(support_coverage) AS support_coverage FROM m_nbf "
    f"WHERE commencing_year = {NBF_YEAR} GROUP BY ALL")
CALENDAR_YEARS = sorted({term[4] for term in HALF_YEARS + TEN_DAYS})
add("rp_seheef_matrix", lambda b: reports.seheef_matrix(b.model, CALENDAR_YEARS),
    "SELECT seheef_activity, seheef_life_stage, " + ", ".join(
        f"CAST(sum({c}) FILTER (WHERE {test}) AS BIGINT) AS {c}_{y}" for y, test in (
            *((y, f"year = {y}") for y in CALENDAR_YEARS),
            ("other", "year IS NULL OR year NOT IN "
                      f"({', '.join(map(str, CALENDAR_YEARS))})")) for c in ("cases", "students"))
    + " FROM m_seheef GROUP BY seheef_activity, seheef_life_stage")
add("rp_triage_cards", lambda b: reports.triage_cards(b.model),
    "SELECT count(DISTINCT student_id) AS students_on_list, count(DISTINCT student_id) FILTER "
    "(WHERE left(priority_tier, 2) = 'P1') AS p1_students, "
    f"(SELECT count(*) FILTER (WHERE {_DONE}) / count(*)::DOUBLE FROM f_alert) "
    "AS alert_action_rate, (SELECT median(days_to_action) FROM f_alert) AS median_days_to_action "
    "FROM m_triage")
add("rp_triage_table", lambda b: reports.triage_table(b.model),
    "SELECT priority_tier, student_name, student_id, program_name, home_campus_code, mode, "
    "reasons, latest_alert_week, logins_last2wk, missed_last2wk, nbf_equity_cohort, case_status, "
    "advisor_id, CASE left(priority_tier, 2) WHEN 'P1' THEN '#F2B8B5' WHEN 'P2' THEN '#F7E1A0' "
    "WHEN 'P3' THEN '#BFE3DC' ELSE '#E6E6E6' END AS tier_colour FROM m_triage")
add("rp_triage_tiers", lambda b: reports.triage_tiers(b.model),
    "SELECT DISTINCT priority_tier FROM m_triage")


@query("rp_triage_advisors", "SELECT DISTINCT advisor_name FROM m_triage JOIN v_advisors "
                             "USING (advisor_id)")
def rp_triage_advisors(b: Bound):
    """The slicer's names, narrowed to advisors with somebody on the list."""
    busy = b.advisors.join(b.triage.select("advisor_id"), "advisor_id", "left_semi")
    return reports.triage_advisors(b.model.scoped({"dim_advisor": busy}))


add("rp_triage_slicers", lambda b: reports.triage_slicers(b.model),
    "SELECT DISTINCT 'priority_tier' AS slicer, priority_tier AS value FROM m_triage UNION ALL "
    "SELECT DISTINCT 'advisor_name', advisor_name FROM m_triage JOIN v_advisors "
    "USING (advisor_id)")
add("rp_caseload", lambda b: reports.caseload(b.model),
    "SELECT advisor_id, count(DISTINCT student_id) AS students_on_list FROM m_triage "
    "GROUP BY advisor_id")


def _with_results(b: Bound):
    return b.model.scoped({"mart_effectiveness_results": b.results()})


add("rp_effect_table", lambda b: reports.effect_table(_with_results(b)).select(
    "estimator", "note", "estimate_pp",
    _holds("ci_low_pp", "estimate_pp", "ci_high_pp").alias("in_order")),
    f"SELECT estimator, note, estimate_pp, true AS in_order FROM ({ESTIMATES})")
add("rp_effect_bar", lambda b: reports.effect_bar(b.model.scoped({
    "mart_effectiveness_results": evaluation.estimates(b.effect_input)})),
    "SELECT 'Naive difference' AS estimator, round_even(100 * "
    "(avg(retained_next_term) FILTER (WHERE contacted = 1) "
    "- avg(retained_next_term) FILTER (WHERE contacted = 0)), 2) AS estimate_pp FROM m_effect "
    "UNION ALL SELECT 'Coarsened exact matching', round_even(100 * estimate, 2) FROM v_matched")
add("rp_engagement", lambda b: reports.engagement(b.model).withColumn(
    "avg_logins", F.round("avg_logins", 9)),
    "SELECT week_number, mode, round(avg(avg_logins), 9) AS avg_logins FROM m_trend "
    "GROUP BY week_number, mode")
add("rp_effect_cards", lambda b: reports.effect_cards(b.model),
    f"SELECT count(*) AS alerts_raised, count(*) FILTER (WHERE {_DONE}) AS alerts_actioned, "
    "(SELECT count(*) FILTER (WHERE contact_outcome ILIKE '%reached%') / "
    "nullif(count(*) FILTER (WHERE source = 'Early alert'), 0)::DOUBLE FROM f_case) AS reach_rate "
    "FROM f_alert")
add("rp_dq_card", lambda b: reports.dq_card(b.model),
    "SELECT CAST(sum(issues) AS BIGINT) AS issues FROM m_dq")
add("rp_dq_table", lambda b: reports.dq_table(b.model), "SELECT * FROM m_dq")
add("rp_dq_bar", lambda b: reports.dq_bar(b.model),
    "SELECT rule_id, CAST(sum(issues) AS BIGINT) AS issues FROM m_dq GROUP BY rule_id")

