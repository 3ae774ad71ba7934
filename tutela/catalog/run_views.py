"""The whole run as SQL: what its tables hold, computed straight from the supplied tables."""

from __future__ import annotations

import re

from tutela.catalog.bindings import PROGRAMS
from tutela.catalog.extracts import REASONS, RUN_MAX_YEAR, TERM_OF
from tutela.catalog.views import _DAY, _INSIDE, VIEWS, _half, _person

_NOW = "2001S2"


def _choice(number: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][CAST(1 + {number} % {len(values)} AS INTEGER)]"


def _term(day: str) -> str:
    one, two, three = TERM_OF.values()
    return f"CASE WHEN {day} <= 10 THEN '{one}' WHEN {day} <= 20 THEN '{two}' ELSE '{three}' END"


RUN_VIEWS = {
    "r_students": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS student_id,
               left(c_mktsegment, 1) || lower(substr(c_mktsegment, 2)) AS first_name,
               'N' || c_nationkey AS last_name,
               CASE WHEN c_custkey % 97 <> 0 AND c_custkey % 89 <> 0
                    THEN DATE '1930-01-01' + CAST(c_custkey % 12 * 2000 AS INTEGER) END AS dob,
               {_choice('c_custkey', 'F', 'M', 'X')} AS gender,
               CASE WHEN c_nationkey % 10 = 0 THEN 'International' ELSE 'Domestic' END
                   AS citizenship,
               CAST(c_nationkey AS VARCHAR) AS postcode, left(r_name, 2) AS state,
               r_name AS home_campus_code, c_mktsegment AS program_code, commencing_term,
               CASE WHEN c_custkey % 3 = 0 THEN 'Part-time' ELSE 'Full-time' END
                   AS attendance_type,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Online' ELSE 'On-campus' END AS mode,
               {_choice('c_custkey', 'u25', '25+')} AS age_group,
               {_choice('c_custkey', 'School', 'VET', 'Mature age', 'Other')}
                   AS basis_of_admission,
               CASE WHEN c_custkey % 5 IN (0, 4) THEN c_acctbal END AS atar,
               {_choice('c_custkey', 'No', 'Yes', 'No', 'No', 'Unknown')} AS first_nations,
               {_choice('c_custkey', 'No', 'No', 'Yes', 'No', 'No', 'No', 'Unknown')}
                   AS disability,
               {_choice('c_custkey', 'Yes', 'No')} AS nesb,
               {_choice('c_custkey', 'completed', 'discontinued', 'active', 'active')}
                   AS student_status,
               CASE WHEN c_custkey % 4 = 1 THEN commencing_term END AS status_term
        FROM customer JOIN v_regions ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, min({_half('o_orderdate')}) AS commencing_term
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "r_enrol": f"""
        SELECT CAST({_person('o_custkey')} AS VARCHAR) AS student_id,
               CAST(l_partkey AS VARCHAR) AS unit_code, {_half('o_orderdate')} AS term_code,
               coalesce(canonical, upper(n_name)) AS campus_code,
               upper(n_name) AS campus_code_raw,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Withdrawn pre-census'
                    WHEN o_orderdate >= DATE '2001-07-01' THEN 'In progress'
                    ELSE 'Completed' END AS enrolment_status,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'WW'
                    WHEN o_orderdate >= DATE '2001-07-01' THEN 'IP'
                    WHEN l_quantity >= 41.5 THEN 'HD' WHEN l_quantity >= 36.5 THEN 'DI'
                    WHEN l_quantity >= 31.5 THEN 'CR' WHEN l_quantity >= 24 THEN 'PA'
                    ELSE 'NN' END AS grade,
               CASE WHEN o_orderdate < DATE '2001-07-01' THEN 2 * l_quantity + 2 END AS mark,
               CAST(0.125 AS DOUBLE) AS eftsl,
               make_date(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN 2 ELSE 8 END, 1)
                   AS census_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN v_syn ON variant = upper(n_name)""",
    "r_map": """
        SELECT s.student_id AS duplicate_id, g.survivor AS surviving_id FROM r_students s
        JOIN (SELECT first_name, last_name, dob, program_code, commencing_term,
                     count(*) AS members,
                     coalesce(min(student_id) FILTER (WHERE student_id IN
                         (SELECT student_id FROM r_enrol)), min(student_id)) AS survivor
              FROM r_students GROUP BY ALL) g
          ON s.first_name = g.first_name AND s.last_name = g.last_name
         AND s.program_code = g.program_code AND s.dob IS NOT DISTINCT FROM g.dob
         AND s.commencing_term IS NOT DISTINCT FROM g.commencing_term
        WHERE members > 1 AND s.student_id <> survivor""",
    "r_dedup": "SELECT * FROM r_students WHERE student_id NOT IN (SELECT duplicate_id FROM r_map)",
    "r_dim_student": """
        SELECT s.*, first_name || ' ' || last_name AS student_name, ses_quartile, remoteness,
               CAST(left(commencing_term, 4) AS INTEGER) AS commencing_year,
               CASE WHEN citizenship = 'Domestic' AND ses_quartile = 1 THEN 'Yes' ELSE 'No' END
                   AS low_ses,
               CASE WHEN citizenship = 'Domestic' AND remoteness <> 'Metropolitan'
                    THEN 'Yes' ELSE 'No' END AS regional_remote,
               CASE WHEN citizenship = 'Domestic'
                     AND (ses_quartile = 1 OR first_nations = 'Yes') THEN 'Yes' ELSE 'No' END
                   AS nbf_equity_cohort,
               CASE WHEN citizenship <> 'Domestic' THEN 'Not applicable'
                    WHEN ses_quartile = 1 AND first_nations = 'Yes' THEN 'Low SES + First Nations'
                    WHEN first_nations = 'Yes' THEN 'First Nations'
                    WHEN ses_quartile = 1 AND atar >= 80 THEN 'Low SES (high preparedness)'
                    WHEN ses_quartile = 1 THEN 'Low SES' ELSE 'Not applicable' END
                   AS nbf_category
        FROM r_dedup s JOIN v_postcode p ON s.postcode = CAST(p.postcode AS VARCHAR)""",
    "r_campus": "SELECT r_name AS campus_code, 'Campus ' || r_name AS campus_name, "
                "left(r_name, 2) AS state FROM region",
    "r_unit": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS unit_code, p_name AS unit_name,
               {_choice('p_partkey', *(p[0] for p in PROGRAMS), 'RETIRED')} AS program_code,
               CAST(1 + p_partkey % 3 AS INTEGER) AS year_level, CAST(0.125 AS DOUBLE) AS eftsl
        FROM part""",
    "r_advisor": "SELECT advisor_id, advisor_name, covered_campuses FROM v_advisors",
    "r_judged": """
        SELECT *, coalesce(mark > 100, false) AS bad_mark,
               campus_code NOT IN (SELECT canonical FROM v_syn) AS bad_campus,
               student_id NOT IN (SELECT student_id FROM r_students) AS orphan FROM r_enrol""",
    "r_rej": """
        SELECT * EXCLUDE (bad_mark, bad_campus, orphan),
               CASE WHEN bad_mark THEN 'R02_mark_out_of_range'
                    WHEN bad_campus THEN 'R03_unknown_campus'
                    ELSE 'R06_orphan_enrolment' END AS reject_rule
        FROM r_judged WHERE bad_mark OR bad_campus OR orphan""",
    "r_f_enrol": """
        SELECT coalesce(surviving_id, student_id) AS student_id, e.* EXCLUDE (student_id),
               CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN true
                    WHEN grade = 'NN' THEN false END AS passed,
               CASE WHEN grade = 'WW' THEN CAST(0 AS DOUBLE) ELSE eftsl END AS eftsl_certified,
               CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN eftsl ELSE CAST(0 AS DOUBLE) END
                   AS eftsl_passed
        FROM r_enrol e LEFT JOIN r_map ON duplicate_id = student_id
        WHERE (student_id, unit_code, term_code) NOT IN
              (SELECT (student_id, unit_code, term_code) FROM r_rej)""",
    "r_activity": f"""
        SELECT CAST(student_id AS VARCHAR) AS student_id,
               {_choice("(CAST(right(term_code, 1) AS INTEGER) - 1)", *TERM_OF.values())}
                   AS term_code, week_number, week_start,
               logins, 3 * logins + week_number AS page_views, items_due, submitted_on_time,
               submitted_late, missed FROM v_activity""",
    "r_f_eng": """
        SELECT coalesce(surviving_id, student_id) AS student_id, a.* EXCLUDE (student_id)
        FROM r_activity a LEFT JOIN r_map ON duplicate_id = student_id
        WHERE student_id IN (SELECT student_id FROM r_students)""",
    "r_alerts": f"""
        SELECT 'A' || event_id AS alert_id, CAST({_person('user_id')} AS VARCHAR) AS student_id,
               {_term(_DAY)} AS term_code, CAST(1 + ({_DAY} - 1) % 10 AS INTEGER) AS week_number,
               CAST(ts AS DATE) AS raised_date,
               {_choice('event_id', *REASONS)} AS reason_code
        FROM events WHERE event_type = 'error' AND {_INSIDE}""",
    "r_f_case": f"""
        SELECT 'C' || event_id AS case_id, coalesce(surviving_id, sid) AS student_id,
               c.term_code, opened_date,
               CASE event_id % 4 WHEN 0 THEN 'Early alert' WHEN 3 THEN 'Staff referral'
                    ELSE 'Self-referral' END AS source,
               'Type ' || event_id % 4 AS case_type, 'Activity ' || event_id % 5
                   AS seheef_activity,
               'Stage ' || event_id % 3 AS seheef_life_stage,
               'ADV' || lpad(CAST(1 + user_id % 11 AS VARCHAR), 2, '0') AS advisor_id,
               nullif({_choice('event_id', 'Phone', 'Email', '')}, '') AS contact_channel,
               {_choice('event_id', 'Reached - support plan agreed', 'Voicemail left',
                        'Service provided')} AS contact_outcome,
               CASE WHEN value < 20 THEN 'Open' WHEN value < 50 THEN 'In progress'
                    ELSE 'Closed' END AS status,
               closed_date, CASE WHEN event_id % 4 = 0 THEN first_alert END AS linked_alert_id,
               CAST(closed_date - opened_date AS INTEGER) AS days_open
        FROM (SELECT *, CAST({_person('user_id')} AS VARCHAR) AS sid, {_term(_DAY)} AS term_code,
                     CAST(ts AS DATE) AS opened_date,
                     CASE WHEN value >= 50
                          THEN CAST(ts AS DATE) + CAST(floor(value) AS INTEGER) % 21 END
                         AS closed_date
              FROM events WHERE event_type = 'signup' AND {_INSIDE}) c
        LEFT JOIN (SELECT student_id, term_code, min(alert_id) AS first_alert FROM r_alerts
                   GROUP BY ALL) f ON f.student_id = sid AND f.term_code = c.term_code
        LEFT JOIN r_map ON duplicate_id = sid""",
    "r_f_alert": f"""
        SELECT alert_id, a.sid AS student_id, a.term_code, week_number, raised_date, reason_code,
               case_id AS actioned_case_id, opened_date AS actioned_date, contact_outcome,
               status AS case_status,
               CASE WHEN case_id IS NOT NULL THEN 'Actioned - case opened'
                    WHEN (a.sid, a.term_code) IN (SELECT (student_id, term_code) FROM r_f_case
                                                  WHERE source = 'Early alert')
                    THEN 'Covered by same-term case'
                    WHEN a.term_code = '{_NOW}' THEN 'Open - awaiting triage'
                    ELSE 'Monitored - no contact' END AS lifecycle_status,
               CAST(opened_date - raised_date AS INTEGER) AS days_to_action
        FROM (SELECT r_alerts.*, coalesce(surviving_id, student_id) AS sid
              FROM r_alerts LEFT JOIN r_map ON duplicate_id = student_id) a
        LEFT JOIN (SELECT * FROM r_f_case WHERE linked_alert_id IS NOT NULL
                   QUALIFY row_number() OVER (PARTITION BY linked_alert_id ORDER BY case_id) = 1) c
          ON c.linked_alert_id = alert_id""",
    "r_effect": f"""
        SELECT a.student_id, a.term_code, a.alert_week, a.reasons_at_alert, a.contacted,
               CAST(coalesce((SELECT sum(logins) FROM r_f_eng w WHERE w.student_id = a.student_id
                              AND w.term_code = a.term_code AND w.week_number
                              BETWEEN a.alert_week - 1 AND a.alert_week), 0) AS BIGINT)
                   AS logins_2wk_at_alert,
               CAST(coalesce((SELECT sum(missed) FROM r_f_eng w WHERE w.student_id = a.student_id
                              AND w.term_code = a.term_code AND w.week_number < a.alert_week), 0)
                    AS BIGINT) AS pre_missed,
               d.mode = 'Online' AS online, d.nbf_equity_cohort = 'Yes' AS nbf_equity,
               d.commencing_term = a.term_code AS first_term,
               CASE WHEN d.student_status = 'completed' OR (a.student_id,
                         CASE a.term_code WHEN '2000S2' THEN '2001S1' ELSE '2001S2' END)
                         IN (SELECT (student_id, term_code) FROM r_f_enrol)
                    THEN 1 ELSE 0 END AS retained_next_term
        FROM r_alerted a JOIN r_dim_student d ON d.student_id = a.student_id""",
}
#: What the statements of the bound tables and of the run have in common, by other names.
_NAMES = {"v_students": "r_students", "v_map": "r_map", "v_dedup": "r_dedup",
          "v_judged": "r_judged", "v_rej": "r_rej", "v_activity": "r_activity",
          "d_student": "r_dim_student", "f_enrol": "r_f_enrol", "f_eng": "r_f_eng",
          "f_case": "r_f_case", "f_alert": "r_f_alert", "v_flags": "r_flags",
          "v_cohorts": "r_cohorts", "m_executive": "r_executive", "m_retention": "r_retention",
          "m_nbf": "r_nbf", "m_seheef": "r_seheef", "m_triage": "r_triage",
          "v_alerted": "r_alerted", "m_effect": "r_effect", "m_trend": "r_trend",
          "v_issues": "r_issues", "m_dq": "r_dq", "v_cells": "r_cells",
          "v_matched": "r_matched", "v_fair": "r_fair", "m_fair": "r_m_fair"}


def renamed(text: str) -> str:
    text = re.sub(r"\b[a-z]_\w+\b", lambda m: _NAMES.get(m.group(), m.group()), text)
    return text.replace("2024T3", _NOW).replace("<= 2000", f"<= {RUN_MAX_YEAR}")


for _name, _new in _NAMES.items():
    if _new not in RUN_VIEWS:
        RUN_VIEWS[_new] = renamed(VIEWS[_name])
RUN_VIEWS["r_fair"] = RUN_VIEWS["r_fair"].replace("r_f_eng", "r_f_enrol")  # of enrolled students
# a view stands behind those it names
_order = ["r_flags", "r_cohorts", "r_executive", "r_retention", "r_nbf", "r_seheef", "r_triage",
          "r_alerted", "r_effect", "r_trend", "r_issues", "r_dq", "r_cells", "r_matched", "r_fair",
          "r_m_fair"]
RUN_VIEWS = {n: v for n, v in RUN_VIEWS.items() if n not in _order} | {
    n: RUN_VIEWS[n] for n in _order}
VIEWS |= RUN_VIEWS

#: Columns of floating numbers, which digests take in ten-thousandths.
FLOATS = {"atar", "mark", "eftsl", "eftsl_certified", "eftsl_passed", "success_rate", "avg_mark",
          "retention_rate", "support_coverage", "reach_rate", "avg_logins", "missed_rate",
          "estimate_pp", "naive_pp", "matched_pp", "alert_rate", "contact_rate_given_alert",
          "retained_next_term_contacted", "retained_next_term_uncontacted", "value", "max_gap_pp",
          "alert_rate_ratio_vs_nonequity", "contact_rate_gap_pp_vs_nonequity"}
#: layer -> table -> (view, columns)
RUN_TABLES: dict[str, dict[str, tuple[str, str]]] = {
    "dimensions": {
        "dim_student": ("r_dim_student",
                        "student_id first_name last_name student_name dob gender citizenship "
                        "postcode state home_campus_code program_code commencing_term "
                        "commencing_year attendance_type mode age_group basis_of_admission atar "
                        "first_nations disability nesb ses_quartile remoteness low_ses "
                        "regional_remote nbf_equity_cohort nbf_category student_status "
                        "status_term"),
        "dim_term": ("v_terms", "term_code term_start census_date teaching_weeks year semester "
                                "is_current"),
        "dim_campus": ("r_campus", "campus_code campus_name state"),
        "dim_program": ("v_programs", "program_code program_name field"),
        "dim_unit": ("r_unit", "unit_code unit_name program_code year_level eftsl"),
        "dim_advisor": ("r_advisor", "advisor_id advisor_name covered_campuses")},
    "facts": {
        "fact_enrolment": ("r_f_enrol", "student_id unit_code term_code campus_code "
                           "campus_code_raw enrolment_status grade mark eftsl census_date passed "
                           "eftsl_certified eftsl_passed"),
        "fact_engagement_week": ("r_f_eng", "student_id term_code week_number week_start logins "
                                 "page_views items_due submitted_on_time submitted_late missed"),
        "fact_case": ("r_f_case", "case_id student_id term_code opened_date source case_type "
                      "seheef_activity seheef_life_stage advisor_id contact_channel "
                      "contact_outcome status closed_date linked_alert_id days_open"),
        "fact_alert": ("r_f_alert", "alert_id student_id term_code week_number raised_date "
                       "reason_code actioned_case_id actioned_date contact_outcome case_status "
                       "lifecycle_status days_to_action")},
    "marts": {
        "mart_executive": ("r_executive", "term_code campus_code mode field headcount "
                           "eftsl_certified eftsl_passed success_rate avg_mark "
                           "withdrawals_pre_census"),
        "mart_retention_cohort": ("r_retention", "cohort commencing_year students retention_rate"),
        "mart_nbf_funding": ("r_nbf", "commencing_year nbf_category indicative_rate "
                             "commencing_students indicative_funding students_with_support_case "
                             "support_coverage"),
        "mart_seheef_activity": ("r_seheef", "year seheef_activity seheef_life_stage case_type "
                                 "nbf_equity_cohort cases students reach_rate"),
        "mart_triage_current": ("r_triage", "student_id student_name program_code program_name "
                                "home_campus_code mode attendance_type nbf_equity_cohort "
                                "first_nations disability is_commencing first_alert_week "
                                "latest_alert_week alert_count reasons contacted case_status "
                                "contact_outcome logins_last2wk missed_last2wk priority_tier "
                                "advisor_id"),
        "mart_effectiveness_input": ("r_effect", "student_id term_code alert_week "
                                     "reasons_at_alert contacted logins_2wk_at_alert pre_missed "
                                     "online nbf_equity first_term retained_next_term"),
        "mart_dq_summary": ("r_dq", "rule_id severity table_name issues"),
        "mart_engagement_trend": ("r_trend", "term_code week_number mode nbf_equity_cohort "
                                  "students avg_logins missed_rate")},
    "quality": {
        "dq_issues": ("r_issues", "rule_id severity table_name row_key detail"),
        "rej_enrolments": ("r_rej", "student_id unit_code term_code campus_code campus_code_raw "
                           "enrolment_status grade mark eftsl census_date reject_rule")},
}


def _cell(column: str) -> str:
    text = f"CAST(CAST(round({column} * 10000) AS HUGEINT) AS VARCHAR)" if column in FLOATS else \
        rf"replace(replace(CAST({column} AS VARCHAR), '\', '\\'), '|', '\|')"
    return rf"coalesce({text}, '\N')"


def digest_sql(table: str, view: str, columns: str) -> str:
    row = " || '|' || ".join(_cell(c) for c in sorted(columns.split()))
    return (f"SELECT '{table}' AS table_name, count(*) AS rows, CAST(coalesce(sum(CAST(CAST("
            f"'0x' || left(md5({row}), 15) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS digest "
            f"FROM {view}")


def layer_sql(layer: str) -> str:
    return " UNION ALL ".join(digest_sql(t, v, c) for t, (v, c) in RUN_TABLES[layer].items())
