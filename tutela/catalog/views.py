"""The same bindings as SQL, for an independent engine.

``sql(text)`` puts the views a query names, and the views those name, in front
of it as common table expressions.
"""

from __future__ import annotations

import re

from tutela.catalog.bindings import (ADVISORS, DAYS, HALF_YEARS, PROGRAMS, SHIFT, STRANGER,
                                     TEN_DAYS)
from tutela.plans.references import FUNDING_RATES


def _values(rows, columns: str, dates: tuple[int, ...] = ()) -> str:
    def cell(i, v):
        if isinstance(v, bool):
            return "true" if v else "false"
        text = f"'{v}'" if isinstance(v, str) else str(v)
        return f"DATE {text}" if i in dates else text

    body = ", ".join("(" + ", ".join(cell(i, v) for i, v in enumerate(r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


TERM_COLUMNS = "term_code, term_start, census_date, teaching_weeks, year, semester, is_current"


def _half(col: str) -> str:
    return (f"CAST(year({col}) AS VARCHAR) || CASE WHEN month({col}) <= 6 THEN 'S1' "
            "ELSE 'S2' END")


def _ten(day: str) -> str:
    return f"CASE WHEN {day} <= 10 THEN '2024T1' WHEN {day} <= 20 THEN '2024T2' ELSE '2024T3' END"


def _person(key: str) -> str:
    return f"CASE WHEN {key} % {STRANGER[0]} = {STRANGER[1]} THEN {key} + {SHIFT} ELSE {key} END"


_DAY = f"(CAST(ts AS DATE) - DATE '{TEN_DAYS[0][1]}' + 1)"
_INSIDE = f"{_DAY} BETWEEN 1 AND {DAYS}"

VIEWS = {
    "v_terms": _values(HALF_YEARS, TERM_COLUMNS, (1, 2)),
    "v_tterms": _values(TEN_DAYS, TERM_COLUMNS, (1, 2)),
    "v_programs": _values(PROGRAMS, "program_code, program_name, field"),
    "v_advisors": _values(ADVISORS, "advisor_id, advisor_name, covered_campuses, upn"),
    "v_rates": _values(FUNDING_RATES, "nbf_category, indicative_rate"),
    "v_regions": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region "
                 "ON n_regionkey = r_regionkey",
    "v_postcode": """
        SELECT n_nationkey AS postcode, 1 + n_nationkey % 4 AS ses_quartile,
               CASE n_nationkey % 5 WHEN 0 THEN 'Regional' WHEN 1 THEN 'Remote'
                    ELSE 'Metropolitan' END AS remoteness
        FROM nation""",
    "v_syn": "SELECT upper(trim(n_name)) AS variant, r_name AS canonical FROM v_regions "
             "WHERE n_nationkey < 24",
    "v_raw": """
        SELECT ' ' || c_custkey || ' ' AS student_id,
               '  ' || c_mktsegment || ' ' || c_name || ' ' AS first_name,
               c_name || ' ' AS last_name,
               CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '31/02/2020'
                    WHEN c_custkey % 5 = 1 THEN strftime(day, '%d/%m/%Y')
                    WHEN c_custkey % 5 = 2 THEN CAST(day AS VARCHAR)
                    WHEN c_custkey % 5 = 3 THEN '2020' ELSE '' END AS dob,
               lower(n_name) || ' ' AS campus_code,
               CASE c_custkey % 5 WHEN 0 THEN CAST(c_acctbal AS VARCHAR) WHEN 1 THEN '75F'
                    WHEN 2 THEN '' WHEN 3 THEN 'n/a' ELSE ' 12.5 ' END AS atar,
               CASE c_custkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN '' END
                   AS first_nations_flag
        FROM (SELECT *, DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS day FROM customer)
        JOIN v_regions ON c_nationkey = n_nationkey""",
    "v_students": f"""
        SELECT c_custkey AS student_id, substr(c_name, 1, 8) AS first_name,
               substr(c_name, 10) AS last_name,
               CASE WHEN c_custkey % 97 <> 0
                    THEN DATE '1930-01-01' + CAST(c_custkey * 37 % 33000 AS INTEGER) END AS dob,
               c_mktsegment AS program_code,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Online' ELSE 'On-campus' END AS mode,
               CASE WHEN c_nationkey % 10 = 0 THEN 'International' ELSE 'Domestic' END
                   AS citizenship,
               c_nationkey AS postcode,
               CASE WHEN c_acctbal > 0 THEN c_acctbal / 100 END AS atar,
               CASE WHEN c_custkey % 30 = 1 THEN 'Yes' WHEN c_custkey % 37 = 1 THEN 'Unknown'
                    ELSE 'No' END AS first_nations,
               CASE WHEN c_custkey % 11 = 1 THEN 'Yes' WHEN c_custkey % 41 = 1 THEN 'Unknown'
                    ELSE 'No' END AS disability,
               CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS nesb,
               CASE WHEN c_custkey % 4 = 0 THEN 'Part-time' ELSE 'Full-time' END
                   AS attendance_type,
               CASE WHEN c_custkey % 7 = 0 THEN 'completed' WHEN c_custkey % 7 = 1
                    THEN 'discontinued' ELSE 'active' END AS student_status,
               r_name AS campus_code_raw,
               CAST(floor(c_acctbal / 1000) AS BIGINT) AS match_band, commencing_term
        FROM customer JOIN v_regions ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, min({_half('o_orderdate')}) AS commencing_term
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "v_map": """
        SELECT s.student_id AS duplicate_id, g.survivor AS surviving_id
        FROM v_students s
        JOIN (SELECT postcode, program_code, match_band, count(*) AS members,
                     coalesce(min(CASE WHEN student_id IN (SELECT o_custkey FROM orders
                                                           WHERE o_orderstatus = 'P')
                                       THEN student_id END), min(student_id)) AS survivor
              FROM v_students GROUP BY postcode, program_code, match_band) g
          ON s.postcode = g.postcode AND s.program_code = g.program_code
         AND s.match_band IS NOT DISTINCT FROM g.match_band
        WHERE g.members > 1 AND s.student_id <> g.survivor""",
    "v_dedup": "SELECT * FROM v_students WHERE student_id NOT IN (SELECT duplicate_id FROM v_map)",
    "d_student": """
        SELECT s.* EXCLUDE (campus_code_raw), s.campus_code_raw AS home_campus_code,
               first_name || ' ' || last_name AS student_name, p.ses_quartile, p.remoteness,
               CAST(substr(commencing_term, 1, 4) AS INTEGER) AS commencing_year,
               CASE WHEN citizenship = 'Domestic' AND ses_quartile = 1 THEN 'Yes' ELSE 'No' END
                   AS low_ses,
               CASE WHEN citizenship = 'Domestic' AND remoteness IN ('Regional', 'Remote')
                    THEN 'Yes' ELSE 'No' END AS regional_remote,
               CASE WHEN citizenship = 'Domestic'
                     AND (ses_quartile = 1 OR first_nations = 'Yes') THEN 'Yes' ELSE 'No' END
                   AS nbf_equity_cohort,
               CASE WHEN citizenship <> 'Domestic' THEN 'Not applicable'
                    WHEN first_nations = 'Yes' AND ses_quartile = 1 THEN 'Low SES + First Nations'
                    WHEN first_nations = 'Yes' THEN 'First Nations'
                    WHEN ses_quartile <> 1 OR ses_quartile IS NULL THEN 'Not applicable'
                    WHEN atar >= 80 THEN 'Low SES (high preparedness)'
                    ELSE 'Low SES' END AS nbf_category
        FROM v_dedup s LEFT JOIN v_postcode p ON s.postcode = p.postcode""",
    "v_enrol": f"""
        SELECT e.*, coalesce(v.canonical, e.campus_code_raw) AS campus_code
        FROM (SELECT {_person('o_custkey')} AS student_id, l_partkey AS unit_code,
                     {_half('o_orderdate')} AS term_code,
                     upper(trim(n_name)) AS campus_code_raw, 2 * l_quantity + 2 AS mark,
                     CAST(0.125 AS DOUBLE) AS eftsl,
                     CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
                          THEN 'Withdrawn pre-census'
                          WHEN o_orderdate >= DATE '2001-07-01' THEN 'In progress'
                          ELSE 'Completed' END AS enrolment_status,
                     CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'WW'
                          WHEN o_orderdate >= DATE '2001-07-01' THEN 'IP'
                          WHEN l_quantity >= 41.5 THEN 'HD' WHEN l_quantity >= 36.5 THEN 'DI'
                          WHEN l_quantity >= 31.5 THEN 'CR' WHEN l_quantity >= 24 THEN 'PA'
                          ELSE 'NN' END AS grade
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation ON s_nationkey = n_nationkey) e
        LEFT JOIN v_syn v ON v.variant = e.campus_code_raw""",
    "v_judged": """
        SELECT e.*, coalesce(mark NOT BETWEEN 0 AND 100, false) AS bad_mark,
               coalesce(campus_code NOT IN (SELECT canonical FROM v_syn), false) AS bad_campus,
               student_id NOT IN (SELECT student_id FROM v_students) AS orphan
        FROM v_enrol e""",
    "v_rej": """
        SELECT * EXCLUDE (bad_mark, bad_campus, orphan),
               CASE WHEN bad_mark THEN 'R02_mark_out_of_range'
                    WHEN bad_campus THEN 'R03_unknown_campus'
                    ELSE 'R06_orphan_enrolment' END AS reject_rule
        FROM v_judged WHERE bad_mark OR bad_campus OR orphan""",
    "v_clean": """
        SELECT * FROM v_enrol WHERE (student_id, unit_code, term_code) NOT IN
               (SELECT (student_id, unit_code, term_code) FROM v_rej)""",
    "f_enrol": """
        SELECT coalesce(m.surviving_id, e.student_id) AS student_id,
               e.* EXCLUDE (student_id),
               CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN true
                    WHEN grade IN ('NN', 'WN') THEN false END AS passed,
               CASE WHEN enrolment_status <> 'Withdrawn pre-census' THEN eftsl
                    ELSE CAST(0 AS DOUBLE) END AS eftsl_certified,
               CASE WHEN grade IN ('HD', 'DI', 'CR', 'PA') THEN eftsl
                    ELSE CAST(0 AS DOUBLE) END AS eftsl_passed
        FROM v_clean e LEFT JOIN v_map m ON m.duplicate_id = e.student_id""",
    "v_activity": f"""
        SELECT {_person('u.user_id')} AS student_id, {_ten('u.d')} AS term_code,
               CAST(1 + (u.d - 1) % 10 AS INTEGER) AS week_number,
               DATE '2024-01-01' + CAST(u.d - 1 AS INTEGER) AS week_start,
               count(CASE WHEN event_type IN ('view', 'click') THEN 1 END) AS logins,
               count(CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN 1 END)
                   AS items_due,
               count(CASE WHEN event_type = 'purchase' THEN 1 END) AS submitted_on_time,
               count(CASE WHEN event_type = 'signup' THEN 1 END) AS submitted_late,
               count(CASE WHEN event_type = 'error' THEN 1 END) AS missed
        FROM (SELECT user_id, unnest(range(1, 31)) AS d
              FROM (SELECT DISTINCT user_id FROM events)) u
        LEFT JOIN events e ON e.user_id = u.user_id AND {_DAY.replace('ts', 'e.ts')} = u.d
        GROUP BY u.user_id, u.d""",
    "f_eng": """
        SELECT coalesce(m.surviving_id, a.student_id) AS student_id, a.* EXCLUDE (student_id)
        FROM v_activity a LEFT JOIN v_map m ON m.duplicate_id = a.student_id
        WHERE a.student_id IN (SELECT student_id FROM v_students)""",
    "v_signals": """
        SELECT student_id, term_code, week_number, logins, items_due, submitted_on_time, missed,
               CAST(sum(logins) OVER (PARTITION BY student_id, term_code ORDER BY week_number
                    ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS logins_2wk,
               CAST(sum(items_due) OVER w AS BIGINT) AS cum_due,
               CAST(sum(submitted_on_time) OVER w AS BIGINT) AS cum_on_time,
               CAST(sum(missed) OVER w AS BIGINT) AS cum_missed
        FROM v_activity
        WINDOW w AS (PARTITION BY student_id, term_code ORDER BY week_number)""",
    "v_alerts": """
        SELECT student_id || '-' || term_code || '-' || lpad(CAST(week_number AS VARCHAR), 2, '0')
                   || '-' || rule_no AS alert_id,
               student_id, term_code, week_number,
               term_start + CAST(7 * (week_number - 1) + 2 AS INTEGER) AS raised_date, reason_code
        FROM (SELECT student_id, term_code, rule_no, reason_code, min(week_number) AS week_number
              FROM (SELECT *, 1 AS rule_no, 'INACTIVITY_14D' AS reason_code FROM v_signals
                    WHERE logins_2wk <= 0
                    UNION ALL
                    SELECT *, 2, 'NON_SUBMISSION' FROM v_signals WHERE cum_missed >= 6
                    UNION ALL
                    SELECT *, 3, 'LOW_ONTIME_RATE' FROM v_signals
                    WHERE week_number >= 6 AND cum_due >= 3 AND 10 * cum_on_time < 2 * cum_due)
              WHERE week_number BETWEEN 3 AND 10
              GROUP BY student_id, term_code, rule_no, reason_code)
        JOIN v_tterms USING (term_code)""",
    "v_cases": f"""
        SELECT c.*, CASE WHEN source = 'Early alert' THEN first_alert END AS linked_alert_id
        FROM (SELECT event_id AS case_id, {_person('user_id')} AS student_id,
                     {_ten(_DAY)} AS term_code,
                     CAST(ts AS DATE) AS opened_date,
                     CASE WHEN event_id % 8 = 0 THEN 'Early alert'
                          WHEN event_id % 8 < 5 THEN 'Self-referral' ELSE 'Staff referral' END
                         AS source,
                     'Type ' || event_id % 4 AS case_type,
                     'Activity ' || event_id % 5 AS seheef_activity,
                     'Stage ' || event_id % 3 AS seheef_life_stage,
                     'ADV' || lpad(CAST(1 + user_id % 10 AS VARCHAR), 2, '0') AS advisor_id,
                     CASE WHEN value < 20 THEN 'Open' WHEN value < 50 THEN 'In progress'
                          ELSE 'Closed' END AS status,
                     CASE event_id % 3 WHEN 0 THEN 'Reached - support plan agreed'
                          WHEN 1 THEN 'Voicemail left' ELSE 'Service provided' END
                         AS contact_outcome,
                     CASE WHEN value >= 50
                          THEN CAST(ts AS DATE) + CAST(floor(value) AS INTEGER) % 21 END
                         AS closed_date
              FROM events WHERE event_type = 'signup' AND {_INSIDE}) c
        LEFT JOIN (SELECT student_id, term_code, min(alert_id) AS first_alert
                   FROM v_alerts GROUP BY student_id, term_code) USING (student_id, term_code)""",
    "f_case": """
        SELECT coalesce(m.surviving_id, c.student_id) AS student_id, c.* EXCLUDE (student_id),
               CAST(closed_date - opened_date AS INTEGER) AS days_open
        FROM v_cases c LEFT JOIN v_map m ON m.duplicate_id = c.student_id""",
    "f_alert": """
        SELECT a.alert_id, a.sid AS student_id, a.term_code, a.week_number, a.raised_date,
               a.reason_code, c.case_id AS actioned_case_id, c.opened_date AS actioned_date,
               c.contact_outcome, c.status AS case_status,
               CASE WHEN c.case_id IS NOT NULL THEN 'Actioned - case opened'
                    WHEN EXISTS (SELECT 1 FROM f_case o WHERE o.source = 'Early alert'
                                 AND o.student_id = a.sid AND o.term_code = a.term_code)
                    THEN 'Covered by same-term case'
                    WHEN t.is_current THEN 'Open - awaiting triage'
                    ELSE 'Monitored - no contact' END AS lifecycle_status,
               CAST(c.opened_date - a.raised_date AS INTEGER) AS days_to_action
        FROM (SELECT v_alerts.*, coalesce(surviving_id, student_id) AS sid
              FROM v_alerts LEFT JOIN v_map ON duplicate_id = student_id) a
        JOIN v_tterms t ON t.term_code = a.term_code
        LEFT JOIN (SELECT * FROM f_case WHERE linked_alert_id IS NOT NULL
                   QUALIFY row_number() OVER (PARTITION BY linked_alert_id ORDER BY case_id) = 1) c
          ON c.linked_alert_id = a.alert_id""",
    "v_presence": f"""
        SELECT DISTINCT coalesce(surviving_id, {_person('user_id')}) AS student_id,
               {_ten(_DAY)} AS term_code
        FROM events LEFT JOIN v_map ON duplicate_id = {_person('user_id')}
        WHERE event_type = 'purchase' AND value > 60 AND {_INSIDE}""",
    "v_flags": """
        SELECT d.*, CASE WHEN student_status = 'completed' OR (student_id, commencing_year + 1) IN
                         (SELECT (student_id, CAST(substr(term_code, 1, 4) AS INTEGER))
                          FROM f_enrol) THEN 1 ELSE 0 END AS retained_y1
        FROM d_student d WHERE citizenship = 'Domestic' AND commencing_year <= 2000""",
    "v_cohorts": """
        SELECT d.student_id, c.cohort FROM d_student d,
        LATERAL (SELECT 'All domestic' AS cohort
                 UNION ALL SELECT 'Low SES' WHERE d.low_ses = 'Yes'
                 UNION ALL SELECT 'First Nations' WHERE d.first_nations = 'Yes'
                 UNION ALL SELECT 'Disability' WHERE d.disability = 'Yes'
                 UNION ALL SELECT 'Regional/remote' WHERE d.regional_remote = 'Yes'
                 UNION ALL SELECT 'Online' WHERE d.mode = 'Online'
                 UNION ALL SELECT 'Non-equity' WHERE 'Yes' NOT IN (d.low_ses, d.first_nations,
                     d.disability, d.regional_remote) AND d.first_nations = 'No'
                     AND d.disability = 'No') c
        WHERE d.citizenship = 'Domestic'""",
    "m_executive": """
        SELECT term_code, campus_code, mode, field, count(DISTINCT student_id) AS headcount,
               round(sum(eftsl_certified), 1) AS eftsl_certified,
               round(sum(eftsl_passed), 1) AS eftsl_passed,
               round(sum(eftsl_passed) / nullif(sum(eftsl_certified), 0), 4) AS success_rate,
               round(avg(mark) FILTER (WHERE mark BETWEEN 0 AND 100), 1) AS avg_mark,
               count(*) FILTER (WHERE enrolment_status = 'Withdrawn pre-census')
                   AS withdrawals_pre_census
        FROM f_enrol JOIN (SELECT student_id, mode, program_code FROM d_student) USING (student_id)
        JOIN v_programs USING (program_code)
        GROUP BY term_code, campus_code, mode, field""",
    "m_retention": """
        SELECT cohort, commencing_year, count(*) AS students,
               round(avg(retained_y1), 4) AS retention_rate
        FROM v_flags JOIN v_cohorts USING (student_id) GROUP BY cohort, commencing_year""",
    "m_nbf": """
        SELECT commencing_year, nbf_category, indicative_rate, count(*) AS commencing_students,
               count(*) * indicative_rate AS indicative_funding,
               count(*) FILTER (WHERE helped) AS students_with_support_case,
               round(avg(CASE WHEN helped THEN 1.0::DOUBLE ELSE 0 END), 4) AS support_coverage
        FROM (SELECT commencing_year, nbf_category,
                     student_id IN (SELECT student_id FROM f_case) AS helped FROM d_student)
        JOIN v_rates USING (nbf_category)
        WHERE nbf_category <> 'Not applicable'
        GROUP BY commencing_year, nbf_category, indicative_rate""",
    "m_seheef": """
        SELECT CAST(left(term_code, 4) AS INTEGER) AS year, seheef_activity, seheef_life_stage,
               case_type, nbf_equity_cohort, count(*) AS cases,
               count(DISTINCT student_id) AS students,
               round(avg(CASE WHEN contact_outcome LIKE 'Reached%' THEN 1.0::DOUBLE ELSE 0 END), 4)
                   AS reach_rate
        FROM f_case JOIN (SELECT student_id, nbf_equity_cohort FROM d_student) USING (student_id)
        GROUP BY ALL""",
    "m_triage": """
        SELECT d.student_id, d.student_name, d.program_code, program_name, d.home_campus_code,
               d.mode, d.attendance_type, d.nbf_equity_cohort, d.first_nations, d.disability,
               d.commencing_term = '2024T3' AS is_commencing,
               first_alert_week, latest_alert_week, alert_count, reasons, contacted,
               case_status, contact_outcome,
               CAST(coalesce(l2, 0) AS BIGINT) AS logins_last2wk,
               CAST(coalesce(m2, 0) AS BIGINT) AS missed_last2wk,
               CASE WHEN contacted = 1 AND case_status IN ('Open', 'In progress')
                    THEN 'P3 - support in progress'
                    WHEN contacted = 1 THEN 'P4 - resolved / monitoring'
                    WHEN alert_count > 1 THEN 'P1 - multiple signals, not yet contacted'
                    ELSE 'P2 - single signal, not yet contacted' END AS priority_tier,
               coalesce(own, (SELECT min(advisor_id) FROM v_advisors
                              WHERE '|' || covered_campuses || '|'
                                    LIKE '%|' || d.home_campus_code || '|%')) AS advisor_id
        FROM (SELECT student_id, min(week_number) AS first_alert_week,
                     max(week_number) AS latest_alert_week, count(*) AS alert_count,
                     string_agg(DISTINCT reason_code, ', ' ORDER BY reason_code) AS reasons,
                     max(CASE WHEN lifecycle_status LIKE 'Actioned%'
                               OR lifecycle_status LIKE 'Covered%' THEN 1 ELSE 0 END) AS contacted,
                     max(case_status) AS case_status, max(contact_outcome) AS contact_outcome
              FROM f_alert WHERE term_code = '2024T3' GROUP BY student_id) a
        JOIN d_student d ON d.student_id = a.student_id
        JOIN v_programs p ON p.program_code = d.program_code
        LEFT JOIN (SELECT student_id, sum(logins) AS l2, sum(missed) AS m2 FROM f_eng
                   WHERE term_code = '2024T3' AND week_number >= 9 GROUP BY student_id) r
          ON r.student_id = a.student_id
        LEFT JOIN (SELECT student_id, advisor_id AS own FROM f_case WHERE term_code = '2024T3'
                   QUALIFY row_number() OVER (PARTITION BY student_id
                                              ORDER BY opened_date DESC, case_id DESC) = 1) c
          ON c.student_id = a.student_id
        WHERE d.student_status <> 'discontinued'""",
    "v_alerted": """
        SELECT student_id, term_code, min(week_number) AS alert_week,
               count(*) FILTER (WHERE week_number = first_week) AS reasons_at_alert,
               max(CASE WHEN lifecycle_status LIKE 'Actioned%'
                         OR lifecycle_status LIKE 'Covered%' THEN 1 ELSE 0 END) AS contacted
        FROM (SELECT *, min(week_number) OVER (PARTITION BY student_id, term_code) AS first_week
              FROM f_alert WHERE term_code <> '2024T3')
        GROUP BY student_id, term_code""",
    "m_effect": """
        SELECT a.student_id, a.term_code, a.alert_week, a.reasons_at_alert, a.contacted,
               CAST(coalesce((SELECT sum(logins) FROM f_eng w WHERE w.student_id = a.student_id
                              AND w.term_code = a.term_code AND w.week_number
                              BETWEEN a.alert_week - 1 AND a.alert_week), 0) AS BIGINT)
                   AS logins_2wk_at_alert,
               CAST(coalesce((SELECT sum(missed) FROM f_eng w WHERE w.student_id = a.student_id
                              AND w.term_code = a.term_code AND w.week_number < a.alert_week), 0)
                    AS BIGINT) AS pre_missed,
               d.mode = 'Online' AS online, d.nbf_equity_cohort = 'Yes' AS nbf_equity,
               d.commencing_term = a.term_code AS first_term,
               CASE WHEN d.student_status = 'completed' OR EXISTS (
                         SELECT 1 FROM v_presence n WHERE n.student_id = a.student_id
                         AND n.term_code = '2024T' || (CAST(right(a.term_code, 1) AS INTEGER) + 1))
                    THEN 1 ELSE 0 END AS retained_next_term
        FROM v_alerted a JOIN d_student d ON d.student_id = a.student_id""",
    "m_trend": """
        SELECT term_code, week_number, mode, nbf_equity_cohort,
               count(DISTINCT student_id) AS students, round(avg(logins), 2) AS avg_logins,
               round(CAST(sum(missed) AS DOUBLE) / nullif(sum(items_due), 0), 4) AS missed_rate
        FROM f_eng JOIN (SELECT student_id, mode, nbf_equity_cohort FROM d_student)
             USING (student_id)
        GROUP BY ALL""",
    "v_issues": """
        SELECT 'R01_duplicate_student' AS rule_id, 'FATAL' AS severity,
               'banner_students' AS table_name, CAST(duplicate_id AS VARCHAR) AS row_key,
               'merged into ' || surviving_id AS detail FROM v_map
        UNION ALL
        SELECT 'R02_mark_out_of_range', 'FATAL', 'banner_enrolments',
               student_id || '|' || unit_code || '|' || term_code, 'mark=' || mark
        FROM v_judged WHERE bad_mark
        UNION ALL
        SELECT 'R03_unknown_campus', 'FATAL', 'banner_enrolments',
               student_id || '|' || unit_code || '|' || term_code,
               'campus_code=' || campus_code_raw
        FROM v_judged WHERE bad_campus
        UNION ALL
        SELECT 'R04_missing_equity_flag', 'WARN', 'banner_students', CAST(student_id AS VARCHAR),
               CASE first_nations WHEN 'Unknown' THEN 'first_nations_flag'
                    ELSE 'disability_flag' END
        FROM v_dedup WHERE 'Unknown' IN (first_nations, disability)
        UNION ALL
        SELECT 'R05_dob_implausible', 'WARN', 'banner_students', CAST(student_id AS VARCHAR),
               coalesce(CAST(dob AS VARCHAR), 'unparseable')
        FROM v_dedup WHERE dob IS NULL OR dob NOT BETWEEN DATE '1936-01-01' AND DATE '2011-01-01'
        UNION ALL
        SELECT 'R06_orphan_enrolment', 'FATAL', 'banner_enrolments',
               student_id || '|' || unit_code || '|' || term_code, 'no student record'
        FROM v_judged WHERE orphan
        UNION ALL
        SELECT 'R07_orphan_activity', 'FATAL', 'canvas_activity',
               student_id || '|' || term_code || '|' || week_number, 'no student record'
        FROM v_activity WHERE student_id NOT IN (SELECT student_id FROM v_students)""",
    "m_dq": """
        SELECT rule_id, severity, table_name, count(*) AS issues FROM v_issues GROUP BY ALL
        UNION ALL
        SELECT 'quarantined_enrolment_rows', 'FATAL', 'banner_enrolments', count(*) FROM v_rej""",
    "v_cells": """
        SELECT CASE WHEN alert_week BETWEEN 1 AND 5 THEN 'w3-5' WHEN alert_week BETWEEN 6 AND 8
                    THEN 'w6-8' WHEN alert_week BETWEEN 9 AND 12 THEN 'w9-11' ELSE 'nan' END
               || '|' || CASE WHEN reasons_at_alert > 3 THEN 3 ELSE reasons_at_alert END
               || '|' || CASE WHEN logins_2wk_at_alert <= 2 THEN 'inactive'
                    WHEN logins_2wk_at_alert <= 6 THEN 'low'
                    WHEN logins_2wk_at_alert <= 999 THEN 'normal' ELSE 'nan' END
               || '|' || CASE WHEN pre_missed <= 2 THEN '0-2' WHEN pre_missed <= 99 THEN '3+'
                    ELSE 'nan' END
               || '|' || CASE WHEN online IS NOT FALSE THEN 'True' ELSE 'False' END
               || '|' || CASE WHEN nbf_equity IS NOT FALSE THEN 'True' ELSE 'False' END
               || '|' || CASE WHEN first_term IS NOT FALSE THEN 'True' ELSE 'False' END AS stratum,
               contacted, retained_next_term AS outcome, count(*) AS n
        FROM m_effect GROUP BY ALL""",
    "v_matched": """
        SELECT sum(t * (yt / t - yc / c)) FILTER (WHERE t > 0 AND c > 0)
                   / sum(t) FILTER (WHERE t > 0 AND c > 0) AS estimate,
               count(*) FILTER (WHERE t > 0 AND c > 0) AS n_strata,
               coalesce(sum(t) FILTER (WHERE t > 0 AND c > 0), 0)
                   / greatest(sum(t), 1) AS matched_share
        FROM (SELECT stratum,
                     CAST(coalesce(sum(n) FILTER (WHERE contacted = 1), 0) AS DOUBLE) AS t,
                     CAST(coalesce(sum(n) FILTER (WHERE contacted = 0), 0) AS DOUBLE) AS c,
                     CAST(coalesce(sum(n * outcome) FILTER (WHERE contacted = 1), 0) AS DOUBLE)
                         AS yt,
                     CAST(coalesce(sum(n * outcome) FILTER (WHERE contacted = 0), 0) AS DOUBLE)
                         AS yc
              FROM v_cells GROUP BY stratum)""",
    "v_fair": """
        SELECT names.cohort, coalesce(st.student_terms, 0) AS student_terms,
               round_even(coalesce(al.n, 0) / greatest(coalesce(st.student_terms, 0), 1)::DOUBLE, 4)
                   AS alert_rate,
               round_even(al.contact, 4) AS contact_rate_given_alert,
               round_even(al.kept1, 4) AS retained_next_term_contacted,
               round_even(al.kept0, 4) AS retained_next_term_uncontacted,
               coalesce(al.n, 0) AS alerted_n
        FROM (VALUES ('Non-equity'), ('First Nations'), ('Low SES'), ('Disability'),
                     ('Regional/remote'), ('Online'), ('All domestic')) names(cohort)
        LEFT JOIN (SELECT cohort, count(*) AS student_terms
                   FROM (SELECT DISTINCT student_id, term_code FROM f_eng
                         WHERE term_code <> '2024T3') JOIN v_cohorts USING (student_id)
                   GROUP BY cohort) st USING (cohort)
        LEFT JOIN (SELECT cohort, count(*) AS n, avg(contacted) AS contact,
                          avg(retained_next_term) FILTER (WHERE contacted = 1) AS kept1,
                          avg(retained_next_term) FILTER (WHERE contacted = 0) AS kept0
                   FROM m_effect JOIN v_cohorts USING (student_id) GROUP BY cohort) al
          USING (cohort)""",
    "m_fair": """
        SELECT f.*, round_even(alert_rate / nullif((SELECT alert_rate FROM v_fair
                   WHERE cohort = 'Non-equity'), 0), 2) AS alert_rate_ratio_vs_nonequity,
               round_even((contact_rate_given_alert - (SELECT contact_rate_given_alert FROM v_fair
                   WHERE cohort = 'Non-equity')) * 100, 1) AS contact_rate_gap_pp_vs_nonequity
        FROM v_fair f""",
    "v_tt": "SELECT * FROM v_terms UNION ALL SELECT * FROM v_tterms",
}
_NAME = re.compile(r"\b[a-z]_\w+\b")


def sql(text: str) -> str:
    needed: set[str] = set()
    todo = [text]
    while todo:
        for name in _NAME.findall(todo.pop()):
            if name in VIEWS and name not in needed:
                needed.add(name)
                todo.append(VIEWS[name])
    if not needed:
        return text.strip()
    head = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in VIEWS if n in needed)
    return f"WITH {head}\n{text.strip()}"
