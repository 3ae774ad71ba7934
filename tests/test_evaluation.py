import random

import numpy as np
import pytest

from tutela.plans import evaluation, fairness, references

R = "student_id string, term_code string, alert_week int, reasons_at_alert int, contacted int, " \
    "logins_2wk_at_alert int, pre_missed int, online boolean, nbf_equity boolean, " \
    "first_term boolean, retained_next_term int"


def make_rows(n=3000, effect=0.10, seed=5):
    """Contact goes to the worse off, so the naive difference is biased downwards."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        week, reasons = rnd.randint(3, 11), rnd.randint(1, 3)
        logins, missed = rnd.randint(0, 8), rnd.randint(0, 4)
        severe = reasons - 1 + (logins <= 2)
        contacted = int(rnd.random() < 0.25 + 0.2 * severe)
        keep = 0.8 - 0.15 * severe + effect * contacted
        out.append((f"s{i}", "T1", week, reasons, contacted, logins, missed, rnd.random() < .3,
                    rnd.random() < .3, rnd.random() < .5, int(rnd.random() < keep)))
    return out


def brute(rows):
    arm = {0: [], 1: []}
    strata = {}
    for r in rows:
        arm[r[4]].append(r[10])
        week = "a" if r[2] <= 5 else "b" if r[2] <= 8 else "c"
        log = "i" if r[5] <= 2 else "l" if r[5] <= 6 else "n"
        key = (week, min(max(r[3], 1), 3), log, r[6] <= 2, r[7], r[8], r[9])
        strata.setdefault(key, {0: [], 1: []})[r[4]].append(r[10])
    both = [(len(s[1]), np.mean(s[1]) - np.mean(s[0])) for s in strata.values() if s[0] and s[1]]
    w = sum(b[0] for b in both)
    return (np.mean(arm[1]) - np.mean(arm[0]), sum(a * b for a, b in both) / w, len(both),
            w / len(arm[1]))


@pytest.fixture(scope="module")
def sample(spark):
    rows = make_rows()
    return rows, spark.createDataFrame(rows, R)


def test_both_estimates_match_brute_force(sample):
    rows, df = sample
    got = evaluation.both_estimates(evaluation.cells(df)).first()
    assert tuple(got) == pytest.approx(brute(rows))


def test_matching_recovers_the_injected_effect(sample):
    _, df = sample
    v = evaluation.verdict(evaluation.estimates(df)).first()
    assert v.verdict == "RECOVERED" and v.matched_pp > v.naive_pp
    assert abs(v.matched_pp - 10) < 5


def test_bootstrap_interval_close_to_row_resampling(sample):
    rows, df = sample
    got = {r.estimator: r for r in evaluation.bootstrap(evaluation.cells(df), reps=400).collect()}
    naive = got[evaluation.NAIVE_NAME]
    data = np.array([(r[4], r[10]) for r in rows])
    rng = np.random.default_rng(0)
    stats = []
    for _ in range(400):
        s = data[rng.integers(0, len(data), len(data))]
        stats.append(s[s[:, 0] == 1, 1].mean() - s[s[:, 0] == 0, 1].mean())
    low, high = np.percentile(stats, [2.5, 97.5])
    assert naive.ci_low == pytest.approx(low, abs=0.01)
    assert naive.ci_high == pytest.approx(high, abs=0.01)
    cem = got[evaluation.MATCHED_NAME]
    assert cem.ci_low < cem.estimate < cem.ci_high
    assert naive.estimate == pytest.approx(brute(rows)[0])


def test_resample_is_repeatable_and_keeps_the_total(sample):
    rows, df = sample
    c = evaluation.cells(df)
    a = evaluation.resample(c, 5).groupBy("replicate").sum("n").collect()
    assert {r[0]: r[1] for r in a} == dict.fromkeys(range(6), len(rows))
    first = evaluation.resample(c, 5).orderBy("replicate", "stratum", "contacted", "outcome")
    assert first.collect() == evaluation.resample(c.repartition(3), 5).orderBy(
        "replicate", "stratum", "contacted", "outcome").collect()


def test_one_arm_stratum_and_values_outside_bins(spark):
    base = ("s", "T1", 4, 1, 1, 1, 0, False, False, None, 1)
    other = ("s", "T1", 20, 7, 0, 1000, 0, False, False, False, 0)
    df = spark.createDataFrame([base, other], R)
    names = {r.stratum for r in evaluation.strata(df).collect()}
    assert names == {"w3-5|1|inactive|0-2|False|False|True",    # an unknown flag reads as true
                     "nan|3|nan|0-2|False|False|False"}
    got = evaluation.both_estimates(evaluation.cells(df)).first()
    assert (got.matched, got.n_strata, got.matched_share, got.naive) == (None, 0, 0.0, 1.0)


S = "student_id string, citizenship string, mode string, low_ses string, first_nations string, " \
    "disability string, regional_remote string"


def test_fairness_lists_every_cohort(spark):
    students = spark.createDataFrame(
        [("a", "Domestic", "Online", "No", "No", "No", "No"),
         ("b", "Domestic", "On-campus", "Yes", "No", "Unknown", "No"),
         ("c", "International", "Online", "No", "No", "No", "No")], S)
    enrol = spark.createDataFrame([("a", "T1"), ("a", "T1"), ("b", "T1"), ("c", "T1"), ("a", "T2")],
                                  "student_id string, term_code string")
    terms = references.term_rows(spark, [
        ("T1", "2024-01-01", "2024-01-10", 13, 2024, "S1", False),
        ("T2", "2024-07-01", "2024-07-10", 13, 2024, "S2", True)])
    rows = spark.createDataFrame([("a", 1, 1), ("b", 0, 1), ("c", 1, 0)],
                                 "student_id string, contacted int, retained_next_term int")
    audit = fairness.fairness(enrol, students, rows, terms)
    got = {r.cohort: r for r in audit.collect()}
    assert len(got) == 7
    assert (got["All domestic"].student_terms, got["All domestic"].alerted_n) == (2, 2)
    assert got["First Nations"].student_terms == 0
    assert got["First Nations"].alert_rate == 0.0
    assert got["First Nations"].contact_rate_given_alert is None
    assert got["Low SES"].contact_rate_gap_pp_vs_nonequity == -100.0
    assert got["Low SES"].alert_rate_ratio_vs_nonequity == 1.0
    assert got["Non-equity"].student_terms == 1
    assert fairness.fair_verdict(audit).first().verdict == "REVIEW REQUIRED"


def test_replicates_lie_in_many_tasks_and_estimators_are_an_argument(sample):
    _, df = sample
    c = evaluation.cells(df)
    drawn = evaluation.resample(c, 20)
    assert drawn.rdd.getNumPartitions() > 1
    one = evaluation.bootstrap(c, {"mine": evaluation.cem}, reps=20).collect()
    both = {r.estimator: r for r in evaluation.bootstrap(c, reps=20).collect()}
    assert [r.estimator for r in one] == ["mine"]
    other = both[evaluation.MATCHED_NAME]
    assert (one[0].estimate, one[0].ci_low, one[0].replicates) == (
        other.estimate, other.ci_low, other.replicates)
