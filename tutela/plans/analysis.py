"""The analyses that follow a run: each reads the published warehouse and writes its result tables.

They are a version of their own, made for one state of the tables they read (by their digests). A run
that was broken off goes on with the analyses that have no record yet, and nothing is computed again
while the tables are the same, whichever version of the warehouse they are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutela.plans import evaluation, fairness, quality, reports
from tutela.plans.constraints import RULES, audit_summary
from tutela.sources import Store
from tutela.sources.publication import Version

LAYER = "results"
READ = ("dim_student", "dim_term", "fact_enrolment", "mart_effectiveness_input",
        "mart_retention_cohort", "mart_triage_current", "mart_nbf_funding")


def arms(rows: DataFrame) -> DataFrame:
    """How many alerted student-terms there are with and without contact."""
    contacted = F.col("contacted") == 1
    return rows.agg(F.count(F.lit(1)).alias("alerted_terms"), F.count_if(contacted)
                    .alias("contacted"), F.count_if(F.col("contacted") == 0).alias("uncontacted"))


def analyse(spark: SparkSession, warehouse: Version, store: Store,
            reps: int = evaluation.REPLICATES, seed: int = evaluation.SEED,
            funded_year: int = reports.FUNDED_YEAR) -> Version:
    """Publishes effectiveness_results, effectiveness_verdict, effectiveness_arms, fairness_audit,
    fairness_verdict, headline and constraint_report of a warehouse. Stops before all of them if
    enrolments refer to unknown students."""
    used = sorted({*READ, *(t for t in RULES if t in warehouse.tables)})
    run = store.begin({"digests": {t: warehouse.tables[t].digest for t in used}, "reps": reps,
                       "seed": seed, "funded_year": funded_year})
    t = {name: warehouse.read(name) for name in used}

    def checked() -> dict[str, DataFrame]:
        quality.assert_no_orphans(t["fact_enrolment"], t["dim_student"])
        return {"constraint_report": audit_summary({n: t[n] for n in RULES if n in t})}

    run.stage("constraints", LAYER, checked)
    rows = t["mart_effectiveness_input"]
    found = run.stage("effectiveness", LAYER, lambda: {
        "effectiveness_arms": arms(rows),
        "effectiveness_results": evaluation.results(rows, reps, seed)})
    run.stage("effectiveness-verdict", LAYER, lambda: {
        "effectiveness_verdict": evaluation.verdict(found["effectiveness_results"])})
    fair = run.stage("fairness", LAYER, lambda: {"fairness_audit": fairness.fairness(
        t["fact_enrolment"], t["dim_student"], rows, t["dim_term"])})
    run.stage("fairness-verdict", LAYER, lambda: {
        "fairness_verdict": fairness.fair_verdict(fair["fairness_audit"])})
    run.stage("headline", LAYER, lambda: {"headline": reports.headline(
        t["mart_retention_cohort"], t["mart_triage_current"], t["mart_nbf_funding"],
        funded_year)})
    return run.publish()
