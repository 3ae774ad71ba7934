"""Registered queries against an independent SQL engine, and their plans."""

import math
import os

import duckdb
import pytest

from tutela.catalog import base_queries, plan_queries, run_queries  # noqa: F401
from tutela.catalog.bindings import Bound
from tutela.catalog.registry import REGISTRY, callables, oracles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")
SAMPLE = ["mt_executive", "mt_triage", "mt_effect_input", "mt_retention", "dq_summary",
          "dq_inject", "dq_constraints", "dq_catch_rate", "dq_calendar", "an_results", "ag_pivot", "an_fairness", "an_realism", "rp_program_matrix",
          "ms_retention_gap", "src_csv_text", "run_dimensions", "run_facts", "run_marts",
          "run_quality", "run_audit", "run_analysis", "layout_by_student", "fn_sql_text", "rl_sql"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def norm(rows):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.9g}")
        return v
    return sorted((tuple(map(cell, r)) for r in rows),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, duck, name):
    df = callables()[name](spark, FOLDER)
    names = sorted(df.columns)
    rel = duck.sql(oracles()[name])
    assert sorted(rel.columns) == names
    order = [rel.columns.index(c) for c in names]
    assert norm([[r[c] for c in names] for r in df.collect()]) \
        == norm([[r[i] for i in order] for r in rel.fetchall()])


def test_every_query_has_sql():
    assert not [n for n, q in REGISTRY.items() if not q.sql]


@pytest.mark.parametrize("name", ["executive", "triage", "fairness", "dq_summary", "retention"])
def test_plans_join_by_key_only(spark, monkeypatch, name):
    monkeypatch.setattr(Bound, "share", lambda self, *n: None)
    plan = getattr(Bound(spark, FOLDER), name)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scans_read_the_columns_they_need(spark):
    df = callables()["ag_count_distinct"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in scan and "l_orderkey" in scan
    early = callables()["mt_seheef"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    # all signups are cases since the calendar goes by date: kind and time reach the scan
    events = next(line for line in early.splitlines() if "events.parquet" in line)
    assert "EqualTo(event_type,signup)" in events and "IsNotNull(ts)" in events
