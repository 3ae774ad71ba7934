"""Declared keys and checks of the warehouse tables, and an audit of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.operators.sets import stack
from tutela.plans.quality import FATAL
from tutela.sources import lookup
from tutela.sources.digest import escaped


@dataclass(frozen=True)
class Rules:
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    refs: dict[str, str] = field(default_factory=dict)      # column -> table of that key
    checks: dict[str, str] = field(default_factory=dict)    # name -> SQL test


# --- fixed values: declared constraints -------------------------------------
STUDENT, TERM, CAMPUS = "dim_student", "dim_term", "dim_campus"
KEYS = {STUDENT: "student_id", TERM: "term_code", CAMPUS: "campus_code",
        "dim_program": "program_code", "dim_advisor": "advisor_id", "dim_unit": "unit_code",
        "fact_case": "case_id"}
RULES: dict[str, Rules] = {
    TERM: Rules(("term_code",), ("term_start", "census_date", "teaching_weeks", "year",
                                 "semester", "is_current")),
    CAMPUS: Rules(("campus_code",), ("campus_name", "state")),
    "dim_program": Rules(("program_code",), ("program_name", "field")),
    "dim_advisor": Rules(("advisor_id",), ("advisor_name", "covered_campuses")),
    "dim_unit": Rules(("unit_code",), ("unit_name", "program_code", "year_level", "eftsl"),
                      {"program_code": "dim_program"}),
    STUDENT: Rules(("student_id",), ("student_name", "citizenship", "first_nations", "disability",
                                     "nesb", "low_ses", "regional_remote", "nbf_equity_cohort",
                                     "nbf_category", "student_status"),
                   {"home_campus_code": CAMPUS, "program_code": "dim_program",
                    "commencing_term": TERM}),
    "fact_enrolment": Rules(
        ("student_id", "unit_code", "term_code"),
        ("campus_code", "enrolment_status", "eftsl", "eftsl_certified", "eftsl_passed",
         "census_date"),
        {"student_id": STUDENT, "unit_code": "dim_unit", "term_code": TERM, "campus_code": CAMPUS},
        {"mark": "mark BETWEEN 0 AND 100"}),
    "fact_engagement_week": Rules(
        ("student_id", "term_code", "week_number"),
        ("week_start", "logins", "page_views", "items_due", "submitted_on_time",
         "submitted_late", "missed"),
        {"student_id": STUDENT, "term_code": TERM}),
    "fact_case": Rules(
        ("case_id",), ("student_id", "term_code", "opened_date", "source", "case_type",
                       "seheef_activity", "seheef_life_stage", "status"),
        {"student_id": STUDENT, "term_code": TERM, "advisor_id": "dim_advisor"}),
    "fact_alert": Rules(
        ("alert_id",), ("student_id", "term_code", "week_number", "raised_date", "reason_code",
                        "lifecycle_status"),
        {"student_id": STUDENT, "term_code": TERM, "actioned_case_id": "fact_case"}),
    "dq_issues": Rules((), ("rule_id", "severity", "table_name", "row_key"), {},
                       {"severity": "severity IN ('FATAL', 'WARN')"}),
}
# ---------------------------------------------------------------------------


ENTRIES = "array<struct<slot: int, key: string, held: boolean>>"


@dataclass(frozen=True)
class _Slot:
    """What is counted for a key: rows that hold it (``PK``), rows of it that break a rule of their
    own, or rows that refer to it as a key of the table ``target`` (``FK``)."""

    table: str
    rule: str
    kind: str
    detail: str
    column: str = ""
    target: str = ""


def _key_text(columns: Sequence[str]) -> Column:
    """The parts of a key, told apart whatever they hold; a null part is marked."""
    parts = [F.coalesce(escaped(F.col(c).cast("string")), F.lit("\\N")) for c in columns]
    return F.concat_ws("|", *parts) if parts else F.lit("")


def _slots(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> list[_Slot]:
    out = []
    for name, r in rules.items():
        if name in tables:
            if r.key:
                out.append(_Slot(name, f"PK_{'_'.join(r.key)}", "PK", ""))
            out += [_Slot(name, f"NN_{c}", "NN", "missing", c)
                    for c in dict.fromkeys((*r.key, *r.required))]
            out += [_Slot(name, f"CK_{c}", "CK", "check failed", c) for c in r.checks]
            out += [_Slot(name, f"FK_{c}", "FK", f"{c}=", c, target)
                    for c, target in r.refs.items() if target in tables and target in rules]
    return out


def _entries(df: DataFrame, name: str, r: Rules, slots: Sequence[_Slot]) -> DataFrame:
    """(slot, key, held) of all that a row says about its own key and those it refers to; ``held``
    marks the keys that references of a slot may have."""
    own, always, broken = F.col("__own"), [], []

    def entry(i: int, key: Column, held: bool = False) -> Column:
        return F.struct(F.lit(i).alias("slot"), key.alias("key"), F.lit(held).alias("held"))

    tests = []
    for i, slot in enumerate(slots):
        if slot.target == name and r.key:
            always.append(entry(i, own, True))
        if slot.table != name:
            continue
        if slot.kind == "PK":
            always.append(entry(i, own))
        elif slot.kind == "FK":
            always.append(entry(i, escaped(F.col(slot.column).cast("string"))))
        else:
            test = F.col(slot.column).isNull() if slot.kind == "NN" \
                else F.coalesce(~F.expr(r.checks[slot.column]), F.lit(False))
            tests.append(test)
            broken.append(F.when(test, entry(i, own)))
    listed = F.array(*always).cast(ENTRIES)
    if broken:
        # few rows break a rule: the others do not look at each rule's entry
        more = F.filter(F.array(*broken), lambda e: e.isNotNull()).cast(ENTRIES)
        listed = F.when(reduce(or_, tests), F.concat(listed, more)).otherwise(listed)
    # a null refers to nothing
    return df.withColumn("__own", _key_text(r.key)).select(F.inline(listed)).filter(
        F.col("key").isNotNull())


def audit(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules] = RULES) -> DataFrame:
    """Broken constraints of all given tables: rule_id, severity, table_name, row_key, detail,
    rows (how many break the rule at this key; for a reference the key is the one that is missing).

    A table takes part if it is given; so does a reference if both its tables are. Facts may fail:
    cases and alerts of unknown people are kept on purpose. As in SQL, a null refers to nothing
    and a check that is unknown counts as met.

    Every table is scanned once, whatever the number of its rules. A row is turned into entries on
    its own key and on the keys it refers to, each for one rule, so that two numbers are all that is
    counted for a key; a table that others refer to says for each reference which keys there are.
    Keys of all kinds meet in one aggregation, which counts them within the map tasks before they
    move, so a key with any share of the rows is one row of each task. A filter of known keys would
    only save the exchange of keys that are missing, since it proves absence and not presence.
    """
    slots = _slots(tables, rules)
    entries = stack([_entries(tables[n], n, rules[n], slots) for n in rules if n in tables])
    held, n = F.col("held"), F.col("rows")
    counts = entries.groupBy("slot", "key").agg(F.count_if(~held).alias("rows"),
                                                F.max(held).alias("held"))

    def of(field: str) -> Column:
        return F.array(*(F.lit(getattr(s, field)) for s in slots))[F.col("slot")]

    broken = F.when(of("kind") == "PK", n > 1).when(of("kind") == "FK", (n > 0) & ~held) \
        .otherwise(n > 0)
    detail = F.when(of("kind") == "PK", F.concat(n.cast("string"), F.lit(" rows"))) \
        .when(of("kind") == "FK", F.concat(of("detail"), F.col("key"))).otherwise(of("detail"))
    return counts.filter(broken).select(
        of("rule").alias("rule_id"), F.lit(FATAL).alias("severity"), of("table").alias("table_name"),
        F.col("key").alias("row_key"), detail.alias("detail"), n)


def rule_list(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules] = RULES) \
        -> list[tuple[str, str]]:
    """(table_name, rule_id) of all that ``audit`` looks at."""
    return sorted({(s.table, s.rule) for s in _slots(tables, rules)})


def audit_summary(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules] = RULES) \
        -> DataFrame:
    """(table_name, rule_id, broken_keys, broken_rows) for every declared rule, met ones too."""
    found = audit(tables, rules).groupBy("table_name", "rule_id").agg(
        F.count(F.lit(1)).alias("broken_keys"), F.sum("rows").alias("broken_rows"))
    spark = next(iter(tables.values())).sparkSession
    names = lookup(spark, rule_list(tables, rules), "table_name string, rule_id string")
    return names.join(found, ["table_name", "rule_id"], "left").fillna(
        0, ["broken_keys", "broken_rows"])
