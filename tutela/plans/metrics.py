"""Metric registry: named measures over the star schema.

``evaluate`` reduces the home table of each measure to its grouping columns and
join keys before any dimension is joined, so that a fact of any size, and any
hot key in it, meets the dimensions as a small table. Sums and counts add up
afterwards, distinct counts keep the counted id as a key, and medians keep a
histogram of values with their frequencies.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions.scalars import tier_colour

# --- fixed values: relationships, many side first ---------------------------
RELATIONSHIPS = [
    ("fact_enrolment", "student_id", "dim_student", "student_id"),
    ("fact_engagement_week", "student_id", "dim_student", "student_id"),
    ("fact_case", "student_id", "dim_student", "student_id"),
    ("fact_alert", "student_id", "dim_student", "student_id"),
    ("mart_triage_current", "student_id", "dim_student", "student_id"),
    ("fact_enrolment", "term_code", "dim_term", "term_code"),
    ("fact_engagement_week", "term_code", "dim_term", "term_code"),
    ("fact_case", "term_code", "dim_term", "term_code"),
    ("fact_alert", "term_code", "dim_term", "term_code"),
    ("fact_enrolment", "campus_code", "dim_campus", "campus_code"),
    ("fact_enrolment", "unit_code", "dim_unit", "unit_code"),
    ("dim_student", "program_code", "dim_program", "program_code"),
    ("fact_case", "advisor_id", "dim_advisor", "advisor_id"),
    ("mart_triage_current", "advisor_id", "dim_advisor", "advisor_id"),
]
# numeric attributes that are never summed by default
NO_SUM = {
    ("mart_retention_cohort", "commencing_year"), ("mart_nbf_funding", "commencing_year"),
    ("mart_nbf_funding", "indicative_rate"), ("mart_seheef_activity", "year"),
    ("fact_engagement_week", "week_number"), ("fact_alert", "week_number"),
    ("fact_enrolment", "mark"), ("mart_triage_current", "first_alert_week"),
    ("mart_triage_current", "latest_alert_week"), ("mart_engagement_trend", "week_number"),
}
# ---------------------------------------------------------------------------
NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")


@dataclass(frozen=True)
class Part:
    """One aggregate over the home table: kind is sum, count, distinct, median or min."""

    kind: str
    value: str = "1"
    where: str | None = None

    def column(self) -> Column:
        value = F.expr(self.value)
        return F.when(F.expr(self.where), value) if self.where else value


@dataclass(frozen=True)
class Measure:
    table: str
    parts: dict[str, Part]
    formula: Callable[..., Column] = field(default=lambda x: x)
    fmt: str | None = None
    # replaces the filter on a column and subtracts the result
    against: tuple[str, str] | None = None


def total(table: str, value: str, fmt: str | None = None, where: str | None = None) -> Measure:
    return Measure(table, {"x": Part("sum", value, where)}, fmt=fmt)


def rows_of(table: str, where: str | None = None, fmt: str | None = "#,0") -> Measure:
    return Measure(table, {"x": Part("count", "1", where)}, fmt=fmt)


def distinct_of(table: str, value: str, where: str | None = None) -> Measure:
    return Measure(table, {"x": Part("distinct", value, where)}, fmt="#,0")


def median_of(table: str, value: str) -> Measure:
    return Measure(table, {"x": Part("median", value)}, fmt="0.0")


def ratio(table: str, top: Part, bottom: Part, fmt: str | None = "0.0%", **more) -> Measure:
    return Measure(table, {"a": top, "b": bottom},
                   lambda a, b: F.try_divide(a.cast("double"), b.cast("double")), fmt, **more)


def mean(table: str, value: str, where: str | None = None, fmt: str | None = None,
         **more) -> Measure:
    known = f"({value}) IS NOT NULL" + (f" AND ({where})" if where else "")
    return ratio(table, Part("sum", value, where), Part("count", "1", known), fmt, **more)


# --- fixed values: measure definitions, formats and lifecycle names ---------
ACTIONED_STATES = ("lifecycle_status IN ('Actioned - case opened', "
                   "'Covered by same-term case')")
MEASURES: dict[str, Measure] = {
    "headcount": distinct_of("fact_enrolment", "student_id"),
    "eftsl_certified": total("fact_enrolment", "eftsl_certified", "#,0.0"),
    "eftsl_passed": total("fact_enrolment", "eftsl_passed", "#,0.0"),
    # in-progress units stay in the denominator
    "success_rate_all": ratio("fact_enrolment", Part("sum", "eftsl_passed"),
                              Part("sum", "eftsl_certified")),
    # units without an outcome yet are left out; a blank grade is not one of them
    "success_rate": ratio("fact_enrolment", Part("sum", "eftsl_passed"),
                          Part("sum", "eftsl_certified", "NOT (grade <=> 'IP')")),
    "average_mark": mean("fact_enrolment", "mark", "mark >= 0 AND mark <= 100", "0.0"),
    "pre_census_withdrawals": rows_of("fact_enrolment",
                                      "enrolment_status = 'Withdrawn pre-census'"),
    "alerts_raised": rows_of("fact_alert"),
    "alerts_actioned": rows_of("fact_alert", ACTIONED_STATES),
    "alert_action_rate": ratio("fact_alert", Part("count", "1", ACTIONED_STATES), Part("count")),
    "median_days_to_action": median_of("fact_alert", "days_to_action"),
    "open_alerts_current": rows_of(
        "fact_alert", "lifecycle_status = 'Open - awaiting triage' AND `dim_term.is_current`"),
    "p1_students": distinct_of("mart_triage_current", "student_id",
                               "left(priority_tier, 2) = 'P1'"),
    "students_on_list": distinct_of("mart_triage_current", "student_id"),
    "tier_colour": Measure("mart_triage_current", {"x": Part("min", "priority_tier")},
                           lambda x: tier_colour(x)),
    "cases_opened": rows_of("fact_case"),
    "reach_rate": ratio("fact_case",
                        Part("count", "1", "contains(lower(contact_outcome), 'reached')"),
                        Part("count", "1", "source = 'Early alert'")),
    "median_days_case_open": median_of("fact_case", "days_open"),
    "nbf_indicative_funding": total("mart_nbf_funding", "indicative_funding", '"$"#,0'),
    "nbf_commencing_students": total("mart_nbf_funding", "commencing_students", "#,0"),
    "nbf_support_coverage": ratio("mart_nbf_funding",
                                  Part("sum", "students_with_support_case"),
                                  Part("sum", "commencing_students")),
    # unweighted mean of the cohort rates
    "retention_rate": mean("mart_retention_cohort", "retention_rate", fmt="0.0%"),
    "retention_gap": mean("mart_retention_cohort", "retention_rate", fmt="+0.0%;-0.0%;0.0%",
                          against=("cohort", "Non-equity")),
    "avg_weekly_logins": mean("fact_engagement_week", "logins", fmt="0.0"),
    "missed_item_rate": ratio("fact_engagement_week", Part("sum", "missed"),
                              Part("sum", "items_due")),
}
# ---------------------------------------------------------------------------


def sum_of(ref: str) -> Measure:
    table, col = ref.split(".")
    return total(table, col)


def mean_of(ref: str) -> Measure:
    table, col = ref.split(".")
    return mean(table, col)


def default_summary(table: str, column: str, dtype: str) -> str:
    """How a column is summarised when a report names it without an aggregate."""
    numeric = dtype.startswith(NUMERIC)
    counted = table.startswith(("fact_", "mart_")) and (table, column) not in NO_SUM
    return "sum" if numeric and counted else "none"


def default_totals(df: DataFrame, table: str) -> DataFrame:
    """All columns summed that the model sums by default."""
    cols = [c for c, t in df.dtypes if default_summary(table, c, t) == "sum"]
    return df.agg(*[F.sum(c).alias(c) for c in cols])


def path(home: str, target: str) -> list[tuple[str, str, str, str]]:
    """Relationships to follow from a fact to one of its dimensions."""
    frontier = [(home, [])]
    while frontier:
        table, steps = frontier.pop(0)
        if table == target:
            return steps
        frontier += [(r[2], [*steps, r]) for r in RELATIONSHIPS if r[0] == table]
    raise KeyError(f"{home} has no relationship to {target}")


def related(home: str, target: str) -> bool:
    try:
        path(home, target)
        return True
    except KeyError:
        return False


@dataclass(frozen=True)
class Wanted:
    """What a visual needs of a table: keys to group by and aggregates."""

    home: str
    keys: tuple[str, ...]
    parts: tuple[Part, ...]


@dataclass(frozen=True)
class Reduced:
    """A table reduced to some keys: ``names`` holds the column of each aggregate, ``__rows`` how
    many rows it had. Distinct ids and values of medians are keys too."""

    frame: DataFrame
    keys: tuple[str, ...]
    names: dict[Part, str]

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], parts: Sequence[Part]) -> Reduced:
        names = {p: f"__part{i}" for i, p in enumerate(parts)}
        return cls(_reduce(df, keys, {n: p for p, n in names.items()}, {}), tuple(keys), names)

    def serves(self, keys: Sequence[str], parts) -> bool:
        return set(keys) <= set(self.keys) and all(p in self.names for p in parts)


def _reduce(source: DataFrame | Reduced, keys: Sequence[str], parts: Mapping[str, Part],
            filters: Mapping[str, Sequence]) -> DataFrame:
    """One row for each combination of keys, counted ids and values of medians, with the aggregates
    under their names and ``__rows``; of a table or of a finer reduction."""
    again = isinstance(source, Reduced)
    df = source.frame if again else source
    for name, values in filters.items():
        df = df.filter(F.col(name).isin(*values))
    spread = {n: p for n, p in parts.items() if p.kind in ("distinct", "median")}
    ready = df.withColumns({n: F.col(source.names[p]) if again else p.column()
                            for n, p in spread.items()}) if spread else df
    sums = [(_merge(p, source.names[p]) if again else _partial(p)).alias(n)
            for n, p in parts.items() if n not in spread]
    rows = F.sum("__rows") if again else F.count(F.lit(1))
    return ready.groupBy(*keys, *spread).agg(*sums, rows.alias("__rows"))


class Model:
    """Tables by name, the measures over them, and the rows a role may see."""

    def __init__(self, tables: Mapping[str, DataFrame], measures: dict[str, Measure] | None = None,
                 reduced: Mapping[str, Reduced] | None = None):
        self.tables = tables
        self.measures = measures or MEASURES
        self.reduced = reduced or {}
        self.wanted: list[Wanted] | None = None

    def scoped(self, tables: dict[str, DataFrame]) -> Model:
        """With other tables, such as the rows that a role may see; what was reduced for a page
        holds for the tables it was made from only."""
        kept = {home: r for home, r in self.reduced.items() if home not in tables}
        return Model(ChainMap(tables, self.tables), self.measures, kept)

    def for_page(self, visuals: Sequence[Callable[[Model], object]],
                 write: Callable[[DataFrame, str], DataFrame] | None = None) -> Model:
        """A model that answers all given visuals from one reduction of each table they use.

        The visuals are planned once to learn the keys and aggregates they need. Each table is then
        reduced to all of these keys together: sums and counts add up from there, counted ids and
        values of medians stay as keys, so every coarser visual is exact. ``write`` stores a
        reduction (as ``session.keep`` does), so that its table is scanned once for the page.
        """
        learner = Model(self.tables, self.measures)
        learner.wanted = []
        for visual in visuals:
            visual(learner)
        out: dict[str, Reduced] = {}
        for home in dict.fromkeys(w.home for w in learner.wanted):
            mine = [w for w in learner.wanted if w.home == home]
            parts = list(dict.fromkeys(p for w in mine for p in w.parts))
            keys = sorted({k for w in mine for k in w.keys})
            one = Reduced.of(self.tables[home], keys, parts)
            out[home] = Reduced(write(one.frame, home), one.keys, one.names) if write else one
        return Model(self.tables, self.measures, out)

    def evaluate(self, measures: Sequence[str | tuple[str, Measure]], by: Sequence[str] = (),
                 where: dict[str, Sequence] | None = None,
                 levels: bool = False) -> DataFrame:
        """Measures per combination of the ``table.column`` names in ``by``.

        ``where`` lists allowed values per ``table.column`` and leaves alone
        measures whose table is not related to the filtered one. Fact rows
        without a dimension partner form a group of their own (NULL). With
        ``levels`` the groups are rolled up and ``level`` tells how many of the
        ``by`` columns a row is summed over.
        """
        named = [(m, self.measures[m]) if isinstance(m, str) else m for m in measures]
        frames, seen = [], []
        for _, m in named:
            if (m.table, m.against) in seen:
                continue
            seen.append((m.table, m.against))
            same = [(n, x) for n, x in named if (x.table, x.against) == (m.table, m.against)]
            frames.append(self._one(m.table, same, by, where or {}, levels))
        names = [b.split(".")[1] for b in by] + (["level"] if levels else [])
        out = frames[0]
        for f in frames[1:]:
            out = _side_by_side(out, f, names)
        return out.select(*names, *[n for n, _ in named])

    # ------------------------------------------------------------ one table --
    def _one(self, home, named, by, where, levels) -> DataFrame:
        against = named[0][1].against
        main = self._grouped(home, named, by, where, levels)
        if not against:
            return main
        col, value = against
        rest = [b for b in by if b != f"{home}.{col}"]
        other = {k: v for k, v in where.items() if k != f"{home}.{col}"}
        ref = self._grouped(home, named, rest, {**other, f"{home}.{col}": [value]}, False)
        keys = [b.split(".")[1] for b in rest]
        ref = ref.withColumnsRenamed({n: f"__ref_{n}" for n, _ in named})
        both = _side_by_side(main, ref, keys, how="left")
        return both.withColumns({n: F.col(n) - F.col(f"__ref_{n}") for n, _ in named}) \
            .drop(*[f"__ref_{n}" for n, _ in named])

    def _grouped(self, home, named, by, where, levels) -> DataFrame:
        parts = {f"{n}__{k}": p for n, m in named for k, p in m.parts.items()}
        # dimension columns named inside a measure become grouping columns of
        # the first reduction, like those of the report
        inner = sorted({t for p in parts.values() for t in _dimension_columns(p)})
        filters = {k: v for k, v in where.items() if related(home, k.split(".")[0])}
        needed = list(dict.fromkeys([*by, *filters, *inner]))
        own = [n.split(".")[1] for n in needed if n.startswith(home + ".")]
        chains = [path(home, n.split(".")[0]) for n in needed if not n.startswith(home + ".")]
        late = {n: p for n, p in parts.items() if _dimension_columns(p)}
        early = {n: p for n, p in parts.items() if n not in late}
        raw = sorted({c for p in late.values()
                      for c in _home_columns(p, self.tables[home].columns)})
        keys = list(dict.fromkeys([*own, *[c[0][1] for c in chains], *raw]))
        if self.wanted is not None:
            self.wanted.append(Wanted(home, tuple(keys), tuple(early.values())))
        source = self.reduced.get(home)
        if source is None or not source.serves(keys, early.values()):
            source = self.tables[home]
        own_filters = {n.split(".")[1]: v for n, v in filters.items() if n.startswith(home + ".")}
        small = _reduce(source, keys, early, own_filters)
        wide = self._join_dimensions(small, home, needed, chains)
        for name, values in filters.items():
            if not name.startswith(home + "."):
                wide = wide.filter(F.col(f"`{name}`").isin(*values))
        groups = [F.col(f"`{b}`" if not b.startswith(home + ".") else b.split(".")[1])
                  .alias(b.split(".")[1]) for b in by]
        finals = [_final(p, n).alias(n) for n, p in parts.items()]
        if levels:
            agg = wide.select("*", *[g.alias(f"__by{i}") for i, g in enumerate(groups)]) \
                .rollup(*[f"__by{i}" for i in range(len(by))]) \
                .agg(F.bit_count(F.grouping_id()).cast("int").alias("level"), *finals)
            heads = [F.col(f"__by{i}").alias(b.split(".")[1]) for i, b in enumerate(by)]
            heads.append(F.col("level"))
        else:
            agg = wide.groupBy(*groups).agg(*finals)
            heads = [F.col(b.split(".")[1]) for b in by]
        values = [m.formula(*[F.col(f"{n}__{k}") for k in m.parts]).alias(n) for n, m in named]
        return agg.select(*heads, *values)

    def _join_dimensions(self, small, home, needed, chains) -> DataFrame:
        steps = list(dict.fromkeys(s for c in chains for s in c))
        for many, fk, one, key in steps:
            dim = self.tables[one]
            take = [n.split(".")[1] for n in needed if n.startswith(one + ".")]
            onward = [s[1] for s in steps if s[0] == one]
            cols = [F.col(key).alias("__key"), *[F.col(c).alias(f"{one}.{c}")
                                                for c in dict.fromkeys([*take, *onward])]]
            left = F.col(fk) if many == home else F.col(f"`{many}.{fk}`")
            small = small.join(dim.select(*cols), left == F.col("__key"), "left").drop("__key")
        return small


def _dimension_columns(p: Part) -> list[str]:
    """Back-quoted ``dim.column`` names used by a part."""
    text = f"{p.value} {p.where or ''}"
    return [t for t in text.split("`")[1::2] if "." in t]


def _home_columns(p: Part, columns: Sequence[str]) -> list[str]:
    words = "".join(ch if ch.isalnum() or ch == "_" else " "
                    for ch in f"{p.value} {p.where or ''}").split()
    return [c for c in columns if c in words]


def _partial(p: Part) -> Column:
    if p.kind == "sum":
        return F.sum(p.column())
    if p.kind == "count":
        return F.count(p.column())
    if p.kind == "min":
        return F.min(p.column())
    raise ValueError(p.kind)


def _merge(p: Part, name: str) -> Column:
    return F.min(name) if p.kind == "min" else F.sum(name)


def _final(p: Part, name: str) -> Column:
    """Second reduction over the pre-reduced rows (``__rows`` source rows each)."""
    if _dimension_columns(p):
        if p.kind != "count":
            raise ValueError("only counts may test dimension columns")
        return F.coalesce(F.sum(F.when(F.expr(p.where), F.col("__rows"))), F.lit(0))
    if p.kind == "sum":
        return F.sum(name)
    if p.kind == "count":
        return F.coalesce(F.sum(name), F.lit(0))
    if p.kind == "min":
        return F.min(name)
    if p.kind == "distinct":
        return F.countDistinct(name)
    return F.percentile(F.col(name), F.lit(0.5), F.col("__rows"))


def _side_by_side(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "full") -> DataFrame:
    """Results of two home tables next to each other; without keys both are one row."""
    new = [c for c in b.columns if c not in keys]
    if not keys:
        return a.withColumns({c: b.select(c).scalar() for c in new})
    right = b.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *new)
    test = None
    for k in keys:
        t = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        test = t if test is None else test & t
    both = a.join(right, test, how)
    if how == "full":
        both = both.withColumns({k: F.coalesce(k, f"__r_{k}") for k in keys})
    return both.drop(*[f"__r_{k}" for k in keys])


