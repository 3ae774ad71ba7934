"""Does outreach work? Naive and matched estimates with bootstrap intervals.

Both estimators depend on the data only through the number of student-terms per
(stratum, arm, outcome). These cells are few and do not grow with the data: the
strata are combinations of binned covariates. Resampling rows with replacement
is the same as one multinomial draw over the cells, so the bootstrap never
touches the rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutela.functions import clip, cut, stratum_key
from tutela.operators.aggregates import weighted_mean
from tutela.operators.sets import stack

# --- fixed values: bins, labels, replicates and seed ------------------------
WEEK_EDGES, WEEK_LABELS = (0, 5, 8, 12), ("w3-5", "w6-8", "w9-11")
LOGIN_EDGES, LOGIN_LABELS = (-1, 2, 6, 999), ("inactive", "low", "normal")
MISSED_EDGES, MISSED_LABELS = (-1, 2, 99), ("0-2", "3+")
REASON_RANGE = (1, 3)
REPLICATES, SEED = 400, 7
NAIVE_NAME = "Naive difference"
MATCHED_NAME = "Coarsened exact matching"
NAIVE_NOTE = "Biased: contacted students are selected for severity"
# ---------------------------------------------------------------------------


def _flag_text(c: str) -> Column:
    """``True`` / ``False``; an unknown flag reads as true, as it does when a
    blank of a true/false column is turned into a boolean."""
    return F.when(F.coalesce(F.col(c), F.lit(True)), "True").otherwise("False")


def strata(rows: DataFrame) -> DataFrame:
    """Adds the matching stratum. Values outside every bin form a stratum ``nan``."""
    return rows.withColumn("stratum", stratum_key(
        cut("alert_week", WEEK_EDGES, WEEK_LABELS),
        clip("reasons_at_alert", *REASON_RANGE).cast("int").cast("string"),
        cut("logins_2wk_at_alert", LOGIN_EDGES, LOGIN_LABELS),
        cut("pre_missed", MISSED_EDGES, MISSED_LABELS),
        _flag_text("online"), _flag_text("nbf_equity"), _flag_text("first_term")))


def cells(rows: DataFrame) -> DataFrame:
    """Number of student-terms per stratum, arm and outcome."""
    return strata(rows).groupBy(
        "stratum", "contacted", F.col("retained_next_term").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))


def both_estimates(cell_counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Both estimators in one pass over the cells.

    * ``naive``: difference in outcome means, contacted minus not
    * ``matched``: coarsened exact matching, the difference within each stratum
      that has both arms, weighted by its number of contacted student-terms
    """
    def arm(value: int, x: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("contacted") == value, x)), F.lit(0))

    n, kept = F.col("n"), F.col("n") * F.col("outcome")
    per = cell_counts.groupBy(*by, "stratum").agg(
        arm(1, n).alias("t"), arm(0, n).alias("c"), arm(1, kept).alias("yt"),
        arm(0, kept).alias("yc"))
    both = (F.col("t") > 0) & (F.col("c") > 0)
    effect = F.when(both, F.try_divide("yt", "t") - F.try_divide("yc", "c"))
    weight = F.when(both, F.col("t"))
    total = {x: F.sum(x) for x in ("t", "c", "yt", "yc")}
    return per.groupBy(*by).agg(
        (F.try_divide(total["yt"], total["t"]) - F.try_divide(total["yc"], total["c"]))
        .alias("naive"),
        weighted_mean(effect, weight).alias("matched"),
        F.count_if(both).alias("n_strata"),
        (F.coalesce(F.sum(weight), F.lit(0)) / F.greatest(total["t"], F.lit(1)))
        .alias("matched_share"))


def naive(cell_counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return both_estimates(cell_counts, by).select(*by, F.col("naive").alias("estimate"))


def cem(cell_counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return both_estimates(cell_counts, by).select(
        *by, F.col("matched").alias("estimate"), "n_strata", "matched_share")


def resample(cell_counts: DataFrame, reps: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """Cell counts of bootstrap samples 1 .. ``reps``, as (replicate, cell
    columns, n); replicate 0 is the data itself.

    The cells, a list bounded by the number of strata, ride along with each
    replicate number, and the numbers are dealt over the cluster; each replicate
    draws from its own seeded stream, so a lost task redraws the same numbers
    wherever it runs again.
    """
    spark = cell_counts.sparkSession
    listed = cell_counts.agg(F.array_sort(F.collect_list(
        F.struct("stratum", "contacted", "outcome", "n"))).alias("cells"))
    slices = max(1, min(reps + 1, spark.sparkContext.defaultParallelism))
    tasks = spark.range(0, reps + 1, 1, slices).select(
        listed.scalar().alias("cells"), F.col("id").cast("int").alias("replicate"))

    @F.pandas_udf("array<bigint>")
    def draw(counts: pd.Series, replicate: pd.Series) -> pd.Series:
        out = []
        for c, r in zip(counts, replicate):
            c = np.asarray(c, dtype=np.int64)
            if r == 0:
                out.append(c)
                continue
            total = int(c.sum())
            p = c / total if total else np.full(len(c), 1.0 / max(len(c), 1))
            out.append(np.random.default_rng([seed, int(r)]).multinomial(total, p))
        return pd.Series(out)

    drawn = tasks.withColumn("draws", draw(F.col("cells.n"), F.col("replicate")))
    pairs = drawn.select("replicate", F.inline(F.arrays_zip("cells", "draws")))
    return pairs.select("replicate", F.col("cells.stratum").alias("stratum"),
                        F.col("cells.contacted").alias("contacted"),
                        F.col("cells.outcome").alias("outcome"),
                        F.col("draws").alias("n")).filter(F.col("n") > 0)


Estimator = Callable[[DataFrame, Sequence[str]], DataFrame]
_DETAILS = ("n_strata", "matched_share")


def _both(runs: DataFrame) -> DataFrame:
    one = both_estimates(runs, by=["replicate"])
    return one.select("replicate", *_DETAILS, F.inline(F.array(
        F.struct(F.lit(NAIVE_NAME).alias("estimator"), F.col("naive").alias("estimate")),
        F.struct(F.lit(MATCHED_NAME).alias("estimator"), F.col("matched").alias("estimate")))))


def _each(runs: DataFrame, estimators: Mapping[str, Estimator]) -> DataFrame:
    parts = []
    for name, estimate in estimators.items():
        one = estimate(runs, ["replicate"])
        extra = [F.col(c) if c in one.columns else F.lit(None).cast(t).alias(c)
                 for c, t in zip(_DETAILS, ("bigint", "double"))]
        parts.append(one.select("replicate", *extra, F.lit(name).alias("estimator"), "estimate"))
    return stack(parts)


def bootstrap(cell_counts: DataFrame, estimators: Mapping[str, Estimator] | None = None,
              reps: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """One row per estimator: point estimate, 95 % percentile interval, number of
    replicates, strata and matched share. A replicate without an estimate (no
    stratum has both arms) is left out of the interval.

    An estimator takes cell counts and grouping columns and returns the groups
    with a column ``estimate`` (``naive`` and ``cem`` are two). Without a choice
    both built-in ones are computed in a single pass over the drawn cells.
    """
    runs = resample(cell_counts, reps, seed)
    long = _each(runs, estimators) if estimators else _both(runs)
    data = F.col("replicate") == 0
    spread = F.percentile(F.when(~data, F.col("estimate")), F.array(F.lit(0.025), F.lit(0.975)))
    return long.groupBy("estimator").agg(
        F.max(F.when(data, F.col("estimate"))).alias("estimate"), spread.alias("ci"),
        F.count_if(~data).alias("replicates"),
        *(F.max(F.when(data, F.col(c))).alias(c) for c in _DETAILS)).select(
        "estimator", "estimate", F.col("ci")[0].alias("ci_low"), F.col("ci")[1].alias("ci_high"),
        "replicates", *_DETAILS)


def _pp(c: str) -> Column:
    return F.bround(F.col(c) * 100, 2)


def _note() -> Column:
    share = F.bround(F.col("matched_share") * 100, 0).cast("int").cast("string")
    matched = F.concat(F.col("n_strata").cast("string"), F.lit(" strata; "), share,
                       F.lit("% of treated matched"))
    return F.when(F.col("estimator") == NAIVE_NAME, NAIVE_NOTE).otherwise(matched)


def estimates(rows: DataFrame) -> DataFrame:
    """Both point estimates in percentage points, two digits, without intervals."""
    one = both_estimates(cells(rows))
    return one.select("n_strata", "matched_share", F.inline(F.array(
        F.struct(F.lit(NAIVE_NAME).alias("estimator"), F.col("naive").alias("estimate")),
        F.struct(F.lit(MATCHED_NAME).alias("estimator"), F.col("matched").alias("estimate"))))) \
        .select("estimator", _pp("estimate").alias("estimate_pp"), _note().alias("note"))


def results(rows: DataFrame, reps: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """The published table: estimate, interval and note per estimator."""
    return bootstrap(cells(rows), None, reps, seed).select(
        "estimator", _pp("estimate").alias("estimate_pp"), _pp("ci_low").alias("ci_low_pp"),
        _pp("ci_high").alias("ci_high_pp"), _note().alias("note"))


def verdict(table: DataFrame) -> DataFrame:
    """Recovered if the matched estimate is positive and above the naive one."""
    pick = {n: F.max(F.when(F.col("estimator") == name, F.col("estimate_pp"))).alias(n)
            for n, name in (("naive_pp", NAIVE_NAME), ("matched_pp", MATCHED_NAME))}
    both = table.agg(*pick.values())
    good = (F.col("matched_pp") > 0) & (F.col("matched_pp") > F.col("naive_pp"))
    return both.select(
        "naive_pp", "matched_pp",
        F.when(good, "RECOVERED").otherwise("NOT RECOVERED").alias("verdict"),
        F.when(F.col("naive_pp") < 0, "wrong").otherwise("attenuated").alias("naive_sign"))
