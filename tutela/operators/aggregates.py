"""Aggregations. Everything here reduces inside the map tasks first, so one
key with a large share of the rows costs no single task more than its share of
the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_rest(df: DataFrame, **aggs: Column) -> DataFrame:
    """GROUP BY ALL: every column not named as a source is a key."""
    return df.groupBy(*df.columns).agg(*[c.alias(n) for n, c in aggs.items()])


def sum_when(test: Column, value: Column | int = 1) -> Column:
    value = value if isinstance(value, Column) else F.lit(value).cast("bigint")
    return F.sum(F.when(test, value).otherwise(F.lit(0)))


def share(test: Column) -> Column:
    """Part of the rows for which the test is true."""
    return F.avg(F.when(test, 1.0).otherwise(0.0))


def any_of(test: Column) -> Column:
    return F.max(F.when(test, 1).otherwise(0))


def distinct_text(col: str, sep: str = ", ") -> Column:
    """Sorted distinct values joined by ``sep``. Only for code columns: the set
    kept per group is as large as the number of codes."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def ordered_list(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Distinct values of a bounded-domain column per group, in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(col)).alias(name))


def median_of(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    """Exact median of a whole-number column such as day counts.

    Rows are first counted per value, so the state per group holds each
    different value once, however many rows share it.
    """
    counts = (df.filter(F.col(col).isNotNull()).groupBy(*by, col)
              .agg(F.count(F.lit(1)).alias("__n")))
    return counts.groupBy(*by).agg(F.percentile(F.col(col), F.lit(0.5), F.col("__n")).alias(name))


def interval_of(df: DataFrame, by: Sequence[str], col: str, low: float = 0.025,
                high: float = 0.975) -> DataFrame:
    """Percentile interval with linear interpolation between neighbours, for
    columns with a bounded number of different values (see ``median_of``)."""
    counts = (df.filter(F.col(col).isNotNull()).groupBy(*by, col)
              .agg(F.count(F.lit(1)).alias("__n")))
    both = counts.groupBy(*by).agg(F.percentile(
        F.col(col), F.array(F.lit(low), F.lit(high)), F.col("__n")).alias("__p"))
    return both.select(*by, F.col("__p")[0].alias("ci_low"), F.col("__p")[1].alias("ci_high"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def value_share(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Normalised value counts; the total is a scalar over the counts."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("t"))
    return counts.withColumn(name, F.col("rows") / total.scalar())


def rollup_levels(df: DataFrame, levels: Sequence[str], *aggs: Column) -> DataFrame:
    """Matrix rows: measures at every level of a hierarchy and in total.

    ``level`` is the number of hierarchy columns a row is summed over, which
    tells a subtotal from a group of NULLs.
    """
    out = df.rollup(*levels).agg(F.grouping_id().alias("level"), *aggs)
    return out.withColumn("level", F.bit_count("level").cast("int"))


def pivot_sum(df: DataFrame, rows: Sequence[str], across: str, values: Sequence,
              rest: str | None = "other", **sums: str) -> DataFrame:
    """Rows by columns. The column values are given, which saves the extra job
    that would look for them and fixes the schema.

    Values that are not listed, nulls too, are summed into the column ``rest``.
    With ``rest=None`` the caller vouches for the list: another value ends the
    job with an error.
    """
    listed = [str(v) for v in values]
    known = F.col(across).cast("string").isin(*listed)
    name = F.concat(F.lit(f"{across} has an unlisted value: "), F.coalesce(
        F.col(across).cast("string"), F.lit("NULL")))
    column = F.when(known, F.col(across).cast("string")).otherwise(
        F.lit(rest) if rest else F.raise_error(name).cast("string"))
    shown = [*listed, rest] if rest else listed
    wide = (df.withColumn(across, column).groupBy(*rows).pivot(across, shown)
            .agg(*[F.sum(c).alias(n) for n, c in sums.items()]))
    single = len(sums) == 1
    return wide.select(*rows, *[
        F.col(f"`{v}`" if single else f"`{v}_{n}`").alias(f"{n}_{v}")
        for v in shown for n in sums])
