"""Parquet / CSV tables on the shared file system."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tutela.sources.digest import ROW_DIGEST, digest, with_row_digest

# Physical layout of the large facts: partition columns, then the order of rows
# inside each file, so that footers prune by lifecycle, student and week.
LAYOUT: dict[str, tuple[list[str], list[str]]] = {
    "fact_alert": (["term_code"], ["lifecycle_status"]),
    "fact_case": (["term_code"], ["student_id"]),
    "fact_engagement_week": (["term_code"], ["week_number"]),
    "fact_enrolment": (["term_code"], ["student_id"]),
}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                only_partitions: bool = False, digested: bool = False) -> int | tuple[int, str]:
    """Write once and return the row count the same job observed, with ``digested`` also the
    table's digest (``digest``).

    ``overwrite`` replaces the whole table, partitions of an earlier run
    included; ``only_partitions`` replaces those that the rows belong to and
    leaves the others.

    Rows of a partitioned table are first brought together by partition value
    in pieces of even size: a term becomes a few full files instead of one
    small file per task, and a term with most of the rows is split over many
    writers. Inside each file the rows are ordered.
    """
    seen = Observation()
    more = [digest().alias("digest")] if digested else []
    out = with_row_digest(df) if digested else df
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *more).drop(ROW_DIGEST)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    order = [*partition_by, *sort_by]
    if order:
        out = out.sortWithinPartitions(*order)
    writer = out.write.mode(mode).option(
        "partitionOverwriteMode", "dynamic" if only_partitions else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        (writer.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    else:
        writer.format(fmt).save(path)
    # a plan found to be empty as it runs can lose the node that observes; digest of no rows: '0'
    got = seen.get if seen._jo.getRow().length() else {"rows": 0, "digest": "0"}
    return (got["rows"], got["digest"]) if digested else got["rows"]


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet",
                 digested: bool = False) -> dict[str, int] | dict[str, tuple[int, str]]:
    """Write each table below ``folder``; returns table -> row count, with ``digested`` also the
    digest."""
    counts = {}
    for name, df in tables.items():
        parts, order = LAYOUT.get(name, ([], []))
        counts[name] = write_table(df, f"{folder}/{name}", fmt, digested=digested,
                                   partition_by=parts if fmt == "parquet" else (), sort_by=order)
    return counts


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables below ``folder``. Given as table -> frame, each has the columns of its frame: a
    partitioned table without rows has no file that names them."""
    frames = names if isinstance(names, Mapping) else {}
    return {n: (spark.read.schema(frames[n].schema) if n in frames else spark.read)
            .parquet(f"{folder}/{n}") for n in names}
