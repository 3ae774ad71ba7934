"""A digest of a table that depends on its rows, but not on their order.

Each row becomes one canonical text of its columns in the order of their names; the digest is the
sum of the first 60 bits of the texts' MD5 values. Rows that repeat count as often as they do, and a
sum adds up over tasks, so a digest costs no exchange of rows and can ride along with a write. Any
engine with MD5 can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_DIGEST = "__row_digest"
DIGITS = 10_000  # floating numbers count in ten-thousandths
FLOATS = (T.DoubleType, T.FloatType)
#: Types whose plain text another engine writes the same way.
PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
         T.DecimalType, T.DateType)


def digested(schema: T.StructType) -> list[T.StructField]:
    """The columns that count, by name: all but times of loading and nested ones."""
    return sorted((f for f in schema if isinstance(f.dataType, FLOATS + PLAIN)),
                  key=lambda f: f.name)


def escaped(text: Column) -> Column:
    """Text in which the separator and the mark of a null cannot occur."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def _text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, FLOATS):
        return c.cast("string")
    c = c.cast("double")
    finite = F.abs(c) < F.lit(1e30)
    out = F.when(finite, F.round(F.when(finite, c) * DIGITS).cast("decimal(38,0)")
                 .cast("string")).when(F.isnan(c), "nan").when(c > 0, "inf").otherwise("-inf")
    # numbers of a usual size are rounded as whole ones, away from zero at a half as above
    size = F.abs(c) * DIGITS
    whole = F.floor(size)
    whole = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    return F.when(size < F.lit(1e15), F.when(c < 0, -whole).otherwise(whole).cast("string")) \
        .when(c.isNotNull(), out)


def with_row_digest(df: DataFrame) -> DataFrame:
    """The rows with the number of each in the column ``ROW_DIGEST``.

    The texts are columns of their own before anything is made of them, and escaped together only
    where a row needs it: one expression over all columns is code too long for the JVM to compile.
    """
    texts = F.array(*map(_text, digested(df.schema))).cast("array<string>")
    row, every = F.col(ROW_DIGEST), F.array_join(ROW_DIGEST, "")
    special = F.contains(every, F.lit("|")) | F.contains(every, F.lit("\\"))
    text = F.when(special, F.array_join(F.transform(row, escaped), "|", "\\N")).otherwise(
        F.array_join(row, "|", "\\N"))
    return df.withColumn(ROW_DIGEST, texts).withColumn(
        ROW_DIGEST, F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("bigint"))


def digest() -> Column:
    """Aggregate over ``with_row_digest``: the digest of a table, as text; '0' without rows. Added
    in thirds of 20 bits, which whole numbers hold for 2^43 rows."""
    total = None
    for place in range(3):
        part = F.sum(F.shiftright(ROW_DIGEST, 20 * place).bitwiseAND((1 << 20) - 1))
        part = part.cast("decimal(38,0)") * F.lit(1 << 20 * place).cast("decimal(38,0)")
        total = part if total is None else total + part
    return F.coalesce(total.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).cast("string")


def table_digest(df: DataFrame, name: str) -> DataFrame:
    """(table_name, rows, digest), one row."""
    return with_row_digest(df).agg(F.count(F.lit(1)).alias("rows"), digest().alias("digest")).select(
        F.lit(name).alias("table_name"), "rows", "digest")
