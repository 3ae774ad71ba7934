"""CSV extracts: land as text first, impose types afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from tutela.functions import to_date, to_double


#: Column that holds the whole text of a record which does not have the header's fields.
MALFORMED = "malformed_record"


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                  multi_line: bool = False, malformed: bool = False) -> DataFrame:
    """Every column as text. Empty and quoted-empty fields are NULL.

    With ``columns`` the header is checked against the names instead of read in
    a job of its own. Records do not span lines, so large files stay splittable;
    ``multi_line`` allows quoted line breaks and reads each file in one task.

    A record with a field too many or too few stops the job. With ``malformed``
    (``columns`` must be given) it is kept, its text in the column ``MALFORMED``,
    for ``well_formed`` and ``malformed_records`` to part.
    """
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("encoding", "UTF-8").option("multiLine", multi_line)
              .option("mode", "PERMISSIVE" if malformed else "FAILFAST"))
    if columns:
        fields = [T.StructField(c, T.StringType())
                  for c in (*columns, *((MALFORMED,) if malformed else ()))]
        reader = reader.schema(T.StructType(fields)).option("enforceSchema", False)
    if malformed:
        # a parser that skips columns does not see how many there were
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option(
            "columnPruning", False)
    return reader.csv(path)


def _is_malformed():
    # not a plain null test: the reader would apply that before it has filled the column
    return F.coalesce(F.length(MALFORMED), F.lit(-1)) >= 0


def well_formed(raw: DataFrame) -> DataFrame:
    return raw.filter(~_is_malformed()).drop(MALFORMED)


def malformed_records(raw: DataFrame, name: str) -> DataFrame:
    """(table_name, row_key, record) of the records that do not fit the header; the key is what
    stood in the first field."""
    return raw.filter(_is_malformed()).select(
        F.lit(name).alias("table_name"), F.col(raw.columns[0]).alias("row_key"),
        F.col(MALFORMED).alias("record"))


def _fail_soft(name: str, dtype: str):
    if dtype == "double":
        return to_double(name)
    if dtype == "date":
        return to_date(name)
    return F.col(name).try_cast(dtype)


def read_typed_csv(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """Promote the header, keep the named columns, cast; a bad value becomes NULL."""
    raw = read_text_csv(spark, path)
    return raw.select([_fail_soft(n, t).alias(n) for n, t in fields.items()])
