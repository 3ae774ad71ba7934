"""Inline reference rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def lookup(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows given as Python values.

    They become a local relation, so the planner knows their true size and
    chooses the join by it.
    """
    struct = T._parse_datatype_string(schema)
    rows = list(rows)
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)
