"""Small frames from rows at hand."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

_ARROW = {
    T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.StringType(): pa.string(),
    T.TimestampType(): pa.timestamp("us", tz="UTC")}


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A frame the planner knows the size of, down to none; such rows are part of the plan."""
    rows = list(rows)
    columns = [pa.array([r[i] for r in rows], _ARROW[f.dataType]) for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema.names), schema)
