"""SQL text over named frames."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_views = threading.Lock()


def _temp_view(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        found = spark.catalog.getTable(name)
    except AnalysisException:
        return None
    return spark.table(name) if found.isTemporary else None


def run_sql(
    spark: SparkSession,
    query: str,
    frames: dict[str, DataFrame],
    args: dict | None = None,
) -> DataFrame:
    """Run `query` with every frame visible under its own name.

    The views exist only while the query is analyzed, and views of the same names that were
    there before come back, so no query sees what another one left. `args` are bound
    parameters (`:name`).
    """
    with _views:
        before = {name: _temp_view(spark, name) for name in frames}
        try:
            for name, frame in frames.items():
                frame.createOrReplaceTempView(name)
            return spark.sql(query, args=args) if args else spark.sql(query)
        finally:
            for name, view in before.items():
                if view is None:
                    spark.catalog.dropTempView(name)
                else:
                    view.createOrReplaceTempView(name)
