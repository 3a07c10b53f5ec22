"""Catalog tables over published folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.text import quoted


def register(spark: SparkSession, table: str, path: str) -> DataFrame:
    """(Re)create `table` over the Parquet files at `path`, with the columns found there."""
    name = ".".join(quoted(part) for part in table.split("."))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path=path, source="parquet")
