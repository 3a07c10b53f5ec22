"""Column layouts: raw columns to landing columns, report columns to warehouse columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import column

# Warehouse spellings of column types that Spark spells otherwise.
WAREHOUSE_TYPES = {
    "bool": "boolean",
    "bpchar": "char",
    "character": "char",
    "character varying": "varchar",
    "double precision": "double",
    "float4": "float",
    "float8": "double",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "nvarchar": "varchar",
    "char varying": "varchar",
    # Spark's writer spells both one way; it sends instants, and the zone is the session's.
    "timestamp with time zone": "timestamp",
    "timestamp without time zone": "timestamp",
    "timestamptz": "timestamp",
}


def _source(df: DataFrame, name: str) -> Column | None:
    """The column a layout row names: exact name, unheadered position, or nested path."""
    have = {c.lower() for c in df.columns}
    if name.lower() in have:
        return column(name)
    position = re.fullmatch(r"col(\d+)", name.lower())
    if position and f"_c{position[1]}" in have:
        return F.col(f"_c{position[1]}")
    if "." in name and name.split(".")[0].lower() in have:
        return F.col(name)
    return None


def apply_mapping(df: DataFrame, columns: Sequence[tuple[str, str]] | None) -> DataFrame:
    """Project the (source, target) pairs in order, as text; None passes every column through."""
    if columns is None:
        return df
    found = [(_source(df, source), source, target) for source, target in columns]
    missing = [source for col, source, _ in found if col is None]
    if missing or not found:
        raise ValueError(f"source columns not found: {missing}; the file has {df.columns}")
    return df.select(*[col.cast("string").alias(target) for col, _, target in found])


def spark_type(declared: str) -> str:
    """A declared warehouse type as Spark reads it."""
    name, size = re.fullmatch(r"\s*([^(]+?)\s*(\(.*\))?\s*", declared.lower()).groups()
    kind = WAREHOUSE_TYPES.get(name, name) + (size or "").replace(" ", "")
    if kind in ("char", "varchar", "text") or kind.endswith("(max)"):
        raise ValueError(f"column type {declared!r} needs a length")
    try:
        StructType.fromDDL(f"c {kind}")
    except PySparkException as e:
        raise ValueError(f"column type {declared!r} is not known") from e
    return kind


def warehouse_ddl(columns: Sequence[tuple[str, str]]) -> str:
    """Column list for the table to be created, from (name, declared type) pairs."""
    return ", ".join(f"`{name}` {spark_type(declared)}" for name, declared in columns)


def warehouse_columns(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """The declared columns in the declared order and types."""
    def as_declared(name: str, declared: str) -> Column:
        kind = spark_type(declared)
        stored = "string" if kind.startswith(("varchar", "char")) else kind
        return column(name).cast(stored).alias(name)

    return df.select(*[as_declared(name, declared) for name, declared in columns])
