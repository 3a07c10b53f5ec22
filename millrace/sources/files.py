"""Raw files: listing them, and choosing the newest that fits a pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.filenames import base_name, date_stamp, folder_name, name_regex


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, mtime and length of every file under `folder`; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("modificationTime").alias("mtime"), "length")


def latest_files(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest file per group: highest date stamp in the name, then latest change, then path.

    A maximum per group, not a sort: each task reduces its own files first.
    """
    stamped = files.withColumn("stamp", date_stamp(base_name(F.col("path"))))
    stamped = stamped.where(F.col("stamp").isNotNull())
    newest = stamped.groupBy(*by).agg(F.max(F.struct("stamp", "mtime", "path")).alias("f"))
    return newest.select(*by, "f.path", "f.stamp", "f.mtime").where(F.col("path").isNotNull())


def latest_file(files: DataFrame, pattern: str, fmt: str) -> DataFrame:
    """At most one row: the newest file whose base name fits the pattern and format. A folder with
    such a name is one file, delivered in parts."""
    fits, folder = name_regex(pattern, fmt), folder_name(F.col("path"))
    named = files.withColumn("path", F.when(base_name(F.col("path")).rlike(fits), F.col("path")).when(
        base_name(folder).rlike(fits), folder))
    return latest_files(named.where(F.col("path").isNotNull()))
