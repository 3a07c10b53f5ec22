"""Consecutive row ids 1..N without a global window.

A stored Parquet row already has a position: its file, and its index within the file. The id
is that index plus the rows in the files before, a prefix sum in two levels over a count per file.
The id is a pure function of stored bytes, so a lost executor or a second read gives every row the
same id again. The counts are joined to the rows the way Spark picks by their size.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace import fixed
from millrace.functions.text import column, quoted, spare
from millrace.settings import scratch

PART = "_landing_part"
# Files of a range, of which the rows before are summed up together.
SPAN = 1024


def _index() -> Column:
    return F.col("_metadata.row_index")


def has_row_index(df: DataFrame) -> bool:
    try:
        df.select(_index())
        return True
    except AnalysisException:
        return False


def _ranged(df: DataFrame, order_by: list[str | Column], partitions: int | None) -> DataFrame:
    """Rows in global order. The stored position breaks ties, so a hot key spans many ranges."""
    ties = spare(df.columns, "_tie_file", "_tie_row")
    tied = df.select(
        "*", F.xxhash64("_metadata.file_path").alias(ties[0]), _index().alias(ties[1]))
    keys = [*order_by, *ties]
    ranged = (tied.repartitionByRange(partitions, *keys) if partitions
              else tied.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys).drop(*ties)


def _store(df: DataFrame, path: str, part: str) -> DataFrame:
    (df.withColumn(part, F.spark_partition_id())
       .write.mode("overwrite")
       .option("maxRecordsPerFile", 0)  # one file per task: the part number names the file
       .parquet(path))
    return df.sparkSession.read.parquet(path)


def _starts(counts: DataFrame) -> DataFrame:
    """_file, _before: the rows in the files before each. counts: _range, _file, n, last.

    A prefix sum in two levels: within each range of files, and over the ranges. Only a number for
    each range reaches the driver.
    """
    path = scratch(counts.sparkSession, "file-offsets")
    within = Window.partitionBy("_range").orderBy("_file").rowsBetween(
        Window.unboundedPreceding, -1)
    counts.withColumn("_before", F.coalesce(F.sum("n").over(within), F.lit(0))).write.parquet(path)
    placed = counts.sparkSession.read.parquet(path)
    sums = placed.groupBy("_range").agg(
        F.sum("n").alias("n"), F.bool_and(F.col("n") == F.col("last") + 1).alias("whole")
    ).orderBy("_range").collect()
    if not all(r["whole"] for r in sums):
        raise ValueError("only whole stored files can be numbered; store the filtered rows first")
    starts, at = {}, 0
    for r in sums:
        starts[r["_range"]] = at
        at += r["n"]
    # Ranges without files have no start; the list has one for every number up to the last.
    table = F.lit([starts.get(i, 0) for i in range(max(starts, default=-1) + 1)] or [0])
    return placed.select("_file", (F.col("_before") + F.get(
        table.cast("array<bigint>"), F.col("_range").cast("int"))).alias("_before"))


def _number(stored: DataFrame, key: Column, part: str | None = None) -> DataFrame:
    """Prefix ROW_ID; `key` tells the files apart and its order is the order of the files."""
    spark = stored.sparkSession
    names = [c for c in stored.columns if c != part]
    counts = (stored.select(key.alias("_file"), _index().alias("_row")).groupBy("_file")
              .agg(F.count(F.lit(1)).alias("n"), F.max("_row").alias("last")))
    if part:  # numbered already, in order
        counts = counts.withColumn("_range", F.floor(F.col("_file") / SPAN))
    else:
        path = scratch(spark, "file-counts")
        counts.write.parquet(path)
        counts = spark.read.parquet(path).repartitionByRange("_file").withColumn(
            "_range", F.spark_partition_id().cast("bigint"))
        path = scratch(spark, "file-ranges")
        counts.write.parquet(path)
        counts = spark.read.parquet(path)
    file, row, before = spare(names, "_file", "_row", "_before")
    offsets = _starts(counts).toDF(file, before)
    columns = [column(c) for c in names]
    placed = stored.select(*columns, key.alias(file), _index().alias(row))
    row_id = (F.col(before) + F.col(row) + 1).alias(fixed.ROW_ID)
    return placed.join(offsets, file).select(row_id, *columns)


def number_stored_rows(stored: DataFrame) -> DataFrame:
    """ROW_ID for rows read straight from Parquet files (projections are fine, filters are not).

    Nothing is shuffled but a row for each file. Files count in the order of their paths.
    """
    return _number(stored, F.col("_metadata.file_path"))


def with_row_id(
    df: DataFrame,
    path: str | None = None,
    order_by: list[str | Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Prefix ROW_ID to any frame, by storing it once under `path`.

    Without `order_by` the rows keep the partitions they have: no shuffle, arbitrary but fixed
    order. With it, ids follow that order, through a range shuffle into `partitions` ranges.
    """
    spark = df.sparkSession
    path = path or scratch(spark, "landing")
    part, = spare(df.columns, PART)
    if order_by:
        if not has_row_index(df):
            df = _store(df, path + "-unordered", part).drop(part)
        df = _ranged(df, order_by, partitions)
    return _number(_store(df, path, part), F.col(quoted(part)), part)
