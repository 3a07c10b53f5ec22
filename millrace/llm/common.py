"""What several corpus operators share: work tables, bounded Arrow batches, text expressions."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.settings import remove, scratch

# A word is a run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
ARROW_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Arrow batches of few rows while a job with Python tasks runs, since texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# The work tables of the outcome that is being computed.
_TABLES: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame, written to the shared work area and read back: later steps reread it, lost
    executors included, and its lineage ends here."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    tables = _TABLES.get()
    if tables is not None:
        tables.append(path)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Remove the work tables of stored frames that nothing reads any more, and have the JVM collect
    what finished steps left, upon which Spark removes their shuffle files."""
    spark = frames[0].sparkSession
    tables = _TABLES.get()
    for frame in frames:
        for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            remove(spark, path)
            if tables is not None:
                tables[:] = [t for t in tables if not path.endswith(t.split(":", 1)[-1])]
    collect(spark)


def collect(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def outcome(spark: SparkSession, name: str, build: Callable[[], DataFrame],
            path: str | None = None) -> DataFrame:
    """The frame that `build` makes, stored. The work tables stored on the way are removed, also when
    it fails, so disk holds those of one step at a time."""
    outer, tables = _TABLES.get(), []
    token = _TABLES.set(tables)
    kept = None
    try:
        result = stored(build(), name, path)
        kept = tables.pop()
    finally:
        _TABLES.reset(token)
        for path in tables:
            remove(spark, path)
        collect(spark)
    if outer is not None:
        outer.append(kept)
    return result


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores as keep them apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(spark: SparkSession) -> int:
    """Into how many parts a group of rows is cut for counting: four for each shuffle task."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def positions(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with a bigint column `name` that counts 0, 1, ... within each group.

    A group of any size is cut into slices by a hash of the ordering columns. Each slice is
    numbered by itself and starts where the ones before it end, so no task holds a whole group.
    `rows` is read twice: pass a stored frame. The order is by slice, then by `order`.
    """
    from pyspark.sql import Window

    n = slices(rows.sparkSession)
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(n)))
    sizes = cut.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_g"), F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_slice").orderBy(*order)
    numbered = cut.withColumn("_i", F.row_number().over(inside) - 1)
    return (numbered.join(starts, F.col(group).eqNullSafe(F.col("_g"))
                          & (F.col("_slice") == F.col("_s")), "left")
            .withColumn(name, (F.col("_start") + F.col("_i")).cast("long"))
            .drop("_slice", "_g", "_s", "_start", "_i"))
