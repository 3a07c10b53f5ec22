"""Tables this library or its users have stored: logs, dependencies, JDBC tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.model import AUDIT, VIOLATIONS, Bases, Dataset
from millrace.sinks.versions import read_current
from millrace.sources.local import local_frame


def read_table(
    spark: SparkSession, source: str | dict, schema: StructType, must_exist: bool = False,
    **folders
) -> DataFrame:
    """A Parquet folder or a JDBC table in the given columns and types.

    A folder that is not there has no rows, as of a log before its first run, unless it
    `must_exist`.

    Folders are read with the schema stated, so nothing is inferred from footers or folder names.
    `folders` are the values of the leading partition columns, in order: only the files of that
    one subfolder are listed, however many others a log has gathered.
    """
    if isinstance(source, dict):
        stored = spark.read.format("jdbc").options(**source).load()
    else:
        try:
            path = "/".join([source.rstrip("/"), *[f"{k}={v}" for k, v in folders.items()]])
            stored = spark.read.schema(schema).option("basePath", source).parquet(path)
        except AnalysisException as e:
            if must_exist or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return local_frame(spark, [], schema)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_audit(
    spark: SparkSession, source: str | dict, cycle_id: str | None = None
) -> DataFrame:
    """The audit log, or one cycle of it."""
    if cycle_id is None:
        return read_table(spark, source, AUDIT)
    log = read_table(spark, source, AUDIT, CYCLE_ID=cycle_id)
    return log.where(F.col("CYCLE_ID") == cycle_id)


def read_run(
    spark: SparkSession, source: str | dict, dataset_id: int, cycle_id: str, run_id: int
) -> DataFrame:
    """One run's violations as stored. The filters name a folder or go to the database."""
    log = read_table(spark, source, VIOLATIONS,
                     DATASET_ID=dataset_id, CYCLE_ID=cycle_id, RUN_ID=run_id)
    return log.where((F.col("DATASET_ID") == dataset_id) & (F.col("CYCLE_ID") == cycle_id)
                     & (F.col("RUN_ID") == run_id))


def read_violations(
    spark: SparkSession, source: str | dict, dataset_id: int, cycle_id: str, run_id: int
) -> DataFrame:
    """One run's violations, each once, whoever appended them how often."""
    return read_run(spark, source, dataset_id, cycle_id, run_id).distinct()


def load_dependencies(
    spark: SparkSession, sources: list[Dataset], bases: Bases
) -> dict[str, DataFrame]:
    """Each source dataset's stored rows under its dataset name, of versioned targets the current."""
    return {d.dataset_name: read_current(spark, bases.target(d)) for d in sources}
