"""Run ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.model import join_path
from millrace.settings import Files

CLAIMS = "_claims"


def next_run_ids(log: DataFrame, key: str) -> DataFrame:
    """Next run id per cycle and `key` (DATASET_ID or GLUE_JOB_ID)."""
    return log.groupBy(key, "CYCLE_ID").agg((F.max("RUN_ID") + 1).alias("MAX_RUN_ID"))


def next_run_id(log: DataFrame, key: str, value: int, cycle_id: str) -> int:
    """Next run id of one dataset or job in one cycle; 1 when it has not run yet."""
    mine = next_run_ids(log.where((F.col(key) == value) & (F.col("CYCLE_ID") == cycle_id)), key)
    return mine.agg(F.coalesce(F.max("MAX_RUN_ID"), F.lit(1)).alias("n")).first()["n"]


def claim_run_id(spark: SparkSession, sink: str | dict, log: DataFrame, key: str, value: int,
                 cycle_id: str) -> int:
    """The next run id of one dataset or job in one cycle, for this caller alone.

    From the log's next id on, ids are claimed by making a file that must not be there: of callers
    that try the same one at once, on any machines, one makes it and the others go on to the next.
    Claims lie beside the log, hidden from its readers. A log in a database has no such folder: there
    the next id is taken as it is.
    """
    number = next_run_id(log, key, value, cycle_id)
    if isinstance(sink, dict):
        return number
    folder = join_path(sink, f"{CLAIMS}/{key}={value}/CYCLE_ID={cycle_id}")
    files = Files(spark, folder)
    while not files.create(join_path(folder, str(number))):
        number += 1
    return number
