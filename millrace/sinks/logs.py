"""Appending to the logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.model import AUDIT, Dataset, Run, join_path
from millrace.sinks.publish import publish
from millrace.sources.local import local_frame

# The folders of the violations log; a run owns its folder.
RUN_FOLDERS = ("DATASET_ID", "CYCLE_ID", "RUN_ID")


def append(df: DataFrame, sink: str | dict, partition_by: Sequence[str] = ()) -> None:
    """Append to a Parquet folder or to a JDBC table."""
    if isinstance(sink, dict):
        df.write.format("jdbc").mode("append").options(**sink).save()
    else:
        df.write.mode("append").partitionBy(*partition_by).parquet(sink)


def write_violations(log: DataFrame, sink: str | dict, run: Run) -> None:
    """Store one run's violations.

    In a folder they replace what an earlier, failed attempt at the same run left.
    """
    if isinstance(sink, dict):
        append(log, sink)
        return
    ids = (run.dataset_id, run.cycle_id, run.run_id)
    folder = "/".join(f"{name}={value}" for name, value in zip(RUN_FOLDERS, ids))
    log.drop(*RUN_FOLDERS).write.mode("overwrite").parquet(join_path(sink, folder))


def put_aside(records: DataFrame, base: str, run: Run) -> int:
    """Store the malformed records of one run in a folder of its own, as text, and count them. A second
    try replaces the first."""
    ids = (run.dataset_id, run.cycle_id, run.run_id)
    folder = join_path(base, "/".join(f"{n}={v}" for n, v in zip(RUN_FOLDERS, ids)))
    written = Observation()
    records.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(folder)
    return written.get["n"]


def compact(spark: SparkSession, log: str, cycle_id: str, files: int = 1) -> None:
    """Rewrite the audit rows or summaries of a closed cycle, a file or more for each run, into few.

    The new files are written and counted before the old ones go, as every target is (`publish`);
    rows stay as they are, repeats too. A cycle that is still written to must not be compacted.
    """
    folder = join_path(log, f"CYCLE_ID={cycle_id}")
    publish(spark.read.parquet(folder), folder, partitions=files)


def audit(
    spark: SparkSession,
    sink: str | dict,
    run: Run,
    dataset: Dataset,
    process: str,
    status: str,
    count: int = 0,
    message: str = "",
) -> None:
    """Append one row to the audit log."""
    loaded = run.load_date and run.load_date.astimezone()
    row = (run.cycle_id, run.run_id, loaded, run.job_id, run.job_name,
           dataset.dataset_id, dataset.dataset_type.upper(), dataset.dataset_name,
           process, status, count, message)
    append(local_frame(spark, [row], AUDIT), sink, ("CYCLE_ID",))
