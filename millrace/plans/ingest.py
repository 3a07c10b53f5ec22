"""Ingestion: newest raw file to flagged staging table."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import fixed
from millrace.functions.text import spare
from millrace.model import SUMMARY, Bases, Dataset, Logs, Rule, Run
from millrace.operators.mapping import apply_mapping
from millrace.operators.numbering import has_row_index, number_stored_rows, with_row_id
from millrace.operators.quality import check, custom_hits, flag, summarize
from millrace.operators.runs import claim_run_id
from millrace.settings import remove, scratch
from millrace.sinks.catalog import register
from millrace.sinks.logs import append, audit, put_aside, write_violations
from millrace.sinks.publish import publish
from millrace.sinks.versions import current
from millrace.sources.control import Control
from millrace.sources.files import latest_file, list_files
from millrace.sources.raw import has_header, read_raw, split_malformed
from millrace.sources.stored import read_audit, read_run

log = logging.getLogger(__name__)


@contextmanager
def audited(spark: SparkSession, logs: Logs, run: Run, dataset: Dataset, process: str):
    """Append the audit row of one run: SUCCESS with the count set on the outcome, or FAILED."""
    outcome: dict = {"count": 0, "message": ""}
    try:
        yield outcome
    except Exception as e:
        audit(spark, logs.audit, run, dataset, process, fixed.FAILED, 0, str(e))
        raise
    audit(spark, logs.audit, run, dataset, process, fixed.SUCCESS, outcome["count"],
          outcome["message"])
    log.info("%s: %s rows", dataset.dataset_name, outcome["count"])


def land(
    spark: SparkSession,
    dataset: Dataset,
    raw: DataFrame,
    columns: list[tuple[str, str]] | None,
    work: str | None = None,
) -> DataFrame:
    """Mapped and numbered rows, with the same ids whenever they are read.

    Parquet rows are numbered where they lie. Other formats are parsed once, into a table under
    the folder `work`; rules, flags and log read that. A file in parts is numbered part by part, in
    the order of their names: Spark reads the larger ones first.
    """
    mapped = apply_mapping(raw, columns)
    if (dataset.file_format or "").lower() == "parquet":
        return number_stored_rows(mapped)
    path = f"{work or scratch(spark, 'work')}/landing"
    if has_row_index(raw) or len(raw.inputFiles()) < 2:
        return with_row_id(mapped, path)
    part, start = spare(mapped.columns, "_part", "_start")
    placed = mapped.withColumns({
        part: F.col("_metadata.file_path"), start: F.col("_metadata.file_block_start")})
    return with_row_id(placed, path, [part, start]).drop(part, start)


def stage(
    landing: DataFrame,
    rules: Iterable[Rule],
    run: Run,
    logs: Logs,
    target: str,
    archive: str | None = None,
    partitions: int | str | None = None,
    strict: bool = True,
    work: str | None = None,
    versioned: bool = False,
) -> int:
    """Log the violations, publish the flagged rows, log the summary; returns the row count."""
    spark = landing.sparkSession
    rules = list(rules)
    hits = None
    if any(r.kind == "CUSTOM" for r in rules):
        path = f"{work or scratch(spark, 'work')}/hits"
        custom_hits(landing, rules).write.mode("overwrite").parquet(path)
        hits = spark.read.parquet(path)
    found = check(landing, rules, run, strict, hits, compact=True)
    write_violations(found, logs.violations, run)
    count = publish(flag(landing, rules, strict, hits), target, archive, partitions,
                    run.load_date, versioned)
    if not isinstance(logs.violations, dict):
        # The run's own folder holds each finding once; counting it spares a pass over the rows.
        found = read_run(spark, logs.violations, run.dataset_id, run.cycle_id, run.run_id)
    summary = summarize(found, rules, run).select(*SUMMARY.names)
    append(summary.coalesce(1), logs.summary, ("CYCLE_ID",))
    return count


def ingest_dataset(
    spark: SparkSession,
    control: Control,
    dataset: Dataset,
    bases: Bases,
    logs: Logs,
    job_name: str | None = None,
    database: str | None = None,
    partitions: int | str | None = None,
    strict: bool = True,
    read_options: dict | None = None,
    now: datetime | None = None,
    versioned: bool = False,
    quarantine: str | None = None,
) -> Run:
    """Ingest the newest file of one dataset.

    Its target keeps versions if it is to be `versioned`. With a base folder for `quarantine`, records
    that do not fit the file's columns are put there (`sources.raw.split_malformed`) and their
    number stands in the audit row's message; without one they are read as well as they can be.
    """
    now = now or datetime.now()
    cycle_id = f"{now:{fixed.CYCLE_FORMAT}}"
    run_id = claim_run_id(spark, logs.audit, read_audit(spark, logs.audit, cycle_id), "DATASET_ID",
                          dataset.dataset_id, cycle_id)
    run = Run(cycle_id, run_id, dataset.dataset_id, dataset.job_id, job_name, now)
    with audited(spark, logs, run, dataset, fixed.INGESTION) as outcome:
        folder, fmt = bases.source(dataset), dataset.file_format
        newest = latest_file(
            list_files(spark, folder), dataset.file_name_pattern, fmt).first()
        if newest is None:
            raise FileNotFoundError(
                f"no file like {dataset.file_name_pattern}.{fmt} with a date under {folder}")
        log.info("%s: %s", dataset.dataset_name, newest["path"])
        columns = (None if dataset.select_all_fields == fixed.YES
                   else control.layout(dataset.dataset_id))
        reading = (newest["path"], fmt, dataset.file_delimiter, has_header(dataset.header_flag),
                   columns is not None)
        target, work = bases.target(dataset), scratch(spark, f"ingest-{cycle_id}-{run_id}")
        try:
            if quarantine is None:
                raw = read_raw(spark, *reading, **(read_options or {}))
            else:
                raw, bad = split_malformed(spark, *reading, work=work, **(read_options or {}))
                put = put_aside(bad, quarantine, run)
                outcome["message"] = f"{put} malformed records" if put else ""
            outcome["count"] = stage(
                land(spark, dataset, raw, columns, work), control.rule_list(dataset.dataset_id),
                run, logs, target, bases.archive(dataset), partitions, strict, work, versioned)
        finally:
            remove(spark, work)
        if database:
            register(spark, f"{database}.{dataset.target_table_name}", current(spark, target))
    return run


def ingest(
    spark: SparkSession,
    control: Control,
    job_id: int,
    bases: Bases,
    logs: Logs,
    workers: int = 1,
    **options,
) -> list[Run]:
    """Ingest every active raw dataset of a job; `options` as for `ingest_dataset`.

    `workers` datasets run side by side in the one session. All are tried, whatever happens to the
    others; the failures are raised together at the end.
    """
    datasets = control.raw_datasets(job_id)
    log.info("job %s: %s datasets", job_id, len(datasets))

    def one(dataset: Dataset) -> Run | Exception:
        try:
            return ingest_dataset(spark, control, dataset, bases, logs, **options)
        except Exception as e:
            log.exception("%s failed", dataset.dataset_name)
            return e

    with ThreadPoolExecutor(workers) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one), datasets))
    failed = [x for x in done if isinstance(x, Exception)]
    if failed:
        raise ExceptionGroup(f"job {job_id}: {len(failed)} of {len(datasets)} datasets", failed)
    return done
