"""Facts and reports: one transformation of stored dependencies, published."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import fixed
from millrace.model import Bases, Logs, Run, overlaps
from millrace.operators.mapping import warehouse_ddl
from millrace.operators.runs import claim_run_id
from millrace.operators.sqlstep import run_sql
from millrace.plans.ingest import audited
from millrace.sinks.catalog import register
from millrace.sinks.publish import publish
from millrace.sinks.versions import current, read_current
from millrace.sinks.warehouse import publish_jdbc
from millrace.sources.control import Control
from millrace.sources.stored import load_dependencies, read_audit

Transform = str | Callable[[dict[str, DataFrame]], DataFrame]


def transform(spark: SparkSession, step: Transform, sources: dict[str, DataFrame]) -> DataFrame:
    """Run SQL text over the sources' names, or call a function with the sources."""
    return run_sql(spark, step, sources) if isinstance(step, str) else step(sources)


def build(
    spark: SparkSession,
    control: Control,
    job_id: int,
    step: Transform,
    bases: Bases,
    logs: Logs,
    process: str = fixed.FACT,
    job_name: str | None = None,
    database: str | None = None,
    warehouse: dict | None = None,
    partitions: int | str | None = None,
    now: datetime | None = None,
    versioned: bool = False,
) -> Run:
    """Build a job's target from its dependencies.

    A report is a build with `process='REPORTING'` and, for its warehouse table, JDBC options
    in `warehouse`; that table is loaded from the published files, not computed again.
    """
    now = now or datetime.now()
    cycle_id = f"{now:{fixed.CYCLE_FORMAT}}"
    target = control.target(job_id)
    audit_log = read_audit(spark, logs.audit, cycle_id)
    run_id = claim_run_id(spark, logs.audit, audit_log, "GLUE_JOB_ID", job_id, cycle_id)
    run = Run(cycle_id, run_id, target.dataset_id, job_id, job_name, now)
    with audited(spark, logs, run, target, process) as outcome:
        sources = control.sources_of(target, job_id)
        declared = control.declared_types(target.dataset_id) if warehouse else []
        warehouse_ddl(declared)  # an unknown type fails before anything is published
        path = bases.target(target)
        if any(overlaps(path, bases.target(s)) for s in sources):
            raise ValueError(f"{target.dataset_name} would overwrite one of its sources")
        result = transform(spark, step, load_dependencies(spark, sources, bases))
        outcome["count"] = publish(result, path, bases.archive(target), partitions, now,
                                   versioned)
        if database:
            register(spark, f"{database}.{target.target_table_name}", current(spark, path))
        if warehouse:
            publish_jdbc(read_current(spark, path), declared, warehouse)
    return run


def build_all(
    spark: SparkSession,
    control: Control,
    steps: Mapping[int, Transform],
    bases: Bases,
    logs: Logs,
    workers: int = 1,
    options: Mapping[int, dict] | None = None,
    now: datetime | None = None,
) -> list[Run]:
    """Build the targets of several jobs, each after the jobs whose targets it reads.

    Jobs of one level (`Control.levels`) do not read each other and run side by side, `workers` at a
    time. When one fails, the others of its level are still tried, later levels are not.
    """
    done: list[Run] = []
    jobs = control.levels().where(F.col("JOB_ID").isin(list(steps))).collect()
    missing = sorted(set(steps) - {r["JOB_ID"] for r in jobs})
    if missing:
        raise LookupError(f"jobs without dependencies or a target: {missing}")

    def one(job: int) -> Run | Exception:
        try:
            return build(spark, control, job, steps[job], bases, logs, now=now,
                         **(options or {}).get(job, {}))
        except Exception as e:
            return e

    for level in sorted({r["LEVEL"] for r in jobs}):
        mine = sorted(r["JOB_ID"] for r in jobs if r["LEVEL"] == level)
        with ThreadPoolExecutor(workers) as pool:
            ran = list(pool.map(inheritable_thread_target(spark)(one), mine))
        failed = [x for x in ran if isinstance(x, Exception)]
        done += [x for x in ran if not isinstance(x, Exception)]
        if failed:
            raise ExceptionGroup(f"{len(failed)} of {len(mine)} jobs of level {level}", failed)
    return done
