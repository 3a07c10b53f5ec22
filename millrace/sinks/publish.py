"""Target folders and their dated archive copies."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from millrace import fixed
from millrace.model import join_path, overlaps
from millrace.settings import Files
from millrace.sinks.versions import current, make_current, new_version

REBALANCE = "rebalance"


def archive_path(archive: str, now: datetime) -> str:
    return join_path(archive, f"{now:{fixed.ARCHIVE_DAY}}/{now:{fixed.ARCHIVE_TIME}}")


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def publish(
    df: DataFrame,
    target: str,
    archive: str | None = None,
    partitions: int | str | None = None,
    now: datetime | None = None,
    versioned: bool = False,
    keep: int = 1,
) -> int:
    """Replace the folder `target` by the frame, copy it to the archive, return the row count.

    The new rows are written and counted before the old ones go, so a write that dies leaves these
    as they were, and the frame may be made of them. A plain target is then renamed into place, which
    leaves a moment without it; a `versioned` one has none (`sinks.versions`), and its last `keep`
    versions stay for readers that still use them.

    The frame is computed once: the copy is made from the written files, and the rows are
    counted while they are written. Files follow the frame's partitions, which are input splits
    or what adaptive execution made of a shuffle, so no shuffle is added for them; give a number
    of files or `rebalance` where that does not suit.
    """
    if archive and overlaps(archive, target):
        raise ValueError(f"replacing {target} would take the archive {archive} along")
    if partitions == REBALANCE:
        df = df.hint(REBALANCE)
    elif partitions is not None:
        df = df.repartition(partitions)
    # Observed after any shuffle, in the tasks that write: each is counted once, retries or not.
    spark, written = df.sparkSession, Observation()
    observed = df.observe(written, F.count(F.lit(1)).alias("n"))
    if versioned:
        place = new_version(target, now)
        _write(observed, place)
        make_current(spark, target, place, written.get["n"], keep)
    else:
        _replace(observed, target)
    if archive:
        stored = spark.read.schema(df.schema).parquet(current(spark, target))
        _write(stored, archive_path(archive, now or datetime.now()))
    return written.get["n"]


def _replace(df: DataFrame, target: str) -> None:
    files = Files(df.sparkSession, target)
    folder, name = target.rstrip("/").rsplit("/", 1)
    mark = uuid.uuid4().hex
    new, old = (f"{folder}/._{name}-{kind}-{mark}" for kind in ("new", "old"))
    try:
        _write(df, new)
        if files.exists(target):
            files.move(target, old)
        try:
            files.move(new, target)
        except Exception:
            if files.exists(old):
                files.move(old, target)
            raise
    finally:
        files.delete(new)
        if files.exists(target):
            files.delete(old)
