"""Targets whose rows are replaced without a gap.

A versioned target is a folder of versions and a file that names the current one:

    target/_CURRENT                    the name of a version
    target/_versions/<stamp>-<id>/     the rows as they were written

A new version is written beside the others and its rows are counted again before the pointer is
replaced, in one step. A write that dies half way leaves the pointer as it was; a reader that has
resolved the pointer goes on reading its version, which stays for the next `keep` replacements.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from millrace.model import join_path
from millrace.settings import Files

POINTER, VERSIONS = "_CURRENT", "_versions"
# Unfinished versions of writers that died are removed after a day.
STALE = 24 * 3600


def current(spark: SparkSession, target: str) -> str:
    """The folder that holds a target's rows now: the current version, or the target itself where
    it has no versions."""
    pointer = join_path(target, POINTER)
    files = Files(spark, target)
    if not files.exists(pointer):
        return target
    return join_path(target, f"{VERSIONS}/{files.read(pointer).strip()}")


def read_current(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(current(spark, target))


def new_version(target: str, now: datetime | None = None) -> str:
    """A folder for a version that no other writer has."""
    stamp = f"{now or datetime.now():%Y%m%dT%H%M%S%f}"
    return join_path(target, f"{VERSIONS}/{stamp}-{uuid.uuid4().hex}")


def make_current(spark: SparkSession, target: str, version: str, rows: int, keep: int = 1) -> None:
    """Point to a version after its rows have been counted, and remove what lies further back.

    Of two writers the later one wins; neither ever removes a version that is being written.
    """
    there = spark.read.parquet(version).count()
    if there != rows:
        raise ValueError(f"{version} holds {there} rows, {rows} were written")
    files = Files(spark, target)
    name = version.rstrip("/").rsplit("/", 1)[1]
    before = (files.read(join_path(target, POINTER)).strip()
              if files.exists(join_path(target, POINTER)) else None)
    fresh = join_path(target, f"{POINTER}-{uuid.uuid4().hex}")
    files.create(fresh, name)
    files.replace(fresh, join_path(target, POINTER))
    _tidy(files, target, {name, before}, keep)


def _tidy(files: Files, target: str, used: set, keep: int) -> None:
    folder = join_path(target, VERSIONS)
    finished, dead = [], []
    for name, changed in files.folders(folder):
        if files.exists(join_path(folder, f"{name}/_SUCCESS")):
            finished.append((changed, name))
        elif changed < (time.time() - STALE) * 1000:
            dead.append(name)
    older = [n for _, n in sorted(finished, reverse=True) if n not in used]
    for name in [*older[max(keep - 1, 0):], *dead]:
        files.delete(join_path(folder, name))
