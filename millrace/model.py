"""Table schemas and the small records the jobs pass around."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

from millrace import fixed


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
    "timestamp": T.TimestampType()}


def _schema(columns: str) -> T.StructType:
    named = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


# Columns of the control and log tables.
DATASETS = _schema(
    "DATASET_ID int, DATASET_NAME string, DATASET_TYPE string, JOB_ID int, ACTIVE_FLAG string, "
    "SELECT_ALL_FIELDS string, FILE_NAME_PATTERN string, FILE_FORMAT string, "
    "FILE_DELIMITER string, HEADER_FLAG string, SOURCE_LOCATION string, "
    "TARGET_LOCATION string, ARCHIVE_LOCATION string, TARGET_TABLE_NAME string")

COLUMNS = _schema(
    "DATASET_ID int, COLUMN_SEQUENCE_NUMBER int, SOURCE_COLUMN_NAME string, "
    "COLUMN_NAME string, COLUMN_DATA_TYPE string")

RULES = _schema(
    "DATASET_ID int, QC_ID int, COLUMN_NAME string, QC_TYPE string, QC_PARAM string, "
    "CRITICALITY string, ACTIVE_FLAG string")

DEPENDENCIES = _schema("JOB_ID int, SOURCE_DATASET_ID int, ACTIVE_FLAG string")

VIOLATIONS = _schema(
    "CYCLE_ID string, RUN_ID int, DATASET_ID int, ROW_ID bigint, QC_ID int, "
    "COLUMN_NAME string, QC_TYPE string, QC_PARAM string, QC_DESC string, CRITICALITY string")

SUMMARY = _schema(
    "CYCLE_ID string, RUN_ID int, DATASET_ID int, QC_ID int, COLUMN_NAME string, "
    "QC_TYPE string, QC_PARAM string, QC_DESC string, CRITICALITY string, "
    "ERROR_COUNT bigint, QC_RESULT string")

AUDIT = _schema(
    "CYCLE_ID string, RUN_ID int, LOAD_DATE timestamp, GLUE_JOB_ID int, GLUE_JOB_NAME string, "
    "DATASET_ID int, DATASET_TYPE string, DATASET_NAME string, PROCESS_NAME string, "
    "PROCESS_STATUS string, RECORD_COUNT bigint, PROCESS_MESSAGE string")


@dataclass(frozen=True)
class Dataset:
    """One row of the dataset control table; field names are the lower-cased column names."""

    dataset_id: int
    dataset_name: str
    dataset_type: str
    job_id: int
    active_flag: str | None = None
    select_all_fields: str | None = None
    file_name_pattern: str | None = None
    file_format: str | None = None
    file_delimiter: str | None = None
    header_flag: str | None = None
    source_location: str | None = None
    target_location: str | None = None
    archive_location: str | None = None
    target_table_name: str | None = None

    @property
    def is_raw(self) -> bool:
        return self.dataset_type.upper() == fixed.RAW_TYPE.upper()


@dataclass(frozen=True)
class Rule:
    """One data-quality rule."""

    dataset_id: int
    qc_id: int
    column_name: str
    qc_type: str
    qc_param: str | None = None
    criticality: str | None = None

    @property
    def kind(self) -> str:
        return self.qc_type.upper()

    @property
    def description(self) -> str:
        return fixed.DESCRIPTIONS[self.kind].format(
            column=self.column_name, param=self.qc_param)

    @property
    def is_critical(self) -> bool:
        return fixed.CRITICAL_PATTERN.strip("%") in (self.criticality or "")


@dataclass(frozen=True)
class Run:
    """Identity of one execution, as stamped on every log row."""

    cycle_id: str
    run_id: int
    dataset_id: int
    job_id: int | None = None
    job_name: str | None = None
    load_date: datetime | None = None


@dataclass(frozen=True)
class Bases:
    """Base folders of the three layers."""

    raw: str
    curated: str
    processed: str

    def source(self, dataset: Dataset) -> str:
        return join_path(self.raw, dataset.source_location)

    def layer(self, dataset: Dataset) -> str:
        return self.curated if dataset.is_raw else self.processed

    def target(self, dataset: Dataset) -> str:
        return join_path(self.layer(dataset), dataset.target_location)

    def archive(self, dataset: Dataset) -> str | None:
        if not dataset.archive_location:
            return None
        return join_path(self.layer(dataset), dataset.archive_location)


@dataclass(frozen=True)
class Logs:
    """Where the three logs live: each a folder of Parquet files or a dict of JDBC options."""

    violations: str | dict
    summary: str | dict
    audit: str | dict


def overlaps(path: str, other: str) -> bool:
    """Whether one folder is the other or lies within it."""
    a, b = path.rstrip("/") + "/", other.rstrip("/") + "/"
    return a.startswith(b) or b.startswith(a)


def join_path(base: str, location: str | None) -> str:
    """The exact folder `location` names under `base`; refuses to mean `base` itself."""
    parts = [p for p in (location or "").split("/") if p]
    if not parts:
        raise ValueError(f"empty location under {base}")
    return "/".join([base.rstrip("/"), *parts])
