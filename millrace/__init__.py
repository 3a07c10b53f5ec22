"""Control-table-driven batch ETL and data-quality checks on Spark DataFrames."""

from millrace.model import Bases, Dataset, Logs, Rule, Run
from millrace.operators.joins import joined_counts, key_counts, left_join
from millrace.operators.mapping import apply_mapping, warehouse_columns
from millrace.operators.numbering import number_stored_rows, with_row_id
from millrace.operators.quality import (
    check, custom_hits, flag, flag_from_log, rollup, summarize)
from millrace.operators.runs import claim_run_id, next_run_id, next_run_ids
from millrace.operators.sqlstep import run_sql
from millrace.plans.build import build, build_all
from millrace.plans.ingest import ingest
from millrace.plans.marts import fact_customer, report_address, report_affiliation
from millrace.sinks.catalog import register
from millrace.sinks.logs import append, audit, compact, write_violations
from millrace.sinks.publish import publish
from millrace.sinks.versions import read_current
from millrace.sinks.warehouse import publish_jdbc
from millrace.sources.control import Control, dependency_levels, load_control
from millrace.sources.files import latest_file, latest_files, list_files
from millrace.sources.raw import read_raw, split_malformed
from millrace.sources.stored import load_dependencies, read_audit, read_violations

__all__ = [
    "Bases", "Control", "Dataset", "Logs", "Rule", "Run", "append", "apply_mapping", "audit",
    "build", "build_all", "check", "claim_run_id", "compact", "custom_hits", "dependency_levels",
    "fact_customer", "flag", "flag_from_log", "ingest", "joined_counts", "key_counts",
    "latest_file", "latest_files", "left_join", "list_files", "load_control",
    "load_dependencies", "next_run_id", "next_run_ids", "number_stored_rows", "publish",
    "publish_jdbc", "read_audit", "read_current", "read_raw", "read_violations", "register",
    "report_address", "report_affiliation", "rollup", "run_sql", "split_malformed", "summarize",
    "warehouse_columns", "with_row_id", "write_violations",
]
