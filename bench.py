"""Times the queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once for the clock, into a sink that keeps nothing. Under
"plain_forms" stand the obvious forms of the two central operators for comparison: one query
per rule, joined back, and ids from a global window.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, Window, functions as F

from checks.compare import session
from checks.queries import PLAIN_RULES, QUERIES, RUN, dirty, landing, table
from millrace.functions.rules import violation
from millrace.operators.numbering import number_stored_rows, with_row_id
from millrace.operators.quality import check, flag, flag_from_log

HEADLINE = [
    "row_id_orders", "row_id_hot_key", "row_id_unordered", "row_id_stored", "map_orders",
    "select_all_lineitem", "read_raw_csv", "read_raw_json", "latest_file", "dqm_null",
    "dqm_length_le", "dqm_domain", "dqm_custom", "dqm_log", "dqm_rollup", "staging_orders",
    "staging_orders_ranged", "staging_orders_custom", "staging_from_log", "dqm_summary", "dqm_summary_with_pass",
    "next_run_id", "dependency_resolve", "job_target", "column_layout", "heavy_left_join",
    "heavy_right_join", "fact_customer_rows", "fact_customer_by_sql", "report_address_rows",
    "report_affiliation_rows", "publish_roundtrip", "publish_rebalanced", "archive_copy",
    "catalog_table", "log_append", "load_audit", "stage_orders", "build_fact", "build_report",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def clock(run) -> float:
    run()
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def log_by_rule(rows: DataFrame) -> DataFrame:
    """The log with a query per rule."""
    parts = [check(rows.where(violation(r)), [r], RUN) for r in PLAIN_RULES]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log.distinct()


def forms(spark, sf: str) -> dict[str, float]:
    """Plain forms next to ours, on the same stored rows."""
    rows = landing(spark, sf)
    items = table(spark, sf, "lineitem")
    constant = Window.orderBy(F.lit(1))
    return {
        "log_query_per_rule": clock(lambda: drain(log_by_rule(rows))),
        "log_single_pass": clock(lambda: drain(check(rows, PLAIN_RULES, RUN))),
        "flags_by_join": clock(lambda: drain(flag_from_log(rows, log_by_rule(rows)))),
        "flags_single_pass": clock(lambda: drain(flag(rows, PLAIN_RULES))),
        "row_id_global_window": clock(
            lambda: drain(items.select(F.row_number().over(constant).alias("ROW_ID"), "*"))),
        "row_id_stored_position": clock(lambda: drain(number_stored_rows(items))),
        "row_id_stored_first": clock(lambda: drain(with_row_id(items))),
        "row_id_ordered_window": clock(lambda: drain(dirty(spark, sf).select(
            F.row_number().over(Window.orderBy("o_orderkey")).alias("ROW_ID"), "*"))),
        "row_id_ordered_ranges": clock(
            lambda: drain(with_row_id(dirty(spark, sf), order_by=["o_orderkey"]))),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in HEADLINE:
        times[name] = clock(lambda: drain(QUERIES[name](spark, sf)))
        print(name, times[name], file=sys.stderr, flush=True)
    compared = forms(spark, sf)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf.rsplit("sf", 1)[-1], "plain_forms": compared}))


if __name__ == "__main__":
    main()
