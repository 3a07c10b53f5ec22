"""One query per operator, over whole tables. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import fixed
from millrace.functions.filenames import base_name, name_regex
from millrace.functions.text import full_name, one_line_address
from millrace.model import (
    COLUMNS, DATASETS, DEPENDENCIES, RULES, SUMMARY, VIOLATIONS, Bases, Dataset, Logs,
    Rule, Run)
from millrace.operators.joins import left_join
from millrace.operators.mapping import apply_mapping, warehouse_columns
from millrace.operators.numbering import number_stored_rows, with_row_id
from millrace.operators.quality import (
    check, flag, flag_from_log, rollup, summarize)
from millrace.operators.runs import claim_run_id, next_run_ids
from millrace.operators.sqlstep import run_sql
from millrace.plans.build import build, build_all
from millrace.plans.ingest import ingest, stage
from millrace.plans.marts import (
    fact_customer, fact_from, report_address, report_address_from, report_affiliation,
    report_affiliation_from)
from millrace.settings import scratch
from millrace.sinks.catalog import register
from millrace.sinks.logs import RUN_FOLDERS, append, audit, compact, write_violations
from millrace.sinks.publish import archive_path, publish
from millrace.sinks.versions import read_current
from millrace.sources.control import (
    Control, dependency_levels as levels_of, job_targets, layouts, resolve_dependencies)
from millrace.sources.files import latest_files, list_files
from millrace.sources.raw import read_raw, split_malformed
from millrace.sources.stored import (
    load_dependencies, read_audit, read_table, read_violations)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = datetime(2024, 1, 1, 12, 0, 0)
RUN = Run("20240101", 1, 1, 10, "orders", NOW)

NULL_RULE = Rule(1, 1, "PRIO", "NULL", None, "CRITICAL")
DOMAIN_RULE = Rule(1, 10, "PRIO", "domain", "1-URGENT, 2-HIGH,3-medium", "low")
STATUS_RULE = Rule(1, 3, "o_orderstatus", "DOMAIN", "F,O", "critical")
LENGTHS = {
    "le": Rule(1, 2, "PRIO", "LENGTH", "<= 8", "NON-CRITICAL"),
    "ge": Rule(1, 5, "PRIO", "LENGTH", " >=9", "NON-CRITICAL"),
    "eq": Rule(1, 6, "PRIO", "LENGTH", "=8", "NON-CRITICAL"),
    "lt": Rule(1, 7, "PRIO", "LENGTH", "<9", "NON-CRITICAL"),
    "gt": Rule(1, 8, "PRIO", "LENGTH", "> 6", "NON-CRITICAL"),
}
CUSTOM_RULE = Rule(
    1, 4, "o_custkey", "CUSTOM",
    "select ROW_ID from landingTable where o_custkey in "
    "(select o_custkey from landingTable group by o_custkey having count(*) > 14)", "CRITICAL")
CLEAN_RULE = Rule(1, 9, "o_orderkey", "LENGTH", "> 0", "low")
PLAIN_RULES = [NULL_RULE, LENGTHS["le"], DOMAIN_RULE, STATUS_RULE]
ALL_RULES = [*PLAIN_RULES, CUSTOM_RULE, CLEAN_RULE]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with faults put into a column."""
    last = F.col("o_orderkey") % 10
    prio = (F.when(last == 0, None).when(last == 1, "").when(last == 2, " null ")
            .when(last == 3, " 1-urgent").otherwise(F.col("o_orderpriority")))
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", prio.alias("PRIO"), "o_totalprice", "o_orderdate")


def landing(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered where they lie: the file holds the orders in key order."""
    return number_stored_rows(dirty(spark, sf))


# --- numbering, mapping ------------------------------------------------------------------


@query
def row_id_orders(spark, sf):
    return with_row_id(table(spark, sf, "orders"), order_by=["o_orderkey"])


@query
def row_id_hot_key(spark, sf):
    """Order key with a third of all rows on one value; a second key makes ids comparable."""
    hot = F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.col("o_orderpriority"))
    keyed = table(spark, sf, "orders").select(hot.alias("k"), "o_orderkey")
    return with_row_id(keyed, order_by=["k", "o_orderkey"])


def _id_facts(numbered: DataFrame) -> DataFrame:
    return numbered.agg(
        F.count(F.lit(1)).alias("n"), F.min("ROW_ID").alias("first"), F.max("ROW_ID").alias("last"),
        F.sum("ROW_ID").cast("bigint").alias("total"),
        F.countDistinct("ROW_ID").alias("ids"))


@query
def row_id_unordered(spark, sf):
    return _id_facts(with_row_id(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")))


@query
def row_id_stored(spark, sf):
    return _id_facts(number_stored_rows(table(spark, sf, "lineitem").select("l_orderkey")))


@query
def map_orders(spark, sf):
    return apply_mapping(table(spark, sf, "orders"), [
        ("o_orderstatus", "STATUS"), ("o_orderkey", "ORDER_ID"), ("o_custkey", "CUSTOMER_ID")])


@query
def select_all_lineitem(spark, sf):
    return apply_mapping(table(spark, sf, "lineitem"), None)


# --- raw files ---------------------------------------------------------------------------


def _raw_events(spark, sf) -> DataFrame:
    """All columns of events, with the time as text so that its spelling is one."""
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "props", F.col("ts").cast("string").alias("ts"), "value")


def _write_raw(df: DataFrame, fmt: str, **options) -> str:
    path = scratch(df.sparkSession, "raw")
    df.write.format(fmt).options(**options).save(path)
    return path


EVENT_LAYOUT = [("event_type", "KIND"), ("event_id", "ID"), ("user_id", "USER"), ("props", "PROPS"),
                ("ts", "TS"), ("value", "VALUE")]


@query
def read_raw_csv(spark, sf):
    path = _write_raw(_raw_events(spark, sf), "csv", header=True, sep="|", escape='"')
    return apply_mapping(
        read_raw(spark, path, "csv", "|", header=True), EVENT_LAYOUT)


@query
def read_raw_unheadered(spark, sf):
    path = _write_raw(_raw_events(spark, sf), "csv", sep="\t", escape='"')
    raw = read_raw(spark, path, "CSV", "\t", header=False)
    return apply_mapping(raw, [("col2", "KIND"), ("_c0", "ID"), ("col1", "USER"), ("_c3", "PROPS"),
                               ("_c4", "TS"), ("col5", "VALUE")])


@query
def read_raw_json(spark, sf):
    nested = _raw_events(spark, sf).select(
        "event_id", F.struct("user_id", "event_type").alias("who"), "props", "ts", "value")
    raw = read_raw(spark, _write_raw(nested, "json"), "json")
    return apply_mapping(raw, [
        ("who.event_type", "KIND"), ("event_id", "ID"), ("who.user_id", "USER"),
        ("props", "PROPS"), ("ts", "TS"), ("value", "VALUE")])


@query
def read_raw_xml(spark, sf):
    """Nested elements, and values kept as the file spells them."""
    nested = _raw_events(spark, sf).select(
        "event_id", F.struct("user_id", "event_type").alias("who"), "props", "ts", "value",
        F.lit("00501").alias("zip"))
    raw = read_raw(spark, _write_raw(nested, "xml", rowTag="event"), "xml", as_text=True, rowTag="event")
    return apply_mapping(raw, [
        ("who.event_type", "KIND"), ("event_id", "ID"), ("who.user_id", "USER"),
        ("props", "PROPS"), ("ts", "TS"), ("value", "VALUE"), ("zip", "ZIP")])


@query
def read_raw_text(spark, sf):
    """Lines as they are."""
    rows = _raw_events(spark, sf)
    lines = rows.select(F.concat_ws("\t", *rows.columns).alias("value"))
    return apply_mapping(read_raw(spark, _write_raw(lines, "text"), "text"), [("value", "LINE")])


@query
def read_raw_quarantine(spark, sf):
    """Delimited records with a field too many or too few go aside, as they stand in the file."""
    rows = _raw_events(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in (
        "event_id", "user_id", "event_type", "ts", "value")])
    line = F.concat_ws("|", *rows.columns)
    key = F.col("event_id").cast("bigint") % 7
    lines = rows.select(F.when(key == 0, F.concat(line, F.lit("|more")))
                        .when(key == 1, F.concat_ws("|", "event_id", "user_id")).otherwise(line))
    schema = "event_id string, user_id string, event_type string, ts string, value string"
    path = _write_raw(lines.toDF("value"), "text")
    good, bad = split_malformed(spark, path, "csv", "|", header=False, schema=schema)
    whole = good.select(F.lit("landed").alias("PLACE"), line.alias("RECORD"))
    return whole.union(bad.select(F.lit("quarantine"), "RECORD"))


@query
def read_raw_orc(spark, sf):
    return apply_mapping(
        read_raw(spark, _write_raw(_raw_events(spark, sf), "orc"), "orc"), EVENT_LAYOUT)


@query
def read_raw_parquet(spark, sf):
    return apply_mapping(
        read_raw(spark, f"{sf}/events.parquet", "parquet"), EVENT_LAYOUT)


@query
def list_raw_files(spark, sf):
    """Paths, lengths and times of the files in a tree of folders, summed up by folder."""
    path = scratch(spark, "raw")
    rows = _raw_events(spark, sf)
    rows.select("event_type", F.concat_ws("|", *rows.columns).alias("line")).write.partitionBy(
        "event_type").text(path)
    folder = F.regexp_extract("path", "/event_type=([^/]+)/[^/]+$", 1)
    listed = list_files(spark, path).where(F.col("length") > 0)
    return listed.groupBy(folder.alias("event_type")).agg(
        F.sum("length").alias("bytes"), F.bool_and(F.contains("path", F.lit(path))).alias("in_folder"),
        F.bool_and(F.col("mtime") > F.lit("2020-01-01").cast("timestamp")).alias("dated"))


def _inventory(spark, sf, stamp_format) -> DataFrame:
    name = F.concat_ws("_", "event_type", F.date_format("ts", stamp_format))
    return table(spark, sf, "events").select(
        "event_type", F.concat(F.lit("in/"), name, F.lit(".csv")).alias("path"),
        F.col("ts").alias("mtime"))


@query
def latest_file(spark, sf):
    files = _inventory(spark, sf, "yyyyMMdd")
    fitting = files.where(
        base_name(F.col("path")).rlike(name_regex("[a-z]+_YYYYMMDD", "CSV")))
    return latest_files(fitting, ["event_type"])


@query
def latest_file_to_the_second(spark, sf):
    files = _inventory(spark, sf, "yyyyMMddHHmmss")
    fitting = files.where(
        base_name(F.col("path")).rlike(name_regex("(click|view)_YYYYMMDDHHMMSS", "csv")))
    return latest_files(fitting, ["event_type"])


# --- data quality ------------------------------------------------------------------------


@query
def dqm_null(spark, sf):
    return check(landing(spark, sf), [NULL_RULE], RUN)


@query
def dqm_length_le(spark, sf):
    return check(landing(spark, sf), [LENGTHS["le"]], RUN)


@query
def dqm_length_ge(spark, sf):
    return check(landing(spark, sf), [LENGTHS["ge"]], RUN)


@query
def dqm_length_eq(spark, sf):
    return check(landing(spark, sf), [LENGTHS["eq"]], RUN)


@query
def dqm_length_lt(spark, sf):
    return check(landing(spark, sf), [LENGTHS["lt"]], RUN)


@query
def dqm_length_gt(spark, sf):
    return check(landing(spark, sf), [LENGTHS["gt"]], RUN)


@query
def dqm_length_unreadable(spark, sf):
    return check(landing(spark, sf), [Rule(1, 11, "PRIO", "LENGTH", "8", "low")], RUN, strict=False)


@query
def dqm_domain(spark, sf):
    return check(landing(spark, sf), [DOMAIN_RULE], RUN)


@query
def dqm_numbers(spark, sf):
    """Rules on columns that are not text."""
    rules = [Rule(1, 12, "o_custkey", "LENGTH", ">2", "low"),
             Rule(1, 13, "o_orderkey", "DOMAIN", "1,2,3", "low")]
    return check(landing(spark, sf), rules, RUN)


@query
def dqm_custom(spark, sf):
    return check(landing(spark, sf), [CUSTOM_RULE], RUN)


@query
def dqm_custom_refused(spark, sf):
    """Rules whose queries read or return what they may not, with the reason; findings of the others."""
    table(spark, sf, "customer").createOrReplaceTempView("customers_of_others")
    rows, found = landing(spark, sf), []
    texts = [
        "select ROW_ID from landingTable l join customers_of_others c on l.o_custkey = c.c_custkey",
        f"select ROW_ID from landingTable where o_custkey in (select c_custkey from parquet.`{sf}/customer.parquet`)",
        "select o_orderkey as ROW_ID from landingTable",
        "select o_orderkey from landingTable",
        "with x as (select ROW_ID as r, PRIO from landingTable) select max(r) as ROW_ID from x group by PRIO",
        "select ROW_ID from landingTable where o_totalprice > 100000 union select ROW_ID from landingTable "
        "where o_custkey % 2 = 0"]
    for i, text in enumerate(texts):
        rule = Rule(1, i, "o_custkey", "CUSTOM", text, "low")
        try:
            hits = check(rows, [rule], RUN).select("ROW_ID", "QC_ID", F.lit("found").alias("OUTCOME"))
        except ValueError as e:
            reason = "reads" if "reads" in str(e) else "one column" if "one column" in str(e) else "not the landing's"
            hits = rows.select(F.max("ROW_ID").alias("ROW_ID"), F.lit(i).alias("QC_ID"),
                               F.lit(f"refused: {reason}").alias("OUTCOME"))
        found.append(hits)
    spark.catalog.dropTempView("customers_of_others")
    return reduce(DataFrame.union, found)


@query
def dqm_log(spark, sf):
    return check(landing(spark, sf), [*PLAIN_RULES, *LENGTHS.values()], RUN)


@query
def dqm_rollup(spark, sf):
    return rollup(check(landing(spark, sf), PLAIN_RULES, RUN))


@query
def staging_orders(spark, sf):
    return flag(landing(spark, sf), PLAIN_RULES)


@query
def staging_orders_ranged(spark, sf):
    """The same rows numbered through a range shuffle and a stored landing."""
    return flag(with_row_id(dirty(spark, sf), order_by=["o_orderkey"]), PLAIN_RULES)


@query
def staging_orders_custom(spark, sf):
    return flag(landing(spark, sf), ALL_RULES)


@query
def staging_from_log(spark, sf):
    rows = landing(spark, sf)
    return flag_from_log(rows, check(rows, ALL_RULES, RUN))


@query
def dqm_summary(spark, sf):
    return summarize(check(landing(spark, sf), ALL_RULES, RUN))


@query
def dqm_summary_with_pass(spark, sf):
    return summarize(check(landing(spark, sf), ALL_RULES, RUN), ALL_RULES, RUN)


# --- control rows ------------------------------------------------------------------------


@query
def next_run_id(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("user_id").alias("DATASET_ID"),
        F.date_format("ts", "yyyyMMdd").alias("CYCLE_ID"),
        F.get_json_object("props", "$.k").cast("int").alias("RUN_ID"))
    return next_run_ids(runs, "DATASET_ID")


def _datasets(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("DATASET_ID"), F.col("c_name").alias("DATASET_NAME"),
        F.when(F.col("c_nationkey") < 12, "raw").otherwise("processed").alias("DATASET_TYPE"),
        (F.col("c_custkey") % 211).alias("JOB_ID"),
        F.when(F.col("c_mktsegment") == "BUILDING", "N").otherwise("Y").alias("ACTIVE_FLAG"))


def _control(spark, sf) -> Control:
    columns = table(spark, sf, "part").select(
        F.col("p_size").alias("DATASET_ID"), F.col("p_partkey").alias("COLUMN_SEQUENCE_NUMBER"),
        F.col("p_name").alias("SOURCE_COLUMN_NAME"), F.col("p_type").alias("COLUMN_NAME"),
        F.col("p_brand").alias("COLUMN_DATA_TYPE"))
    rules = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 100).alias("DATASET_ID"), F.col("l_linenumber").alias("QC_ID"),
        F.col("l_partkey").alias("QC_PARAM"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("ACTIVE_FLAG"))
    dependencies = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 97).alias("JOB_ID"), F.col("o_custkey").alias("SOURCE_DATASET_ID"),
        F.when(F.col("o_orderstatus") == "F", "N").otherwise("Y").alias("ACTIVE_FLAG"))
    return Control(_datasets(spark, sf), columns, rules, dependencies)


@query
def job_datasets(spark, sf):
    return _control(spark, sf).datasets(7, fixed.RAW_TYPE)


@query
def dataset_rules(spark, sf):
    return _control(spark, sf).rules(42)


@query
def job_dependencies(spark, sf):
    return _control(spark, sf).dependencies(5)


@query
def dependency_resolve(spark, sf):
    control = _control(spark, sf)
    active = control.all_dependencies.where(F.col("ACTIVE_FLAG") == fixed.YES)
    return resolve_dependencies(active, control.all_datasets.drop("ACTIVE_FLAG"))


@query
def job_target(spark, sf):
    datasets = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("DATASET_ID"), F.col("o_custkey").alias("JOB_ID"))
    return job_targets(datasets)


@query
def column_layout(spark, sf):
    control = _control(spark, sf)
    return layouts(control.all_columns, control.all_datasets)


@query
def dependency_levels(spark, sf):
    """In which order jobs can run: a part needs those of a half, a third and a fifth of its number."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("JOB_ID")).where("JOB_ID > 0")
    needs = parts.select("JOB_ID", F.explode(F.array(F.lit(2), F.lit(3), F.lit(5))).alias("by")).where(
        F.col("JOB_ID") % F.col("by") == 0).select(
        "JOB_ID", (F.col("JOB_ID") / F.col("by")).cast("bigint").alias("NEEDS"))
    return levels_of(needs)


# --- joins, facts, reports ---------------------------------------------------------------


def people(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stand-ins for persons, affiliations and addresses, with NULL keys and repeated rows."""
    c, o, s = (table(spark, sf, n) for n in ("customer", "orders", "supplier"))
    key = F.col("c_custkey")
    hcp = c.select(
        key.cast("string").alias("ID"), F.col("c_name").alias("FIRST_NAME"),
        F.when(key % 3 == 0, None).when(key % 3 == 1, "").otherwise("M").alias("MIDDLE_NAME"),
        F.col("c_mktsegment").alias("LAST_NAME"),
        F.when(key % 7 != 0, key.cast("string")).alias("NPI"))
    hcp = hcp.unionByName(hcp.where(F.col("NPI").isNull()))
    affil = o.select(
        F.col("o_orderkey").cast("string").alias("ID"),
        F.col("o_custkey").cast("string").alias("HCP_ID"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey").cast("string")).alias("HCP_NPI"),
        F.col("o_orderpriority").alias("HCO_ID"))
    addr = s.select(
        F.col("s_suppkey").cast("string").alias("VID"),
        (F.col("s_nationkey") * 2 + 1).cast("string").alias("NPI"),
        F.col("s_name").alias("ADDR_LINE_1"),
        F.when(F.col("s_suppkey") % 2 == 0, "Suite").alias("ADDR_LINE_2"),
        F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("CITY"),
        F.when(F.col("s_suppkey") % 3 != 0, "ST").alias("STATE"),
        F.when(F.col("s_suppkey") % 4 == 0, "").otherwise("00501").alias("ZIP"))
    return hcp, affil, addr


@query
def heavy_left_join(spark, sf):
    """A third of the left rows on one key, a third on NULL."""
    o_key = F.col("o_orderkey")
    left = table(spark, sf, "orders").select(
        "o_orderkey", F.when(o_key % 3 == 0, F.lit(1).cast("bigint"))
        .when(o_key % 3 == 1, F.col("o_custkey")).alias("k"))
    right = table(spark, sf, "customer").select("c_custkey", "c_name")
    return left_join(left, right, "k", "c_custkey", cell_rows=500)


@query
def heavy_right_join(spark, sf):
    """A third of the right rows on one key."""
    left = table(spark, sf, "customer").select("c_custkey", "c_name")
    right = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint"))
        .otherwise(F.col("o_custkey") * 2).alias("k"))
    return left_join(left, right, "c_custkey", "k", cell_rows=500)


@query
def heavy_join_mixed_types(spark, sf):
    """A bigint key against a double and a decimal one, heavy on both sides."""
    key = F.col("o_orderkey")
    left = table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 2 == 0, 7).otherwise(F.col("o_custkey")).cast("bigint").alias("k"))
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 == 0, 7).otherwise(F.col("c_custkey")).alias("v"))
    doubles = customers.select(F.col("v").cast("double").alias("d"), F.col("c_custkey").alias("dk"))
    decimals = customers.where("c_custkey % 3 = 0").select(
        F.col("v").cast("decimal(12,2)").alias("e"), F.col("c_custkey").alias("ek"))
    # The counts and sums of the joined rows follow from those of each key, not from a row for each pair.
    joined = left_join(left, doubles, "k", "d", cell_rows=200, cell_pairs=5_000,
                       totals={"n_d": "count(1)", "dk": "sum(dk)"})
    joined = left_join(joined, decimals, "k", "e", cell_rows=2_000, cell_pairs=50_000,
                       totals={"n_e": "count(1)", "ek": "sum(ek)"})
    n_d, n_e = (F.coalesce(n, F.lit(1)) for n in ("n_d", "n_e"))
    return joined.groupBy("o_orderkey", "k").agg(
        F.sum(n_d * n_e).alias("n"), F.sum(F.col("dk") * n_e).alias("dk"),
        F.sum(F.col("ek") * n_d).alias("ek"))


@query
def heavy_join_light_pairs(spark, sf):
    """Keys light on each side whose pairs are many."""
    left = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 40).alias("k"))
    right = table(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_suppkey") % 40).alias("r"))
    return left_join(left, right, "k", "r", cell_pairs=50)


@query
def fact_heavy_keys(spark, sf):
    """The fact with heavy keys, NULL keys and repeated rows, each key split."""
    hcp, affil, addr = people(spark, sf)
    hot = F.when(F.col("ID").cast("bigint") % 4 == 0, "3").otherwise(F.col("NPI"))
    affil = affil.withColumn("HCP_NPI", F.when(
        F.col("ID").cast("bigint") % 9 == 0, "3").otherwise(F.col("HCP_NPI")))
    return fact_customer(hcp.withColumn("NPI", hot), affil, addr, cell_rows=4, cell_pairs=40)


@query
def fact_customer_rows(spark, sf):
    return fact_customer(*people(spark, sf))


@query
def fact_customer_by_sql(spark, sf):
    """A transformation given as SQL text over dataset names."""
    hcp, affil, addr = people(spark, sf)
    text = """
        with p as (select distinct * from STG_MDM_HCP)
        select distinct p.*, a.HCO_ID, d.CITY from p
        left join STG_MDM_AFFIL a on p.NPI = a.HCP_NPI
        left join STG_VEEVA_ADDR d on d.NPI = p.NPI"""
    return run_sql(
        spark, text, {"STG_MDM_HCP": hcp, "STG_MDM_AFFIL": affil, "STG_VEEVA_ADDR": addr})


@query
def report_names(spark, sf):
    """Name and address texts with NULL and empty parts."""
    hcp, _, _ = people(spark, sf)
    return hcp.select(
        "ID", full_name("FIRST_NAME", "MIDDLE_NAME", "LAST_NAME").alias("HCP_NAME"),
        one_line_address("MIDDLE_NAME", "NPI").alias("HCP_ADDR")).distinct()


@query
def report_address_rows(spark, sf):
    return report_address(fact_customer(*people(spark, sf)))


@query
def report_affiliation_rows(spark, sf):
    return report_affiliation(fact_customer(*people(spark, sf)))


# --- sinks -------------------------------------------------------------------------------


@query
def publish_roundtrip(spark, sf):
    path = scratch(spark, "target")
    publish(table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


@query
def publish_numbered_files(spark, sf):
    path = scratch(spark, "target")
    publish(table(spark, sf, "orders"), path, partitions=4)
    return spark.read.parquet(path)


@query
def publish_rebalanced(spark, sf):
    path = scratch(spark, "target")
    publish(table(spark, sf, "orders"), path, partitions="rebalance")
    return spark.read.parquet(path)


@query
def publish_swap(spark, sf):
    """A versioned target before, during and after a replacement, and after one that failed."""
    path, seen = scratch(spark, "target"), []
    orders = table(spark, sf, "orders")

    def look(when: str, rows: DataFrame) -> None:
        seen.append(rows.select(F.lit(when).alias("WHEN_READ"), "o_orderkey", "o_totalprice"))
    publish(orders.where("o_orderkey % 2 = 0"), path, versioned=True)
    before = read_current(spark, path)
    look("before", before)
    publish(orders, path, versioned=True)
    look("by the reader of before", before)
    look("after", read_current(spark, path))
    try:
        publish(orders.select("o_orderkey", F.raise_error(F.lit("lost")).alias("o_totalprice")), path,
                versioned=True)
    except Exception:
        look("after a failure", read_current(spark, path))
    return reduce(DataFrame.union, seen)


@query
def publish_over_itself(spark, sf):
    """A plain target made of its own rows, and kept by a write that fails."""
    path = scratch(spark, "target")
    publish(table(spark, sf, "orders"), path)
    publish(spark.read.parquet(path).withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    try:
        publish(table(spark, sf, "orders").withColumn("o_custkey", F.raise_error(F.lit("lost"))), path)
    except Exception:
        return spark.read.parquet(path)


@query
def archive_copy(spark, sf):
    path, archive = scratch(spark, "target"), scratch(spark, "archive")
    publish(table(spark, sf, "customer"), path, archive, now=NOW)
    return spark.read.parquet(archive_path(archive, NOW))


@query
def catalog_table(spark, sf):
    """Registered twice, with other columns the second time."""
    name, path = "millrace_catalog_check", scratch(spark, "target")
    customers = table(spark, sf, "customer")
    publish(customers.select("c_custkey"), path)
    register(spark, name, path)
    publish(customers.drop("c_acctbal"), path)
    register(spark, name, path)
    rows = spark.table(name).select("*")
    spark.sql(f"drop table {name}")  # its files stay; so do the rows that were resolved
    return rows


@query
def warehouse_layout(spark, sf):
    """The rows a warehouse load sends: declared columns, order and types."""
    return warehouse_columns(table(spark, sf, "orders"), [
        ("o_orderdate", "DATE"), ("o_orderkey", "VARCHAR(20)"), ("o_custkey", "INT8"),
        ("o_totalprice", "DOUBLE PRECISION"), ("o_orderpriority", "CHARACTER VARYING(15)")])


@query
def log_append(spark, sf):
    """The same findings appended twice, read back once."""
    path = scratch(spark, "log")
    found = check(landing(spark, sf), PLAIN_RULES, RUN)
    for _ in range(2):
        append(found, path, RUN_FOLDERS)
    return read_violations(spark, path, RUN.dataset_id, RUN.cycle_id, RUN.run_id)


@query
def log_replace(spark, sf):
    """A run that is tried again replaces its findings; another run's stay."""
    path = scratch(spark, "log")
    rows = landing(spark, sf)
    write_violations(check(rows, [NULL_RULE], RUN), path, RUN)
    other = Run(RUN.cycle_id, 2, RUN.dataset_id)
    write_violations(check(rows, [STATUS_RULE], other), path, other)
    write_violations(check(rows, [DOMAIN_RULE], RUN), path, RUN)
    return read_table(spark, path, VIOLATIONS)


@query
def claimed_run_ids(spark, sf):
    """Eight callers at once for each of five datasets: each gets an id of its own, after those used."""
    base = scratch(spark, "claims")
    used = table(spark, sf, "events").select(
        (F.col("user_id") % 5).cast("int").alias("DATASET_ID"), F.lit("20240101").alias("CYCLE_ID"),
        F.get_json_object("props", "$.k").cast("int").alias("RUN_ID"))
    kinds = [r[0] for r in used.select("DATASET_ID").distinct().collect()]
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda kind: (kind, claim_run_id(
            spark, base, used, "DATASET_ID", kind, "20240101")), [k for k in kinds for _ in range(8)]))
    return spark.createDataFrame(ids, "DATASET_ID int, RUN_ID int")


@query
def log_compacted(spark, sf):
    """Audit rows of two cycles, a file for each, before and after one cycle is compacted."""
    path = scratch(spark, "audit")
    rows = table(spark, sf, "supplier").select(
        F.when(F.col("s_nationkey") < 12, "20240101").otherwise("20240102").alias("CYCLE_ID"),
        F.col("s_suppkey").cast("int").alias("RUN_ID"), F.col("s_name").alias("PROCESS_MESSAGE"))
    for part in range(5):
        append(rows.where(F.col("RUN_ID") % 5 == part), path, ("CYCLE_ID",))
    files = list_files(spark, f"{path}/CYCLE_ID=20240101").where("length > 0")
    many = files.count()
    compact(spark, path, "20240101", 1)
    few = list_files(spark, f"{path}/CYCLE_ID=20240101").where("path like '%.parquet'").count()
    return read_audit(spark, path).select(
        "CYCLE_ID", "RUN_ID", "PROCESS_MESSAGE", F.lit(few == 1 and many >= few).alias("FEWER"))


@query
def load_audit(spark, sf):
    log = scratch(spark, "audit")
    for i, name in enumerate(("customer", "part", "orders", "lineitem", "events"), start=1):
        n = publish(table(spark, sf, name), scratch(spark, "target"))
        audit(spark, log, Run("20240101", 1, i, 10, "load", NOW), Dataset(i, name, "raw", 10),
              fixed.INGESTION, fixed.SUCCESS, n)
    return _dated(read_audit(spark, log))


def _dated(log: DataFrame) -> DataFrame:
    return log.withColumn("LOAD_DATE", F.date_format("LOAD_DATE", "yyyy-MM-dd HH:mm:ss"))


# --- whole jobs --------------------------------------------------------------------------


def _logs(spark) -> Logs:
    base = scratch(spark, "logs")
    return Logs(f"{base}/violations", f"{base}/summary", f"{base}/audit")


@query
def stage_orders(spark, sf):
    """Log, staging table, archive and summary in one go; the stored staging table."""
    target = scratch(spark, "staging")
    stage(landing(spark, sf), ALL_RULES, RUN, _logs(spark), target, scratch(spark, "archive"))
    return spark.read.parquet(target)


@query
def stage_orders_log(spark, sf):
    logs = _logs(spark)
    stage(landing(spark, sf), ALL_RULES, RUN, logs, scratch(spark, "staging"))
    return read_table(spark, logs.violations, VIOLATIONS)


@query
def stage_orders_summary(spark, sf):
    logs = _logs(spark)
    stage(landing(spark, sf), ALL_RULES, RUN, logs, scratch(spark, "staging"))
    return read_table(spark, logs.summary, SUMMARY)


def _jobs(spark, sf) -> tuple[Control, Bases, Logs]:
    """Stored dependencies and the control rows of a fact job (20) and a report job (30)."""
    base = scratch(spark, "layers")
    bases = Bases(f"{base}/raw", f"{base}/curated", f"{base}/processed")

    def row(i, name, kind, job):
        return (i, name, kind, job, "Y", "N", None, None, None, None, None,
                f"{name.lower()}/", f"archive/{name.lower()}/", name.lower())

    inputs = ("STG_MDM_HCP", "STG_MDM_AFFIL", "STG_VEEVA_ADDR")
    rows = [row(i, n, "raw", 10) for i, n in enumerate(inputs, start=1)]
    rows += [row(4, "F_CUSTOMER", "processed", 20), row(5, "RPT", "processed", 30)]
    needs = [(20, 1, "Y"), (20, 2, "Y"), (20, 3, "Y"), (20, 9, "N"), (30, 4, "Y")]
    control = Control(
        spark.createDataFrame(rows, DATASETS), spark.createDataFrame([], COLUMNS),
        spark.createDataFrame([], RULES), spark.createDataFrame(needs, DEPENDENCIES))
    for frame, name in zip(people(spark, sf), inputs):
        publish(frame, f"{bases.curated}/{name.lower()}")
    return control, bases, _logs(spark)


@query
def build_fact(spark, sf):
    control, bases, logs = _jobs(spark, sf)
    build(spark, control, 20, fact_from, bases, logs, now=NOW)
    return spark.read.parquet(bases.target(control.target(20)))


@query
def build_report(spark, sf):
    control, bases, logs = _jobs(spark, sf)
    build(spark, control, 20, fact_from, bases, logs, now=NOW)
    build(spark, control, 30, report_address_from, bases, logs, fixed.REPORTING, now=NOW)
    return spark.read.parquet(bases.target(control.target(30)))


@query
def build_audit(spark, sf):
    """Two builds of a fact and one of a report, as the audit log tells them."""
    control, bases, logs = _jobs(spark, sf)
    for _ in range(2):
        build(spark, control, 20, fact_from, bases, logs, job_name="fact", now=NOW)
    text = "select distinct ID, NPI from F_CUSTOMER"
    build(spark, control, 30, text, bases, logs, fixed.REPORTING, "report", now=NOW)
    return _dated(read_audit(spark, logs.audit))


FACT_SQL = """
    select distinct h.ID, h.FIRST_NAME, h.MIDDLE_NAME, h.LAST_NAME, h.NPI, a.HCO_ID, d.ADDR_LINE_1,
      d.ADDR_LINE_2, d.CITY, d.STATE, d.ZIP, cast(null as string) as PLACEHOLDER
    from (select distinct * from STG_MDM_HCP) h
    left join (select distinct * from STG_MDM_AFFIL) a on h.NPI = a.HCP_NPI
    left join (select distinct * from STG_VEEVA_ADDR) d on h.NPI = d.NPI"""


@query
def build_fact_by_sql(spark, sf):
    """The fact's job with its transformation as SQL text."""
    control, bases, logs = _jobs(spark, sf)
    build(spark, control, 20, FACT_SQL, bases, logs, now=NOW)
    return spark.read.parquet(bases.target(control.target(20)))


@query
def build_report_affiliation(spark, sf):
    """Fact and second report as jobs given in any order, each into a versioned target."""
    control, bases, logs = _jobs(spark, sf)
    versions = {"versioned": True}
    build_all(spark, control, {30: report_affiliation_from, 20: fact_from}, bases, logs, workers=2,
              options={20: versions, 30: {**versions, "process": fixed.REPORTING}}, now=NOW)
    return read_current(spark, bases.target(control.target(30)))


@query
def dependency_frames(spark, sf):
    """Rows per stored dependency of a job, under their dataset names."""
    control, bases, _ = _jobs(spark, sf)
    frames = load_dependencies(spark, control.sources(20), bases)
    text = " union all ".join(
        f"select '{name}' as DATASET_NAME, count(*) as n from {name}" for name in frames)
    return run_sql(spark, text, frames)


def _put(df: DataFrame, fmt: str, path: str, **options) -> None:
    """Write the frame as the one file `path`, through the file system Spark uses."""
    spark = df.sparkSession
    folder = scratch(spark, "one-file")
    df.coalesce(1).write.format(fmt).options(**options).save(folder)
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration())
    written = [s.getPath() for s in files.listStatus(jvm.org.apache.hadoop.fs.Path(folder))
               if s.getPath().getName().startswith("part-")]
    files.mkdirs(jvm.org.apache.hadoop.fs.Path(path).getParent())
    files.rename(written[0], jvm.org.apache.hadoop.fs.Path(path))


INGEST_RULES = [
    (1, 1, "PRIO", "NULL", None, "CRITICAL", "Y"), (1, 2, "PRIO", "LENGTH", "<= 8", "NON-CRITICAL", "Y"),
    (1, 3, "STATUS", "DOMAIN", "F,O", "critical", "Y"),
    (1, 4, "CUSTOMER_ID", "CUSTOM",
     "select ROW_ID from landingTable where CUSTOMER_ID in (select CUSTOMER_ID from landingTable "
     "group by CUSTOMER_ID having count(*) > 14)", "CRITICAL", "Y"),
    (1, 9, "ORDER_ID", "NULL", None, "low", "N"), (2, 1, "KIND", "DOMAIN", "click,view", "low", "Y")]


def _ingested(spark, sf, *jobs: int) -> tuple[Bases, Logs]:
    """Raw files of three datasets, in as many parts as Spark writes, older ones, of one part, beside
    them, and the given jobs run in order."""
    base = scratch(spark, "ingest")
    bases = Bases(f"{base}/raw", f"{base}/curated", f"{base}/processed")
    orders = dirty(spark, sf).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("string")).orderBy("o_orderkey")
    csv = {"header": True, "sep": "|", "escape": "\"", "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False}
    _put(orders.limit(3), "csv", f"{bases.raw}/orders/orders_20231231.csv", **csv)
    orders.write.options(**csv).csv(f"{bases.raw}/orders/orders_20240101.csv")
    events = table(spark, sf, "events").orderBy("event_id")
    events.write.parquet(f"{bases.raw}/events/events_20240101.parquet")
    _put(events.limit(2), "parquet", f"{bases.raw}/events/events_20230101.parquet")

    def row(i, name, job, fmt, folder):
        return (i, name, "raw", job, "Y", "N", f"{folder}_YYYYMMDD", fmt, "|", "Y", f"{folder}/",
                f"{name}/", f"archive/{name}/", name.lower())

    layout = [(1, 30, "PRIO", "PRIO"), (1, 4, "o_orderkey", "ORDER_ID"),
              (1, 20, "o_orderstatus", "STATUS"), (1, 5, "o_custkey", "CUSTOMER_ID"),
              (1, 6, "o_totalprice", "TOTAL"), (1, 31, "o_orderdate", "DAY"),
              (2, 2, "event_type", "KIND"), (2, 10, "event_id", "ID"), (2, 1, "user_id", "USER"),
              (2, 3, "props", "PROPS"), (2, 4, "ts", "TS"), (2, 5, "value", "VALUE"),
              (3, 1, "absent", "A")]
    control = Control(
        spark.createDataFrame([row(1, "STG_ORDERS", 10, "csv", "orders"),
                               row(2, "STG_EVENTS", 10, "parquet", "events"),
                               row(3, "STG_BAD", 11, "csv", "orders")], DATASETS),
        spark.createDataFrame([(*c, "VARCHAR(99)") for c in layout], COLUMNS),
        spark.createDataFrame(INGEST_RULES, RULES), spark.createDataFrame([], DEPENDENCIES))
    logs = _logs(spark)
    for job in jobs:
        try:
            ingest(spark, control, job, bases, logs, job_name="in", now=NOW)
        except ExceptionGroup:
            if job != 11:
                raise
    return bases, logs


@query
def ingest_orders(spark, sf):
    """The staging table of a whole ingestion from delimited files."""
    bases, _ = _ingested(spark, sf, 10)
    return spark.read.parquet(f"{bases.curated}/STG_ORDERS")


@query
def ingest_events(spark, sf):
    """The staging table of a whole ingestion from Parquet files."""
    bases, _ = _ingested(spark, sf, 10)
    return spark.read.parquet(f"{bases.curated}/STG_EVENTS")


@query
def ingest_log(spark, sf):
    _, logs = _ingested(spark, sf, 10)
    return read_table(spark, logs.violations, VIOLATIONS)


@query
def ingest_summary(spark, sf):
    _, logs = _ingested(spark, sf, 10)
    return read_table(spark, logs.summary, SUMMARY)


@query
def ingest_audit(spark, sf):
    """Two runs of a job and a failed one."""
    _, logs = _ingested(spark, sf, 10, 10, 11)
    return read_audit(spark, logs.audit).withColumn(
        "LOAD_DATE", F.date_format("LOAD_DATE", "yyyy-MM-dd HH:mm:ss"))


@query
def read_raw_json_text(spark, sf):
    """All columns of events as JSON spells them, and values that typing would change."""
    rows = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "props", "value",
        F.lit("00501").alias("zip"))
    path = scratch(spark, "raw")
    # Written as text, so that the number 1.10 stands in the file as it is.
    rows.select(F.concat(F.lit('{"n":1.10,'), F.substring(F.to_json(F.struct(*rows.columns)), 2, 1 << 30)
                         )).write.text(path)
    raw = read_raw(spark, path, "json", as_text=True)
    return apply_mapping(raw, [(c, c.upper()) for c in [*rows.columns, "n"]])
