"""Sinks, and whole jobs over files in a folder, run twice."""

import glob
import os
import shutil
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import _ingested
from millrace import (
    Bases, Logs, Rule, Run, append, build, check, ingest, latest_file, list_files, publish, read_audit,
    read_raw, read_violations, register, write_violations)
from millrace import fixed
from millrace.model import SUMMARY, VIOLATIONS, Dataset
from millrace.plans.ingest import land
from millrace.plans.marts import fact_from, report_address_from, report_affiliation_from
from millrace.sinks.publish import archive_path
from millrace.sources.stored import read_table
from tests.conftest import SF
from tests.test_sources import make_control

NOW = datetime(2024, 3, 5, 14, 30, 15)


def lines(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


# --- sinks -------------------------------------------------------------------------------


def test_publish_counts_replaces_and_archives(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    target, archive = str(tmp_path / "t"), str(tmp_path / "a")
    assert publish(orders, target, archive, now=NOW) == orders.count()
    copy = archive_path(archive, NOW)
    assert copy == f"{archive}/2024-03-05/20240305T143015"
    assert lines(spark.read.parquet(copy)) == lines(orders)
    assert publish(orders.limit(3), target) == 3
    assert spark.read.parquet(target).count() == 3
    assert spark.read.parquet(copy).count() == orders.count()
    assert publish(orders.where("false"), target) == 0
    assert spark.read.parquet(target).columns == orders.columns


@pytest.mark.parametrize("partitions,files", [(None, 1), (3, 3), ("rebalance", 1)])
def test_publish_file_numbers(spark, tmp_path, partitions, files):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert publish(orders, str(tmp_path / "t"), partitions=partitions) == orders.count()
    assert len(list((tmp_path / "t").glob("*.snappy.parquet"))) == files


def test_publish_refuses_an_archive_within_the_target(spark, tmp_path):
    for target, archive in [("t", "t/old"), ("t/new", "t"), ("t", "t")]:
        with pytest.raises(ValueError, match="archive"):
            publish(spark.range(1), str(tmp_path / target), str(tmp_path / archive))
    publish(spark.range(1), str(tmp_path / "t"), str(tmp_path / "told"))


def test_build_refuses_to_overwrite_a_source(spark, tmp_path):
    def row(i, name, job, folder):
        return (i, name, "processed", job, "Y", "N", None, None, None, None, None, folder, None, name)

    control = make_control(spark, [row(1, "A", 1, "x/a/"), row(2, "B", 2, "x/")], [(2, 1, "Y")])
    bases = Bases(*[str(tmp_path)] * 3)
    logs = Logs(*[str(tmp_path / n) for n in ("d", "s", "log")])
    publish(spark.range(5), str(tmp_path / "x" / "a"))
    with pytest.raises(ValueError, match="overwrite"):
        build(spark, control, 2, "select * from A", bases, logs, now=NOW)
    assert spark.read.parquet(str(tmp_path / "x" / "a")).count() == 5
    assert read_audit(spark, logs.audit).first()["PROCESS_STATUS"] == "FAILED"


def test_publish_leaves_sibling_folders_alone(spark, tmp_path):
    publish(spark.range(2), str(tmp_path / "ab"))
    publish(spark.range(3), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "ab")).count() == 2


def test_register_follows_a_changed_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(2), path)
    register(spark, "millrace_test_table", path)
    publish(spark.range(3).selectExpr("id", "'x' as x"), path)
    register(spark, "millrace_test_table", path)
    assert spark.table("millrace_test_table").columns == ["id", "x"]
    assert spark.table("millrace_test_table").count() == 3
    spark.sql("drop table millrace_test_table")
    assert spark.read.parquet(path).count() == 3, "dropping the table keeps the files"


def test_violation_log(spark, tmp_path):
    path, rules = str(tmp_path / "log"), [Rule(1, 1, "c", "NULL")]
    rows = spark.createDataFrame([(1, None), (2, "x")], "ROW_ID bigint, c string")
    run, other = Run("20240101", 1, 1), Run("20240101", 1, 2)
    assert read_violations(spark, path, 1, "20240101", 1).count() == 0
    write_violations(check(rows, rules, run), path, run)
    write_violations(check(rows, rules, other), path, other)
    write_violations(check(rows.where("false"), rules, run), path, run)
    assert read_violations(spark, path, 1, "20240101", 1).count() == 0
    got = read_violations(spark, path, 2, "20240101", 1)
    assert got.schema == VIOLATIONS and got.count() == 1
    assert all("DATASET_ID=2" in f for f in got.inputFiles())
    assert read_table(spark, path, VIOLATIONS).count() == 1
    append(check(rows, rules, other), path, ("DATASET_ID", "CYCLE_ID", "RUN_ID"))
    assert read_violations(spark, path, 2, "20240101", 1).count() == 1


# --- whole jobs --------------------------------------------------------------------------

HCP = "1,Ann,,Lee,N1\n2,Bo,M,Ray,N2\n3,Cy,null,Fox,\n3,Cy,null,Fox,\n"
AFFIL = "AID|PERSON|PERSON_NPI|ORG\na|1|N1|H1\nb|1|N1|H2\nc|9|N9|H9\n"
ADDR = ('{"VID":"v1","NPI":"N1","A":{"L1":"1 St","L2":null},"CITY":"Rome","STATE":"NY","ZIP":1}\n'
        '{"VID":"v2","NPI":"N1","A":{"L1":"2 St","L2":"B"},"CITY":"Rome","STATE":"XX","ZIP":2}\n')


@pytest.fixture
def world(spark, tmp_path):
    for folder, name, text in [
            ("hcp", "hcp_20240304.csv", "0,old,,file,N0\n"), ("hcp", "hcp_20240305.csv", HCP),
            ("affil", "AFFIL_20240305093000.csv", AFFIL), ("addr", "addr_20240305.json", ADDR)]:
        path = tmp_path / "raw" / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def row(i, name, kind, job, pattern=None, fmt=None, sep=None, header=None, folder="x"):
        return (i, name, kind, job, "Y", "N", pattern, fmt, sep, header, f"{folder}/",
                f"{name}/", f"archive/{name}/", name.lower())

    control = make_control(
        spark,
        [row(1, "STG_MDM_HCP", "raw", 10, "hcp_YYYYMMDD", "csv", ",", "N", "hcp"),
         row(2, "STG_MDM_AFFIL", "raw", 10, "affil_YYYYMMDDHHMMSS", "csv", "|", "Y", "affil"),
         row(3, "STG_VEEVA_ADDR", "raw", 10, "addr_YYYYMMDD", "json", None, "N", "addr"),
         row(4, "F_CUSTOMER", "processed", 20), row(5, "RPT_1", "processed", 30),
         row(6, "RPT_2", "processed", 31)],
        [(20, 1, "Y"), (20, 2, "Y"), (20, 3, "Y"), (30, 4, "Y"), (31, 4, "Y")],
        [(1, n, f"col{n}", name, "VARCHAR(9)") for n, name in enumerate(
            ["ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "NPI"])]
        + [(2, n, src, name, "VARCHAR(9)") for n, (src, name) in enumerate(
            [("AID", "ID"), ("PERSON", "HCP_ID"), ("PERSON_NPI", "HCP_NPI"), ("ORG", "HCO_ID")])]
        + [(3, n, src, name, "VARCHAR(9)") for n, (src, name) in enumerate(
            [("VID", "VID"), ("NPI", "NPI"), ("A.L1", "ADDR_LINE_1"), ("A.L2", "ADDR_LINE_2"),
             ("CITY", "CITY"), ("STATE", "STATE"), ("ZIP", "ZIP")])],
        [(1, 1, "NPI", "NULL", None, "CRITICAL", "Y"), (1, 2, "MIDDLE_NAME", "NULL", None, "low", "Y"),
         (1, 3, "FIRST_NAME", "LENGTH", "<= 3", "low", "Y"),
         (1, 4, "ID", "CUSTOM", "select ROW_ID from landingTable where ID in (select ID from "
          "landingTable group by ID having count(*) > 1)", "low", "Y"),
         (1, 5, "ID", "NULL", None, "low", "N"), (3, 6, "STATE", "DOMAIN", "NY, CA", "low", "Y")])
    base = str(tmp_path)
    bases = Bases(f"{base}/raw", f"{base}/curated", f"{base}/processed")
    logs = Logs(f"{base}/log/dqm", f"{base}/log/summary", f"{base}/log/audit")
    return control, bases, logs, tmp_path


def run_all(spark, control, bases, logs, workers=1):
    runs = ingest(spark, control, 10, bases, logs, workers=workers, now=NOW, job_name="in")
    runs.append(build(spark, control, 20, fact_from, bases, logs, now=NOW))
    runs.append(build(spark, control, 30, report_address_from, bases, logs, fixed.REPORTING,
                      now=NOW))
    runs.append(build(spark, control, 31, report_affiliation_from, bases, logs, fixed.REPORTING,
                      now=NOW))
    return runs


@pytest.mark.parametrize("workers", [1, 3])
def test_raw_to_report_twice(spark, world, workers):
    control, bases, logs, tmp = world
    assert {r.run_id for r in run_all(spark, control, bases, logs, workers)} == {1}
    hcp = spark.read.parquet(bases.curated + "/STG_MDM_HCP")
    assert hcp.columns == ["QC_ID", "QC_DESC", "CRITICALITY_FLAG", "ROW_ID", "ID", "FIRST_NAME",
                           "MIDDLE_NAME", "LAST_NAME", "NPI"]
    assert sorted(r["ROW_ID"] for r in hcp.collect()) == [1, 2, 3, 4]
    flags = [(r["ID"], r["QC_ID"], r["CRITICALITY_FLAG"]) for r in hcp.orderBy("ID").collect()]
    assert flags == [("1", "[2]", "N"), ("2", None, "N"), ("3", "[1, 2, 4]", "Y"),
                     ("3", "[1, 2, 4]", "Y")]
    fact = spark.read.parquet(bases.processed + "/F_CUSTOMER")
    assert fact.count() == 4 + 1 + 1
    reports = [spark.read.parquet(f"{bases.processed}/RPT_{i}") for i in (1, 2)]
    assert [r.count() for r in reports] == [4, 4]
    first = lines(fact)

    runs = run_all(spark, control, bases, logs, workers)
    assert {r.run_id for r in runs} == {2}
    assert lines(spark.read.parquet(bases.processed + "/F_CUSTOMER")) == first
    audit = read_audit(spark, logs.audit)
    assert audit.count() == 12
    got = {(r["DATASET_NAME"], r["RUN_ID"]): (r["RECORD_COUNT"], r["PROCESS_NAME"])
           for r in audit.collect()}
    assert got["STG_MDM_HCP", 1] == got["STG_MDM_HCP", 2] == (4, "INGESTION")
    assert got["F_CUSTOMER", 2] == (6, "FACT") and got["RPT_1", 2] == (4, "REPORTING")
    assert {r["PROCESS_STATUS"] for r in audit.collect()} == {"SUCCESS"}
    assert audit.where("LOAD_DATE is null").count() == 0

    summary = read_table(spark, logs.summary, SUMMARY).where("RUN_ID = 2")
    assert sorted((r["DATASET_ID"], r["QC_ID"], r["ERROR_COUNT"], r["QC_RESULT"])
                  for r in summary.collect()) == [
        (1, 1, 2, "FAIL"), (1, 2, 3, "FAIL"), (1, 3, 0, "PASS"), (1, 4, 2, "FAIL"),
        (3, 6, 1, "FAIL")]
    for i, n in ((1, 7), (3, 1)):
        assert read_violations(spark, logs.violations, i, "20240305", 2).count() == n
    archived = tmp / "curated" / "archive" / "STG_MDM_HCP" / "2024-03-05" / "20240305T143015"
    assert lines(spark.read.parquet(str(archived))) == lines(
        spark.read.parquet(bases.curated + "/STG_MDM_HCP"))


@pytest.mark.parametrize("workers", [1, 3])
def test_a_failed_run_is_logged_and_its_id_is_not_used_again(spark, world, workers):
    control, bases, logs, tmp = world
    bad = tmp / "raw" / "affil" / "AFFIL_20240305100000.csv"
    bad.write_text("AID|OTHER\na|1\n")
    with pytest.raises(ExceptionGroup, match="1 of 3") as failed:
        ingest(spark, control, 10, bases, logs, workers=workers, now=NOW)
    assert "PERSON" in str(failed.value.exceptions[0])
    status = {r["DATASET_NAME"]: (r["PROCESS_STATUS"], r["RUN_ID"])
              for r in read_audit(spark, logs.audit).collect()}
    assert status == {"STG_MDM_HCP": ("SUCCESS", 1), "STG_MDM_AFFIL": ("FAILED", 1),
                      "STG_VEEVA_ADDR": ("SUCCESS", 1)}
    (tmp / "raw" / "affil" / "AFFIL_20240305110000.csv").write_text(AFFIL)
    assert [r.run_id for r in ingest(spark, control, 10, bases, logs, now=NOW)] == [2, 2, 2]


def test_the_whole_error_is_logged(spark, world):
    control, bases, logs, _ = world

    def fail(sources):
        raise ValueError("x" * 5000)
    ingest(spark, control, 10, bases, logs, now=NOW)
    with pytest.raises(ValueError):
        build(spark, control, 20, fail, bases, logs, now=NOW)
    row = read_audit(spark, logs.audit).where("PROCESS_STATUS = 'FAILED'").first()
    assert row["PROCESS_MESSAGE"] == "x" * 5000


def test_a_job_without_its_sources_is_logged(spark, world):
    control, bases, logs, _ = world
    lost = replace(control, all_dependencies=control.all_dependencies.where("JOB_ID <> 20"))
    with pytest.raises(LookupError):
        build(spark, lost, 20, fact_from, bases, logs, now=NOW)
    assert read_audit(spark, logs.audit).where("PROCESS_STATUS = 'FAILED'").count() == 1


def test_no_file_is_a_named_error(spark, world):
    control, bases, logs, tmp = world
    empty = Bases(str(tmp / "raw2"), bases.curated, bases.processed)
    (tmp / "raw2" / "hcp").mkdir(parents=True)
    with pytest.raises(ExceptionGroup) as failed:
        ingest(spark, control, 10, empty, logs, now=NOW)
    first = failed.value.exceptions[0]
    assert isinstance(first, FileNotFoundError) and "hcp_YYYYMMDD" in str(first)
    assert {r["PROCESS_STATUS"] for r in read_audit(spark, logs.audit).collect()} == {"FAILED"}


def test_raw_parquet_is_numbered_in_place(spark, world, tmp_path):
    control, bases, logs, tmp = world
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.coalesce(1).write.parquet(str(tmp / "one"))
    file = next((tmp / "one").glob("*.parquet"))
    (tmp / "raw" / "orders").mkdir()
    (tmp / "raw" / "orders" / "orders_20240305.parquet").write_bytes(file.read_bytes())
    rows = [(7, "ORDERS", "raw", 40, "Y", "Y", "orders_YYYYMMDD", "parquet", None, None,
             "orders/", "ORDERS/", None, "orders")]
    rules = [(7, 1, "o_orderkey", "LENGTH", "<3", "low", "Y")]
    ingest(spark, make_control(spark, rows, rules=rules), 40, bases, logs, now=NOW)
    staged = spark.read.parquet(bases.curated + "/ORDERS")
    assert staged.columns[3:] == ["ROW_ID", *orders.columns]
    n = orders.count()
    assert staged.agg(F.min("ROW_ID"), F.max("ROW_ID"), F.countDistinct("ROW_ID")).first() == (1, n, n)
    assert staged.where("QC_ID is not null").count() == n - 100
    assert not (tmp / "curated" / "archive").exists()


@pytest.mark.parametrize("all_fields", [True, False])
def test_a_file_in_parts_is_one_file_in_their_order(spark, tmp_path, all_fields):
    """A folder named like a file: later parts are larger, so Spark reads them first."""
    named = f"{tmp_path}/in_20240201.csv"
    for i, (first, last) in enumerate([(0, 20), (20, 600), (600, 5000)]):
        rows = spark.range(first, last, numPartitions=1).selectExpr("id as n", "repeat('x', 40) as t")
        rows.write.option("header", True).csv(f"{tmp_path}/one-{i}")
        part, = glob.glob(f"{tmp_path}/one-{i}/part-*.csv")
        os.makedirs(named, exist_ok=True)
        shutil.copy(part, f"{named}/part-{i}.csv")
    spark.range(3).selectExpr("id as n").write.csv(f"{tmp_path}/in_20240101.csv")
    newest = latest_file(list_files(spark, str(tmp_path)), "in_YYYYMMDD", "csv").collect()
    assert [r["path"].split("/")[-1] for r in newest] == ["in_20240201.csv"]
    raw = read_raw(spark, newest[0]["path"], "csv")
    landed = land(spark, Dataset(1, "IN", "raw", 1, file_format="csv"), raw,
                  None if all_fields else [("n", "n")])
    assert landed.columns == ["ROW_ID", "n", "t"][:3 if all_fields else 2]
    assert landed.where("ROW_ID <> cast(n as bigint) + 1").count() == 0 and landed.count() == 5000


def test_ingest_queries_write_their_files_in_many_tasks(spark, tmp_path):
    """All orders and all events went through one task each."""
    spark.read.parquet(f"{SF}/orders.parquet").repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bases, _ = _ingested(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for name in ("orders/orders_20240101.csv", "events/events_20240101.parquet"):
        assert len(glob.glob(f"{bases.raw}/{name}/part-*")) > 1


def test_sql_text_and_catalog(spark, world):
    control, bases, logs, _ = world
    spark.sql("create database if not exists millrace_test")
    ingest(spark, control, 10, bases, logs, now=NOW, database="millrace_test")
    assert spark.table("millrace_test.stg_mdm_affil").count() == 3
    text = "select h.ID, a.HCO_ID from STG_MDM_HCP h join STG_MDM_AFFIL a on h.NPI = a.HCP_NPI"
    build(spark, control, 20, text, bases, logs, now=NOW, database="millrace_test", partitions=2)
    assert lines(spark.table("millrace_test.f_customer")) == ["('1', 'H1')", "('1', 'H2')"]
    spark.sql("drop database millrace_test cascade")
