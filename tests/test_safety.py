"""Replacing targets without a gap, claimed run ids, quarantine, rule plans, levels, odd names."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from millrace import (
    Rule, Run, check, claim_run_id, compact, dependency_levels, flag, left_join, publish,
    read_current, split_malformed, with_row_id)
from millrace.model import AUDIT
from millrace.sinks import versions
from millrace.sinks.logs import put_aside
from millrace.sources import control
from millrace.sources.local import local_frame
from tests.conftest import plan_of


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def failing(spark):
    return spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))


@pytest.mark.parametrize("versioned", [False, True])
def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path, versioned):
    target = str(tmp_path / "t")
    publish(spark.range(3), target, versioned=versioned)
    with pytest.raises(Exception, match="lost"):
        publish(failing(spark), target, versioned=versioned)
    assert ids(read_current(spark, target)) == [0, 1, 2]
    assert publish(read_current(spark, target).union(spark.range(7, 8)), target, versioned=versioned) == 4
    assert ids(read_current(spark, target)) == [0, 1, 2, 7]
    assert versioned or [p.name for p in tmp_path.iterdir()] == ["t"]


def test_readers_see_the_old_or_the_new_rows(spark, tmp_path):
    """While versions are swapped, every read is of one of them, whole."""
    target, stop = str(tmp_path / "t"), time.time() + 8
    publish(spark.range(10), target, versioned=True, keep=50)

    def read(_):
        seen = set()
        while time.time() < stop:
            seen.add(tuple(ids(read_current(spark, target))))
        return seen

    def write(_):
        for i in range(1, 9):
            publish(spark.range(i * 10, i * 10 + 10), target, versioned=True, keep=50)
        return set()
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(f, 0) for f in (read, read, write)]
        seen = set().union(*(j.result() for j in jobs))
    assert all(s == tuple(range(s[0], s[0] + 10)) and s[0] % 10 == 0 for s in seen) and len(seen) > 1


def test_old_versions_go_and_unfinished_ones_after_a_day(spark, tmp_path):
    target = str(tmp_path / "t")
    folder = tmp_path / "t" / versions.VERSIONS
    for name, age in (("young", 0), ("dead", 3 * 86400)):
        (folder / name).mkdir(parents=True)
        os.utime(folder / name, (time.time() - age,) * 2)
    for i in range(5):
        publish(spark.range(i), target, versioned=True, keep=2)
    left = {p.name for p in folder.iterdir() if not p.name.startswith(".")}
    assert "young" in left and "dead" not in left and len(left) == 1 + 3
    assert ids(read_current(spark, target)) == [0, 1, 2, 3]


def test_a_version_that_is_short_of_rows_is_not_made_current(spark, tmp_path):
    target = str(tmp_path / "t")
    publish(spark.range(3), target, versioned=True)
    version = versions.new_version(target)
    spark.range(2).write.parquet(version)
    with pytest.raises(ValueError, match="holds 2 rows"):
        versions.make_current(spark, target, version, 3)
    assert ids(read_current(spark, target)) == [0, 1, 2]


def test_eight_threads_get_eight_run_ids(spark, tmp_path):
    log = local_frame(spark, [], AUDIT)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claim_run_id(
            spark, str(tmp_path / "log"), log, "DATASET_ID", 7, "20240101"), range(8)))
    assert sorted(got) == list(range(1, 9))
    assert claim_run_id(spark, str(tmp_path / "log"), log, "DATASET_ID", 8, "20240101") == 1


def test_malformed_records_go_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id|x\n1|a\n2\n3|c|more\n4|"d|e"\n\n')
    good, bad = split_malformed(spark, str(tmp_path / "a.csv"), "csv", "|")
    assert sorted(map(tuple, good.collect())) == [("1", "a"), ("4", "d|e")]
    assert sorted(r["RECORD"] for r in bad.collect()) == ["2", "3|c|more"]
    assert all(r["FILE"].endswith("a.csv") for r in bad.collect())
    run = Run("20240101", 1, 5)
    for _ in range(2):
        assert put_aside(bad, str(tmp_path / "q"), run) == 2
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2
    (tmp_path / "b.json").write_text('{"id":1,"_record":2}\n{"id":\n{"id":3}\n')
    good, bad = split_malformed(spark, str(tmp_path / "b.json"), "json", as_text=True)
    assert sorted(map(str, (tuple(r) for r in good.select("id", "_record").collect()))) == [
        "('1', '2')", "('3', None)"]
    assert [r["RECORD"] for r in bad.collect()] == ['{"id":']
    spark.range(3).write.parquet(str(tmp_path / "c"))
    good, bad = split_malformed(spark, str(tmp_path / "c"), "parquet")
    assert good.count() == 3 and bad.count() == 0


@pytest.mark.parametrize("text,why", [
    ("select ROW_ID from landingTable, other_rows", "reads"),
    ("select ROW_ID from landingTable where c in (select id from other_rows)", "reads"),
    ("select l.ROW_ID from other_rows landingTable join landingTable l on 1 = 1", None),
    ("select id as ROW_ID from other_rows landingTable", "reads"),
    ("select ROW_ID + 1 as ROW_ID from landingTable", "not the landing's"),
    ("select c as ROW_ID from landingTable", "not the landing's"),
    ("select ROW_ID from landingTable union all select c from landingTable", "not the landing's"),
    ("select c from landingTable", "one column"),
    ("select ROW_ID from (select * from landingTable) where c > 1", None),
    ("with a as (select ROW_ID r, c from landingTable) select min(r) as ROW_ID from a group by c", None),
    ("select a.ROW_ID from landingTable a join landingTable b on a.c = b.c + 1", None),
    ("select ROW_ID from landingTable where c = (select max(c) from landingTable)", None)])
def test_rule_queries_read_the_landing_only(spark, text, why):
    spark.range(3).createOrReplaceTempView("other_rows")
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "ROW_ID bigint, c bigint")
    rule = Rule(1, 4, "c", "CUSTOM", text, "low")
    try:
        if why or "other_rows" in text:
            with pytest.raises(ValueError, match=f"rule 4 .*{why or 'reads'}"):
                check(rows, [rule], Run("20240101", 1, 1))
        else:
            assert check(rows, [rule], Run("20240101", 1, 1)).count() > 0
    finally:
        spark.catalog.dropTempView("other_rows")


def test_levels(spark):
    needs = [(2, 1), (3, 2), (3, 1), (4, 3), (6, 5), (2, 1), (None, 1), (7, None)]
    got = {r["JOB_ID"]: r["LEVEL"] for r in dependency_levels(
        spark.createDataFrame(needs, "JOB_ID int, NEEDS int")).collect()}
    assert got == {1: 0, 5: 0, 2: 1, 6: 1, 3: 2, 4: 3}
    assert dependency_levels(spark.createDataFrame([], "JOB_ID int, NEEDS int")).count() == 0
    with pytest.raises(ValueError, match=r"\[8, 9\]"):
        dependency_levels(spark.createDataFrame([*needs, (8, 9), (9, 8)], "JOB_ID int, NEEDS int"))


def test_levels_send_no_table_to_the_driver(spark, monkeypatch):
    """A round's rows were broadcast, and a broadcast is collected on the driver first."""
    plans, keep = [], control._kept
    monkeypatch.setattr(control, "_kept", lambda df, *a: (plans.append(plan_of(df)), keep(df, *a))[1])
    needs = spark.range(2, 60).selectExpr("id as JOB_ID", "explode(array(id - 1, id div 2)) as NEEDS")
    levels = dependency_levels(needs.where("JOB_ID < 12 or NEEDS < 12"))
    assert {(r["JOB_ID"], r["LEVEL"]) for r in levels.where("JOB_ID < 12").collect()} == {
        (i, i - 1) for i in range(1, 12)}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(6):
        spark.createDataFrame([(f"2024010{i % 2}", i)] * 2, "CYCLE_ID string, RUN_ID int").write.mode(
            "append").partitionBy("CYCLE_ID").parquet(path)
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    compact(spark, path, "20240100")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
    assert len(list((tmp_path / "log" / "CYCLE_ID=20240100").glob("*.parquet"))) == 1
    assert len(list((tmp_path / "log" / "CYCLE_ID=20240101").glob("*.parquet"))) >= 3


@pytest.mark.parametrize("cell", [50, 10_000])
def test_joins_with_any_columns_and_equal_rows(spark, cell):
    """Map columns, names of helper columns, and a thousand equal rows, split or not."""
    left = spark.range(1000).selectExpr("1L as k", "map('a', 1) as m", "7 as _rows", "8 as _key",
                                        "9 as _place", "10 as _matched")
    left = left.union(spark.range(20).selectExpr("cast(null as bigint)", "map('b', 2)", "1", "2", "3", "4"))
    right = spark.range(3).selectExpr("1L as r", "array(map('x', id)) as n", "id as _columns", "0 as _copied")
    got = left_join(left, right, "k", "r", cell_rows=cell)
    assert got.columns == [*left.columns, *right.columns] and got.count() == 3020
    assert got.where("_rows = 7 and _key = 8 and _place = 9 and _matched = 10 and n[0]['x'] = _columns"
                     ).count() == 3000


def test_equal_rows_of_a_hot_key_lie_in_many_cells(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(100_000).selectExpr("1L as k", "'same' as t")
        got = left_join(left, spark.range(2).selectExpr("id as r"), "k", "r", cell_rows=1000)
        assert "_row_cell" in plan_of(got)
        parts = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 8 and max(r["count"] for r in parts) < 30_000
        assert sum(r["count"] for r in parts) == 100_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_numbering_and_flags_with_any_names(spark, tmp_path):
    names = ["_file", "_row", "_before", "_tie_file", "_tie_row", "_landing_part", "_broken_0", "_range"]
    df = spark.range(40).select((-F.col("id")).alias("k"), *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for order in (None, ["k"]):
        got = with_row_id(df, str(tmp_path / f"l{len(order or [])}"), order)
        assert got.columns == ["ROW_ID", *df.columns]
        rows = got.orderBy("ROW_ID").collect()
        assert [r["ROW_ID"] for r in rows] == list(range(1, 41))
        assert all(r[n] == i for r in rows for i, n in enumerate(names))
        assert not order or [r["k"] for r in rows] == list(range(-39, 1))
    flagged = flag(got, [Rule(1, 1, "k", "NULL"), Rule(1, 2, "k", "LENGTH", "> 1")])
    assert flagged.columns == ["QC_ID", "QC_DESC", "CRITICALITY_FLAG", *got.columns]
    assert flagged.where("_broken_0 = 6").count() == 40


def test_ids_over_many_ranges_of_files(spark, tmp_path, monkeypatch):
    from millrace.operators import numbering
    monkeypatch.setattr(numbering, "SPAN", 3)
    df = with_row_id(spark.range(1000).repartition(17), str(tmp_path / "l"))
    assert sorted(r[0] for r in df.select("ROW_ID").collect()) == list(range(1, 1001))
    assert "SinglePartition" not in plan_of(df)
