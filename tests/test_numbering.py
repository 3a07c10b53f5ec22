"""Row ids: exactly 1..N, the same on every read, and no global window in the plan."""

import pytest
from pyspark.sql import functions as F

from millrace import number_stored_rows, with_row_id
from tests.conftest import SF, plan_of


def ids(df):
    return [r["ROW_ID"] for r in df.select("ROW_ID").orderBy("ROW_ID").collect()]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_unordered_over_many_partitions(spark, orders, tmp_path):
    df = with_row_id(orders.repartition(7), str(tmp_path / "l"))
    assert ids(df) == list(range(1, orders.count() + 1))
    assert df.columns == ["ROW_ID", *orders.columns]
    assert "SinglePartition" not in plan_of(df) and "Exchange hash" not in plan_of(df)
    assert sorted(df.select("ROW_ID", "o_orderkey").collect()) == \
        sorted(df.select("ROW_ID", "o_orderkey").collect())


def test_same_ids_after_a_new_read(spark, orders, tmp_path):
    a = with_row_id(orders.repartition(5), str(tmp_path / "l"))
    first = sorted(a.select("ROW_ID", "o_orderkey").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert sorted(a.select("ROW_ID", "o_orderkey").collect()) == first
        assert sorted(a.repartition(3).select("ROW_ID", "o_orderkey").collect()) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_max_records_setting_does_not_split_the_files(spark, orders, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        assert ids(with_row_id(orders, str(tmp_path / "l"))) == list(range(1, orders.count() + 1))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_ordered(spark, orders, tmp_path, partitions):
    df = with_row_id(orders, str(tmp_path / "l"), ["o_custkey", F.desc("o_orderkey")], partitions)
    got = [(r["o_custkey"], -r["o_orderkey"]) for r in df.orderBy("ROW_ID").collect()]
    assert got == sorted(got)
    assert ids(df) == list(range(1, len(got) + 1))


def test_ordered_when_adaptive_execution_merges_ranges(spark, orders, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "60",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = with_row_id(orders, str(tmp_path / "l"), [F.desc("o_orderkey")])
        files = len(list((tmp_path / "l").glob("*.parquet")))
        assert 1 < files < 60
        got = [r["o_orderkey"] for r in df.orderBy("ROW_ID").collect()]
        assert got == sorted(got, reverse=True) and ids(df) == list(range(1, len(got) + 1))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ordered_ties_keep_the_stored_order_and_a_hot_key_is_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    (spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot")
                              .otherwise(F.col("id").cast("string")).alias("k"))
     .coalesce(1).write.parquet(path))
    df = with_row_id(spark.read.parquet(path), str(tmp_path / "l"), ["k"], 12)
    rows = df.orderBy("ROW_ID").collect()
    hot = [r["id"] for r in rows if r["k"] == "hot"]
    assert hot == sorted(hot) and len(hot) == 1000
    stored = spark.read.parquet(str(tmp_path / "l"))
    parts = stored.where("k = 'hot'").select("_landing_part").distinct().count()
    assert parts > 2, "one key's rows must span several tasks"


def test_ordered_frame_that_is_not_stored(spark, tmp_path):
    df = with_row_id(spark.range(100).withColumn("k", -F.col("id")), str(tmp_path / "l"), ["k"], 4)
    assert [r["id"] for r in df.orderBy("ROW_ID").collect()] == list(range(99, -1, -1))


def test_stored_rows_in_file_order(spark, orders, tmp_path):
    orders.repartition(6).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    df = number_stored_rows(stored.select("o_orderkey", F.upper("o_orderstatus").alias("s")))
    assert ids(df) == list(range(1, orders.count() + 1))
    placed = stored.select("o_orderkey", "_metadata.file_path", "_metadata.row_index").collect()
    placed.sort(key=lambda r: (r["file_path"], r["row_index"]))
    assert [r["o_orderkey"] for r in df.orderBy("ROW_ID").collect()] == \
        [r["o_orderkey"] for r in placed]


def test_stored_rows_refuse_a_filter(spark, orders):
    with pytest.raises(ValueError, match="whole stored files"):
        number_stored_rows(orders.where("o_orderkey % 2 = 0"))


def test_empty(spark, orders, tmp_path):
    none = orders.where("false")
    assert ids(with_row_id(none, str(tmp_path / "a"))) == []
    assert ids(with_row_id(none, str(tmp_path / "b"), ["o_orderkey"])) == []


def test_nulls_and_odd_names_survive(spark, tmp_path):
    df = spark.createDataFrame([(None, "x"), ("b", None)], "`a.b c` string, d string")
    got = with_row_id(df, str(tmp_path / "l"))
    assert got.columns == ["ROW_ID", "a.b c", "d"]
    assert sorted(map(str, (tuple(r)[1:] for r in got.collect()))) == ["('b', None)", "(None, 'x')"]


def test_thousands_of_files(spark, tmp_path):
    """Ids run through all files in the order of their paths, none of them on the driver."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    (tmp_path / "many").mkdir()
    for i in range(2000):
        pq.write_table(pa.table({"v": [10 * i + j for j in range(i % 3)]}, pa.schema([("v", pa.int64())])),
                       tmp_path / "many" / f"f{i:05d}.parquet")
    rows = number_stored_rows(spark.read.parquet(str(tmp_path / "many"))).collect()
    assert sorted((r["v"], r["ROW_ID"]) for r in rows) == [
        (v, n + 1) for n, v in enumerate(sorted(r["v"] for r in rows))]
