"""Heavy-key joins against a plain join, and the fact's shape."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from checks.queries import QUERIES
from millrace import fact_customer, left_join, report_address, report_affiliation
from millrace.operators.joins import SPREAD, _grid
from tests.conftest import plan_of

KEYS = st.sampled_from([None, "a", "a", "a", "b", "b", "c", "d"])


def pairs(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(KEYS, max_size=25), right=st.lists(KEYS, max_size=25),
       cell=st.integers(1, 4), most=st.integers(1, 30))
def test_any_keys(spark, left, right, cell, most):
    a = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "i int, k string")
    b = spark.createDataFrame([(i, k) for i, k in enumerate(right)], "j int, r string")
    got = left_join(a, b, "k", "r", cell_rows=cell, cell_pairs=most)
    assert pairs(got) == pairs(a.join(b, a.k == b.r, "left"))


def test_heavy_on_both_sides_and_absent_on_the_right(spark):
    a = spark.range(300).selectExpr("id", "case when id % 3 = 0 then 1L when id % 3 = 1 then 2L "
                                          "when id % 2 = 0 then null else id end as k")
    b = spark.range(90).selectExpr("id as rid", "case when id % 3 = 0 then 1L else id end as r")
    for right in (b, b.where("r <> 2"), b.where("r > 1000")):
        got = left_join(a, right, "k", "r", cell_rows=10)
        assert pairs(got) == pairs(a.join(right, a.k == right.r, "left"))


@pytest.mark.parametrize("left,right", [
    ("bigint", "double"), ("double", "bigint"), ("bigint", "decimal(12,2)"), ("int", "bigint"),
    ("float", "double"), ("decimal(10,1)", "decimal(20,4)"), ("double", "double"),
    ("date", "timestamp"), ("string", "string")])
@pytest.mark.parametrize("cell", [10, 10_000])
def test_keys_of_any_pair_of_types(spark, left, right, cell):
    """Half the rows on one key: values compare as in a plain join, and no left row is lost."""
    make = "date_add(date'2024-01-01', cast({} as int))" if left == "date" else "{}"
    key = make.format("case when id % 2 = 0 then 0 else id end")
    a = spark.range(400).selectExpr("id", f"cast({key} as {left}) as k")
    b = spark.range(60).selectExpr("id as rid", f"cast({make.format('id % 20')} as {right}) as r")
    if right == "double":
        b = b.selectExpr("rid", "case when r = 0 then -r else r end as r")
    got = pairs(left_join(a, b, "k", "r", cell_rows=cell, cell_pairs=cell * 10))
    assert got == pairs(a.join(b, a.k == b.r, "left"))
    assert len({x.split(",")[0] for x in got}) == 400


def test_key_below_any_share_of_the_rows_is_split(spark):
    a = spark.range(100_000).selectExpr("id", "case when id < 1900 then 0 else id end as k")
    b = spark.range(10).selectExpr("id as r")
    rows = left_join(a, b, "k", "r", cell_rows=100)
    assert rows.count() == 100_000 and "_row_cell" in plan_of(rows)


def test_small_keys_are_not_split(spark):
    a = spark.range(100).selectExpr("id", "1L as k")
    assert "_row_cell" not in plan_of(left_join(a, spark.range(5).selectExpr("id as r"), "k", "r"))


@pytest.mark.parametrize("left,right", [
    (225_000, 1_500), (1_500, 225_000), (1_000_000, 1), (1, 1_000_000), (3_000, 2_400), (7, 9)])
@pytest.mark.parametrize("rows,pairs_", [(1_000_000, 50), (4, 40), (500, 10**9)])
def test_copies_stay_few_next_to_rows_and_pairs(spark, left, right, rows, pairs_):
    """Cells as small as asked for made thirty copies for each pair."""
    a = spark.createDataFrame([(1, left)], "key long, n long")
    b = spark.createDataFrame([(1, right)], "key long, n long")
    most = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for r in _grid(a, b, T.LongType(), rows, pairs_).collect():
        cells = r["rows"] * r["columns"]
        assert 1 < cells <= most + max(r["rows"], r["columns"])
        copies = left * r["columns"] + right * r["rows"]
        assert copies <= left + right + 2 * (most * left * right) ** 0.5
        if cells < most / 2:
            assert left <= rows * r["rows"] and right <= rows * r["columns"]
            assert left * right <= pairs_ * cells


@pytest.mark.parametrize("cell", [10, 10_000])
def test_totals_stand_for_the_joined_rows(spark, cell):
    """Of a key heavy on both sides, with NULL keys and two zeros, no pair is made."""
    a = spark.range(400).selectExpr("id", "case id % 4 when 0 then null when 1 then id else 0 end as k")
    b = spark.range(90).selectExpr("id as rid", "cast(case id % 3 when 0 then -0.0D when 1 then 0 "
                                   "when 2 then if(id % 2 = 0, null, id) end as double) as r")
    b = b.withColumn("w", F.when(F.col("rid") % 5 != 0, F.col("rid")))
    got = left_join(a, b, "k", "r", cell_rows=cell, totals={"n": "count(1)", "w": "sum(w)"})
    assert got.columns == ["id", "k", "r", "n", "w"] and got.count() == 400
    whole = a.join(b, a.k == b.r, "left").groupBy("id", "k").agg(
        F.count("rid").alias("n"), F.sum("w").alias("w"))
    assert pairs(got.select("id", "k", F.coalesce("n", F.lit(0)), "w")) == pairs(whole)


def test_mixed_types_make_no_row_for_each_pair(spark, tmp_path):
    """Ten thousand left rows meet a thousand and 334 on the right: 3.3 billion pairs."""
    spark.range(20_000).selectExpr("id as o_orderkey", "-1L as o_custkey").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(10_000).selectExpr("id as c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    got = QUERIES["heavy_join_mixed_types"](spark, str(tmp_path))
    keys = [7, *range(0, 10_000, 10)]
    thirds = [k for k in keys if k % 3 == 0]
    found = {tuple(r)[1:] for r in got.collect()}
    assert found == {(-1, 1, None, None), (
        7, len(keys) * len(thirds), sum(keys) * len(thirds), sum(thirds) * len(keys))}


def test_keys_without_a_common_type(spark):
    a = spark.range(3).selectExpr("id", "array(id) as k")
    with pytest.raises(TypeError, match="common type"):
        left_join(a, spark.range(3).selectExpr("id as r"), "k", "r")


def test_cells_stay_in_the_join_keys(spark):
    """A folded cell column would put a heavy key's rows back into one task."""
    b = spark.range(100).selectExpr("id as rid", "id as r")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("case when id % 2 = 0 then id end", "case when id % 2 = 0 then id else 1 end"):
            a = spark.range(100).selectExpr("id", f"{key} as k")
            plan = plan_of(left_join(a, b, "k", "r", cell_rows=10))
            lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line
                     and "_row" in line.split("ENSURE")[0]]
            assert len(lines) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def people(spark):
    hcp = spark.createDataFrame([
        ("1", "Ann", None, "Lee", "N1"), ("1", "Ann", None, "Lee", "N1"),
        ("2", "Bo", "", "Ray", "N2"), ("3", "Cy", "M", "Fox", None),
        ("4", "Di", "Q", None, "N9")], "ID string, FIRST_NAME string, MIDDLE_NAME string, "
                                       "LAST_NAME string, NPI string")
    affil = spark.createDataFrame([
        ("a", "1", "N1", "H1"), ("b", "1", "N1", "H2"), ("c", "1", "N1", "H2"),
        ("d", "2", "N2", None), ("e", "7", "N7", "H7"), ("f", "3", None, "H3")],
        "ID string, HCP_ID string, HCP_NPI string, HCO_ID string")
    addr = spark.createDataFrame([
        ("v1", "N1", "1 St", None, "Rome", "NY", "1"), ("v2", "N1", "2 St", "B", "Rome", "NY", ""),
        ("v3", "N2", None, None, None, None, None)],
        "VID string, NPI string, ADDR_LINE_1 string, ADDR_LINE_2 string, CITY string, "
        "STATE string, ZIP string")
    return hcp, affil, addr


def test_fact_fans_out_and_keeps_the_unmatched(people):
    fact = fact_customer(*people)
    assert fact.columns == [
        "ID", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "NPI", "HCO_ID", "ADDR_LINE_1",
        "ADDR_LINE_2", "CITY", "STATE", "ZIP", "PLACEHOLDER"]
    assert dict(fact.dtypes)["PLACEHOLDER"] == "string"
    rows = fact.collect()
    count = {i: sum(r["ID"] == i for r in rows) for i in "1234"}
    assert count == {"1": 4, "2": 1, "3": 1, "4": 1}
    assert fact.distinct().count() == len(rows)


@pytest.mark.parametrize("cells", [(1, 1), (2, 3), (1, 100)])
def test_fact_is_the_same_with_heavy_keys(people, cells):
    assert pairs(fact_customer(*people, *cells)) == pairs(fact_customer(*people))


def test_fact_shuffles_no_joined_rows_for_distinct(people):
    plan = plan_of(fact_customer(*people))
    top = plan[:plan.index("Join")]
    assert "HashAggregate" not in top and "Exchange" not in top


def test_reports(people):
    fact = fact_customer(*people)
    names = {r["HCP_ID"]: r for r in report_address(fact).collect()}
    assert names["2"]["HCP_NAME"] == "Bo  Ray" and names["2"]["HCP_ADDR"] == ""
    assert names["4"]["HCP_NAME"] == "Di Q" and names["3"]["HCP_NPI"] is None
    assert {r["HCP_ADDR"] for r in report_address(fact).where("HCP_ID = 1").collect()} == {
        "1 St,Rome,NY,1", "2 St,Rome,NY,"}
    got = report_affiliation(fact).where("HCP_ID = 1").collect()
    assert sorted(r["HCP_HCO_ID"] for r in got) == ["H1", "H2"]


def test_a_key_with_all_the_pairs_has_cells_enough_to_fill_tasks_evenly(spark):
    """Four hashed cells for each task left the fullest task with twice the rows of others; many keys
    need no more."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for keys, least, most in ((1, 48, 64), (40, 3, 5)):
        counts = spark.createDataFrame([(k, 100_000) for k in range(keys)], "key long, n long")
        got = _grid(counts, counts, T.LongType(), 4, 40).collect()
        assert len(got) == keys
        assert all(least * tasks <= r["rows"] * r["columns"] <= most * tasks for r in got)


def same_rows(got, want):
    both = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
            for df in (got, want)]
    return both[0] == both[1]


@pytest.mark.parametrize("cell_pairs", [100_000, 10**9])
def test_keys_of_several_blocks(spark, cell_pairs):
    """Keys with more rows on either side than a block holds, split or not, next to light ones."""
    a = spark.range(4_000).selectExpr("id", "case when id % 2 = 0 then 1 when id % 3 = 0 then null "
                                            "when id % 5 = 0 then 2 else id end as k")
    b = spark.range(3_000).selectExpr("id as rid", "if(id % 2 = 0, 1, if(id % 7 = 0, 2, id)) as r")
    got = left_join(a, b, "k", "r", cell_rows=1_200, cell_pairs=cell_pairs)
    assert "_row_cell" in plan_of(got) and same_rows(got, a.join(b, a.k == b.r, "left"))


def test_a_file_of_the_pairs_stays_small(spark, tmp_path):
    """Left rows in no order of the keys gave two bytes for each pair, 28 GB for 13.5 billion pairs."""
    a = spark.range(4_000).selectExpr("id", "id % 40 as k")
    b = spark.range(20_000).selectExpr("id as rid", "id % 40 as r")
    got = left_join(a, b, "k", "r", cell_pairs=25_000)
    got.write.parquet(f"{tmp_path}/pairs")
    written = spark.read.parquet(f"{tmp_path}/pairs")
    assert same_rows(written, a.join(b, a.k == b.r, "left"))
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < written.count() / 2


def test_tasks_grow_with_the_pairs(spark):
    """Merged by the bytes they read, few tasks made all the pairs."""
    a = spark.range(20_000).selectExpr("id", "id % 4 as k")
    b = spark.range(2_000).selectExpr("id as rid", "id % 4 as r")
    got = left_join(a, b, "k", "r", cell_rows=1_000)
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) == 8
