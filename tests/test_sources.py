"""Raw files, layouts and control rows."""

import os

import pytest
from pyspark.errors import AnalysisException
from millrace import (
    Bases, Control, apply_mapping, latest_file, list_files, load_control, next_run_id, read_raw,
    run_sql, warehouse_columns)
from millrace.functions.filenames import name_regex
from millrace.model import AUDIT, COLUMNS, DATASETS, DEPENDENCIES, RULES, join_path
from millrace.operators.mapping import spark_type, warehouse_ddl
from millrace.settings import scratch, work_folder
from millrace.sinks.warehouse import writer_options


def touch(folder, name, mtime):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("a\n")
    os.utime(path, (mtime, mtime))


def newest(spark, folder, pattern, fmt="csv"):
    row = latest_file(list_files(spark, str(folder)), pattern, fmt).first()
    return row and row["path"].split("/")[-1]


@pytest.fixture
def inbox(tmp_path):
    for name, mtime in [
            ("hcp_20240101.csv", 9_000), ("hcp_20240201.csv", 1_000), ("HCP_20240201.CSV", 2_000),
            ("hcp_20240201093000.csv", 10), ("other_20250101.csv", 9_999), ("hcp_2024.csv", 9_999),
            ("hcp_20240301.csv.bak", 9_999), ("xhcp_20250301.csv", 9_999),
            ("deep/hcp_20230101.csv", 9_999)]:
        touch(tmp_path, name, mtime)
    return tmp_path


def test_latest_by_stamp_then_by_change(spark, inbox):
    assert newest(spark, inbox, "hcp_YYYYMMDD") == "HCP_20240201.CSV"
    assert newest(spark, inbox, "hcp_YYYYMMDDHHMMSS") == "hcp_20240201093000.csv"
    assert newest(spark, inbox, "other_YYYYMMDD") == "other_20250101.csv"


def test_nothing_fits(spark, inbox, tmp_path_factory):
    assert newest(spark, inbox, "nope_YYYYMMDD") is None
    assert newest(spark, inbox, "hcp_2024") is None, "a name without a stamp is no candidate"
    assert newest(spark, tmp_path_factory.mktemp("empty"), "hcp_YYYYMMDD") is None


def test_nested_folders_count_with_their_real_path(spark, tmp_path):
    touch(tmp_path, "a/b/hcp_20240101.csv", 5)
    found = latest_file(list_files(spark, str(tmp_path)), "hcp_YYYYMMDD", "csv").first()
    assert found["path"].endswith("/a/b/hcp_20240101.csv")


def test_pattern_text():
    assert name_regex("hcp_YYYYMMDD", "csv") == r"(?i)^hcp_\d{8}.csv$"
    assert name_regex("YYYYMMDDHHMMSS_x", "csv") == r"(?i)^\d{14}_x.csv$"


def test_listing_opens_no_file(spark, inbox):
    files = list_files(spark, str(inbox))
    assert files.columns == ["path", "mtime", "length"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_read_and_map(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x|y|z\n1|it's|\n2||b\n")
    raw = read_raw(spark, str(tmp_path / "a.csv"), "csv", "|", True)
    mapped = apply_mapping(raw, [("Z", "LAST"), ("x", "FIRST")])
    assert mapped.dtypes == [("LAST", "string"), ("FIRST", "string")]
    assert sorted(mapped.collect(), key=lambda r: r["FIRST"]) == [(None, "1"), ("b", "2")]
    assert apply_mapping(raw, None).columns == ["x", "y", "z"]
    with pytest.raises(ValueError, match="nope"):
        apply_mapping(raw, [("nope", "N")])
    with pytest.raises(ValueError):
        apply_mapping(raw, [])


def test_quotes_and_backslashes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"x ""y"", z",C:\\d\n"C:\\",2\n')
    got = read_raw(spark, str(tmp_path / "a.csv"), "csv").collect()
    assert sorted(got) == [("C:\\", "2"), ('x "y", z', "C:\\d")]


def test_unheadered(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n3,4\n")
    raw = read_raw(spark, str(tmp_path / "a.csv"), "csv", None, False)
    assert raw.columns == ["_c0", "_c1"] and raw.count() == 2
    assert apply_mapping(raw, [("col1", "B")]).collect() == [("2",), ("4",)]


def test_text_and_xml(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert read_raw(spark, str(tmp_path / "a.txt"), "text").count() == 2
    (tmp_path / "a.xml").write_text("<r><p><i>1</i></p><p><i>2</i></p></r>")
    raw = read_raw(spark, str(tmp_path / "a.xml"), "xml", rowTag="p")
    assert sorted(apply_mapping(raw, [("i", "I")]).collect()) == [("1",), ("2",)]


def test_run_sql_binds_frames_and_restores_views(spark):
    spark.range(3).createOrReplaceTempView("mine")
    got = run_sql(spark, "select a.id from mine a join b on a.id = b.id where a.id > :low",
                  {"mine": spark.range(10), "b": spark.range(5)}, {"low": 2})
    assert sorted(r["id"] for r in got.collect()) == [3, 4]
    assert spark.table("mine").count() == 3
    assert not spark.catalog.tableExists("b")
    with pytest.raises(Exception):
        run_sql(spark, "select nope from b", {"b": spark.range(1)})
    assert not spark.catalog.tableExists("b")
    spark.catalog.dropTempView("mine")


# --- control -----------------------------------------------------------------------------


def dataset(i, name, kind, job, active="Y"):
    return (i, name, kind, job, active, "N", "p", "csv", ",", "Y", "in/", f"{name}/", "a/", name)


def make_control(spark, datasets, dependencies=(), columns=(), rules=()):
    return Control(
        spark.createDataFrame(list(datasets), DATASETS),
        spark.createDataFrame(list(columns), COLUMNS), spark.createDataFrame(list(rules), RULES),
        spark.createDataFrame(list(dependencies), DEPENDENCIES))


def test_control_filters_and_order(spark, tmp_path):
    control = make_control(
        spark,
        [dataset(1, "a", "raw", 7), dataset(2, "b", "RAW", 7), dataset(3, "c", "raw", 7, "N"),
         dataset(4, "d", "raw", 8)],
        columns=[(1, 10, "s10", "t10", "INT"), (1, 2, "s2", "t2", "DATE"), (4, 1, "x", "x", "INT")],
        rules=[(1, 1, "c", "NULL", None, "x", "Y"), (1, 2, "c", "NULL", None, "x", "N")])
    base = str(tmp_path / "control")
    for frame, name in [(control.all_datasets, "CTL_DATASET_MASTER"),
                        (control.all_columns, "CTL_COLUMN_METADATA"),
                        (control.all_rules, "CTL_DQM_MASTER"),
                        (control.all_dependencies, "CTL_DEPENDENCY_MASTER")]:
        frame.write.parquet(f"{base}/{name}")
    for c in (control, load_control(spark, base)):
        assert [d.dataset_name for d in c.raw_datasets(7)] == ["a"]
        assert c.layout(1) == [("s2", "t2"), ("s10", "t10")]
        assert c.declared_types(1) == [("t2", "DATE"), ("t10", "INT")]
        assert [r.qc_id for r in c.rule_list(1)] == [1]


def test_resolution(spark):
    rows = [dataset(1, "a", "RAW", 1), dataset(2, "b", "processed", 2), dataset(3, "c", "x", 3)]
    control = make_control(spark, rows, [(3, 1, "Y"), (3, 2, "Y"), (3, 9, "N")])
    target = control.target(3)
    sources = control.sources_of(target, 3)
    assert target.dataset_name == "c" and [s.dataset_name for s in sources] == ["a", "b"]
    bases = Bases("r", "/cur/", "s3a://pro")
    assert [bases.target(s) for s in sources] == ["/cur/a", "s3a://pro/b"]
    with pytest.raises(LookupError, match="none"):
        control.target(99)
    with pytest.raises(LookupError):
        control.sources_of(control.target(1), 1)


@pytest.mark.parametrize("rows,needs,error", [
    ([dataset(1, "a", "raw", 1), dataset(2, "b", "raw", 1)], [(1, 1, "Y")], LookupError),
    ([dataset(1, "a", "raw", 1)], [(1, 5, "Y")], LookupError),
    ([dataset(1, "a", "raw", 1), dataset(5, "x", "raw", 2), dataset(5, "y", "raw", 3)],
     [(1, 5, "Y")], LookupError),
    ([dataset(1, "a", "raw", 1)], [(1, 1, "Y")], ValueError)])
def test_bad_control_rows_are_named_errors(spark, rows, needs, error):
    with pytest.raises(error):
        control = make_control(spark, rows, needs)
        control.sources_of(control.target(1), 1)


def test_missing_control_table_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_control(spark, str(tmp_path)).raw_datasets(1)


def test_next_run_id(spark):
    def row(cycle, run, dataset_id):
        return (cycle, run, None, 1, None, dataset_id, None, None, None, None, None, None)

    log = spark.createDataFrame(
        [row("20240101", 7, 1), row("20240102", 1, 1), row("20240102", 2, 1),
         row("20240102", 9, 2)], AUDIT)
    assert next_run_id(log, "DATASET_ID", 1, "20240102") == 3
    assert next_run_id(log, "DATASET_ID", 1, "20240101") == 8
    assert next_run_id(log, "DATASET_ID", 1, "20240103") == 1
    assert next_run_id(log, "DATASET_ID", 5, "20240102") == 1


def test_empty_locations_are_refused():
    for location in ("", "/", None):
        with pytest.raises(ValueError):
            join_path("/curated", location)
    assert join_path("s3a://b/", "/a//b/") == "s3a://b/a/b"


class FakeSession:
    """Just enough of a session to ask for a work folder."""

    def __init__(self, master, folder):
        settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = type("C", (), {"get": lambda _, k, d=None: settings.get(k, d),
                                   "set": lambda _, k, v: settings.update({k: v})})()
        self.sparkContext = type("S", (), {"master": master})()


def test_work_folder():
    assert work_folder(FakeSession("yarn", "hdfs:///shared/"), "x") == "hdfs:///shared/millrace/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(FakeSession("yarn", None), "x")
    local = FakeSession("local[2]", None)
    assert work_folder(local, "x") == work_folder(local, "x")
    assert scratch(local, "x") != scratch(local, "x")


# --- warehouse layout --------------------------------------------------------------------


@pytest.mark.parametrize("declared,expected", [
    ("VARCHAR(50)", "varchar(50)"), ("character varying(9)", "varchar(9)"), ("INT8", "bigint"),
    ("Double Precision", "double"), ("NUMERIC(10,2)", "numeric(10,2)"), ("char varying (4)", "varchar(4)"),
    ("timestamp without time zone", "timestamp"), ("bpchar(3)", "char(3)"),
    ("date", "date")])
def test_declared_types(spark, declared, expected):
    assert spark_type(declared) == expected


@pytest.mark.parametrize("declared", [
    "text", "varchar", "bpchar", "character varying", "varchar(max)", "super", "geometry(1)"])
def test_types_that_cannot_be_declared(spark, declared):
    with pytest.raises(ValueError, match="column type"):
        warehouse_ddl([("a", declared)])


def test_warehouse_rows_and_options(spark):
    columns = [("b", "NUMERIC(10,2)"), ("a", "VARCHAR(5)"), ("d", "DATE")]
    df = spark.createDataFrame([(1, "2.50", "2024-01-02", 0)], "a int, b string, d string, e int")
    got = warehouse_columns(df, columns)
    assert got.dtypes == [("b", "decimal(10,2)"), ("a", "string"), ("d", "date")]
    assert warehouse_ddl(columns) == "`b` numeric(10,2), `a` varchar(5), `d` date"
    options = writer_options(columns, {"url": "jdbc:x", "dbtable": "s.t", "numPartitions": 4})
    assert options["numPartitions"] == 4 and options["dbtable"] == "s.t"
    assert options["createTableColumnTypes"] == warehouse_ddl(columns)
    assert got.selectExpr("cast(b as string)").first()[0] == "2.50"
