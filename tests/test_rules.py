"""Rules on edge values, against the definitions spelled out in Python."""

import operator

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from millrace import Rule, Run, check, custom_hits, flag, flag_from_log, rollup, summarize
from millrace.functions.rules import parse_length
from tests.conftest import plan_of

RUN = Run("20240101", 1, 1)
VALUES = [None, "", "  ", " NuLl ", "null", "\t", " \t ", "1-urgent", "A", " a ", "b", "abcde",
          "abcdef", "abcdefg", "ñandú", "日本語テスト", "it's", "x\\y", "NULLS", "a,b", " abcd "]
OPS = {"<=": operator.le, ">=": operator.ge, "=": operator.eq, "<": operator.lt, ">": operator.gt}


def blank(v):
    return v is None or v.strip(" ").upper() in ("", "NULL")


def breaks(rule, v):
    if rule.kind == "NULL":
        return blank(v)
    if blank(v):
        return False
    if rule.kind == "LENGTH":
        op, n = parse_length(rule.qc_param)
        return not OPS[op](len(v), n)
    return v.strip(" ").upper() not in [p.strip() for p in rule.qc_param.split(",")]


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values, start=1)), "ROW_ID bigint, c string")


def found(log):
    return sorted((r["ROW_ID"], r["QC_ID"]) for r in log.collect())


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def rule(i, kind, param=None, criticality="low", column="c"):
    return Rule(1, i, column, kind, param, criticality)


EDGE_RULES = [
    rule(1, "NULL"), rule(2, "null"),
    *[rule(10 + i, "LENGTH", f"{op}6") for i, op in enumerate(OPS)],
    *[rule(20 + i, "length", f"  {op} 5 ") for i, op in enumerate(OPS)],
    rule(30, "DOMAIN", "A, ABCDE ,1-URGENT"), rule(31, "DOMAIN", "a,abcde"),
    rule(32, "DOMAIN", ""), rule(33, "domain", "IT'S,X\\Y,ÑANDÚ"),
]


@pytest.mark.parametrize("r", EDGE_RULES, ids=lambda r: f"{r.qc_type}{r.qc_param}")
def test_edge_values(spark, r):
    expected = [(i, r.qc_id) for i, v in enumerate(VALUES, start=1) if breaks(r, v)]
    assert found(check(frame(spark, VALUES), [r], RUN)) == expected


def test_all_rules_in_one_pass_equal_the_single_ones(spark):
    rows = frame(spark, VALUES)
    expected = sorted(p for r in EDGE_RULES for p in found(check(rows, [r], RUN)))
    assert found(check(rows, EDGE_RULES, RUN)) == expected


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.text("nulNUL ab',\\\t", max_size=7)), min_size=1,
                       max_size=30),
       n=st.integers(0, 7), op=st.sampled_from(list(OPS)))
def test_any_values(spark, values, n, op):
    rules = [rule(1, "NULL"), rule(2, "LENGTH", f"{op}{n}"), rule(3, "DOMAIN", "A,B',NUL")]
    expected = sorted((i, r.qc_id) for i, v in enumerate(values, 1) for r in rules if breaks(r, v))
    assert found(check(frame(spark, values), rules, RUN)) == expected


@pytest.mark.parametrize("text,wanted", [
    ("<=5", ("<=", 5)), ("  >= 12 ", (">=", 12)), ("=0", ("=", 0)), ("<5.7", ("<", 5)),
    (">-1", (">", -1)), ("> +3", (">", 3)), ("5", None), ("=", None), ("==5", None),
    ("<>5", None), ("<five", None), ("", None), (None, None), ("<99999999999", None)])
def test_parse_length(text, wanted):
    assert parse_length(text) == wanted


def test_unreadable_length(spark):
    rows, bad = frame(spark, VALUES), [rule(1, "LENGTH", "about 5")]
    with pytest.raises(ValueError, match="unreadable"):
        check(rows, bad, RUN)
    expected = [(i, 1) for i, v in enumerate(VALUES, 1) if not blank(v)]
    assert found(check(rows, bad, RUN, strict=False)) == expected


@pytest.mark.parametrize("bad", [
    rule(1, "REGEX", "x"), rule(1, "LENGTH"), rule(1, "DOMAIN"), rule(1, "CUSTOM"),
    rule(1, "NULL", column="missing")])
def test_bad_rules_are_named_errors(spark, bad):
    with pytest.raises(ValueError, match="rule 1"):
        check(frame(spark, VALUES), [bad], RUN, strict=False)


def test_typed_and_oddly_named_columns(spark):
    rows = spark.createDataFrame(
        [(1, 5, None, True), (2, None, 1.5, None)],
        "ROW_ID bigint, `an int` int, `a.b` double, flag boolean")
    rules = [rule(1, "NULL", column="an int"), rule(2, "NULL", column="A.B"),
             rule(3, "LENGTH", ">1", column="an int"), rule(4, "DOMAIN", "FALSE", column="flag")]
    assert found(check(rows, rules, RUN)) == [(1, 2), (1, 3), (1, 4), (2, 1)]


def test_log_text(spark):
    rules = [rule(1, "Null", None, "CRITICAL"), rule(2, "LENGTH", "= 3", "low"),
             rule(3, "DOMAIN", "A,B", None), rule(4, "CUSTOM", "select 9 as ROW_ID", "x")]
    rows = frame(spark, [None, "q"])
    got = {r["QC_ID"]: tuple(r) for r in check(rows, rules, RUN).collect()}
    assert got == {
        1: ("20240101", 1, 1, 1, 1, "c", "Null", None, "c must not be NULL", "CRITICAL"),
        2: ("20240101", 1, 1, 2, 2, "c", "LENGTH", "= 3", "c must have a length = 3", "low"),
        3: ("20240101", 1, 1, 2, 3, "c", "DOMAIN", "A,B", "c must be one of: A,B", None),
        4: ("20240101", 1, 1, 9, 4, "c", "CUSTOM", "select 9 as ROW_ID",
            "c must satisfy custom check", "x")}


def test_custom_rows_count_once_and_views_do_not_leak(spark):
    rows = frame(spark, ["a", "b", "c"])
    twice = rule(1, "CUSTOM", "select ROW_ID from landingTable where c <> 'b' union all "
                              "select ROW_ID from landingTable where c = 'c'")
    assert found(check(rows, [twice], RUN)) == [(1, 1), (3, 1)]
    assert not spark.catalog.tableExists("landingTable")


def test_flags(spark):
    rules = [
        rule(10, "NULL", None, "NON-CRITICAL"), rule(2, "DOMAIN", "A", "critical"),
        rule(2, "LENGTH", "=1", "low"), rule(2, "LENGTH", "=1", "low"),
        rule(3, "CUSTOM", "select ROW_ID from landingTable where c = 'b' or c is null", "low")]
    rows = frame(spark, ["A", "b", "xx", None])
    got = {r["ROW_ID"]: (r["QC_ID"], r["QC_DESC"], r["CRITICALITY_FLAG"])
           for r in flag(rows, rules).collect()}
    assert got == {
        1: (None, None, "N"),
        2: ("[2, 3]", "[c must be one of: A, c must satisfy custom check]", "N"),
        3: ("[2]", "[c must be one of: A, c must have a length =1]", "N"),
        4: ("[3, 10]", "[c must not be NULL, c must satisfy custom check]", "Y")}
    again = flag_from_log(rows, check(rows, rules, RUN))
    assert same(again, flag(rows, rules))
    assert again.columns == ["QC_ID", "QC_DESC", "CRITICALITY_FLAG", "ROW_ID", "c"]


def test_no_rules(spark):
    rows = frame(spark, ["a", None])
    assert check(rows, [], RUN).count() == 0
    assert [tuple(r)[:3] for r in flag(rows, []).collect()] == [(None, None, "N")] * 2
    assert summarize(check(rows, [], RUN), [], RUN).count() == 0


def test_rollup_orders_ids_as_numbers(spark):
    rules = [rule(i, "NULL") for i in (10, 9, 100)]
    assert rollup(check(frame(spark, [None]), rules, RUN)).first()["QC_ID"] == "[9, 10, 100]"


def test_summary_adds_up(spark):
    rows = frame(spark, VALUES)
    log = check(rows, EDGE_RULES, RUN)
    summary = summarize(log, EDGE_RULES, RUN).collect()
    assert sum(r["ERROR_COUNT"] for r in summary) == log.count()
    assert len(summary) == len(EDGE_RULES)
    assert {r["QC_RESULT"] for r in summary if r["ERROR_COUNT"] == 0} <= {"PASS"}
    assert {r["QC_RESULT"] for r in summary if r["ERROR_COUNT"] > 0} == {"FAIL"}
    passing = [rule(1, "LENGTH", "<99")]
    assert [r["QC_RESULT"] for r in summarize(check(rows, passing, RUN), passing, RUN).collect()] \
        == ["PASS"]


def test_one_scan_and_no_exchange_for_plain_rules(spark, tmp_path):
    frame(spark, VALUES).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    rules = [r for r in EDGE_RULES if r.kind != "CUSTOM"]
    for df in (check(stored, rules, RUN), flag(stored, rules)):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1
        assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_hits_may_be_stored_and_passed(spark, tmp_path):
    rows = frame(spark, ["a", "b"])
    rules = [rule(1, "CUSTOM", "select ROW_ID from landingTable where c = 'b'"), rule(2, "NULL")]
    custom_hits(rows, rules).write.parquet(str(tmp_path / "hits"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    assert found(check(rows, rules, RUN, hits=hits)) == [(2, 1)]
    assert same(flag(rows, rules, hits=hits), flag(rows, rules))
