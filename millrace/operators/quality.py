"""Data-quality rules over a numbered landing frame.

All NULL, LENGTH and DOMAIN rules run in one pass over the rows: each is a boolean column, the
log is one `explode` of the indexes of the true ones, and the flags are texts built from the
same booleans. No join and no shuffle. CUSTOM rules are queries; their findings are pairs of
ROW_ID and rule index that join back on ROW_ID.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace import fixed
from millrace.functions.rules import validate, violation
from millrace.functions.text import array_text, bracketed, column, null_text, spare
from millrace.model import VIOLATIONS, Rule, Run
from millrace.operators.ruleplan import check_rule_plan
from millrace.operators.sqlstep import run_sql
from millrace.sources.local import local_frame

RULE = "_rule"
_LOG_KEYS = [f for f in VIOLATIONS.names if f != fixed.ROW_ID]
_RULE_FIELD = T.StructField(RULE, T.IntegerType())
_RULES = T.StructType([_RULE_FIELD, *[VIOLATIONS[k] for k in _LOG_KEYS]])
_HITS = T.StructType([VIOLATIONS[fixed.ROW_ID], _RULE_FIELD])


def ordered(rules: Iterable[Rule]) -> list[Rule]:
    """Each rule once, by id. A rule's place here is its index in the log and in the hits."""
    return sorted(set(rules), key=lambda r: (
        r.qc_id, r.column_name, r.qc_type, r.qc_param or "", r.criticality or ""))


def _prepare(landing: DataFrame, rules: Iterable[Rule]) -> tuple[list, list]:
    rules = list(rules)
    columns = {c.lower() for c in landing.columns}
    for rule in rules:
        validate(rule, columns)
    indexed = list(enumerate(ordered(rules)))
    return ([p for p in indexed if p[1].kind != "CUSTOM"],
            [p for p in indexed if p[1].kind == "CUSTOM"])


def custom_hits(landing: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """ROW_ID and rule index for every row a CUSTOM rule's query returns.

    A query sees the view `landingTable` and nothing else of ours. Store the result when both
    the log and the flags need it: it re-runs the queries each time it is read.
    """
    spark = landing.sparkSession
    _, custom = _prepare(landing, rules)
    found = []
    for index, rule in custom:
        rows = run_sql(spark, rule.qc_param, {fixed.LANDING_VIEW: landing})
        check_rule_plan(rows, rule)
        rows = rows.select(F.col(fixed.ROW_ID).cast("bigint")).distinct()
        found.append(rows.withColumn(RULE, F.lit(index)))
    return reduce(DataFrame.unionByName, found) if found else local_frame(spark, [], _HITS)


def _rule_table(spark: SparkSession, rules: list[Rule], run: Run) -> DataFrame:
    """What the log says of each rule, by rule index. A row per rule: small by nature."""
    return local_frame(spark, [
        (i, run.cycle_id, run.run_id, run.dataset_id, r.qc_id, r.column_name, r.qc_type,
         r.qc_param, r.description, r.criticality) for i, r in enumerate(rules)], _RULES)


def check(
    landing: DataFrame,
    rules: Iterable[Rule],
    run: Run,
    strict: bool = True,
    hits: DataFrame | None = None,
    compact: bool = False,
) -> DataFrame:
    """The violations log: one row per broken rule and row. `hits`: stored `custom_hits`.

    Findings are sparse and come from as many tasks as the landing has. For a log that is to be
    stored, `compact` evens them out into files of useful size; only pairs of ROW_ID and rule
    index are shuffled for that, before the texts are attached.
    """
    rules = ordered(rules)
    plain, custom = _prepare(landing, rules)
    if not rules:
        return local_frame(landing.sparkSession, [], VIOLATIONS)
    parts = []
    if plain:
        none = F.lit(-1)
        broken = F.array_remove(F.array(*[
            F.when(violation(rule, strict), F.lit(i)).otherwise(none) for i, rule in plain]), none)
        parts.append(landing.select(fixed.ROW_ID, F.explode(broken).alias(RULE)))
    if custom:
        parts.append(hits if hits is not None else custom_hits(landing, rules))
    found = reduce(DataFrame.unionByName, parts)
    if compact:
        found = found.hint("rebalance", F.col(fixed.ROW_ID))  # by key: spares a sort of the rows
    about = F.broadcast(_rule_table(landing.sparkSession, rules, run))
    return found.join(about, RULE).select(*VIOLATIONS.names)


def _any(columns: Sequence[Column]) -> Column:
    return reduce(or_, columns, F.lit(False))


def _texts(broken: dict[int, Column], rules: list[Rule], text) -> Column:
    """Bracketed texts of the broken rules: each text once, in order, NULL when none is."""
    by_text: dict = {}
    for i, rule in enumerate(rules):
        by_text.setdefault(text(rule), []).append(broken[i])
    parts = [F.when(_any(by_text[t]), F.lit(str(t))) for t in sorted(by_text)]
    return F.when(_any(list(broken.values())), bracketed(parts))


def flag(
    landing: DataFrame,
    rules: Iterable[Rule],
    strict: bool = True,
    hits: DataFrame | None = None,
) -> DataFrame:
    """Staging rows: QC_ID, QC_DESC and CRITICALITY_FLAG before every landing column."""
    rules = ordered(rules)
    plain, custom = _prepare(landing, rules)
    names = landing.columns
    marked = landing
    marks = spare(names, *(f"_broken_{i}" for i in range(len(rules))))
    if custom:
        hits = hits if hits is not None else custom_hits(landing, rules)
        per_row = hits.groupBy(fixed.ROW_ID).agg(*[
            F.bool_or(F.col(RULE) == i).alias(marks[i]) for i, _ in custom])
        marked = marked.join(per_row, fixed.ROW_ID, "left")
        marked = marked.fillna(False, [marks[i] for i, _ in custom])
    marked = marked.select("*", *[
        violation(rule, strict).alias(marks[i]) for i, rule in plain])
    broken = {i: F.col(marks[i]) for i in range(len(rules))}
    critical = _any([broken[i] for i, rule in enumerate(rules) if rule.is_critical])
    return marked.select(
        _texts(broken, rules, lambda r: r.qc_id).alias("QC_ID") if rules
        else null_text().alias("QC_ID"),
        _texts(broken, rules, lambda r: r.description).alias("QC_DESC") if rules
        else null_text().alias("QC_DESC"),
        F.when(critical, fixed.YES).otherwise(fixed.NO).alias("CRITICALITY_FLAG"),
        *[column(n) for n in names])


def rollup(log: DataFrame) -> DataFrame:
    """One row per ROW_ID of a log: the sets of rule ids and descriptions as text, and the flag."""
    seen = log.groupBy(fixed.ROW_ID).agg(*[
        F.collect_set(c).alias(c) for c in ("QC_ID", "QC_DESC", "CRITICALITY")])
    critical = array_text(F.col("CRITICALITY")).like(fixed.CRITICAL_PATTERN)
    return seen.select(
        fixed.ROW_ID,
        array_text(F.col("QC_ID")).alias("QC_ID"),
        array_text(F.col("QC_DESC")).alias("QC_DESC"),
        F.when(critical, fixed.YES).otherwise(fixed.NO).alias("CRITICALITY_FLAG"))


def flag_from_log(landing: DataFrame, log: DataFrame) -> DataFrame:
    """Staging rows from a log that was read back, for when the rules are not at hand."""
    flags = rollup(log.where(F.col(fixed.ROW_ID).isNotNull()))
    joined = landing.join(flags, fixed.ROW_ID, "left")
    return joined.select(
        "QC_ID", "QC_DESC",
        F.coalesce("CRITICALITY_FLAG", F.lit(fixed.NO)).alias("CRITICALITY_FLAG"),
        *[column(n) for n in landing.columns])


def summarize(
    log: DataFrame, rules: Iterable[Rule] | None = None, run: Run | None = None
) -> DataFrame:
    """Errors per rule. With the run's `rules`, those without an error are listed as PASS."""
    counts = log.groupBy(*_LOG_KEYS).agg(F.count(F.lit(1)).alias("ERROR_COUNT"))
    if rules is not None:
        none_yet = _rule_table(log.sparkSession, ordered(rules), run)
        none_yet = none_yet.select(*_LOG_KEYS, F.lit(0).cast("bigint").alias("ERROR_COUNT"))
        counts = (counts.unionByName(none_yet).groupBy(*_LOG_KEYS)
                  .agg(F.sum("ERROR_COUNT").alias("ERROR_COUNT")))
    result = F.when(F.col("ERROR_COUNT") > 0, fixed.FAIL).otherwise(fixed.PASS)
    return counts.select(*_LOG_KEYS, "ERROR_COUNT", result.alias("QC_RESULT"))
