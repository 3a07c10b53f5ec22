"""Rules as boolean expressions: true marks a violation, and no result is NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from millrace import fixed
from millrace.functions.text import is_blank, normalized, quoted
from millrace.model import Rule

_INT_RANGE = range(-2**31, 2**31)


def parse_length(param: str | None) -> tuple[str, int] | None:
    """`'<= 5'` as `('<=', 5)`; None when the operator or the number cannot be read.

    A fraction is cut off, as a cast of text to int does outside ANSI mode.
    """
    text = (param or "").strip(" ")
    op = next((o for o in fixed.LENGTH_OPERATORS if text.startswith(o)), None)
    number = op and re.fullmatch(r"\s*([+-]?\d+)(?:\.\d*)?\s*", text[len(op):])
    if not number or int(number[1]) not in _INT_RANGE:
        return None
    return op, int(number[1])


def domain_values(param: str | None) -> list[str]:
    return [v.strip() for v in (param or "").split(",")]


def _null(rule: Rule, strict: bool) -> Column:
    return is_blank(rule.column_name)


def _length(rule: Rule, strict: bool) -> Column:
    filled = ~is_blank(rule.column_name)
    wanted = parse_length(rule.qc_param)
    if wanted is None:
        if strict or rule.qc_param is None:
            raise ValueError(f"rule {rule.qc_id}: unreadable length {rule.qc_param!r}")
        return filled
    op, size = wanted
    return filled & F.expr(f"not length(cast({quoted(rule.column_name)} as string)) {op} {size}")


def _domain(rule: Rule, strict: bool) -> Column:
    if rule.qc_param is None:
        raise ValueError(f"rule {rule.qc_id}: a DOMAIN rule needs a parameter")
    value = F.expr(normalized(rule.column_name))
    return ~is_blank(rule.column_name) & ~value.isin(*domain_values(rule.qc_param))


_BUILDERS = {"NULL": _null, "LENGTH": _length, "DOMAIN": _domain}


def validate(rule: Rule, columns: set[str]) -> None:
    """Raise for a rule that could only fail later, in the middle of a job.

    `columns` are the lower-cased names the rule may use.
    """
    if rule.kind not in fixed.DESCRIPTIONS:
        raise ValueError(f"rule {rule.qc_id}: unknown type {rule.qc_type!r}")
    if rule.kind == "CUSTOM":
        if not rule.qc_param:
            raise ValueError(f"rule {rule.qc_id}: a CUSTOM rule needs a query")
    elif rule.column_name.lower() not in columns:
        raise ValueError(f"rule {rule.qc_id}: no column {rule.column_name!r}")


def violation(rule: Rule, strict: bool = True) -> Column:
    """The predicate of a NULL, LENGTH or DOMAIN rule.

    Columns are compared as text, so numbers and dates can be checked too. With
    `strict=False` an unreadable length makes every filled value a violation.
    """
    return _BUILDERS[rule.kind](rule, strict)
