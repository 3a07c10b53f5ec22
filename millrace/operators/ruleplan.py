"""What a CUSTOM rule's query reads and returns, from its analysed plan.

A rule may read the landing rows, under their view's name, and nothing else: no tables, no files. The
ROW_ID it returns must be the landing's, as it is, renamed, cast or picked from a group, or a number
that the rule spells out; any other would mark rows that the rule never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from millrace import fixed
from millrace.model import Rule

# Leaves of a plan that hold no stored rows.
_FREE = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "UnionLoopRef"}
# Expressions whose value is one of the row ids they are given.
_PICKING = {"Alias", "AttributeReference", "Cast", "AggregateExpression", "Max", "Min", "First", "Last",
            "AnyValue", "Literal", "MaxBy", "MinBy"}


def _all(sequence) -> Iterator:
    for i in range(sequence.size()):
        yield sequence.apply(i)


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _is_landing(node) -> bool:
    return (_kind(node) == "View" and node.isTempView()
            and node.desc().identifier().table().lower() == fixed.LANDING_VIEW.lower())


def _strangers(node) -> Iterator[str]:
    """Relations other than the landing view, in subqueries too."""
    if _is_landing(node):
        return
    if _kind(node) == "View":
        yield node.desc().identifier().table()
        return
    children = [*_all(node.children()), *_all(node.subqueries())]
    if not list(_all(node.children())) and _kind(node) not in _FREE:
        yield node.simpleString(25).strip()
    for child in children:
        yield from _strangers(child)


def _picked(expression, ids: set) -> bool:
    """Whether a value of these row ids comes out."""
    if _kind(expression) not in _PICKING:
        return False
    children = list(_all(expression.children()))
    if _kind(expression) == "AttributeReference":
        return expression.exprId().id() in ids
    if _kind(expression) in ("MaxBy", "MinBy"):
        return _picked(children[0], ids)
    return _kind(expression) == "Literal" or bool(children) and _picked(children[0], ids)


def _row_ids(node, ctes: dict) -> set:
    """Ids of the attributes of a plan that hold the landing's row ids."""
    if _is_landing(node):
        return {a.exprId().id() for a in _all(node.output()) if a.name() == fixed.ROW_ID}
    kind, below = _kind(node), [_row_ids(c, ctes) for c in _all(node.children())]
    ids = set().union(*below)
    output = list(_all(node.output())) if kind != "WithCTE" else []
    if kind in ("Union", "Intersect", "Except"):
        sides = [list(_all(c.output())) for c in _all(node.children())]
        sides = sides[:1] if kind == "Except" else sides
        return {a.exprId().id() for i, a in enumerate(output)
                if all(s[i].exprId().id() in ids for s in sides)}
    if kind == "CTERelationDef":
        ctes[node.id()] = [a.exprId().id() in ids for a in output]
    elif kind == "CTERelationRef":
        return {a.exprId().id() for a, good in zip(output, ctes.get(node.cteId(), [])) if good}
    named = {"Project": "projectList", "Aggregate": "aggregateExpressions"}.get(kind)
    if named:
        ids |= {e.exprId().id() for e in _all(getattr(node, named)()) if _picked(e, ids)}
    return ids


def check_rule_plan(rows: DataFrame, rule: Rule) -> None:
    """Refuse a rule's query (`rows`, analysed) with an error that names the rule and the reason."""
    plan = rows._jdf.queryExecution().analyzed()
    found = sorted(set(_strangers(plan)))
    if found:
        raise ValueError(f"rule {rule.qc_id} reads something else than {fixed.LANDING_VIEW}: {found}")
    mine = [a for a in _all(plan.output()) if a.name().lower() == fixed.ROW_ID.lower()]
    if len(mine) != 1:
        raise ValueError(f"rule {rule.qc_id} must return one column {fixed.ROW_ID}, it has {len(mine)}")
    if mine[0].exprId().id() not in _row_ids(plan, {}):
        raise ValueError(f"rule {rule.qc_id} returns a {fixed.ROW_ID} that is not the landing's")
