"""Text expressions shared by the rules and the marts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace import fixed


def quoted(name: str) -> str:
    """A top-level column's exact name, dots and spaces included, as SQL reads it."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def spare(taken: list[str], *names: str) -> list[str]:
    """Names for helper columns: those given, with as many underscores as keep them apart."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def normalized(name: str) -> str:
    """SQL for the column as upper-case text without surrounding spaces (tabs stay)."""
    return f"upper(trim(cast({quoted(name)} as string)))"


def is_blank(name: str) -> Column:
    """NULL, empty, only spaces, or the word null. Never NULL itself."""
    return F.expr(f"coalesce({normalized(name)} in {fixed.BLANK_TEXTS}, true)")


def bracketed(parts: list[Column]) -> Column:
    """`[a, b]`: the parts that are not NULL, in the order given."""
    return F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))


def array_text(values: Column) -> Column:
    """Text of a set of values, ordered so that equal sets give equal text."""
    return F.array_sort(values).cast("string")


def full_name(*parts: str) -> Column:
    return F.concat_ws(" ", *[column(p) for p in parts])


def one_line_address(*parts: str) -> Column:
    return F.concat_ws(",", *[column(p) for p in parts])


def null_text() -> Column:
    """A NULL that is stored as text rather than as an untyped column."""
    return F.lit(None).cast("string")
