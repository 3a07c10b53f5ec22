"""File name patterns and the date stamps inside names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace import fixed


def name_regex(pattern: str, fmt: str) -> str:
    """Regular expression for base names; the date tokens stand for runs of digits.

    The dot before the format is left as written, so it stands for any one character.
    """
    body = f"{pattern}.{fmt}"
    for token, digits in fixed.DATE_TOKENS.items():
        body = body.replace(token, digits)
    return f"(?i)^{body}$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def folder_name(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def date_stamp(name: Column) -> Column:
    """The first long stamp in the name, else the first short one, else NULL."""
    found = [F.regexp_extract(name, d, 0) for d in fixed.DATE_TOKENS.values()]
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found])
