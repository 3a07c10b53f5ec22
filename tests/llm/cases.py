"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tags array<string>"
SYLLABLES = ["an", "ber", "co", "den", "er", "fi", "gra", "hol", "im", "ja", "ko", "lu", "mé", "ñ", "ö"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def documents(more: list[str] = ()) -> list[tuple]:
    long = prose(1, 3000)
    texts = [
        None, "", " \t\n ", "one", "one two", "A b C", "x" * 9000, long, long, long + " tail",
        long.replace("ber", "Ber"), prose(2, 40), prose(2, 40) + " more", "日本語の文章です", "á 😀 b",
        *[prose(s, 30 + s) for s in range(10, 30)], *more]
    rows = [(i * 3, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}",
             None if t is None else len(t), None) for i, t in enumerate(texts)]
    return rows


def frame(spark, rows):
    """The rows, with extra columns whose names clash with words operators might use."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in ("n", "size", "start", "kind", "payload", "term", "fragment")})
