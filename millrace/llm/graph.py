"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import outcome, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Of undirected edges (a, b), the vertices with the smallest vertex they reach: id, component.

    Alternates large-star and small-star steps: every vertex hands its neighbours the least one
    it knows of, until the edges are stars around the least vertex. A step is a partial minimum
    and a join, so a hub's neighbours are never gathered. Each round is a stored table.
    Self-loops and repeated edges do no harm; nulls are dropped; no edges give no rows.
    """
    return outcome(edges.sparkSession, "components", lambda: _components(edges))


def _components(edges: DataFrame) -> DataFrame:
    now = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        now = stored(large, "edges-large")
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        small = (now.join(least, "u").where("v <> m").select(
                    F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        now = stored(small.distinct(), "edges-small")
        after = _state(now)
        if after == state:
            break
        state = after
    return (now.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())
