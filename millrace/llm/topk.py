"""Exact top-k search by tiled matrix products.

Queries are cut into blocks and vectors into shards of bounded size. Every (block, shard) tile is
one matrix product with a partial selection of the k best per query; the lists of a query are then
merged in a tree, a bounded number of them at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import stored

BLOCK, SHARD, FAN_IN, STEP = 4096, 4096, 16, 256
# Integers of products up to here are exact in double precision.
EXACT = 2 ** 53
MOST = 2 ** 63 - 1


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; beyond 64 bits they stay Python integers."""
    top = [float(np.abs(x).max(initial=0)) for x in (queries, vectors)]
    if top[0] * top[1] * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
             for x in (queries, vectors)]
    return whole[0] @ whole[1].T


def _tile(k: int, scale: float):
    def run(key, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("query_row", "query_id", "vec_id", "score")}
        if len(queries) and len(vectors):
            vectors = vectors.sort_values("id", ignore_index=True)
            ids = vectors["id"].to_numpy(np.int64)
            v = np.floor(scale * np.stack(vectors["v"].to_list()).astype(np.float64))
            for s in range(0, len(queries), STEP):
                part = queries.iloc[s:s + STEP]
                q = np.floor(scale * np.stack(part["v"].to_list()).astype(np.float64))
                scores = _scores(q, v)
                own = part["id"].to_numpy(np.int64)
                for i in range(len(part)):
                    row = scores[i]
                    at = np.flatnonzero(ids != own[i])
                    if len(at) > k:
                        least = np.partition(row[at], len(at) - k)[len(at) - k]
                        at = at[row[at] >= least]
                    at = at[np.argsort(-row[at], kind="stable")[:k]]
                    out["query_row"] += [part["row"].iloc[i]] * len(at)
                    out["query_id"] += [own[i]] * len(at)
                    out["vec_id"] += ids[at].tolist()
                    out["score"] += [max(-MOST, min(MOST, int(x))) for x in row[at]]
        return pd.DataFrame(out).assign(shard=key[2]).astype(
            {c: "int64" for c in (*out, "shard")})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0,
          block: int = BLOCK, shard: int = SHARD, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner product.

    vectors: vec_id and embedding; a component x counts as floor(scale * x). Queries are the rows
    where `is_query` holds; candidates are all rows but those with the query's own id. Ties go to
    the smaller vec_id. Rows with a null id, a null or empty vector, or a null or non-finite
    component take no part; vectors are compared with vectors of their own length only. A repeated
    row is a candidate, and as a query gives the same list once. Fewer candidates give shorter
    lists; no query gives no rows. A score beyond 64 bits is shown as the nearest 64-bit number.

    Blocks and shards are drawn by a hash of the row's number, so none is much larger than asked,
    whichever ids repeat. A vector is sent once for each block of queries.
    """
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    rows = stored(vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("_q"), usable.alias("_ok")).where(
        "_ok and id is not null and size(v) > 0").select(
        "id", "v", "_q", F.size("v").alias("d"), F.monotonically_increasing_id().alias("row")),
        "vectors")
    counts = rows.groupBy("_q").agg(F.count(F.lit(1)).alias("n"))
    n = {r["_q"]: r["n"] for r in counts.collect()}
    blocks = max(1, math.ceil(n.get(True, 0) / block))
    shards = max(1, math.ceil(sum(n.values()) / shard))
    drawn = F.xxhash64("row")
    asked = (rows.where("_q").groupBy("id", "v", "d").agg(F.min("row").alias("row"))
             .withColumn("b", F.pmod(drawn, F.lit(blocks)).cast("int"))
             .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    held = (rows.select("id", "v", "d", F.pmod(drawn, F.lit(shards)).cast("int").alias("s"))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    lists = stored(
        asked.groupBy("d", "b", "s").cogroup(held.groupBy("d", "b", "s")).applyInPandas(
            _tile(k, scale),
            "query_row long, query_id long, vec_id long, score long, shard long"), "lists")
    best = F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("_minus"), "vec_id"))), 1, k)
    width = shards
    while True:
        # A list has k rows at most, so a merge gathers fan_in * k.
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in))
        width = math.ceil(width / fan_in)
        lists = lists.groupBy("query_row", "query_id", "shard").agg(best.alias("_l")).select(
            "query_row", "query_id", "shard", F.posexplode("_l").alias("_i", "_x")).select(
            "query_row", "query_id", "shard", "_i", F.col("_x.vec_id").alias("vec_id"),
            (-F.col("_x._minus")).alias("score"))
        if width <= 1:
            break
    return lists.select("query_id", (F.col("_i") + 1).alias("rank"), "vec_id", "score")
