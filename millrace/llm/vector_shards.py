"""Vector bin packing of documents into shards, by bytes, tokens and rows at once.

Equal texts are one group and stay together. A group that is large in some dimension is an item of
its own; the others are put into cells by a hash of their text. Items are placed from the largest
to the smallest, each into the shard where the dot product of its vector with the shard's residual
capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import positions, stored, text_of, word_count

# Cells for each shard, and so the largest share of a shard that an item without a group of its
# own has on average: 1/256. At most 3 * CELLS * shards groups can be larger than that.
CELLS = 256


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (a row of sizes). The work is bounded by the number of items."""
    total = items.sum(0)
    weight = items / np.where(total > 0, total, 1) * shards
    residual = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), np.int64)
    for i in np.argsort(-weight.max(1), kind="stable"):
        out[i] = np.argmax(residual @ weight[i])
        residual[out[i]] -= weight[i]
    return out


def pack_shards(docs: DataFrame, shards: int, cells: int = CELLS) -> DataFrame:
    """doc_id, size, tokens, text_crc32, shard and slot of every row of `docs`.

    size: UTF-8 bytes plus 1; tokens: words. A null text is empty, and all empty texts are a group.
    slot counts from 0 in each shard without gaps. Repeated rows are rows of their own, in one
    shard. A group cannot be split, so one with more than a shard's share makes its shard larger.
    To the driver go at most cells * shards sums of small groups and 3 * cells * shards large
    groups, whatever the number of rows.
    """
    spark, n = docs.sparkSession, cells * shards
    text = text_of().cast("string")
    rows = stored(docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        word_count(text).alias("tokens"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text")), "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
            F.sum(F.lit(1)).alias("rows")]
    groups = stored(rows.groupBy("_text").agg(*sums), "text-groups")
    total = groups.agg(F.sum("bytes"), F.sum("tokens"), F.sum("rows")).first()
    large = F.lit(False)
    for name, whole in zip(("bytes", "tokens", "rows"), total, strict=True):
        large = large | (F.col(name) * n > F.lit(whole or 0))
    cell = F.pmod("_text", F.lit(n))
    items = groups.select(
        F.when(large, F.col("_text")).alias("_own"), F.when(~large, cell).alias("_cell"),
        "bytes", "tokens", "rows").groupBy("_own", "_cell").agg(
        *(F.sum(c).alias(c) for c in ("bytes", "tokens", "rows"))).toPandas()
    items = items.sort_values(["_own", "_cell"], ignore_index=True)
    items["shard"] = place(items[["bytes", "tokens", "rows"]].to_numpy(float), shards)
    cut = "_own bigint, _cell bigint, shard int"
    placed = spark.createDataFrame(
        [(None if o != o or o is None else int(o), None if c != c or c is None else int(c), int(s))
         for o, c, s in items[["_own", "_cell", "shard"]].astype(object).itertuples(index=False)],
        cut)
    own = F.broadcast(placed.where("_own is not null").select("_own", F.col("shard").alias("_a")))
    small = F.broadcast(placed.where("_cell is not null").select("_cell", F.col("shard").alias("_b")))
    sharded = (rows.withColumn("_cell", cell)
               .join(own, F.col("_text") == F.col("_own"), "left").join(small, "_cell", "left")
               .select("doc_id", "size", "tokens", "text_crc32", "_text",
                       F.coalesce("_a", "_b").alias("shard")))
    return positions(stored(sharded, "sharded"), "shard", ["doc_id", "_text"], "slot").drop("_text")
