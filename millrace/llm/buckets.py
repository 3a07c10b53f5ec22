"""Packing into optimal length buckets.

Documents become sequences of at most `longest` tokens. From the global histogram of sequence
lengths a dynamic programme chooses the bucket lengths that minimise padding. Inside a bucket,
batches hold as many sequences as a token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import positions, stored, text_of, word_count

LONGEST, BUCKETS, BUDGET = 2048, 16, 65_536


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The ascending bucket lengths of least total padding, at most `buckets` of them.

    A bucket ends at a length that occurs. lengths: ascending, distinct; counts: of each.
    """
    m = len(lengths)
    if not m:
        return []
    number = np.concatenate([[0], np.cumsum(counts)])
    # Padded tokens of one bucket over the lengths i..j-1: lengths[j - 1] * their number.
    best = np.concatenate([[0], lengths * number[1:]])
    back = [np.zeros(m + 1, np.int64)]
    for _ in range(1, min(buckets, m)):
        new, at = best.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (number[j] - number[:j])
            at[j] = np.argmin(cost)
            new[j] = cost[at[j]]
        best = new
        back.append(at)
    out, j = [], m
    for at in reversed(back):
        if not j:
            break
        out.append(int(lengths[j - 1]))
        j = int(at[j])
    return out[::-1]


def sequences(docs: DataFrame, tokens: Column, longest: int) -> DataFrame:
    """doc_id, sequence, first_token, length: each document cut into runs of `longest` tokens."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / longest).cast("long"))
    return (docs.select(F.col("doc_id"), F.xxhash64(text_of().cast("string")).alias("_text"),
                        tokens.cast("long").alias("_n")).where("_n > 0")
            .withColumn("sequence", F.explode(parts))
            .withColumn("first_token", F.col("sequence") * longest)
            .withColumn("length", F.least(F.lit(longest).cast("long"),
                                          F.col("_n") - F.col("first_token"))).drop("_n"))


def pack_buckets(docs: DataFrame, tokens: Column | None = None, longest: int = LONGEST,
                 buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, sequence, first_token, length, bucket_length, batch, slot, padding.

    tokens: the number of tokens of a row, by default its words. A row for every sequence; documents
    without tokens have none. batch counts from 0 within its bucket and holds
    budget / bucket_length sequences (one at least), in an order by a hash of the document; slot
    counts within the batch. Only the last batch of a bucket may be short. The histogram that
    reaches the driver has at most `longest` rows. Repeated rows are sequences of their own.
    """
    rows = stored(sequences(docs, word_count(F.col("text").cast("string"))
                            if tokens is None else tokens, longest), "sequences")
    histogram = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").toPandas()
    ends = boundaries(histogram["length"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64),
                      buckets)
    table = F.lit(ends) if ends else F.array().cast("array<int>")
    padded = F.array_min(F.filter(table, lambda e: e >= F.col("length"))).cast("long")
    placed = positions(rows.withColumn("bucket_length", padded), "bucket_length",
                       ["doc_id", "_text", "sequence"], "_at")
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_length")), F.lit(1))
    return placed.select(
        "doc_id", "sequence", "first_token", "length", "bucket_length",
        F.floor(F.col("_at") / room).alias("batch"), (F.col("_at") % room).cast("int").alias("slot"),
        (F.col("bucket_length") - F.col("length")).alias("padding"))
