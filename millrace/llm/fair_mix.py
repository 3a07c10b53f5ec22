"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated as often as its target asks. A
document's virtual finish time is the source's cumulative tokens up to and including it, divided
by the source's target. The queues merge by finish time, and the merged order is cut at the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import outcome, slices, spare, stored, word_count

REPEATS = 3
WEIGHTS = (1, 2, 3)
# Cells of virtual time; only the rows of one cell need an exact order at the cut.
TIMES = 1 << 16


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The rows with their rank from 0 by a unique key in ascending order, nulls last.

    Ranges are sorted by themselves and start where the ones before them end.
    """
    parts = stored(rows.repartitionByRange(F.asc_nulls_last(key)).sortWithinPartitions(
        F.asc_nulls_last(key)).withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("_at", 33)
    sizes = parts.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return parts.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop(
        "_part", "_at", "_start")


def targets(sources: DataFrame, budget: float, repeats: int = REPEATS) -> DataFrame:
    """Adds `target`: the budget shared by `weight`, at most `repeats` times `source_size`.

    The excess over a limit is shared by weight among the others, until none is above its limit.
    """
    sources = stored(sources, "sources")
    limit = repeats * F.col("source_size")
    level = None
    while True:
        open_ = F.lit(True) if level is None else F.col("weight") * F.lit(level) < limit
        left = sources.agg(
            F.sum(F.when(open_, 0).otherwise(limit)).cast("double"),
            F.sum(F.when(open_, F.col("weight")).otherwise(0)).cast("double")).first()
        if not left[1]:
            break
        after = max(0.0, budget - left[0]) / left[1]
        if level is not None and after <= level * (1 + 1e-12):
            break
        level = after
    if level is None:
        return sources.withColumn("target", limit.cast("double"))
    return sources.withColumn("target", F.least(
        limit.cast("double"), F.col("weight") * F.lit(level)))


def schedule(docs: DataFrame, size: Column, repeats: int = REPEATS, weights=WEIGHTS,
             seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(rows, queue): rows are all documents with source and target; queue is a row for each time
    the mix takes a document, with its finish time. See `mix`."""
    n = slices(docs.sparkSession)
    rows = stored(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = F.array(*[F.lit(w) for w in weights])
    totals = numbered(totals, "source", "_rank").withColumn(
        "weight", F.get(every, (F.col("_rank") % len(weights)).cast("int"))).drop("_rank")
    budget = totals.agg(F.sum("source_size")).first()[0] or 0
    shares = stored(targets(totals, float(budget), repeats), "targets")
    joined = stored(rows.withColumnRenamed("source", "_s").join(
        shares, F.col("_s").eqNullSafe(F.col("source")), "left").drop("_s"), "mix-joined")
    # Each pass over a source has an order of its own, by a hash. A slice is a range of that hash,
    # so its start is the sum of the slices before it and no task holds a whole source.
    passes = F.sequence(F.lit(0), F.least(
        F.lit(repeats), F.ceil(F.col("target") / F.col("source_size"))).cast("int") - 1)
    queued = joined.where("size > 0 and target > 0").withColumn("_pass", F.explode(passes))
    key = F.xxhash64(F.lit(seed), F.col("_pass"), F.col("doc_id"), F.col("_text"))
    queued = queued.withColumn("_key", key).withColumn(
        "_slice", F.floor((F.shiftright("_key", 32) + (1 << 31)) * n / (1 << 32)))
    by = ["source", "_pass", "_slice"]
    sums = queued.groupBy(*by).agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_pass", "_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("_s"), F.col("_pass").alias("_p"),
                         F.col("_slice").alias("_l"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*by).orderBy("_key", "doc_id", "_text").rowsBetween(
        Window.unboundedPreceding, 0)
    queue = (queued.withColumn("_run", F.sum("size").over(inside))
             .join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_pass") == F.col("_p"))
                   & (F.col("_slice") == F.col("_l")))
             .withColumn("finish", (F.col("_start") + F.col("_run")) / F.col("target")))
    queue = stored(queue.select("doc_id", "source", "_text", "size", "_pass", "_key", "finish",
                                ), "queue")
    return joined, cut(queue, budget)


def cut(queue: DataFrame, budget: int) -> DataFrame:
    """The rows of `queue` in order of finish time, up to the one that reaches the budget."""
    cell = F.least(F.floor(F.col("finish") * TIMES), F.lit(16 * TIMES))
    cells = queue.groupBy(cell.alias("_cell")).agg(F.sum("size").alias("_sum"))
    order = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    edge = cells.select("_cell", "_sum", F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_b")
                        ).where((F.col("_b") < budget) & (F.col("_b") + F.col("_sum") >= budget)
                                ).agg(F.min("_cell"), F.min("_b")).first()
    if edge[0] is None:
        return queue
    # Within the cell of the cut the exact order decides. It holds a 65,536th of virtual time.
    inside = Window.orderBy("finish", "source", "_key", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)
    last = queue.where(cell == edge[0]).withColumn(
        "_b", F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.lit(edge[1])).where(
        F.col("_b") < budget).drop("_b")
    return queue.where(cell < edge[0]).unionByName(last)


def _times(rows: DataFrame, queue: DataFrame) -> DataFrame:
    """_d, _t, _s, _times, _rows: how often the mix takes the rows of a document, text and source. Equal
    rows queue side by side and share what was taken of them."""
    taken = queue.groupBy("doc_id", "_text", "source").agg(F.count(F.lit(1)).alias("_times"))
    copies = rows.groupBy("doc_id", "_text", "source").agg(F.count(F.lit(1)).alias("_rows"))
    return taken.join(copies, (taken.doc_id.eqNullSafe(copies.doc_id))
                      & (taken._text == copies._text) & taken.source.eqNullSafe(copies.source)
                      ).select(taken.doc_id.alias("_d"), taken._text.alias("_t"),
                               taken.source.alias("_s"), "_times", "_rows")


def mix(docs: DataFrame, repeats: int = REPEATS, weights=WEIGHTS, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of `docs`.

    size: words of the text, 0 for a null. Sources in the order of their code points, null last,
    weigh 1, 2, 3, 1, ... and share the sum of all sizes; a target is at most `repeats` times its
    source's size. taken: size times the number of times the mix takes the document; the order
    within a source is a hash of seed, pass and document, so reruns agree. Repeated rows count as
    rows of their own. Sources without words have target 0. An empty table gives no rows.
    """
    rows, queue = schedule(docs, word_count(F.col("text").cast("string")), repeats, weights, seed)
    taken = _times(rows, queue)
    alike = Window.partitionBy("doc_id", "_text", "source").orderBy("doc_id")
    return (rows.withColumn("_i", F.row_number().over(alike) - 1)
            .join(taken, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_text") == F.col("_t"))
                  & F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumn("_n", F.coalesce(
                F.floor((F.col("_times") + F.col("_rows") - 1 - F.col("_i")) / F.col("_rows")),
                F.lit(0)))
            .select("doc_id", "size", F.coalesce("source_size", F.lit(0)).cast("long").alias(
                        "source_size"), F.coalesce("target", F.lit(0.0)).alias("target"),
                    (F.col("size") * F.col("_n")).cast("long").alias("taken"), "source",
                    F.col("_n").cast("int").alias("times")))


def mixed(docs: DataFrame, repeats: int = REPEATS, weights=WEIGHTS, seed: int = 17) -> DataFrame:
    """The rows of `docs`, with all columns, each as often as the mix takes it.

    Rows of equal doc_id, text and source are repeated by their own shares, which differ by one at
    most; null ids are told apart by their text. Sizes are those of `mix`; rows that are not taken
    go. Columns may have any names.
    """
    doc, txt, source, times, rows_, own, again = spare(
        docs, "_d", "_t", "_s", "_times", "_rows", "_own", "_again")
    taken = outcome(docs.sparkSession, "taken", lambda: _times(*schedule(
        docs, word_count(F.col("text").cast("string")), repeats, weights, seed))
        ).toDF(doc, txt, source, times, rows_)
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(
        F.col("text").cast("string"), F.lit("")))).join(
        taken, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(txt))
        & F.col("source").cast("string").eqNullSafe(F.col(source)))
    alike = Window.partitionBy(doc, txt, source).orderBy(own)
    single = rows.where(F.col(rows_) == 1).withColumn(again, F.col(times))
    several = rows.where(F.col(rows_) > 1).withColumn(again, F.floor(
        (F.col(times) + F.col(rows_) - F.row_number().over(alike)) / F.col(rows_)))
    return single.unionByName(several).where(F.col(again) > 0).withColumn(again, F.explode(
        F.sequence(F.lit(1).cast("long"), F.col(again)))).select(*docs.columns)
