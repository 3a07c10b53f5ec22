"""Audit of how far the sources of a language diverge, by a sparse merge for each pair of them.

Every source of a language, and the language itself, gives each kept term a smoothed share

    p = 1 + floor(scale (count + smooth) / (N + smooth V)),

V being the number of kept terms and N the sum of the counts over them; all arithmetic is exact. The
distance of two sources is the sum of |p - q| over all kept terms. No source is ever written out
over the whole vocabulary: a source is a sorted sparse array (term id, count). The unordered pairs of
sources are tasks. A task merges two arrays by a galloping intersection and prices the terms that
both have, those that one of them has and those that neither has; its sum serves both ways.

Arrays are cut into chunks of the vocabulary and sources are dealt to blocks, so a task holds a few
chunks of bounded size and a source is sent to one task for each block, not for each other source.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import small_batches, stored

# Terms of a chunk and sources of a block, about; both are dealt by hash.
CHUNK, BLOCK = 4096, 8
# Counts that a task holds before it hands them on, and bytes of text it splits at once.
HELD, PIECE = 1 << 19, 1 << 20
MOST_STEPS = 10 ** 15

# A term is a run of ASCII letters and of characters beyond ASCII, with only A-Z lower-cased.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in parts that end at a blank, `size` bytes or as few more as needed."""
    at = 0
    while at < len(text):
        end = len(text) if at + size >= len(text) else text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs: occurrences and texts, added up before the shuffle."""
    names = ["lang", "source", "term", "n", "docs"]
    total: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def flush():
        for (lang, source), (n, docs) in total.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()),
                 pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()),
                 pa.array([docs[t] for t in terms], pa.int64())], names=names)
        total.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.large_binary())):
            n, docs = total.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for part in pieces(text.as_py().translate(_TERMS)):
                words = part.split()
                n.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(seen)
            if held > HELD:
                held = sum(len(x) for x, _ in total.values())
                if held > HELD:
                    yield from flush()
                    held = 0
    yield from flush()


def term_counts(rows: DataFrame) -> DataFrame:
    """Stored: lang, source, term, n (occurrences), docs (rows that hold the term)."""
    return stored(rows.select("lang", "source", "text").mapInArrow(
        _count, "lang string, source string, term string, n long, docs long").groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")


def shares(count: np.ndarray, whole: int, smooth: int, scale: int) -> np.ndarray:
    """1 + floor(scale (count + smooth) / whole), by long division: nothing passes 64 bits."""
    if whole >= MOST_STEPS:
        raise ValueError("a group has too many terms for 64-bit arithmetic")
    left, digits, out = count.astype(np.int64) + smooth, scale, np.zeros(len(count), np.int64)
    whole = max(whole, 1)
    out += (left // whole) * scale
    left %= whole
    while digits > 1:
        step = min(1000, digits)
        if digits % step:
            raise ValueError("scale must be a power of 1000 times at most 1000")
        digits //= step
        left = left * step
        out += (left // whole) * digits
        left %= whole
    return out + 1


def share_column(count: str, whole: str, smooth: int, scale: int) -> Column:
    """The same in Spark, in whole decimals."""
    return F.expr(f"1 + ({scale} * cast({count} + {smooth} as decimal(19, 0))) div "
                  f"cast({whole} as decimal(19, 0))")


def merged(a: tuple, b: tuple, terms: int, smooth: int, scale: int) -> int:
    """Sum of |p - q| over a chunk of `terms` terms. a and b: (ids ascending, counts, N + smooth V).

    The shorter array gallops through the longer one: each of its ids is searched from where the
    one before was found. What it meets is an overlap, the rest of both is one-sided.
    """
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, n, whole), (others, m, other_whole) = a, b
    p, q = shares(n, whole, smooth, scale), shares(m, other_whole, smooth, scale)
    p0, q0 = (int(shares(np.zeros(1, np.int64), x, smooth, scale)[0]) for x in (whole, other_whole))
    at = np.searchsorted(others, ids)
    met = np.zeros(len(ids), bool)
    inside = at < len(others)
    met[inside] = others[at[inside]] == ids[inside]
    both = np.abs(p[met] - q[at[met]]).sum()
    one = np.abs(p[~met] - q0).sum()
    alone = np.ones(len(others), bool)
    alone[at[met]] = False
    two = np.abs(q[alone] - p0).sum()
    absent = terms - len(ids) - len(others) + int(met.sum())
    return int(both + one + two) + absent * abs(p0 - q0)


def _tasks(smooth: int, scale: int):
    def lists(table: pa.Table) -> list[tuple]:
        sources, wholes = table.column("source").to_pylist(), table.column("whole").to_pylist()
        out = []
        for source, whole, cells in zip(sources, wholes, table.column("cells").combine_chunks()):
            flat = cells.values
            out.append((source, (flat.field("id").to_numpy(), flat.field("n").to_numpy(), whole)))
        return out

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ones, others = lists(left), lists(right)
        lang = (left if left.num_rows else right).column("lang")[0].as_py()
        same = left.num_rows and left.column("i")[0].as_py() == left.column("j")[0].as_py()
        rows = []
        terms = left.column("terms")[0].as_py() if ones else 0
        for source, a in ones:
            for item, b in others:
                if not same or source < item:
                    rows.append((lang, source, item, merged(a, b, terms, smooth, scale)))
        return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(
            [("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("part", pa.int64())])})
    return run


def pair_distances(known: DataFrame, groups: DataFrame, chunks: DataFrame, smooth: int,
                   scale: int) -> DataFrame:
    """lang, a, b, value: of every unordered pair of sources of a language.

    known: lang, source, chunk, id, n. groups: lang, source, whole, blocks. chunks: lang, chunk, terms;
    each language has one at least.
    """
    cells = known.groupBy("lang", "source", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("id", "n"))).alias("cells"))
    grid = groups.join(chunks, "lang").join(cells, ["lang", "source", "chunk"], "left").select(
        "lang", "source", "whole", "blocks", "chunk", "terms",
        F.coalesce("cells", F.array().cast("array<struct<id:int,n:bigint>>")).alias("cells"),
        F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block"))
    grid = stored(grid, "grid")
    key = ["lang", "chunk", "i", "j"]

    def side(mine: str, other: str) -> DataFrame:
        span = (F.sequence("block", F.col("blocks") - 1) if mine == "i"
                else F.sequence(F.lit(0).cast("long"), F.col("block")))
        return grid.withColumn(mine, F.col("block")).withColumn(other, F.explode(span)).select(
            *key, "source", "whole", "terms", "cells")

    parts = side("i", "j").groupBy(*key).cogroup(side("j", "i").groupBy(*key)).applyInArrow(
        _tasks(smooth, scale), "lang string, a string, b string, part long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))


def divergence(docs: DataFrame, least: int = 30, smooth: int = 5, scale: int = 10 ** 9,
               top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: the sources of each language, by how they diverge.

    Part `pair`: each other source of the language with the distance to it, all ranks. Part `term`:
    the `top` terms that the source gives a larger share than its language does, with the excess.
    Equal values are ranked by item, in the order of its bytes.

    A null text, lang or source counts as ''. Each row is a document, repeated rows and null ids
    too. Kept are the terms in `least` documents of a language. A language without kept terms has
    pairs of value 0 and no terms; a source without terms has pairs like any other; a language of
    one source has no pairs. An empty table gives no rows. Other columns are ignored. Texts are read
    whole. The text of a term may be of any length.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")))
    with small_batches(docs.sparkSession):
        counts = term_counts(rows)
    kept = stored(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= least).select("lang", "term", "total"), "kept")
    langs = stored(rows.select("lang", "source").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("sources")).join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_all")),
        "lang", "left").na.fill(0, ["v", "n_all"]).select(
        "lang", "v", (F.col("n_all") + smooth * F.col("v")).alias("lang_whole"),
        F.greatest(F.ceil(F.col("v") / CHUNK), F.lit(1)).alias("cut"),
        F.ceil(F.col("sources") / BLOCK).alias("blocks")), "langs")
    within = Window.partitionBy("lang", "chunk").orderBy("term")
    terms = stored(kept.join(langs.select("lang", "cut"), "lang").withColumn(
        "chunk", F.pmod(F.xxhash64("term"), F.col("cut"))).select(
        "lang", "term", "total", "chunk", F.row_number().over(within).alias("id")), "terms")
    known = stored(counts.select("lang", "source", "term", "n").join(
        terms, ["lang", "term"]), "known")
    groups = stored(rows.select("lang", "source").distinct().join(
        known.groupBy("lang", "source").agg(F.sum("n").alias("n_own")), ["lang", "source"], "left")
        .join(langs, "lang").select(
        "lang", "source", "blocks", "v", "lang_whole",
        (F.coalesce("n_own", F.lit(0)) + smooth * F.col("v")).alias("whole")), "groups")
    chunks = langs.select("lang", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("cut") - 1)).alias("chunk")).join(
        terms.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("terms")),
        ["lang", "chunk"], "left").na.fill(0, ["terms"])
    pairs = stored(pair_distances(
        known.select("lang", "source", "chunk", "id", "n"),
        groups.select("lang", "source", "whole", "blocks"), chunks, smooth, scale), "pairs")
    ways = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("w"), "value")
    excess = known.select("lang", "source", "term", "n", "total").join(
        groups.select("lang", "source", "whole", "lang_whole"), ["lang", "source"]).withColumns({
            "p": share_column("n", "whole", smooth, scale),
            "q": share_column("total", "lang_whole", smooth, scale)}).where("n > 0 and p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(part: str, found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).select(
            "lang", "source", F.lit(part).alias("part"), "item",
            F.col("value").cast("long").alias("value"), "rank")
    best = excess.select("lang", "source", F.col("term").alias("item"), (
        F.col("p") - F.col("q")).alias("value"))
    return ranked("pair", ways.select("lang", "w.source", "w.item", "value")).union(
        ranked("term", best).where(F.col("rank") <= top))
