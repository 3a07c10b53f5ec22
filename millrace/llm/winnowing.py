"""Document fingerprints by winnowing, in DataFrame expressions only.

A fingerprint is chosen from the hashes of all k-word grams: of every `window` grams in a row the
least hash is kept, the rightmost one on ties, together with its position. Two texts that share a
run of at least window + k - 1 words share a kept hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import BLANK, bound, slices, text_of

K, WINDOW = 3, 6
# The gram hash is a polynomial over word hashes, modulo a prime below 2^31 so that no product
# leaves 64 bits.
PRIME, BASE = 2147483647, 1000003
LOW = (1 << 32) - 1
# Scripts written without blanks: each of their characters is a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsKhmer}\p{IsLao}\p{IsMyanmar}]"


def tokens(text: Column) -> Column:
    """Lower-cased words, in order."""
    low = F.lower(text)
    parts = F.when(low.rlike(UNSPACED), F.split(low, f"{BLANK}|(?={UNSPACED})|(?<={UNSPACED})")
                   ).otherwise(F.split(low, BLANK))
    return F.filter(parts, lambda w: w != "")


def _grams(words: Column, k: int) -> Column:
    """Rolling-hash values of the k-word grams; fewer words make one gram, none make none."""
    powers = [pow(BASE, k - 1 - j, PRIME) for j in range(k)]

    def one(values: Column) -> Column:
        def gram(first: Column, i: Column) -> Column:
            total = first * F.lit(powers[0]) % PRIME
            for j in range(1, k):
                total = (total + F.get(values, i + j) * F.lit(powers[j])) % PRIME
            return total
        return F.transform(F.slice(values, F.lit(1), F.size(values) - (k - 1)), gram)

    def all_of(w: Column) -> Column:
        hashed = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME)).cast("long"))
        short = F.pmod(F.xxhash64(F.array_join(w, " ")), F.lit(PRIME)).cast("long")
        return (F.when(F.size(w) >= k, bound(hashed, one))
                .when(F.size(w) > 0, F.array(short)).otherwise(F.array().cast("array<long>")))
    return bound(words, all_of)


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """array<long>, by position: the kept hash times 2^32, plus 2^32 - 1 minus its position."""
    def placed(grams: Column) -> Column:
        return F.transform(grams, lambda g, i: F.shiftleft(g, 32) + (F.lit(LOW) - i))

    def least(codes: Column) -> Column:
        # Where hashes tie the later position has the smaller code.
        windows = F.greatest(F.size(codes) - (window - 1), F.least(F.size(codes), F.lit(1)))
        return F.array_distinct(F.transform(
            F.slice(codes, F.lit(1), windows),
            lambda _, i: F.array_min(F.slice(codes, i + 1, F.lit(window)))))
    return bound(placed(_grams(tokens(text), k)), least)


def compact(codes: Column, window: int = WINDOW) -> Column:
    """The same fingerprint in little space: its hashes, and the step from one kept position to
    the next (from 0 to the first), which is never more than the window."""
    kind = "tinyint" if window < 128 else "int"

    def split(all_codes: Column) -> Column:
        # The second half of a code counts down, so a step is the earlier less the later one.
        steps = F.transform(all_codes, lambda c, i: (
            F.when(i == 0, F.lit(LOW)).otherwise(F.get(all_codes, i - 1).bitwiseAND(F.lit(LOW)))
            - c.bitwiseAND(F.lit(LOW))).cast(kind))
        return F.struct(F.transform(all_codes, lambda c: F.shiftright(c, 32).cast("int")).alias(
            "hashes"), steps.alias("steps"))
    return bound(codes, split)


def shown(print_: Column) -> Column:
    """hash:step, comma-joined, hashes in lower-case hex."""
    return bound(print_, lambda p: F.array_join(F.transform(p["hashes"], lambda h, i: F.concat(
        F.lower(F.hex(h)), F.lit(":"), F.get(p["steps"], i).cast("string"))), ","))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of hashes; 1 when both are empty."""
    def of(both: Column) -> Column:
        shared = F.size(F.array_intersect(both["a"], both["b"]))
        union = F.size(both["a"]) + F.size(both["b"]) - shared
        return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)
    return bound(F.struct(a.alias("a"), b.alias("b")), of)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` with `fingerprint`, array<long>; a null text counts as empty."""
    return docs.withColumn("fingerprint", fingerprint(text_of(), k, window))


def _bucket(key: Column, points: list[int]) -> Column:
    """How many of the ascending points are at most the key; -1 for a null key."""
    steps = [1 << i for i in range(len(points).bit_length() - 1, -1, -1)]
    table = F.lit(points) if points else F.array().cast("array<long>")
    found = F.aggregate(
        F.lit(steps), F.lit(0), lambda at, step: F.when(
            (at + step <= len(points)) & (F.get(table, at + step - 1) <= key), at + step
        ).otherwise(at))
    return F.when(key.isNull(), F.lit(-1)).otherwise(found)


def with_next(docs: DataFrame, payload: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text, payload and next (text, payload) of each row's next row by descending doc_id;
    the first row follows the last.

    Equal ids are ordered by text, null ids come last. The ids are cut at their quantiles into as
    many ranges as the session's shuffle needs, so a range holds a bounded share of the rows; each
    is ordered by itself, and the first row of every range (one text a range) is attached to the
    range before. A null text is an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_of().cast("string").alias("text"))
    n = slices(docs.sparkSession)
    points = rows.agg(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0] or []
    rows = rows.withColumn("_b", _bucket(F.col("doc_id"), sorted(set(points))))
    tops = rows.groupBy("_b").agg(F.max("doc_id").alias("_top"))
    heads = (rows.alias("r").join(F.broadcast(tops.alias("t")), (F.col("r._b") == F.col("t._b"))
                                  & F.col("doc_id").eqNullSafe(F.col("_top")))
             .groupBy(F.col("r._b").alias("_b")).agg(F.min("text").alias("text")))
    # One row a range: as many as there are quantiles.
    order = Window.orderBy(F.desc("_b"))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_b", F.struct("text", payload(F.col("text")).alias("payload")).alias("_h"))
    heads = heads.select("_b", F.coalesce(F.lead("_h").over(order), F.first("_h").over(every))
                         .alias("_head"))
    inside = Window.partitionBy("_b").orderBy(F.desc_nulls_last("doc_id"), "text")
    return (rows.withColumn("payload", payload(F.col("text")))
            .withColumn("_next", F.lead(F.struct("text", "payload")).over(inside))
            .join(heads, "_b").select(
                "doc_id", "text", "payload", F.coalesce("_next", "_head").alias("next")))


def edit_likeness(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text, of an edited form of it, and how alike they are.

    The edited form has its last third (rounded down) replaced by as many leading characters of
    the next text, or by all of it. One row per row of `docs`; see `with_next` for order and ties.
    A text without words has an empty fingerprint and is alike only to others of that kind.
    """
    def short(text: Column) -> Column:
        return compact(fingerprint(text, k, window), window)

    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = (with_next(docs, short).withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("_edited", F.concat(
                F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third),
                F.substring(F.col("next.text"), F.lit(1), third)))
            .withColumn("_new", short(F.col("_edited")))
            .withColumn("_own", F.array_distinct("payload.hashes")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        shown(F.col("payload")).alias("fingerprint"),
        shown(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.array_distinct("_new.hashes")).alias("near_edited"),
        likeness(F.col("_own"), F.array_distinct("next.payload.hashes")).alias("near_next"))
