"""Spelling variants by a dictionary of pairs of trie nodes.

All words stand in a trie, and reversed in a second one; the nodes of both are numbered. A cut of a
word at place i is a pair of integers, the node of what lies before and the node of what lies after.
Leaving out the letter at i gives another pair. Two words differ by a replaced letter when they
have a pair with a letter left out in common, and by an inserted one when such a pair of the longer
is a plain cut of the shorter. A group of words with one pair is thus never larger than the alphabet
(90 letters) plus one word, and every near pair is met in one group exactly.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import small_batches, stored
from millrace.llm.divergence import pieces

# Items of a block; the nodes of a word of n letters take about log n / log WIDTH rounds.
WIDTH = 16
# Nodes this near to the root are shared by many words: their rows are salted.
NEAR_ROOT, SALT = 3, 16
# Different words a task holds before it hands them on.
HELD = 1 << 19

# Letters: a-z, A-Z (lower-cased) and U+00C0 to U+00FF, one byte each in Latin-1.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32
                 for c in range(256))


def _runs(least: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w, n in total.items() if n and len(w) >= least]
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in words], pa.string()),
                 pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc, text in zip(ids, batch.column(1)):
                before = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                plain = (text.as_py() or "").encode("latin-1", "replace").translate(_LETTERS)
                for part in pieces(plain):
                    words = [w for w in part.split() if len(w) >= least]
                    total.update(words)
                    for w in set(words):
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), before)
                        if h % one_in == 0:
                            i, n = h % len(w), words.count(w)
                            total[w] -= n
                            total[w[:i] + w[i + 1:]] += n
                    if len(total) > HELD:
                        yield flush()
        yield flush()
    return run


def words_of(docs: DataFrame, least: int, occurrences: int, one_in: int) -> DataFrame:
    """Stored: id, word, n. Ids follow the order of the words' bytes, which is that of code points."""
    with small_batches(docs.sparkSession):
        counts = stored(docs.select(
            F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")
        ).mapInArrow(_runs(least, one_in), "word string, n long").groupBy("word").agg(
            F.sum("n").alias("n")).where(F.col("n") >= occurrences), "counted")
    return stored(counts.orderBy("word").select(
        F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def _numbered(keys: DataFrame, name: str) -> DataFrame:
    """The distinct rows, each with a number of its own; written, so that it stays the same."""
    return stored(keys.distinct().withColumn(name, F.monotonically_increasing_id()), name)


def trie_nodes(words: DataFrame) -> DataFrame:
    """Stored: id, depth, node of every prefix, the empty one included, of `words` (id, items).

    A prefix is numbered as the node of its whole blocks of WIDTH items and the items after them.
    Nodes of whole blocks come from the same function over the numbers of the blocks, so the rows
    stay in proportion to the letters however long a word is, and rounds grow with its logarithm.
    """
    size = F.size("items")
    heads = words.select("id", F.explode(F.transform(
        F.sequence(F.lit(0), size), lambda d: F.struct(
            d.alias("depth"), F.floor(d / WIDTH).cast("int").alias("blocks"),
            F.array_join(F.slice("items", F.floor(d / WIDTH).cast("int") * WIDTH + 1, d % WIDTH), " ")
            .alias("rest")))).alias("h")).select("id", "h.*")
    whole = words.where(size >= WIDTH)
    if whole.isEmpty():
        heads = heads.withColumn("above", F.lit(-1).cast("long"))
    else:
        blocks = stored(whole.select("id", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor(size / WIDTH).cast("int") - 1),
            lambda b: F.array_join(F.slice("items", b * WIDTH + 1, F.lit(WIDTH)), " "))).alias(
            "b", "block")), "blocks")
        named = blocks.join(_numbered(blocks.select("block"), "code"), "block").groupBy("id").agg(
            F.array_sort(F.collect_list(F.struct("b", F.col("code").cast("string").alias("c"))))
            .alias("items"))
        above = trie_nodes(named.select("id", F.col("items.c").alias("items")))
        heads = heads.join(above.where("depth > 0").select(
            "id", F.col("depth").alias("blocks"), F.col("node").alias("above")),
            ["id", "blocks"], "left").withColumn(
            "above", F.when(F.col("blocks") > 0, F.col("above")).otherwise(F.lit(-1)))
    heads = stored(heads.select("id", "depth", "above", "rest"), "prefixes")
    nodes = _numbered(heads.select("above", "rest", "depth"), "node")
    salts = F.when(F.col("depth") <= NEAR_ROOT, F.lit(SALT)).otherwise(F.lit(1))
    return stored(heads.withColumn("salt", F.pmod(F.xxhash64("id"), salts)).join(
        nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))),
        ["above", "rest", "depth", "salt"]).select("id", "depth", "node"), "nodes")


def pair_groups(words: DataFrame) -> DataFrame:
    """skips, plain: of each pair of nodes the words that give it by leaving out a letter, the most
    frequent first, and the word that gives it whole. A word is (m, id, fresh): m is minus its count;
    not fresh when leaving out the letter before gives the same word."""
    letters = F.split("word", "")
    forward = trie_nodes(words.select("id", letters.alias("items")))
    backward = trie_nodes(words.select("id", F.reverse(letters).alias("items")))
    size = F.length("word")
    places = words.select("id", "n", size.alias("size"), F.posexplode(F.transform(
        F.sequence(F.lit(0), size), lambda i: (i == 0) | (
            F.get(letters, i) != F.get(letters, F.greatest(i - 1, F.lit(0)))))).alias("i", "fresh"))
    after = backward.join(words.select("id", size.alias("size")), "id").select(
        "id", F.col("node").alias("after"), F.explode(F.array(
            F.struct((F.col("size") - F.col("depth")).alias("i"), F.lit(False).alias("skip")),
            F.struct((F.col("size") - F.col("depth") - 1).alias("i"), F.lit(True).alias("skip")))
        ).alias("p")).select("id", "after", "p.*").where("i >= 0")
    pairs = (places.select("id", "i", "n", "fresh")
             .join(forward.select("id", F.col("depth").alias("i"), F.col("node").alias("before")),
                   ["id", "i"]).join(after, ["id", "i"]))
    word = F.struct((-F.col("n")).alias("m"), "id", "fresh")
    return pairs.groupBy("before", "after").agg(
        F.array_sort(F.collect_list(F.when(F.col("skip"), word))).alias("skips"),
        F.min(F.when(~F.col("skip"), word)).alias("plain")).where(
        F.size("skips") + F.col("plain").isNotNull().cast("int") > 1)


def _bare(word: Column) -> Column:
    return F.struct(word["m"].alias("m"), word["id"].alias("id"))


def neighbours(words: DataFrame) -> DataFrame:
    """Stored: id, n_near, best (m, id) of every word (id, word, n) that has a near one."""
    none = F.lit(None).cast("struct<m:bigint,id:bigint>")
    plain = F.col("plain")

    def of_skip(x: Column) -> Column:
        first = F.get("skips", F.lit(0))
        other = F.get("skips", F.when(first["id"] == x["id"], 1).otherwise(0))
        longer = x["fresh"] & plain.isNotNull()
        return F.struct(
            x["id"].alias("id"), (F.size("skips") - 1 + longer.cast("int")).alias("near"),
            F.least(F.when(other.isNotNull(), _bare(other)).otherwise(none),
                    F.when(longer, _bare(plain)).otherwise(none)).alias("best"))

    fresh = F.filter("skips", lambda x: x["fresh"])
    of_plain = F.struct(plain["id"].alias("id"), F.size(fresh).alias("near"), F.when(
        F.size(fresh) > 0, _bare(F.get(fresh, F.lit(0)))).otherwise(none).alias("best"))
    found = pair_groups(words).select(F.explode(F.concat(
        F.transform("skips", of_skip),
        F.when(plain.isNotNull(), F.array(of_plain)).otherwise(
            F.array().cast("array<struct<id:bigint,near:int,best:struct<m:bigint,id:bigint>>>"))
    )).alias("x")).select("x.*").where("near > 0")
    return stored(found.groupBy("id").agg(
        F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best")), "near")


def _roots(forms: DataFrame) -> DataFrame:
    """id, root: where the forms (id, form) lead. A form is several times as frequent as its word, so
    chains are short and have no cycles; each round doubles the steps taken."""
    now = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = now.join(now.select(F.col("id").alias("root"), F.col("root").alias("_next")),
                        "root", "left")
        after = stored(step.select("id", F.coalesce("_next", "root").alias("root"),
                                   F.col("_next").isNotNull().alias("moved")), "roots")
        now = after.select("id", "root")
        if after.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, least: int = 6, occurrences: int = 5, ratio: int = 5,
             one_in: int = 199) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of `docs` (doc_id, text), grouped by spelling.

    Words are runs of a-z, A-Z (lower-cased) and U+00C0 to U+00FF, of `least` letters or more, that
    occur `occurrences` times or more. Of the runs with a crc32 of `<doc_id>:<run>` divisible by
    `one_in` one letter is left out. n_near counts the words at one inserted, deleted or replaced
    letter. The form is the most frequent of them (ties: the first one), if `ratio` times as
    frequent or more; root is where forms lead in the end, or the word itself.

    A null text has no words; a null doc_id is written as nothing. Repeated rows count each.
    Other columns are ignored. An empty table gives no rows. Words and texts may be of any length.
    """
    words = words_of(docs, least, occurrences, one_in)
    near = words.join(neighbours(words), "id", "left")
    forms = stored(near.where(-F.col("best.m") >= ratio * F.col("n")).select(
        "id", F.col("best.id").alias("form"), (-F.col("best.m")).alias("form_n")), "forms")
    named = words.select("id", "word")
    led = (forms.join(_roots(forms), "id")
           .join(named.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
           .join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
           .select("id", "form_word", "root_word", "form_n"))
    return near.join(led, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
