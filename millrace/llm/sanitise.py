"""Information-theoretic sanitisation of personal data, in DataFrame expressions only.

Patterns find the protected entities: mail addresses, IP addresses, card and phone numbers. The
corpus then tells which other words give an entity away. For a term t in the context of mentions of
an entity c, over all distinct texts,

    disclosure = PMI(t; c) / IC(c),  PMI = log(N n(t, c) / (n(t) n(c))),  IC = log(N / n(c)),

is 1 for a word that is never used without the entity and 0 for one that is independent of it. A
term seen in at least `support` different contexts of an entity is generalised to its class from
`generalise` on and removed from `remove` on, wherever it occurs in any text: a text that does not
mention the entity is where the term would give it away.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import bound, outcome, spare, stored, text_of

# The patterns of the contract. Possessive repeats and starts at the beginning of a run match the
# same text as the plain forms, without trying every later start within a long run.
LOCAL = "[A-Za-z0-9._%+-]"
PART = "[A-Za-z0-9-]++"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{PART}(?:\.{PART})++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"
TERM = r"[\p{L}\p{N}]+"
EXTRA = "struct<start:bigint,kind:int,end:bigint,label:string>"
# Characters of a block of text, and items of a block of a running total.
BLOCK, STEP = 1024, 256
# Stands for the characters of a mention; no character, so texts have none of their own.
MASK = "\uffff"


@dataclass(frozen=True)
class Limits:
    """From where on a term counts as disclosing.

    context: characters on either side of a mention in which terms count as used with it; None is
    the whole text.
    """

    support: int = 3
    generalise: float = 0.8
    remove: float = 0.95
    context: int | None = 120


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of bigints: in blocks of STEP, each of which starts where the ones
    before end. An array that grows item by item is copied for each item, so it is kept short."""
    zero = F.lit(0).cast("long")

    def grown(start: Column, items: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))

        def step(state: Column, value: Column) -> Column:
            after = add(state["at"], value)
            return F.struct(after.alias("at"), F.concat(state["out"], F.array(after)).alias("out"))
        return F.aggregate(items, state, step, lambda state: state["out"])

    def run(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int")),
                             lambda g: F.slice(values, g * STEP + 1, F.lit(STEP)))

        def joined(both: Column) -> Column:
            return F.flatten(F.zip_with(
                F.concat(F.array(zero), both["s"]), both["b"], lambda start, block: F.when(
                    block.isNotNull(), grown(start, block)).otherwise(
                    F.array().cast("array<bigint>"))))
        totals = grown(zero, F.transform(blocks, lambda block: F.aggregate(block, zero, add)))
        return bound(F.struct(totals.alias("s"), blocks.alias("b")), joined)
    return F.when(F.size(values) > 0, bound(values, run)).otherwise(F.array().cast("array<bigint>"))


def _sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b)


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _part(blocks: Column, start: Column, length: Column) -> Column:
    """Characters of a text in blocks, without a search from its start. A length below 1: none."""
    first = F.floor(start / BLOCK).cast("int")
    within = (start % BLOCK).cast("int")
    length = F.greatest(length, F.lit(0)).cast("int")
    there = F.slice(blocks, first + 1, F.floor((within + length) / BLOCK).cast("int") + 1)
    return F.substring(F.array_join(there, ""), within + 1, length)


def _located(text: Column, pattern: str, item, kind: str) -> Column:
    """item(start, end, match) of every match, null items left out. The pieces between matches give
    the places: one pass, however many matches there are."""
    def found(both: Column) -> Column:
        lengths = F.zip_with(F.slice(both["p"], F.lit(1), F.size(both["m"])), both["m"],
                             lambda p, m: (F.length(p) + F.length(m)).cast("long"))
        items = F.zip_with(_sums(lengths), both["m"], lambda end, m: item(end - F.length(m), end, m))
        return F.filter(items, lambda x: x.isNotNull())

    def placed(matches: Column) -> Column:
        return F.when(F.size(matches) == 0, F.array().cast(f"array<{kind}>")).otherwise(
            bound(F.struct(matches.alias("m"), F.split(text, pattern, -1).alias("p")), found))
    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def base_spans(text: Column) -> Column:
    """All mentions, by start and then kind."""
    parts = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        def item(start, end, match, number=number, kind=kind):
            return F.when(_holds(kind, match), F.struct(
                start.cast("long").alias("start"), F.lit(number).alias("kind"),
                end.cast("long").alias("end"), match.alias("value")))
        spans = _located(text, pattern, item, SPAN)
        if kind == "email":
            spans = F.when(F.contains(text, F.lit("@")), spans).otherwise(
                F.array().cast(f"array<{SPAN}>"))
        parts.append(spans)
    return F.array_sort(F.concat(*parts))


def replaced(text: Column, spans: Column, new: Callable[[Column, Column], Column]) -> Column:
    """The text with new(span, from) in place of the characters of each span, spans sorted by start.
    from: where the spans before it end."""
    def build(x: Column) -> Column:
        def piece(span: Column, start: Column) -> Column:
            return F.concat(_part(x["b"], start, span["start"] - start), new(span, start))
        last = F.element_at(x["e"], -1)
        return F.concat(
            F.array_join(F.zip_with(x["s"], F.slice(x["e"], F.lit(1), F.size(x["s"])), piece), ""),
            _part(x["b"], last, F.length(text) - last))
    ends = F.concat(F.array(F.lit(0).cast("long")), _running(
        F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)))
    return F.when(F.size(spans) > 0, bound(F.struct(
        spans.alias("s"), ends.alias("e"), _blocks(text).alias("b")), build)).otherwise(text)


def mentions(docs: DataFrame) -> DataFrame:
    """Stored: doc_id, a hash of the text, and its base spans, for every row of `docs`."""
    return stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("txt"),
        base_spans(text_of().cast("string")).alias("base")), "mentions")


def _masked(text: Column, base: Column) -> Column:
    return replaced(F.translate(text, MASK, " "), base, lambda span, start: F.repeat(
        F.lit(MASK), F.greatest(span["end"] - F.greatest(span["start"], start), F.lit(0)).cast("int")))


def _whole_words(text: Column) -> Column:
    """Lower-cased words of a masked text that no mention touches."""
    return F.transform(F.filter(
        F.split(text, rf"[^\p{{L}}\p{{N}}{MASK}]+"),
        lambda w: (w != "") & ~F.contains(w, F.lit(MASK))), F.lower)


def _entity(mention: Column) -> Column:
    return F.concat(mention["kind"].cast("string"), F.lit(":"), F.when(
        mention["kind"] >= 2, F.regexp_replace(mention["value"], "[^0-9]", "")).otherwise(
        F.lower(mention["value"])))


def _context_terms(docs: DataFrame, found: DataFrame, reach: int | None) -> DataFrame:
    """txt, entity, context, term: every whole word used with every mention. Equal texts count once."""
    texts = docs.select(F.xxhash64(text_of()).alias("txt"), text_of().cast("string").alias("_text"))
    held = found.where(F.size("base") > 0).groupBy("txt").agg(F.first("base").alias("base"))
    rows = texts.join(held, "txt").dropDuplicates(["txt"]).select(
        "txt", "base", "_text", _masked(F.col("_text"), F.col("base")).alias("_masked"))
    if reach is None:
        return rows.select(
            "txt", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"),
            F.col("txt").alias("context"), F.array_distinct(_whole_words(F.col("_masked"))).alias("w")
        ).select("txt", "entity", "context", F.explode("w").alias("term"))
    word = rf"[\p{{L}}\p{{N}}{MASK}]+"

    def around(m: Column) -> Column:
        first = F.greatest(m["start"] - reach, F.lit(0))
        places = ((first, m["start"] - first), (m["end"], F.lit(reach)))
        (left, right), (plain, other) = (
            [_part(F.col(blocks), *place) for place in places] for blocks in ("_m", "_b"))
        # A word at the outer edge may go on beyond it.
        left = F.when(F.length(left) < reach, left).otherwise(
            F.regexp_replace(left, F.lit("^" + word), F.lit("")))
        right = F.when(F.length(right) < reach, right).otherwise(
            F.regexp_replace(right, F.lit(word + "$"), F.lit("")))
        return F.struct(_entity(m).alias("entity"), F.xxhash64(plain, other).alias("context"),
                        left.alias("left"), right.alias("right"))
    near = rows.select("txt", "base", _blocks(F.col("_text")).alias("_b"),
                       _blocks(F.col("_masked")).alias("_m")).select(
        "txt", F.explode(F.transform("base", around)).alias("m")).select("txt", "m.*")
    return near.select("txt", "entity", "context", F.explode(F.array_distinct(F.concat(
        _whole_words(F.col("left")), _whole_words(F.col("right"))))).alias("term"))


def corpus_words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, r"[^\p{L}\p{N}]+"), F.lower))


def disclosing(docs: DataFrame, found: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, txt, marks: of each text that holds disclosing terms these, with what to write there
    instead. A term that discloses several entities has the strictest label.

    Texts in which a term occurs near any entity are some of those in which it occurs, so they
    bound its disclosure from above. Only terms that pass by that bound are counted in the corpus.
    """
    n = float(found.agg(F.count_distinct("txt")).first()[0])

    def value(n_t: Column) -> Column:
        information = F.log2(F.lit(n) / F.col("n_c"))
        shared = F.log2(F.col("n_tc") * n / (n_t * F.col("n_c")))
        return F.when(information > 0, shared / information).otherwise(F.lit(0.0))

    terms = stored(_context_terms(docs, found, limits.context), "terms")
    pairs = terms.groupBy("entity", "term").agg(
        F.count_distinct("context").alias("_support"),
        F.count_distinct("txt").alias("n_tc")).where(F.col("_support") >= limits.support)
    entities = terms.groupBy("entity").agg(F.count_distinct("txt").alias("n_c"))
    nearby = terms.groupBy("term").agg(F.count_distinct("txt").alias("_near"))
    likely = stored(pairs.join(entities, "entity").join(nearby, "term").where(
        value(F.col("_near")) >= limits.generalise), "likely")
    used = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("txt"),
        F.explode(corpus_words(text_of())).alias("term")).join(
            likely.select("term").distinct(), "term", "left_semi"), "used")
    label = (F.when(F.col("disclosure") >= limits.remove, F.lit(""))
             .when(F.col("term").rlike(r"\p{N}"), F.lit("[NUMBER]")).otherwise(F.lit("[TERM]")))
    risky = stored(likely.join(used.groupBy("term").agg(F.count_distinct("txt").alias("n_t")), "term")
                   .withColumn("disclosure", value(F.col("n_t")))
                   .where(F.col("disclosure") >= limits.generalise)
                   .groupBy("term").agg(F.min(label).alias("label")), "risky")
    return used.join(risky, "term").groupBy("doc_id", "txt").agg(
        F.collect_set(F.struct("term", "label")).alias("marks"))


def term_spans(docs: DataFrame, found: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, txt, extra: the places of disclosing terms in all texts, with what to write there
    instead; those within mentions too."""
    marks = stored(disclosing(docs, found, limits), "marks").withColumnsRenamed(
        {"doc_id": "_d", "txt": "_t"})
    label = F.map_from_entries("marks")

    def item(start, end, match):
        new = F.try_element_at(label, F.lower(match))
        return F.when(new.isNotNull(), F.struct(
            start.cast("long").alias("start"), F.lit(len(PATTERNS)).alias("kind"),
            end.cast("long").alias("end"), new.alias("label")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text_of()).alias("txt"), text_of().cast("string").alias("_text"))
    return rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_d")) & (
        F.col("txt") == F.col("_t"))).select(
            "doc_id", "txt", _located(F.col("_text"), TERM, item, EXTRA).alias("extra")
        ).dropDuplicates(["doc_id", "txt"])


def _apart(extra: Column, base: Column) -> Column:
    """Those of the sorted spans `extra` that touch none of `base`: both are sorted, so of the mentions
    that start before a term ends only where they reach to is looked at."""
    def free(x: Column) -> Column:
        def before(place: Column) -> Column:
            """How many mentions start before a place: a binary search in as many steps as needed."""
            def step(state: Column, width: Column) -> Column:
                return F.when((state + width <= F.size(x["t"]))
                              & (F.get(x["t"], (state + width - 1).cast("int")) < place),
                              state + width).otherwise(state)
            return F.aggregate(F.lit([1 << i for i in range(25, -1, -1)]), F.lit(0), step)
        return F.filter(x["x"], lambda e: F.coalesce(F.get(
            x["r"], before(e["end"]) - 1), F.lit(0)) <= e["start"])
    starts = F.transform(base, lambda b: b["start"])
    reach = _running(F.transform(base, lambda b: b["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(base) == 0, extra).otherwise(bound(F.struct(
        extra.alias("x"), starts.alias("t"), reach.alias("r")), free))


def sanitised(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, txt (a hash of the text), base (array of mentions), extra (array of term spans).

    One row per row of `docs`; places are in code points, ends exclusive. A null or empty text has
    no spans. Repeated rows and copies count once in the statistics. An empty table gives no rows.
    Texts of any length take work in proportion to their length and their spans. Other columns are
    ignored, whatever their names.
    """
    found = mentions(docs)
    extra = term_spans(docs, found, limits)
    none = F.array().cast(f"array<{EXTRA}>")
    return found.join(
        extra.withColumnsRenamed({"doc_id": "_d", "txt": "_t"}),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("txt") == F.col("_t")), "left").select(
        "doc_id", "txt", "base", F.when(F.col("extra").isNull(), none).otherwise(
            _apart(F.col("extra"), F.col("base"))).alias("extra"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its label; overlapping spans become one."""
    return replaced(text, spans, lambda span, start: F.when(
        span["start"] >= start, span["label"]).otherwise(F.lit("")))


def sanitise(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs` with all columns, personal data and disclosing terms replaced.

    `n_chars`, where there is one, follows the new text. Rows without spans stay as they are. Columns
    may have any names. What is replaced goes by doc_id and text, so repeated rows fare alike.
    """
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in PATTERNS])
    spans = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.get(labels, s["kind"]).alias("label"))), F.col("extra")))
    doc, txt, places, own = spare(docs, "_id", "_txt", "_spans", "_hash")
    found = outcome(docs.sparkSession, "spans", lambda: (
        sanitised(docs, limits).where((F.size("base") > 0) | (F.size("extra") > 0))
        .select(F.col("doc_id").alias(doc), F.col("txt").alias(txt), spans.alias(places))
        .dropDuplicates([doc, txt])))
    rows = docs.withColumn(own, F.xxhash64(text_of())).join(
        found, F.col("doc_id").cast("long").eqNullSafe(F.col(doc))
        & (F.col(own) == F.col(txt)), "left")
    rows = rows.withColumn("text", F.when(
        F.col(places).isNotNull(), redacted(F.col("text"), F.col(places))).otherwise(
        F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(
            F.col(places).isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def digest(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts by kind, a hash of the base spans, and all spans as text. One row per row of `docs`."""
    rows = sanitised(docs, limits).withColumns({"_base": bare(F.col("base"))})
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(PATTERNS)]
    return rows.select(
        "doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("_base", bare(F.col("extra"))))).alias("spans"))
