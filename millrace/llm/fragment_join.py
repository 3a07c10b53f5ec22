"""N-gram Jaccard join by vertical partitioning.

The global order of shingles is the order of their 64-bit hashes. It is cut into fragments, the
same for all documents of one size band, and a document's set falls into one segment per fragment.

* Candidates: two sets with Jaccard t or more differ in at most d = s (1 - t) / t shingles, s
  being the smaller size. With d + 1 + x fragments, at least 1 + x segments are therefore equal as
  a whole. So only documents that share a whole segment are compared. Nothing is lost, and a
  passage or shingle that thousands of documents have in common makes no pairs by itself.
* Overlaps: for each candidate pair the shared shingles are counted in every fragment separately
  and summed per pair; the sum decides exactly.

Documents with equal sets are one class before any of this, so copies are never paired up. Within
a segment's group each class is first compared to the group's hub, the class that has most in
common with others. After that only classes of different components are compared with each other.
Those that resemble one hub are compared if they share rare differences from the consensus of its
group, the others if they share one of their rarest segments. No link that could join two components
is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import outcome, release, stored
from millrace.llm.graph import components
from millrace.llm.hashing import U64, mix, shingle_sets, text_bytes

# Fragments in which overlaps are counted, cut by the first three bits of a hash; a row holds one
# document's segment.
COUNTED = 8
SIGNED = ("doc_id long, n long, s1 long, s2 long, band int, need_own int, need_below int, "
          "own int, signatures array<long>")
# Hubs that a set is tested against, and that it keeps of those it resembles.
TESTED, KEPT = 3, 2
# Members of a hub that share a row of its consensus: a hot hub is spread over many tasks.
SALT = 1024
SEGMENT = "doc_id long, fragment int, hashes array<long>"


@lru_cache(maxsize=None)
def bands(num: int, den: int, least: int) -> tuple[int, ...]:
    """First sizes of the bands, until `least` is passed. The larger set of a pair that reaches
    num/den is in the smaller one's band or in the next."""
    firsts = [1, 2]
    while firsts[-1] <= least:
        firsts.append(max(firsts[-1] + 1, (firsts[-1] - 1) * den // num + 1))
    return tuple(firsts)


@lru_cache(maxsize=None)
def fragments(num: int, den: int, band: int, top: int) -> tuple[int, int]:
    """How many fragments the pairs get whose smaller set is in the band, and how many segments
    that are equal at least. 0 fragments: only equal sets reach the threshold."""
    firsts = bands(num, den, top)
    differing = (firsts[band + 1] - 1) * (den - num) // num
    if not differing:
        return 0, 0
    base = differing + 1
    extra = 2 + math.ceil(3 * base * math.exp(-firsts[band] / base))
    return base + extra, 1 + extra


def band_of(n: int, num: int, den: int) -> tuple[int, int]:
    """A size's band, and a bound for the table of bands that holds it and the next."""
    top = 1 << max(8, (2 * n).bit_length() + 1)
    return int(np.searchsorted(bands(num, den, top), n, side="right")) - 1, top


def signatures(hashes: np.ndarray, num: int, den: int) -> tuple[int, list[int], np.ndarray, int]:
    """The band; for it and the one below, how many segments a linked partner has in common at
    least; for both a value for each of those segments; and how many of these are its own band's."""
    n = len(hashes)
    if not n:
        return 0, [1, 1], np.empty(0, U64), 0
    band, top = band_of(n, num, den)
    mixed, high = mix(hashes + U64(1)), (hashes >> U64(32))
    out, needs, own = [], [], 0
    for b in (band, band - 1):
        cut, equal = fragments(num, den, b, top) if b >= 0 else (0, 0)
        needs.append(1)
        if not cut:
            continue
        at = (high * U64(cut) >> U64(32)).astype(np.int64)
        begins = np.flatnonzero(np.diff(at, prepend=-1))
        there, total = at[begins], np.add.reduceat(mixed, begins)
        needs[-1] = max(equal - (cut - len(there)), 1)
        if cut - len(there) >= equal:  # so many are empty that those in common may all be
            full = np.zeros(cut, U64)
            full[there] = total
            there, total = np.arange(cut), full
        out.append(mix(total + mix(U64(cut) + (there.astype(U64) << U64(32)))))
        own += len(total) if b == band else 0
    return band, needs, np.concatenate(out) if out else np.empty(0, U64), own


def _sign(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in text_bytes(batch.column(1)):
                n, s1, s2, signs, bands_, needs, owns = [], [], [], [], [], [], []
                for hashes in shingle_sets(data, bounds, k):
                    n.append(len(hashes))
                    s1.append(mix(hashes).sum(dtype=U64))
                    s2.append(mix(hashes ^ U64(0x5555555555555555)).sum(dtype=U64))
                    band, need, values, own = signatures(hashes, num, den)
                    bands_.append(band)
                    needs.append(need)
                    owns.append(own)
                    signs.append(values)
                ends = np.cumsum([0] + [len(x) for x in signs], dtype=np.int32)
                flat = np.concatenate(signs) if signs else np.empty(0, U64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(n)), pa.array(n, pa.int64()),
                    pa.array(np.array(s1, U64).view(np.int64)),
                    pa.array(np.array(s2, U64).view(np.int64)), pa.array(bands_, pa.int32()),
                    *(pa.array([x[i] for x in needs], pa.int32()) for i in (0, 1)),
                    pa.array(owns, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
                    names=["doc_id", "n", "s1", "s2", "band", "need_own", "need_below", "own",
                           "signatures"])
    return run


def _cut(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in text_bytes(batch.column(1)):
                doc, fragment, ends, parts = [], [], [0], []
                for i, hashes in enumerate(shingle_sets(data, bounds, k)):
                    at = (hashes >> U64(61)).astype(np.int64)
                    doc += [row + i] * COUNTED
                    fragment += range(COUNTED)
                    ends += (ends[-1] + np.searchsorted(at, np.arange(1, COUNTED + 1))).tolist()
                    parts.append(hashes)
                flat = np.concatenate(parts) if parts else np.empty(0, U64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(doc, pa.int64())),
                    pa.array(fragment, pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))],
                    names=["doc_id", "fragment", "hashes"])
    return run


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) with the number of shared shingles, counted by fragment and summed."""
    left = segments.select(F.col("doc_id").alias("a"), "fragment", F.col("hashes").alias("_a"))
    right = segments.select(F.col("doc_id").alias("b"), "fragment", F.col("hashes").alias("_b"))
    counted = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "n_a", "n_b", "fragment",
        F.size(F.array_intersect("_a", "_b")).cast("long").alias("_shared"))
    # A document whose row is repeated has its segments twice: the maximum counts them once.
    return (counted.groupBy("a", "b", "n_a", "n_b", "fragment").agg(
                F.max("_shared").alias("_shared"))
            .groupBy("a", "b", "n_a", "n_b").agg(F.sum("_shared").alias("shared")))


def _reach(num: int, den: int) -> Column:
    return F.col("shared") * den >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * num


def _sized(pairs: DataFrame, about: DataFrame, num: int, den: int) -> DataFrame:
    """a, b, n_a, n_b of the pairs (a, b) whose sizes allow a link."""
    sizes = about.select("rep", "n")
    return (pairs.join(sizes.withColumnsRenamed({"rep": "a", "n": "n_a"}), "a")
            .join(sizes.withColumnsRenamed({"rep": "b", "n": "n_b"}), "b")
            .where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
            .select("a", "b", "n_a", "n_b"))


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "c", F.coalesce("component", "rep")).drop("component")


def _sharing(pairs: DataFrame, members: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) that have as many segments in common as a link of either needs at least.

    Texts with a frequent line meet in its segment, each with all others, but hardly in a second one;
    so they go before their sets are cut and their overlaps counted.
    """
    held = members.groupBy("rep").agg(F.collect_set("sign").alias("held")).join(about.select(
        "rep", F.least("need_own", "need_below").alias("need")), "rep")

    def side(x: str) -> DataFrame:
        return held.withColumnsRenamed({"rep": x, "held": f"held_{x}", "need": f"need_{x}"})
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.size(F.array_intersect("held_a", "held_b")) >= F.greatest("need_a", "need_b")).select(
        pairs.columns)


def _kept(near: DataFrame, about: DataFrame) -> DataFrame:
    """Stored: hub, rep, n: of the hubs that a set is near to, the KEPT most popular. Versions of one
    text are near to many hubs, and mostly to the same most popular ones."""
    hubs = about.select(F.col("rep").alias("hub"), "popular")
    return stored(near.select(F.col("a").alias("hub"), F.col("b").alias("rep"), F.col("n_b").alias(
        "n")).join(hubs, "hub").groupBy("rep", "n").agg(F.slice(F.array_sort(F.collect_list(
            F.struct((-F.col("popular")).alias("p"), "hub"))), 1, KEPT).alias("hubs")).select(
        F.explode("hubs.hub").alias("hub"), "rep", "n"), "kept")


def _elsewhere(starred: DataFrame, kept: DataFrame, about: DataFrame, found: DataFrame,
               num: int, den: int) -> DataFrame:
    """Candidates of different components that have no hub in common, by the segments they meet in.

    Linked sets share `need` segments of a band, hence one of the rarest (count - need + 1) of each
    of them. So a passage of many short texts, whose segments are frequent, makes no pairs. In each
    segment's group only those without the hub that most of the group has are paired up.
    """
    rarest = Window.partitionBy("rep", "below").orderBy("_m", "sign")
    need = F.when(F.col("below"), F.col("need_below")).otherwise(F.col("need_own"))
    size = F.when(F.col("below"), F.col("count") - F.col("own")).otherwise(F.col("own"))
    # Segments that no one shares are the rarest: they come before those that are listed here.
    listed = Window.partitionBy("rep", "below")
    cut = (starred.join(about.select("rep", "need_own", "need_below", "own", "count"), "rep")
           .withColumn("_at", F.row_number().over(rarest)
                       + size - F.count(F.lit(1)).over(listed))
           .where(F.col("_at") <= size - need + 1).select("sign", "rep"))
    hubs = kept.groupBy("rep").agg(F.collect_list("hub").alias("hubs"))
    placed = stored(_with_component(cut, found).join(hubs, "rep", "left").withColumn(
        "hubs", F.concat(F.coalesce("hubs", F.array().cast("array<bigint>")), F.array("rep"))),
        "placed")
    split = placed.groupBy("sign").agg(F.min("c").alias("_x"), F.max("c").alias("_y")).where(
        "_x < _y").select("sign")
    main = placed.select("sign", F.explode("hubs").alias("hub")).groupBy("sign", "hub").agg(
        F.count(F.lit(1)).alias("_k")).groupBy("sign").agg(F.max_by(
            "hub", F.struct("_k", F.col("hub"))).alias("main"))
    opened = stored(placed.join(main, "sign").where(~F.array_contains("hubs", F.col("main"))).join(
        split, "sign", "left_semi").select("sign", F.col("rep").alias("a"), F.col("c").alias("_c"),
                                           F.col("hubs").alias("_h")), "open")
    others = placed.select("sign", F.col("rep").alias("b"), F.col("c").alias("_d"),
                           F.col("hubs").alias("_i"))
    met = opened.join(others, "sign").where(
        (F.col("_c") != F.col("_d")) & ~F.arrays_overlap("_h", "_i")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return _sized(met, about, num, den)


def _from_consensus(around: DataFrame, segments: DataFrame) -> DataFrame:
    """Stored: hub, rep, salts, fragment, edits: what each member of a hub's group differs by from the
    consensus, the elements that more than half of the members hold."""
    left = segments.select(F.col("doc_id").alias("hub"), "fragment", F.col("hashes").alias("_h"))
    right = segments.select(F.col("doc_id").alias("rep"), "fragment", F.col("hashes").alias("_r"))
    sizes = around.groupBy("hub").agg(F.count(F.lit(1)).alias("members"))
    # A document whose row is repeated has its segments twice.
    differing = stored(
        around.select("hub", "rep").join(sizes, "hub").join(left.dropDuplicates(["hub", "fragment"]),
                                                            "hub")
        .join(right.dropDuplicates(["rep", "fragment"]), ["rep", "fragment"]).select(
            "hub", "rep", "fragment", "members", F.concat(
                F.array_except("_h", "_r"), F.array_except("_r", "_h")).alias("edits")), "differing")
    salts = F.floor(F.col("members") / SALT).cast("int")
    flips = differing.select("hub", "fragment", "members", F.explode("edits").alias("element")).groupBy(
        "hub", "fragment", "element").agg(
        F.count(F.lit(1)).alias("_f"), F.first("members").alias("members")).where(
        2 * F.col("_f") > F.col("members")).groupBy("hub", "fragment").agg(
        F.collect_list("element").alias("flips"), F.first("members").alias("members"))
    flips = flips.select("hub", "fragment", "flips", F.explode(
        F.sequence(F.lit(0), salts)).alias("salt"))
    none = F.array().cast("array<bigint>")
    return stored(differing.withColumn("salt", F.pmod(F.xxhash64("rep"), salts + 1).cast("int")).join(
        flips, ["hub", "fragment", "salt"], "left").withColumn(
        "flips", F.coalesce("flips", none)).select("hub", "rep", "fragment", F.concat(
            F.array_except("edits", "flips"), F.array_except("flips", "edits")).alias("edits")),
        "edits")


def _around_hubs(kept: DataFrame, segments: DataFrame, found: DataFrame, num: int,
                 den: int) -> DataFrame:
    """Candidates of different components that have a hub in common.

    Versions of one text all resemble its hub, so they meet in many segments, though few of them
    are linked. What a set differs by from the consensus of the group tells them apart: with E(x) the
    symmetric difference of x and the consensus, |E(x) ^ E(y)| = |x ^ y|, and a link allows at most
    D = (|x| + |y|) (den - num) / (den + num) of that. So x and y share (|E(x)| + |E(y)| - D) / 2
    elements of their differences. Where that is above 0, then, ordered by how rare the elements are
    around the hub, the first |E(x)| - shared + 1 of each have one in common, and after it each has
    enough left. Partners are taken by classes of |E(y)| at most a twentieth apart. Where it is not
    above 0 the pair is linked for certain; so are both with the member nearest to the consensus.
    """
    steps = [0, 1]
    while steps[-1] < 1 << 40:
        steps.append(max(steps[-1] + 1, steps[-1] * 21 // 20))
    table = F.lit(steps)

    def class_of(e: Column) -> Column:
        return F.size(F.filter(table, lambda s: s <= e)) - 1

    placed = _with_component(kept, found)
    mixed = placed.groupBy("hub").agg(F.min("c").alias("_x"), F.max("c").alias("_y")).where(
        "_x < _y").select("hub")
    around = stored(placed.join(mixed, "hub", "left_semi"), "around")
    edits = _from_consensus(around, segments)
    sizes = edits.groupBy("hub", "rep").agg(F.sum(F.size("edits")).alias("e"))
    members = stored(around.join(sizes, ["hub", "rep"]).withColumn(
        "slack", F.col("e") * (den + num) - F.col("n") * (den - num)), "members")
    # Links for certain, each by the nearest member.
    best = members.groupBy("hub").agg(F.min(F.struct("slack", "rep", "n", "c")).alias("m"))
    sure = members.join(best, "hub").where(
        (F.col("slack") + F.col("m.slack") <= 0) & (F.col("rep") != F.col("m.rep"))
        & (F.col("c") != F.col("m.c"))).select(
        F.least("rep", "m.rep").alias("a"), F.greatest("rep", "m.rep").alias("b"),
        F.when(F.col("rep") < F.col("m.rep"), F.col("n")).otherwise(F.col("m.n")).alias("n_a"),
        F.when(F.col("rep") < F.col("m.rep"), F.col("m.n")).otherwise(F.col("n")).alias("n_b"))
    # Elements that one member has alone are the rarest of its differences and never shared.
    one = edits.select("hub", "rep", F.explode("edits").alias("element"))
    common = one.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1")
    rare = stored(one.join(common, ["hub", "element"]), "rare")
    by_rarity = Window.partitionBy("hub", "rep").orderBy("_f", "element")
    every = Window.partitionBy("hub", "rep")
    most = F.floor(F.col("n") * (den - num) / num)
    span = members.groupBy("hub").agg(F.min("e").alias("_low"), F.max("e").alias("_top"))
    shared = F.greatest(F.ceil((F.col("e") + F.get(table, F.col("other")) - most) / 2), F.lit(1))
    members = (members.join(span, "hub").withColumns({
        "own": class_of(F.col("e")),
        "other": F.explode(F.sequence(
            class_of(F.greatest(F.col("e") - most, F.col("_low"))),
            class_of(F.least(F.col("e") + most, F.col("_top")))))})
        .withColumn("prefix", F.col("e") - shared + 1).where("prefix > 0")
        .groupBy("hub", "rep", "n", "c", "e", "own").agg(
            F.collect_list(F.struct("other", "prefix")).alias("others"),
            F.max("prefix").alias("longest")))
    ranked = (rare.join(members, ["hub", "rep"])
              .withColumn("_at", F.row_number().over(by_rarity)
                          + F.col("e") - F.count(F.lit(1)).over(every))
              .where("_at <= longest")
              .withColumn("other", F.explode(F.filter(
                  "others", lambda o: o["prefix"] >= F.col("_at"))))
              .select("hub", "element", "rep", "n", "c", "e", "_at", "own", F.col("other.other")))
    keyed = stored(ranked, "keyed")

    def side(x: str, own: str, other: str) -> DataFrame:
        return keyed.select("hub", "element", F.col("rep").alias(x), *(
            F.col(c).alias(f"{c}_{x}") for c in ("n", "c", "e", "_at")),
            F.col("own").alias(own), F.col("other").alias(other))
    allowed = F.floor((F.col("n_a") + F.col("n_b")) * (den - num) / (den + num))
    need = F.ceil((F.col("e_a") + F.col("e_b") - allowed) / 2)
    left = 1 + F.least(F.col("e_a") - F.col("_at_a"), F.col("e_b") - F.col("_at_b"))
    met = (side("a", "_k", "_l").join(side("b", "_l", "_k"), ["hub", "element", "_k", "_l"])
           .where("a < b and c_a <> c_b")
           .where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
           .where(left >= need).select("a", "b", "n_a", "n_b"))
    return met.union(sure)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Components of documents whose k-word shingle sets have Jaccard num/den or more.

    One row per row of `docs` (doc_id, text; other columns are ignored): doc_id, n_shingles,
    component_id, the least doc_id reachable by links. A null, empty or blank text has no shingles
    and is linked with nothing. A text of fewer than k words is one shingle. doc_id identifies a
    document: repeated rows are one document and give equal rows. A null doc_id takes no part and
    has a null component_id. An empty table gives no rows. Texts of any length are read whole.
    """
    return outcome(docs.sparkSession, "duplicates", lambda: _classes(docs, k, num, den))


def _classes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_sign(k, num, den), SIGNED), "signed")
    about = ["doc_id", "n", "s1", "s2"]
    classes = stored(signed.where("n > 0 and doc_id is not null").select(*about).groupBy(
        "s1", "s2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    copies = stored(signed.select(*about).join(classes, ["s1", "s2", "n"]).where(
        "doc_id <> rep").select("doc_id").distinct(), "copies")
    firsts = signed.where("n > 0 and doc_id is not null").join(
        copies, "doc_id", "left_anti").withColumnRenamed("doc_id", "rep")
    # The counts and the join with them read one and the same exchange, so both need all columns.
    signs = firsts.select("rep", "own", F.posexplode("signatures").alias("_p", "sign")).select(
        "rep", "sign", (F.col("_p") >= F.col("own")).alias("below")).repartition("sign")
    shared = signs.groupBy("sign").agg(
        F.count(F.lit(1)).alias("_m"), F.min("rep").alias("_x"), F.max("rep").alias("_y"),
        F.max("below").alias("_b")).where("_x < _y and _b is not null").select("sign", "_m")
    groups = stored(signs.join(shared, "sign"), "groups")
    # The class that has most in common with the others comes first: of several versions of one
    # text it is the least altered, to which the rest is linked if to anything.
    ranked = groups.groupBy("rep").agg(
        F.sum("_m").alias("popular"), F.count_if("below").alias("met_below"),
        F.count_if(~F.col("below")).alias("met_own"))
    # A linked set shares `need` segments with its partner alone; who shares fewer with all others
    # together has none there. So sets that meet by chance, more of them in larger corpora, go.
    about = stored(ranked.join(firsts.select(
        "rep", "n", "band", "need_own", "need_below", "own", F.size("signatures").alias("count")
    ).dropDuplicates(["rep"]), "rep").where(
        "met_own >= need_own or met_below >= need_below"), "about")
    sizes = stored(signed.select("doc_id", "n", "s1", "s2"), "sizes")
    members = stored(groups.join(about.select(
        "rep", "popular", "need_own", "need_below", "met_own", "met_below"), "rep").where(
        F.when(F.col("below"), F.col("met_below") >= F.col("need_below")).otherwise(
            F.col("met_own") >= F.col("need_own"))).select(
        "sign", "rep", "below", "_m", "popular"), "members")
    release(signed, copies, groups)

    def cut(pairs: DataFrame) -> DataFrame:
        """The segments of the documents in the pairs, from their texts."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        return stored(texts.join(stored(ids, "compared"), "doc_id", "left_semi").select(
            "doc_id", "text").mapInArrow(_cut(k), SEGMENT), "segments")

    hubs = members.groupBy("sign").agg(
        (-F.max(F.struct("popular", (-F.col("rep")).alias("_r")))["_r"]).alias("hub"))
    starred = stored(members.join(hubs, "sign").select("sign", "hub", "rep", "below", "_m"), "starred")
    # A set is tested against the hubs of most of its segments; other pairs are found below.
    closest = starred.where("hub <> rep").groupBy("hub", "rep").agg(
        F.count(F.lit(1)).alias("_k")).groupBy("rep").agg(F.slice(F.array_sort(F.collect_list(
            F.struct((-F.col("_k")).alias("k"), "hub"))), 1, TESTED).alias("hubs"))
    stars = stored(_sized(closest.select(F.explode("hubs.hub").alias("a"), F.col("rep").alias("b")),
                          about, num, den), "stars")
    segments = cut(stars)
    first = stored(overlaps(stars, segments), "first")
    release(stars)
    links = stored(first.where(_reach(num, den)).select("a", "b"), "links")
    found = components(links)
    kept = _kept(first.where(_reach(num, 2 * den)), about)
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    around = _around_hubs(kept, segments, found, num, den).distinct().join(
        tested, ["a", "b"], "left_anti")
    beside = stored(_sharing(_elsewhere(starred, kept, about, found, num, den).join(
        tested, ["a", "b"], "left_anti"), members, about), "beside")
    more = stored(overlaps(around, segments).union(overlaps(beside, cut(beside))).where(
        _reach(num, den)).select("a", "b"), "links")
    whole = components(links.union(more))
    named = classes.select("s1", "s2", "n", "rep").join(
        whole.withColumnRenamed("id", "rep"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    return sizes.join(named, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(),
               F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of `docs`, with all columns, of the least document of each component.

    Documents without words and rows with a null doc_id stay.
    """
    gone = outcome(docs.sparkSession, "copies", lambda: near_duplicates(docs, k, num, den).where(
        "component_id <> doc_id").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
