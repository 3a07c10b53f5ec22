"""Packing, sharding, mixing, search and training order against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.buckets import boundaries, pack_buckets
from millrace.llm.fair_mix import mix, mixed, targets
from millrace.llm.topk import top_k
from millrace.llm.training_order import (
    END, VOCABULARY, feistel, materialise, read_slots, tokenizer, training_order)
from millrace.llm.vector_shards import pack_shards, place
from tests.llm.cases import documents, frame, prose


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


# --- buckets -----------------------------------------------------------------------------


def padding(ends, lengths, counts):
    return sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 8)))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 5)
        ends = boundaries(np.array(lengths), np.array(counts), k)
        best = min(padding((*some, lengths[-1]), lengths, counts)
                   for r in range(k) for some in itertools.combinations(lengths[:-1], r))
        assert len(ends) <= k and padding(ends, lengths, counts) == best
    assert boundaries(np.array([], int), np.array([], int), 3) == []


def test_batches(spark):
    rows = documents() + documents()[:9]
    got = pack_buckets(frame(spark, rows), longest=500, buckets=4, budget=1200).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        assert r.padding == r.bucket_length - r.length >= 0
    times = Counter(r[0] for r in rows)
    for i, text, *_ in documents():
        n = words(text)
        assert sum(r.length for r in pieces[i]) == n * times[i]
        assert {(r.sequence, r.first_token) for r in pieces[i]} == {
            (s, s * 500) for s in range(-(-n // 500))}
    batches = defaultdict(list)
    for r in got:
        batches[r.bucket_length, r.batch].append(r.slot)
    for (size, batch), slots in batches.items():
        room = max(1200 // size, 1)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        if (size, batch + 1) in batches:
            assert len(slots) == room
    assert pack_buckets(frame(spark, [])).collect() == []


# --- shards ------------------------------------------------------------------------------


def test_place_takes_the_largest_dot_product():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 100, (40, 3)).astype(float)
    got = place(items, 4)
    unit = items / items.sum(0) * 4
    left = np.ones((4, 3))
    for i in sorted(range(40), key=lambda i: -unit[i].max()):
        dots = [sum(a * b for a, b in zip(left[s], unit[i])) for s in range(4)]
        assert dots[got[i]] == pytest.approx(max(dots))
        left[got[i]] -= unit[i]


def test_shards(spark):
    rows = documents([prose(f"s{i}", 20 + i % 50) for i in range(600)]) * 2
    got = pack_shards(frame(spark, rows), 4, cells=64).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    where, slots, size = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.tokens == words(text[r.doc_id])
        where[text[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 4
    assert pack_shards(frame(spark, []), 4).collect() == []


def test_shards_are_nearly_equal(spark):
    rows = [(i, prose(f"e{i}", 30), None, None, None, None) for i in range(3000)]
    got = pack_shards(frame(spark, rows), 8)
    for c in (F.sum("size"), F.sum("tokens"), F.count("*")):
        sums = [r[1] for r in got.groupBy("shard").agg(c).collect()]
        assert max(sums) / min(sums) < 1.05


# --- mixing ------------------------------------------------------------------------------


def filled(sizes, weights, budget, repeats):
    capped = set()
    while True:
        free = [s for s in sizes if s not in capped]
        if not free:
            return {s: repeats * sizes[s] for s in sizes}
        left = budget - sum(repeats * sizes[s] for s in capped)
        level = max(left, 0) / sum(weights[s] for s in free)
        over = [s for s in free if weights[s] * level > repeats * sizes[s]]
        if not over:
            return {s: repeats * sizes[s] if s in capped else weights[s] * level for s in sizes}
        capped |= set(over)


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([1, 5, 50, 1000, 4000]) for i in range(7)}
        weights = {s: 1 + i % 3 for i, s in enumerate(sizes)}
        df = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()],
                                   "source string, source_size long, weight int")
        want = filled(sizes, weights, sum(sizes.values()), 3)
        got = {r.source: r.target for r in targets(df, float(sum(sizes.values()))).collect()}
        assert got == pytest.approx(want)


def test_mix(spark):
    rows = []
    for s, n in (("b", 400), ("a", 60), ("é", 200), (None, 150), ("Z", 10), ("empty", 3)):
        rows += [(len(rows) + i, "" if s == "empty" else prose(f"{s}{i}", 5 + i % 30), None, s, None,
                  None) for i in range(n)]
    rows += rows[:5]
    got = mix(frame(spark, rows)).collect()
    again = mix(frame(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert len(got) == len(rows)
    order = ["Z", "a", "b", "empty", "é", None]
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
    want = filled({s: sizes[s] for s in order}, {s: 1 + i % 3 for i, s in enumerate(order)},
                  sum(sizes.values()), 3)
    taken, size_of = Counter(), {r[0]: words(r[1]) for r in rows}
    for r in got:
        assert r.size == size_of[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 40 + 0.01 * want[s] for s in order)
    assert sum(taken.values()) - sum(sizes.values()) in range(0, 36)
    kept = mixed(frame(spark, rows[:-5]))
    assert kept.columns == frame(spark, rows[:1]).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {r.doc_id: r.times for r in mix(frame(spark, rows[:-5])).collect() if r.times})


def test_mix_of_nothing(spark):
    assert mix(frame(spark, [])).collect() == []
    blank = mix(frame(spark, [(1, None, None, "a", None, None)])).collect()
    assert [(r.size, r.taken) for r in blank] == [(0, 0)]
    assert mixed(frame(spark, documents())).count() > 0


# --- search ------------------------------------------------------------------------------


def brute_top(rows, k):
    def good(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v)
    rows = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and good(v)]
    out = set()
    for q, v in rows:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows
                            if i != q and len(w) == len(v))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(2).astype("f4").tolist()) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(400, None), (410, [None] * 8), (420, [float("nan")] + [1.0] * 7), (None, [1.0] * 8),
             (430, [float("inf")] * 8), (440, []), (450, [1.0, 2.0]), (451, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1))
    for block, shard in ((4096, 4096), (7, 50), (3, 9)):
        got = top_k(df, F.col("vec_id") % 10 == 0, 6, block=block, shard=shard, fan_in=2)
        assert {tuple(r) for r in got.collect()} == brute_top(rows, 6)
    again = top_k(df.union(df.where("vec_id = 10")), F.col("vec_id") % 10 == 0, 6)
    assert {tuple(r) for r in again.where("query_id = 10").collect()} == {
        r for r in brute_top(rows, 6) if r[0] == 10}
    assert top_k(df.where("false"), F.lit(True)).collect() == []
    assert top_k(df, F.lit(None).cast("boolean")).collect() == []


def test_large_scores_are_exact(spark):
    rows = [(0, [2e6, 1.0]), (1, [2e6, -7.0]), (2, [2e6, 5.0]), (3, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in top_k(df, F.col("vec_id") == 0, 5).collect()}
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    assert {i: got[i] for i in (1, 2)} == {
        i: sum(a * b for a, b in zip(whole[0], whole[i])) for i in (1, 2)}
    assert got[3] == 2 ** 63 - 1


# --- training order ----------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 1000])
def test_feistel_is_a_permutation(spark, n):
    got = [[r[0] for r in spark.range(n).select(feistel(F.col("id"), n, key)).collect()]
           for key in (1, 2)]
    assert sorted(got[0]) == sorted(got[1]) == list(range(n))
    if n > 50:
        assert got[0] != got[1] and got[0] != list(range(n))


def test_tokens_equal_the_plain_encoding():
    import base64

    import tiktoken
    from millrace.llm.training_order import PATTERN
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    plain = tiktoken.Encoding("p", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for _, t, *_ in documents()] + [
        "a  b", " a b ", "a \n b", "it's don't 12 34.5\tx", " a b c d", "x\n y z"]
    for t in texts:
        assert tokenizer(VOCABULARY)(t) == plain.encode_ordinary(t)


def test_round_trip(spark, tmp_path):
    rows = documents()
    folder = str(tmp_path / "shards")
    got = materialise(frame(spark, rows), folder, length=64, per_shard=10).collect()
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n))
    by_slot = list(read_slots(folder, 0, n, 64, 10))
    assert len(by_slot) == n
    encode = tokenizer(VOCABULARY)
    found = defaultdict(dict)
    for r in got:
        assert r.shard == r.slot // 10 and r.byte_offset == 128 * (r.slot % 10)
        record = by_slot[r.slot]
        assert (record[r.tokens:] == END).all()
        found[r.doc_id][r.sequence] = record[:r.tokens].tolist()
    for i, text, *_ in rows:
        assert sum((found[i][s] for s in sorted(found[i])), []) == [*encode(text or ""), END]
    later = list(read_slots(folder, 37, 25, 64, 10))
    assert all(np.array_equal(a, b) for a, b in zip(later, by_slot[37:62])) and len(later) == 25
    assert not [p for p in (tmp_path / "shards").iterdir() if p.name.startswith(".")
                and not p.name.endswith(".crc")]
    assert training_order(frame(spark, [])).count() == 0


def test_a_round_of_shards_shuffles_a_part_of_the_tokens(spark, tmp_path, monkeypatch):
    """All tokens lay in one shuffle, beside the sequences and the shards."""
    from millrace.llm import training_order as t
    plans, keep = [], t.stored
    monkeypatch.setattr(t, "stored", lambda df, name: (plans.append(df), keep(df, name))[1])
    ordered = spark.range(1000).selectExpr("id as slot", "cast(repeat('ab', 8) as binary) as data")
    got = t.write_shards(ordered, str(tmp_path), length=8, per_shard=10)
    assert sorted((r["shard"], r["records"]) for r in got.collect()) == [(i, 10) for i in range(100)]
    assert len(plans) == t.PASSES > 1 and all(df.count() <= 34 for df in plans)
    assert sum(1 for _ in t.read_slots(str(tmp_path), 0, 1000, 8, 10)) == 1000


def test_distinct_words_are_encoded_once(monkeypatch):
    """A batch was encoded by a call and a loop for each of its words; the bytes now encoded are those of its
    distinct words, and the ids are the same."""
    import pyarrow as pa
    import tiktoken
    from millrace.llm import training_order as t
    given = []
    for name in ("encode_ordinary", "encode_to_numpy"):
        monkeypatch.setattr(tiktoken.Encoding, name, lambda self, text, f=getattr(
            tiktoken.Encoding, name), **k: (given.append(text), f(self, text, **k))[1])
    texts = [f"{w} the quick brown fox jumps over it again" * 3 for w in "abcdefgh"] * 50 + [
        "", " ", "a  b", "x  y", None]
    encode, plain = t.batch_tokenizer.__wrapped__(VOCABULARY), tokenizer(VOCABULARY)
    ids, at = encode(pa.array([x or "" for x in texts], pa.large_string()))
    assert len(given) <= len(texts) + 1 and sum(map(len, given)) < 2_000
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(x or "") for x in texts]
