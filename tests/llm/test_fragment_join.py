"""The fragment join against brute force, and the pieces it rests on."""

import random
import re

import numpy as np
import pytest

from millrace.llm.fragment_join import (
    band_of, bands, fragments, keep_first, near_duplicates, signatures)
from millrace.llm.graph import components
from millrace.llm.hashing import shingle_sets
from tests.llm.cases import documents, frame, prose


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute(rows, k, num, den):
    sets = {r[0]: shingles(r[1], k) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(prose(rng.random(), 1) if rng.random() < share else w for w in text.split())


def versions():
    """Groups of versions around the threshold, a shared passage, chains, short texts."""
    out = []
    for g, n in enumerate((8, 14, 40, 120, 400)):
        base = prose(f"base{g}", n)
        out += [base] + [edited(base, 0.004 * (i % 9), f"{g}-{i}") for i in range(30)]
    passage = prose("passage", 60)
    out += [f"{prose(f'l{i}', 40)} {passage} {prose(f'r{i}', 40)}" for i in range(40)]
    chain = prose("chain", 200).split()
    out += [" ".join(chain[i * 4:i * 4 + 120]) for i in range(20)]
    out += [f"{a} {b}" for a in ("x", "y") for b in ("p", "P", "q")]
    random.Random(4).shuffle(out)
    return out


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 4, 5)])
def test_against_brute_force(spark, k, num, den):
    rows = documents(versions())
    want = brute(rows, k, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_duplicates(frame(spark, rows), k, num, den).collect()}
    assert got == want
    kept = {r.doc_id for r in keep_first(frame(spark, rows), k, num, den).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_repeats_nulls_and_empty(spark):
    rows = [(5, "a b c d e", None, None, None, None)] * 3 + [
        (None, "a b c d e", None, None, None, None), (2, "a b c d e", None, None, None, None)]
    got = sorted((tuple(r) for r in near_duplicates(frame(spark, rows), 3, 90, 100).collect()),
                 key=str)
    assert got == [(2, 3, 2), (5, 3, 2), (5, 3, 2), (5, 3, 2), (None, 3, None)]
    assert near_duplicates(frame(spark, []), 3, 90, 100).collect() == []


@pytest.mark.parametrize("num,den", [(90, 100), (4, 5)])
def test_bands_and_segments_hold_every_partner(num, den):
    """Linked sets are in the same or neighbouring bands and share a whole segment."""
    rng = np.random.default_rng(3)
    firsts = bands(num, den, 10_000)
    for n in range(1, 3000):
        top = n * den // num
        a, b = (np.searchsorted(firsts, x, side="right") for x in (n, top))
        assert b - a <= 1
    for _ in range(300):
        n = int(rng.integers(2, 500))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        out = int(rng.integers(0, max(1, int(len(base) * (den - num) / den) + 1)))
        a = base[out:]
        b = np.unique(np.concatenate([base[:len(base) - out // 4], rng.integers(
            0, 1 << 63, 1 + n // 50, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both * den >= num * (len(a) + len(b) - both) and not np.array_equal(a, b):
            (band_a, need_a, in_a, _), (band_b, need_b, in_b, _) = (
                signatures(x, num, den) for x in (a, b))
            need = [need_a[band_a > band_b], need_b[band_b > band_a]]
            assert np.intersect1d(in_a, in_b).size >= max(need)
    assert fragments(num, den, band_of(2, num, den)[0], 256)[0] == 0


def test_hashes_do_not_depend_on_place():
    words = ["alpha", "Beta", "y" * 5000, "é", "😀", "gamma"] * 40
    one = " ".join(words).encode()
    two = ("\t\n".join(words) + "\x0b").encode()
    data = np.frombuffer(one + two, np.uint8)
    a, b = shingle_sets(data, np.array([0, len(one), len(data)]), 3)
    assert len(a) == 6 and np.array_equal(a, b)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    edges += [(200 + rng.randrange(80), 200 + rng.randrange(80)) for _ in range(60)] + [(7, 7)]
    rng.shuffle(edges)
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r.id: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_candidates_grow_with_the_versions(spark, monkeypatch):
    """Versions of one text of which hardly any are linked: pairs to compare do not grow with the
    square of their number, neither around a hub nor for short texts with a frequent line."""
    from millrace.llm import fragment_join as J
    compared = []

    def counted(pairs, segments, overlaps=J.overlaps):
        pairs = pairs.cache()
        compared.append(pairs.count())
        return overlaps(pairs, segments)
    monkeypatch.setattr(J, "overlaps", counted)
    base = prose("base", 300).split()

    def version(i):
        rng, words = random.Random(i), list(base)
        for at in rng.sample(range(300), 8):
            words[at] = prose(f"{i}-{at}", 1) + str(i)
        return " ".join(words)
    line = prose("line", 8)
    seen = []
    for n in (120, 480):
        compared.clear()
        texts = [version(i) for i in range(n)] + [f"{prose(f's{i}', 12)} {line}" for i in range(n)]
        rows = [(i, t, None, None, 1, None) for i, t in enumerate(texts)]
        got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), 5, 4, 5).collect()}
        if n == 120:
            assert got == {i: c for i, (_, c) in brute(rows, 5, 4, 5).items()}
        seen.append((sum(compared), n))
    assert all(pairs <= 5 * n for pairs, n in seen), seen


def test_chance_meetings_are_not_compared(spark, monkeypatch):
    """Texts that share a passage, and so a few segments at most, are left out before any pair is
    made; the linked ones among them are found."""
    from millrace.llm import fragment_join as J
    compared = []

    def counted(pairs, segments, overlaps=J.overlaps):
        pairs = pairs.cache()
        compared.append(pairs.count())
        return overlaps(pairs, segments)
    monkeypatch.setattr(J, "overlaps", counted)
    passage = prose("passage", 30)
    texts = [f"{prose(f'c{i}', 60)} {passage} {prose(f'd{i}', 60)}" for i in range(200)]
    texts += [t + " more" for t in texts[:20]]
    rows = [(i, t, None, None, 1, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), 5, 4, 5).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 5, 4, 5).items()}
    # Forty documents have a partner; each is tested against TESTED hubs at most.
    assert got[219] == 19 and sum(compared) <= J.TESTED * 40, compared


def test_pairs_share_as_many_segments_as_a_link_needs(spark):
    """Sets that met in the segment of a frequent line only were cut and counted, each with all others."""
    from millrace.llm.fragment_join import _sharing
    signs = {i: [0, 10 * i, 10 * i + 1] for i in range(1, 30)} | {30: [0, 10, 11]}
    members = spark.createDataFrame(
        [(s, i) for i, x in signs.items() for s in x], "sign long, rep long")
    about = spark.createDataFrame([(i, 3, 2 + i % 2) for i in signs], "rep long, need_own int, need_below int")
    pairs = spark.createDataFrame(
        [(a, b, 5) for a in signs for b in signs if a < b], "a long, b long, n_a long")
    got = _sharing(pairs, members, about)
    assert got.columns == ["a", "b", "n_a"] and [tuple(r) for r in got.collect()] == [(1, 30, 5)]
