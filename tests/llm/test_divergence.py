"""Divergence of sources against plain Python, and the sparse merge against a dense one."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import divergence as D
from tests.llm.cases import documents, frame, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, smooth, scale, top):
    """rows: (lang, source, text)."""
    docs, counts, groups = Counter(), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        docs.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= least]
        mine = sorted(s for g, s in groups if g == lang)

        def share(count):
            whole = sum(count[t] for t in kept) + smooth * len(kept)
            return {t: 1 + scale * (count[t] + smooth) // whole for t in kept}
        p = {s: share(counts[lang, s]) for s in mine}
        q = share(sum((counts[lang, s] for s in mine), Counter()))
        for s in mine:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found)
                        if part == "pair" or i < top}
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]


@pytest.mark.parametrize("chunk,block", [(4096, 8), (5, 2), (3, 1)])
def test_against_plain_python(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(D, "CHUNK", chunk)
    monkeypatch.setattr(D, "BLOCK", block)
    rows = documents([prose(s, 60) for s in range(40, 60)] + ["Straße STRASSE ﬂ\x00x ÀÉ àé", "_a_b1c"])
    rows += [(900 + i, prose(i % 3, 50), f"l{i % 2}", f"src{i % 5}", 1, None) for i in range(40)]
    rows += [(990, None, "empty", "a", 0, None), (991, "", "empty", "b", 0, None),
             (992, "x", "alone", None, 1, None), (993, None, "l1", "silent", 0, None),
             (993, None, "l1", "silent", 0, None), (None, prose(1, 50), "l0", "src1", 1, None)]
    got = rows_of(D.divergence(frame(spark, rows), least=2, top=7))
    want = plain([(r[2], r[3], r[1]) for r in rows], 2, 5, 10 ** 9, 7)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[3] == "silent" for r in got) and ("empty", "a", "pair", "b", 0, 1) in want


def test_empty_table(spark):
    assert rows_of(D.divergence(frame(spark, []))) == []


def test_merge_is_the_dense_sum():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        dense = rng.integers(0, 4, (2, n)) * rng.integers(0, 10 ** 6, (2, n))
        wholes = [int(d.sum()) + 5 * n for d in dense]
        sparse = [(np.flatnonzero(d), d[d > 0], w) for d, w in zip(dense, wholes)]
        p = [[1 + 10 ** 9 * (int(x) + 5) // w for x in d] for d, w in zip(dense, wholes)]
        want = sum(abs(a - b) for a, b in zip(*p))
        assert D.merged(*sparse, n, 5, 10 ** 9) == D.merged(*sparse[::-1], n, 5, 10 ** 9) == want


def test_shares_are_exact_for_large_counts(spark):
    count = np.array([0, 1, 9_223_372, 10 ** 10, 10 ** 14 - 7, 123456789012345], np.int64)
    for whole in (10 ** 15 - 1, 234567890123456, 10 ** 14 + 3):
        want = [1 + 10 ** 9 * (int(c) + 5) // whole for c in count]
        assert D.shares(count, whole, 5, 10 ** 9).tolist() == want
        got = spark.createDataFrame([(int(c), whole) for c in count], "n long, w long").select(
            D.share_column("n", "w", 5, 10 ** 9).alias("p")).collect()
        assert [r.p for r in got] == want
    with pytest.raises(ValueError):
        D.shares(count, 10 ** 15, 5, 10 ** 9)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD", 20)
    monkeypatch.setattr(D, "PIECE", 64)
    import pyarrow as pa
    texts = [prose(i, 70) for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 8), pa.array(["s"] * 8), pa.array(texts)],
                                       names=["lang", "source", "text"])
    parts = list(D._count(iter([batch])))
    assert len(parts) > 1
    n, docs = Counter(), Counter()
    for p in parts:
        for r in p.to_pylist():
            n[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    words = [t.split() for t in texts]
    assert n == Counter(w for x in words for w in x)
    assert docs == Counter(w for x in words for w in set(x))
