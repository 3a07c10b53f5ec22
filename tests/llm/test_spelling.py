"""Spelling variants against a plain search for neighbours, and trie nodes against prefixes."""

import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling as S
from tests.llm.cases import documents, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=6, occurrences=5, ratio=5, one_in=199):
    """rows: (doc_id, text)."""
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % one_in == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= least and k >= occurrences}
    letters = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        near[w] = {v for i in range(len(w) + 1) for v in (
            [w[:i] + w[i + 1:]] + [w[:i] + c + w[i:] for c in letters]
            + [w[:i] + c + w[i + 1:] for c in letters]) if v != w and v in words}
    form = {}
    for w, k in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * k else None
    out = {}
    for w, k in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, k, len(near[w]), words.get(form[w]))
    return out


def got_of(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("width", [16, 3])
def test_against_plain_search(spark, monkeypatch, width):
    monkeypatch.setattr(S, "WIDTH", width)
    rng = random.Random(5)
    bases = ["".join(rng.choices("aabé÷", k=rng.randint(6, 9))) for _ in range(25)] + [
        "aaaaaaa", "aaaaaa", "aaaaaaaa", "abababab", "x" * 300, "x" * 299, "y" * 6000, "é" * 40 + "à"]
    words = []
    for b in bases:
        words += [b] * rng.choice([5, 30, 200])
        for _ in range(6):
            i = rng.randrange(len(b) + 1)
            v = rng.choice([b[:i] + b[i + 1:], b[:i] + rng.choice("abÀ") + b[i:],
                            b[:i] + rng.choice("cdé") + b[i + 1:]])
            words += [v] * rng.choice([5, 6, 40])
    words += ["kettenwort"] * 600 + ["kettenwor"] * 70 + ["ettenwor"] * 8
    rng.shuffle(words)
    texts = [rng.choice([" ", "-", "3", "\n", "ā", "日"]).join(words[i::20]).title() for i in range(20)]
    rows = documents(texts) + [(None, "achung1Achung " * 9, None, None, 1, None)] * 2
    got = got_of(S.variants(frame(spark, rows), one_in=7))
    assert got == plain([(r[0], r[1]) for r in rows], one_in=7)
    assert any(f and f != r for f, r, *_ in got.values())  # chains of two steps or more
    assert "x" * 300 in got and "y" * 6000 in got


def test_empty_table_and_no_words(spark):
    assert S.variants(frame(spark, [])).collect() == []
    assert S.variants(frame(spark, [(1, None, None, None, 0, None), (2, "a b", None, None, 3, None)])
                      ).collect() == []


def test_nodes_number_prefixes(spark, monkeypatch):
    monkeypatch.setattr(S, "WIDTH", 3)
    words = ["", "a", "abc", "abcd", "abcabcabcabc", "abcabcabcabd", "b" * 40, "b" * 41 + "c"]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    rows = S.trie_nodes(df.select("id", F.when(F.col("word") == "", F.array().cast("array<string>"))
                                  .otherwise(F.split("word", "")).alias("items"))).collect()
    assert len(rows) == sum(len(w) + 1 for w in words)
    prefix = {}
    for r in rows:
        prefix.setdefault(words[r.id][:r.depth], set()).add(r.node)
    assert all(len(x) == 1 for x in prefix.values())
    assert len({n for x in prefix.values() for n in x}) == len(prefix)
