"""Winnowing against a plain Python version."""

import hashlib
import itertools
import re

import pytest

from millrace.llm.winnowing import K, WINDOW, edit_likeness, fingerprints
from tests.llm.cases import documents, frame


def edited(rows):
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    out = {}
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out[r[0]] = (text, text[:len(text) - third] + after[:third], after)
    return out


def kept(shown):
    return {p.split(":")[0] for p in shown.split(",") if p}


def test_edits_and_likeness(spark):
    rows = documents()
    want = edited(rows)
    got = {r.doc_id: r for r in edit_likeness(frame(spark, rows)).collect()}
    assert got.keys() == want.keys()
    by_text = {want[i][0]: r for i, r in got.items()}
    for i, (text, new, after) in want.items():
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == by_text[text].fingerprint
        a, b, c = kept(r.fingerprint), kept(r.edited_fingerprint), kept(by_text[after].fingerprint)
        for value, x, y in ((r.near_edited, a, b), (r.near_next, a, c)):
            assert value == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
        if text == new:
            assert r.near_edited == 1.0 and r.fingerprint == r.edited_fingerprint


def test_rightmost_minimum_of_every_window(spark):
    """Each window holds a kept gram, kept ones are the rightmost least of a window."""
    text = " ".join("ab" if i % 4 else f"w{i % 12}" for i in range(400))
    words = text.split()
    rows = [(1, text, None, None, None, None)]
    every = fingerprints(frame(spark, rows), window=1).first().fingerprint
    grams = [c >> 32 for c in every]
    assert len(grams) == len(words) - K + 1
    want = []
    for s in range(len(grams) - WINDOW + 1):
        at = min(range(s, s + WINDOW), key=lambda i: (grams[i], -i))
        if at not in want:
            want.append(at)
    got = fingerprints(frame(spark, rows)).first().fingerprint
    assert [(1 << 32) - 1 - (c & 0xFFFFFFFF) for c in got] == want
    steps = [int(p.split(":")[1]) for p in edit_likeness(
        frame(spark, rows)).first().fingerprint.split(",")]
    assert list(itertools.accumulate(steps)) == want
    same = {}
    for i, g in enumerate(grams):
        assert same.setdefault(tuple(words[i:i + K]), g) == g


def test_shared_run_is_found(spark):
    run = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, f"one two {run} three", None, None, None, None),
            (2, f"{run} four five six seven", None, None, None, None)]
    a, b = (r.fingerprint for r in fingerprints(frame(spark, rows)).orderBy("doc_id").collect())
    assert {c >> 32 for c in a} & {c >> 32 for c in b}


def test_empty_and_single(spark):
    assert edit_likeness(frame(spark, [])).collect() == []
    only = edit_likeness(frame(spark, [(None, "a b c d e f", None, None, None, None)])).first()
    assert only.near_next == 1.0 and re.fullmatch("[0-9a-f]+:[0-9]+(,.*)?", only.fingerprint)


def test_repeated_rows(spark):
    rows = documents()[:8] * 3
    assert edit_likeness(frame(spark, rows)).count() == 24
