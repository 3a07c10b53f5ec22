"""Positive-unlabelled learning: the risk and its gradient, planted words, awkward rows."""

import random

import numpy as np
import pytest

from millrace.llm import toxicity as T
from millrace.llm.common import table
from millrace.llm.queries import QUERIES
from tests.llm.cases import documents, frame, prose


def examples(rng, rows, words):
    return T._examples([np.unique(rng.integers(0, words, rng.integers(0, 5))) for _ in range(rows)])


def test_risk_and_gradient():
    """Against the definition, example by example; below zero the step goes back."""
    rng = np.random.default_rng(3)
    signs = set()
    for k in range(30):
        confirmed, unlabelled = examples(rng, 6, 7), examples(rng, 9, 7)
        w, prior = rng.normal(0, 2, 8), 0.05 + 0.9 * (k % 2)

        def parts(w):
            def mean(side, sign):
                rows, cols, n = side
                f = [w[-1] + sum(w[c] for r, c in zip(rows, cols) if r == i) for i in range(n)]
                return np.mean([1 / (1 + np.exp(sign * x)) for x in f])
            return prior * mean(confirmed, 1), mean(unlabelled, -1) - prior * mean(confirmed, -1)
        positive, negative = parts(w)
        value, grad = T.risk(w, confirmed, unlabelled, prior)
        assert value == pytest.approx(positive + max(0, negative))
        signs.add(negative < 0)
        for i in range(8):
            up, down = w.copy(), w.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            (a, b), (c, d) = parts(up), parts(down)
            want = -(b - d) / 2e-5 if negative < 0 else (a + b - c - d) / 2e-5
            assert grad[i] == pytest.approx(want, abs=1e-6)
    assert signs == {True, False}


def planted(rng, n, toxic):
    """Confirmed documents hold a bad word or an inflected bad stem; many texts are copies."""
    bad = ["grobian", "lumpazi"]
    stems = ["fiesling" + x for x in ("e", "en", "ern", "s", "chen", "ig", "lich", "heit")]
    rows = []
    for i in range(n):
        text = prose(rng.randrange(10 ** 9), rng.randint(20, 80))
        if i < toxic:
            words = text.split()
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad if i % 2 else stems))
            text = " ".join(words).replace("grobian", "Grobian,")
        rows.append(text)
    return rows


def test_planted_words(spark):
    rng = random.Random(8)
    texts = planted(rng, 900, 180)
    rng.shuffle(texts)
    # One innocent text that is there, and confirmed, very often teaches nothing.
    copied = prose(77, 60)
    texts += [copied] * 60
    marks = ["grobian" in t.lower() or "lumpazi" in t or "fiesling" in t for t in texts]
    rows = [(i, t, None, None, len(t), None) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(m or i >= 900)) for i, m in enumerate(marks) if i % 2],
                                   "doc_id long, toxic int")
    docs = frame(spark, rows)
    model = T.fit(docs, labels)
    got = {r.doc_id: r for r in T.score(docs, model).collect()}
    found = [got[i].score >= 0.5 for i in range(900)]
    assert np.mean([f for f, m in zip(found, marks) if m]) >= 0.97
    assert np.mean([f for f, m in zip(found, marks[:900]) if not m]) <= 0.01
    again = T.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(model.words, again.words) and np.allclose(model.weights, again.weights)


def test_scores_by_hand(spark):
    """The score is the bias plus the weight of each word and stem that occurs, once each."""
    docs = frame(spark, documents(["Fiesling fieslinge fieslinge! ok", "ok" + " ok" * 70000]))
    hashes = {}
    for word in ("fiesling", "fieslinge", "ok"):
        data = np.frombuffer(word.encode(), np.uint8)
        _, h, stems = T.hashed_words(data, np.array([0, len(data)]))
        hashes[word] = h[0]
        hashes.update({word[:n] + "*": s[0] for n, (_, s) in zip(T.STEMS, stems) if len(s)})
    weights = {"fieslinge": 1.5, "ok": -0.25, "fies*": 0.5, "fiesling*": 2.0}
    order = sorted(weights, key=lambda w: hashes[w])
    model = T.Model(np.array([hashes[w] for w in order], np.uint64),
                    np.array([weights[w] for w in order]), -1.0)
    got = {r.doc_id: r for r in T.score(docs, model).collect()}
    last = max(got)
    assert got[last - 3].score == pytest.approx(1 / (1 + np.exp(-(-1 + 1.5 - 0.25 + 0.5 + 2.0))))
    assert (got[last - 3].evidence, got[last].evidence) == (4, 1)
    assert got[0].score == got[3].score == got[6].score == pytest.approx(1 / (1 + np.exp(1.0)))


def test_awkward_rows(spark):
    rows = documents()
    docs = frame(spark, rows + [(None, "alone", None, None, 5, None)] * 2)
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    model = T.fit(docs, labels)
    got = T.score(docs, model).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    assert T.fit(docs, labels.where("toxic = 0")) is None
    assert T.fit(frame(spark, []), labels) is None
    assert {r.score for r in T.score(docs, None).collect()} == {0.0}
    assert T.score(frame(spark, []), model).collect() == []


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op12_unlabelled_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    toxic = [r.predicted for r in rows if r.toxic == 1]
    assert len(toxic) > 60 and np.mean(toxic) >= 0.85
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) <= 0.03
