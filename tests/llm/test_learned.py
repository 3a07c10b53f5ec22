"""Quality and language: held-out accuracy, gradients, awkward rows."""

import numpy as np
import pytest

from millrace.llm import attention, language_mix
from millrace.llm.common import table
from millrace.llm.queries import QUERIES
from tests.llm.cases import documents, frame, prose

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    got = QUERIES["op7_attention_quality"](spark, SF).join(table(spark, SF, "labels"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 40 and np.mean(right) >= 0.95
    assert all(r.predicted == 1 for r in rows if r.quality == 1 and r.toxic == 0)


def test_language_held_out(spark):
    got = QUERIES["op9_language_mixture"](spark, SF).join(
        table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert len(rows) > 100 and np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture_of_two(spark):
    docs = table(spark, SF, "documents")
    model = language_mix.fit(docs)
    texts = {x: " ".join(r.text for r in docs.where(f"lang = '{x}'").orderBy("doc_id").limit(3)
                         .collect()).split()[:300] for x in ("en", "de")}
    mixed = " ".join(texts["en"] + texts["de"][:100])
    row = language_mix.predict(frame(spark, [(1, mixed, None, None, None, None)]), model).first()
    assert {m.lang for m in row.mixture} == {"en", "de"} and row.lang_pred == "en"
    assert 0.6 < row.score < 0.9


def test_em_gains_likelihood():
    rng = np.random.default_rng(1)
    scores = rng.normal(-20, 3, (90, 3))
    text = np.repeat(np.arange(3), 30)
    share, both = language_mix.mixtures(scores, text, 3, np.ones((3, 3)))
    single = np.array([[scores[text == t, l].sum() for l in range(3)] for t in range(3)])
    assert np.allclose(share.sum(1), 1) and (both >= single.max(1) - 1e-6).all()


def test_awkward_rows(spark):
    rows = documents()
    docs = frame(spark, rows)
    langs = {r.doc_id: r for r in language_mix.identify(docs).collect()}
    assert len(langs) == len(rows)
    for i, text, *_ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert langs[i].lang_pred == "und" and langs[i].score == 0.0
        else:
            assert langs[i].lang_pred == "en"
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows)],
                                   "doc_id long, quality int, toxic int")
    model = attention.fit(docs, labels)
    scores = {r.doc_id: r for r in attention.score(docs, model).collect()}
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores.values())
    assert scores[0].score == scores[3].score == scores[6].score and scores[0].passages == 1
    assert scores[21].score == scores[24].score  # equal texts
    empty = frame(spark, [])
    assert attention.fit(empty, labels) is None
    assert attention.score(empty, None).collect() == []
    assert {r.score for r in attention.score(docs, None).collect()} == {0.5}
    assert language_mix.identify(empty).collect() == []
    nothing = language_mix.predict(docs, language_mix.fit(docs.where("lang = 'none'")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_scores_do_not_depend_on_neighbours():
    texts = [t or "" for _, t, *_ in documents()]
    whole = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(whole), np.uint8)
    bounds = np.cumsum([0] + [len(t) for t in whole])
    owner, x = attention.passages(data, bounds)
    for i, t in enumerate(whole):
        one, alone = attention.passages(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert np.array_equal(x[owner == i], alone)


def test_gradient():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(9, 5))
    owner = np.array([0, 0, 0, 1, 2, 2, 2, 2, 3])
    y = np.array([1.0, 0, 1, 0])
    h, g = 4, 3
    w = {"W": rng.normal(size=(5, h)), "b": rng.normal(size=h), "V": rng.normal(size=(h, g)),
         "U": rng.normal(size=(h, g)), "w": rng.normal(size=g), "c": rng.normal(size=h),
         "d": rng.normal(size=1)}

    def loss():
        p = attention._forward(w, x, owner, 4)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    grads = attention._gradient(w, x, owner, y)
    for name, values in w.items():
        for at in np.ndindex(values.shape):
            before = values[at]
            values[at] = before + 1e-5
            up = loss()
            values[at] = before - 1e-5
            down = loss()
            values[at] = before
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_letters_by_code_point(spark):
    """Letters of every script count, marks only after a letter, and nothing else."""
    words = {"tif": "ⵜⴰⵎⴰⵣⵉⵖⵜ ⴰⵡⴰⵍ", "adl": "𞤀𞤣𞤤𞤢𞤥 𞤆𞤵𞤤𞤢𞤪", "hi": "हिन्दी भाषा", "en": "plain words"}
    train = frame(spark, [(i, t, x, None, None, None) for i, (x, t) in enumerate(words.items())])
    none = ["❤️", "！", "。", "٣", "×", "12 ÷ 3", "́", "", None]
    asked = frame(spark, [(i, t, None, None, None, None)
                          for i, t in enumerate([*words.values(), *none])])
    got = {r.doc_id: r for r in language_mix.predict(asked, language_mix.fit(train)).collect()}
    assert [got[i].lang_pred for i in range(4)] == list(words)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in range(4, len(got)))
    data = np.frombuffer("हिन्दीé".encode() + "́a".encode(), np.uint8)
    _, word, text = language_mix.grams(data, np.array([0, 20, len(data)]))
    assert text.tolist() == [0, 1] and len(word) == 21


def test_training_sees_every_passage(spark, monkeypatch):
    """Of texts far longer than a piece, too; the pieces give the gradient of the whole bag."""
    monkeypatch.setattr(attention, "PIECE", 50)
    seen = []
    monkeypatch.setattr(attention, "train", lambda bags, *_: seen.append(bags))
    texts = [prose(1, 20_000), prose(2, 3_500), prose(3, 64), None]
    docs = frame(spark, [(i, t, None, None, None, None) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    attention.fit(docs, labels)
    bags = seen[0]
    assert sorted(bags.size) == [1, 1, 55, 313]
    rng = np.random.default_rng(3)
    w = {k: rng.normal(0, 0.3, n) for k, n in (
        ("W", (attention.FEATURES, 4)), ("b", 4), ("V", (4, 3)), ("U", (4, 3)), ("w", 3),
        ("c", 4), ("d", 1))}
    whole = [np.concatenate(list(bags.pieces(i))) for i in range(4)]
    for i, text in enumerate(texts):
        data = np.frombuffer((text or "").encode(), np.uint8)
        x = attention.passages(data, np.array([0, len(data)]))[1]
        assert any(np.array_equal(x, y) for y in whole)
    want = attention._gradient(w, np.concatenate(whole), np.repeat(np.arange(4), bags.size),
                               np.array(bags.labels, float))
    got = attention.batch_gradient(w, bags, list(range(4)), lambda x: x)
    assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)
