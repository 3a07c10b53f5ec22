"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive examples; all other text is unlabelled, a mixture of toxic
and clean. With the class prior pi the risk of a classifier f is estimated without negatives as

    pi R(p, +) + max(0, R(u, -) - pi R(p, -)),

R(x, y) being the mean loss of examples x with label y. The part in max estimates the risk on clean
text and cannot be negative; where a batch makes it so, the step goes back up instead. Documents are
sets of words and of beginnings of words; a classifier weighs those whose share among the confirmed
documents is above that in unlabelled text, by their likelihood ratio. Several classifiers,
each with the confirmed documents and its own part of the unlabelled ones, are trained side by side
in Spark tasks, and the mean of their logits is the score's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import small_batches, stored
from millrace.llm.hashing import U64, mix, text_bytes, word_hashes, words

# Training looks at so many confirmed and so many unlabelled documents at most, whole.
MOST_CONFIRMED, MOST_UNLABELLED = 4000, 8000
# Classifiers, and how much the two shares of a word must differ (chi-squared with one degree).
MEMBERS, DEPARTS = 4, 20.0
SKETCHES = 6
# A document is the set of its words and of their first so many bytes, since languages inflect.
STEMS = (4, 5, 6, 8)
EPOCHS, BATCHES, RATE, DECAY = 400, 4, 0.05, 1e-6

# Words are runs of ASCII letters, lower-cased, and of bytes beyond ASCII.
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
                     for c in range(256)], np.uint8)


@dataclass
class Model:
    """Sorted word hashes, their weights, and the bias. As large as what the bounded sample shows."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def hashed_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Text number and hash of every word; and the same of the beginnings of longer words."""
    data = _LETTERS[data]
    text, starts, ends = words(data, bounds)
    stems = []
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        stems.append((text[long], mix(
            word_hashes(data, starts[long], starts[long] + n) + U64(n))))
    return text, word_hashes(data, starts, ends), stems


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, confirmed, sketches, words: the least hashes of three words in a row, in SKETCHES orders,
    and the sorted distinct hashes of the words and stems of each text."""
    for batch in batches:
        for row, data, bounds in text_bytes(batch.column(2)):
            text, hashed, stems = hashed_words(data, bounds)
            every = [(np.searchsorted(x, np.arange(len(bounds))), h)
                     for x, h in [(text, hashed), *stems]]
            at = every[0][0]
            parts = [np.unique(np.concatenate([h[e[i]:e[i + 1]] for e, h in every]))
                     for i in range(len(bounds) - 1)]
            ends = np.cumsum([0] + [len(p) for p in parts], dtype=np.int32)
            n = len(parts)
            least = np.array([_least(hashed[a:b]) for a, b in zip(at[:-1], at[1:])], U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), batch.column(1).slice(row, n),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(0, n * SKETCHES + 1, SKETCHES, dtype=np.int32)),
                     pa.array(least.reshape(-1).view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(
                     np.concatenate(parts).view(np.int64)))],
                names=["doc", "confirmed", "sketches", "words"])


def _least(hashed: np.ndarray) -> list[np.uint64]:
    """Versions of one text mostly have one of these in common, different texts hardly ever."""
    if len(hashed) < 3:
        return [mix(hashed.sum(dtype=U64, keepdims=True) + U64(i))[0] for i in range(SKETCHES)]
    runs = mix(mix(mix(hashed[:-2]) + hashed[1:-1]) + hashed[2:])
    return [mix(runs + U64(i)).min() for i in range(SKETCHES)]


def _one_of_each(sets: DataFrame) -> DataFrame:
    """Without the texts that have a sketch in common with one of a lesser hash."""
    rows = sets.select("doc", "confirmed", F.posexplode("sketches").alias("k", "sketch"))
    first = rows.groupBy("confirmed", "k", "sketch").agg(F.min("doc").alias("first"))
    alone = rows.join(first, ["confirmed", "k", "sketch"]).groupBy("doc", "confirmed").agg(
        F.min("first").alias("first")).where(F.col("first") == F.col("doc"))
    return sets.join(alone.select("doc", "confirmed"), ["doc", "confirmed"], "left_semi").select(
        "doc", "confirmed", "words")


def risk(w: np.ndarray, confirmed: tuple, unlabelled: tuple, prior: float) -> tuple[float, np.ndarray]:
    """The estimated risk and the direction of the next step. w: the weights and, last, the bias; a set
    of examples is (row of each entry, word of each entry, number of rows). The loss of output f for
    label y is sigmoid(-y f): it is bounded, so few examples cannot make the estimate negative."""
    def outputs(rows, cols, n):
        return np.bincount(rows, w[cols], minlength=n) + w[-1]

    def pull(rows, cols, n, slope):
        return np.append(np.bincount(cols, slope[rows], minlength=len(w) - 1), slope.sum()) / n

    f, g = (1 / (1 + np.exp(-outputs(*x))) for x in (confirmed, unlabelled))
    positive = prior * (1 - f).mean()
    negative = g.mean() - prior * f.mean()
    of_confirmed = prior * pull(*confirmed, f * (1 - f))
    of_negative = pull(*unlabelled, g * (1 - g)) - of_confirmed
    if negative < 0:
        return positive, -of_negative
    return positive + negative, of_negative - of_confirmed


def _examples(sets: list[np.ndarray]) -> tuple:
    return (np.repeat(np.arange(len(sets)), [len(s) for s in sets]),
            np.concatenate(sets) if sets else np.empty(0, np.int64), len(sets))


def train(confirmed: list[np.ndarray], unlabelled: list[np.ndarray], n: int, prior: float,
          seed: int) -> np.ndarray:
    """Adam over batches that hold the same part of both kinds. The sets hold word numbers below n."""
    rng = np.random.default_rng(seed)
    w = np.zeros(n + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, step = np.zeros(n + 1), np.zeros(n + 1), 0
    batches = max(1, min(BATCHES, len(confirmed), len(unlabelled)))
    for _ in range(EPOCHS):
        dealt = [np.array_split(rng.permutation(len(x)), batches) for x in (confirmed, unlabelled)]
        for one, other in zip(*dealt):
            _, grad = risk(w, _examples([confirmed[i] for i in one]),
                           _examples([unlabelled[i] for i in other]), prior)
            grad[:-1] += DECAY * w[:-1]
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _member(vocabulary: np.ndarray, prior: float):
    def run(table: pa.Table) -> pa.Table:
        member = table.column("member")[0].as_py()
        rows = []
        for kind, key, found in zip(table.column("confirmed").to_pylist(),
                                    table.column("doc").to_pylist(), table.column("words")):
            values = np.sort(found.values.to_numpy(zero_copy_only=False)) if len(found) else (
                np.empty(0, np.int64))
            rows.append((kind, values.tolist(), key))
        rows.sort()  # by content, so that it does not depend on how the rows lie
        sides = [[np.searchsorted(vocabulary, np.array(x, np.int64)) for k, x, _ in rows if k == side]
                 for side in (True, False)]
        w = train(*sides, len(vocabulary), prior, member)
        return pa.table({"member": pa.array([member], pa.int32()),
                         "weights": pa.array([w.tolist()], pa.list_(pa.float64()))})
    return run


def _departure(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Likelihood ratio of two shares against one common share."""
    def part(found: Column, n: int) -> Column:
        rate, common = found / n, (a + b) / (n_a + n_b)
        gain = F.when(found > 0, found * F.log(rate / common)).otherwise(0.0)
        rest = F.when(found < n, (n - found) * F.log((1 - rate) / (1 - common))).otherwise(0.0)
        return gain + rest
    return 2 * (part(a, n_a) + part(b, n_b))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None,
        most: tuple[int, int] = (MOST_CONFIRMED, MOST_UNLABELLED)) -> Model | None:
    """Learns from at most `most` confirmed and unlabelled documents, those with the least hash of
    their id. Without a `prior`, the share of confirmed documents among the labelled ones is taken.

    A document with several labels counts with the least one; rows with a null id are not learned
    from. Copies and versions of one text, told by sketches, count once. None when nothing is
    confirmed.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg(F.min(label).cast("int").alias("mark"))
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    known = stored(ids.join(marked, "doc_id"), "labelled")
    share = known.agg(F.avg((F.col("mark") > 0).cast("double"))).first()[0]
    if not share:
        return None
    prior = float(np.clip(share if prior is None else prior, 1e-4, 0.9))

    def chosen(rows: DataFrame, n: int, confirmed: bool) -> DataFrame:
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select(
            "doc_id", F.lit(confirmed).alias("confirmed"))

    picked = stored(chosen(known.where("mark > 0"), most[0], True).union(
        chosen(ids, most[1], False)), "picked")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(picked), "doc_id").dropDuplicates(["doc_id", "confirmed"])
    with small_batches(spark):
        sets = stored(texts.select(F.xxhash64("doc_id").alias("doc"), "confirmed", "text").mapInArrow(
            _sets, "doc long, confirmed boolean, sketches array<long>, words array<long>"), "sets")
    sets = stored(_one_of_each(sets), "alone")
    n_a, n_b = (sets.where(F.col("confirmed") == x).count() for x in (True, False))
    one = sets.select("doc", "confirmed", F.explode("words").alias("word"))
    a, b = (F.count(F.when(F.col("confirmed") == x, 1)).alias(y) for x, y in ((True, "a"), (False, "b")))
    kept = stored(one.groupBy("word").agg(a, b).where(
        (F.col("a") * n_b > F.col("b") * n_a)
        & (_departure(F.col("a"), F.col("b"), n_a, n_b) >= DEPARTS)).select("word"), "words")
    vocabulary = np.sort(np.array([r.word for r in kept.collect()], np.int64))
    held = sets.select("doc", "confirmed").join(one.join(kept, "word").groupBy(
        "doc", "confirmed").agg(F.collect_list("word").alias("words")), ["doc", "confirmed"], "left")
    members = F.when(F.col("confirmed"), F.sequence(F.lit(0), F.lit(MEMBERS - 1))).otherwise(
        F.array(F.pmod(F.col("doc"), F.lit(MEMBERS)).cast("int")))
    trained = held.select("doc", "confirmed", F.coalesce(
        "words", F.array().cast("array<bigint>")).alias("words"), F.explode(members).alias("member")
    ).groupBy("member").applyInArrow(
        _member(vocabulary, prior), "member int, weights array<double>").orderBy("member").collect()
    w = np.mean([r.weights for r in trained], axis=0)
    order = np.argsort(vocabulary.view(U64))
    return Model(vocabulary.view(U64)[order], w[:-1][order], float(w[-1]))


def logits(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logit of each text and how many different words were weighed in it."""
    n = len(bounds) - 1
    text, hashed, stems = hashed_words(data, bounds)
    size, pairs = max(len(model.words), 1), []
    for rows, values in [(text, hashed), *stems]:
        at = np.searchsorted(model.words, values)
        inside = np.flatnonzero(at < len(model.words))
        met = inside[model.words[at[inside]] == values[inside]]
        pairs.append(rows[met] * size + at[met])
    rows, cols = np.divmod(np.unique(np.concatenate(pairs)), size)
    return (model.bias + np.bincount(rows, model.weights[cols] if len(cols) else None, minlength=n),
            np.bincount(rows, minlength=n))


def _score(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*model_of())
        for batch in batches:
            for row, data, bounds in text_bytes(batch.column(1)):
                f, held = logits(model, data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(f)),
                     pa.array(1 / (1 + np.exp(-np.clip(f, -500, 500))), pa.float64()),
                     pa.array(held, pa.int32())], names=["doc_id", "score", "evidence"])
    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Stored: doc_id, score (0 to 1), evidence (different words that were weighed).

    One row per row of `docs`, null ids and repeats too; only the text is looked at, whole. A null or
    empty text has the score of a text without evidence. Without a model every score is 0. An empty
    table gives no rows. Other columns are ignored.
    """
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("evidence"))
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.bias))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _score(lambda: sent.value), f"doc_id {kind}, score double, evidence int"), "toxicity")
