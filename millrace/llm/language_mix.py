"""Language identification by mixture inference.

Each learned language has a distribution over hashed letter n-grams. A document is a mixture of
languages: expectation-maximisation over its words estimates the proportions from the n-gram
likelihoods. Sets of languages of growing size are tried, and the set with the best likelihood
less a penalty for each further language is kept.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import small_batches, stored
from millrace.llm.hashing import text_bytes

N = 3
CELLS = 1 << 15
ROUNDS = 6
# Log-likelihood that a further language must gain for each doubling of the number of words.
PENALTY = 3.0
SMOOTH = 0.5
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# Of each code point: 2 for a letter, 1 for a mark, which belongs to a letter before it, else 0.
_KIND = np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0)
                  for c in range(sys.maxunicode + 1)], np.uint8)


def _kinds(data: np.ndarray) -> np.ndarray:
    """Of each byte the kind of its character."""
    kind = np.where(data < 128, _KIND[data], 0).astype(np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        one, two, three = (data[np.minimum(lead + j, len(data) - 1)].astype(np.int32) & 0x3F
                           for j in (1, 2, 3))
        width = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = np.choose(width - 2, [
            (first & 0x1F) << 6 | one, (first & 0x0F) << 12 | one << 6 | two,
            (first & 0x07) << 18 | one << 12 | two << 6 | three])
        found = _KIND[np.minimum(code, sys.maxunicode)]
        kind[lead] = found
        for j in (1, 2, 3):
            mine = (width > j) & (lead + j < len(data))
            at = lead[mine] + j
            kind[at] = np.where(data[at] & 0xC0 == 0x80, found[mine], kind[at])
    return kind


def letters(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Lower-cased bytes, with 0 for what belongs to no letter."""
    low = _FOLD[data]
    kind = _kinds(data)
    heads = bounds[bounds < len(data)]
    kind[heads[kind[heads] == 1]] = 0
    mark = kind == 2
    if (kind == 1).any():
        base = np.maximum.accumulate(np.where(kind != 1, np.arange(len(data)), -1))
        mark |= (kind == 1) & (base >= 0) & (kind[base] == 2)
    # Latin capitals of two bytes, C3 80 to C3 9E, to their small forms.
    at = np.flatnonzero(data[:-1] == 0xC3)
    upper = at[(data[at + 1] >= 0x80) & (data[at + 1] <= 0x9E)] if len(at) else at
    low[upper + 1] += 0x20
    return np.where(mark, low, 0)


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell and word number of every n-gram, and the text number of every word.

    Words are runs of letters; a gram may hold the gaps before and after its word.
    """
    low = letters(data, bounds)
    solid = low > 0
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    begins = solid & ~(np.concatenate([[False], solid[:-1]]) & ~first[:-1])
    at = np.flatnonzero(solid)
    word = np.cumsum(begins)[at] - 1
    text = np.searchsorted(bounds, np.flatnonzero(begins), side="right") - 1
    padded = np.zeros(len(low) + 2, np.uint32)
    padded[1:-1] = low
    edge = np.flatnonzero(first[:-1])
    before, after = padded[:-2].copy(), padded[2:].copy()
    before[edge] = 0
    after[edge[edge > 0] - 1] = 0
    value = (before[at] << np.uint32(16)) | (padded[1:-1][at] << np.uint32(8)) | after[at]
    cell = (value * np.uint32(2654435761)) >> np.uint32(17)
    return cell.astype(np.int64), word, text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, cell, n: the n-grams of a task's texts, added up by language before the shuffle."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for row, data, bounds in text_bytes(batch.column(0)):
            cell, word, text = grams(data, bounds)
            names = langs[row:row + len(bounds) - 1]
            codes = {x: i for i, x in enumerate(dict.fromkeys(names))}
            code = np.array([codes[x] for x in names], np.int64)
            both = np.bincount(code[text[word]] * CELLS + cell, minlength=len(codes) * CELLS)
            for x, i in codes.items():
                part = both[i * CELLS:(i + 1) * CELLS]
                total[x] = total[x] + part if x in total else part
    for x, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x] * len(at), pa.string()), pa.array(at, pa.int32()),
             pa.array(n[at], pa.int64())], names=["lang", "cell", "n"])


class Model:
    """Log-probabilities, a row of CELLS for each language. Its size does not depend on the rows."""

    def __init__(self, names: list[str], logs: np.ndarray):
        self.names, self.logs = names, logs


def fit(docs: DataFrame) -> Model:
    """Counts over all rows of `docs` (text, lang) whose lang is not null."""
    with small_batches(docs.sparkSession):
        counts = (docs.where("lang is not null").select(
                      F.col("text").cast("string"), F.col("lang").cast("string"))
                  .mapInArrow(_count, "lang string, cell int, n long")
                  .groupBy("lang", "cell").agg(F.sum("n").alias("n"))
                  .groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
                  .toArrow())  # one row a language, of CELLS counts at most
    names = sorted(counts.column("lang").to_pylist())
    logs = np.zeros((len(names), CELLS), np.float32)
    for lang, cells in zip(counts.column("lang").to_pylist(), counts.column("cells"), strict=True):
        n = np.full(CELLS, SMOOTH)
        flat = cells.values
        n[flat.field("cell").to_numpy()] += flat.field("n").to_numpy()
        logs[names.index(lang)] = np.log(n / n.sum())
    return Model(names, logs)


def mixtures(scores: np.ndarray, text: np.ndarray, n_texts: int,
             allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by EM over words, and the log-likelihood, for the languages each text allows.

    scores: log-likelihood of each word by language; text: of each word, ascending.
    """
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    there = text[starts]
    share = np.zeros((n_texts, scores.shape[1]))
    share[there] = allowed[there] / np.maximum(allowed[there].sum(1, keepdims=True), 1)
    top = np.where(allowed[text], scores, -np.inf).max(1, keepdims=True)
    weights = np.exp(np.clip(scores - top, -700, 0)) * allowed[text]
    count = np.bincount(text, minlength=n_texts)[:, None]
    likelihood = np.zeros(n_texts)
    for _ in range(ROUNDS):
        joint = weights * share[text]
        whole = joint.sum(1, keepdims=True)
        share[there] = np.add.reduceat(joint / np.maximum(whole, 1e-300), starts) / count[there]
    whole = (weights * share[text]).sum(1)
    likelihood[there] = np.add.reduceat(np.log(np.maximum(whole, 1e-300)) + top[:, 0], starts)
    return share, likelihood


def infer(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[list, np.ndarray]:
    """Of each text the shares by language (None without a letter), in the chosen set."""
    n, k = len(bounds) - 1, len(model.names)
    out: list = [None] * n
    cell, word, text = grams(data, bounds)
    if not k or not len(word):
        return out, np.zeros(n)
    begins = np.flatnonzero(np.diff(word, prepend=-1))
    scores = np.stack([np.add.reduceat(model.logs[i][cell], begins, dtype=np.float64)
                       for i in range(k)], 1)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    there = text[starts]
    count = np.bincount(text, minlength=n)
    single = np.full((n, k), -np.inf)
    single[there] = np.add.reduceat(scores, starts)
    best, best_share = single.max(1), (np.arange(k) == single.argmax(1)[:, None]).astype(float)
    fine = PENALTY * np.log2(1 + count)
    # No mixture is likelier than every word in its own best language. Where even that does not
    # outweigh one penalty, the single language is the answer.
    ceiling = np.full(n, -np.inf)
    ceiling[there] = np.add.reduceat(scores.max(1), starts)
    live = ceiling - fine > best
    mine = live[text]
    if mine.any():
        share, full = mixtures(scores[mine], text[mine], n, np.ones((n, k)))
        rank = np.argsort(np.argsort(-share, 1, kind="stable"), 1)
        live &= full - fine > best
    for size in range(2, k + 1):
        # Only texts whose last set gained go on; the others have their set.
        mine = live[text]
        if not mine.any():
            break
        tried, likelihood = mixtures(scores[mine], text[mine], n, (rank < size).astype(float))
        value = likelihood - (size - 1) * fine
        live &= value > best
        best = np.where(live, value, best)
        best_share = np.where(live[:, None], tried, best_share)
    for i in np.flatnonzero(count):
        out[i] = best_share[i]
    return out, best


def _predict(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        for batch in batches:
            for row, data, bounds in text_bytes(batch.column(1), 1 << 20):
                shares, _ = infer(model, data, bounds)
                top = [UNKNOWN if s is None else model.names[int(np.argmax(s))] for s in shares]
                score = [0.0 if s is None else min(1.0, float(s.max())) for s in shares]
                mix = [None if s is None else [
                    {"lang": model.names[j], "share": float(s[j])}
                    for j in np.argsort(-s, kind="stable") if s[j] > 0.005] for s in shares]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(shares)), pa.array(top, pa.string()),
                     pa.array(score, pa.float64()), pa.array(mix, pa.list_(pa.struct(
                         [("lang", pa.string()), ("share", pa.float64())])))],
                    names=["doc_id", "lang_pred", "score", "mixture"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (its share of the words) and mixture, the languages of the set.

    One row per row of `docs`; only `text` is looked at, whole. A null text, one without a letter,
    and any text when nothing was learned: `und`, score 0, null mixture. Ties go to the first name.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.names, model.logs))
    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _predict(lambda: Model(*sent.value)),
        "doc_id " + docs.schema["doc_id"].dataType.simpleString()
        + ", lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
    return stored(found, "languages")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """True for the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts all of them."""
    held = fold(F.col("doc_id"))
    return predict(docs, fit(docs.where(~held))).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "mixture")
