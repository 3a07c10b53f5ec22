"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from its bytes; a small network turns the
encodings h into gated attention weights a = softmax(w . (tanh(V h) * sigmoid(U h))), and the
weighted representation sum(a h) is scored. Only document labels are used; the attention learns
which passages decide.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import small_batches, stored
from millrace.llm.hashing import U64, text_bytes, word_hashes, words

PASSAGE = 64
HIDDEN, GATE = 24, 16
# Training looks at this many documents at most, and like scoring at every passage of each.
MOST_DOCUMENTS = 4000
# Encoded passages held at once in training, and bytes of text a task encodes for it.
PIECE, PART = 8192, 8 << 20
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.01, 1e-4
BUCKETS = 32

# Classes of bytes: blank, line feed, a-z, A-Z, digit, full stop and comma, dash and quote,
# bracket, pipe and slash, other ASCII mark, control, lead byte, continuation byte.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[:32] = 10
_CLASS[[32, 9]] = 0
_CLASS[[10, 13]] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[44, 46]] = 5
_CLASS[[34, 39, 45]] = 6
_CLASS[[40, 41, 60, 62, 91, 93, 123, 125]] = 7
_CLASS[[47, 92, 124]] = 8
_CLASS[192:] = 11
_CLASS[128:192] = 12
CLASSES = 13
FEATURES = CLASSES * CLASSES + BUCKETS + 7


def _unique(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """How many different values each group has."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    return np.bincount(g[fresh], minlength=n)


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, encoding) of every passage, a run of PASSAGE words. A text without words is
    one passage without words."""
    text, starts, ends = words(data, bounds)
    n_texts = len(bounds) - 1
    count = np.bincount(text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(count)])
    each = np.maximum(-(-count // PASSAGE), 1)
    base = np.concatenate([[0], np.cumsum(each)])
    n = int(base[-1])
    place = np.arange(len(text)) - first[text]
    mine = base[text] + place // PASSAGE
    out = np.zeros((n, FEATURES), np.float32)
    owner = np.repeat(np.arange(n_texts), each)
    if not len(text):
        return owner, out
    # Shares of pairs of byte classes; a pair belongs to the passage its first byte lies in.
    kind = _CLASS[data].astype(np.int64)
    heads = np.flatnonzero(np.diff(mine, prepend=-1))
    begins = np.empty(n, np.int64)
    begins[mine[heads]] = starts[heads]
    begins[base[:-1]] = bounds[:-1]
    of_byte = np.repeat(np.arange(n), np.diff(np.append(begins, len(data))))
    pair = of_byte[:-1] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:]
    within = np.ones(len(data), bool)
    within[bounds[1:-1][bounds[1:-1] < len(data)]] = False  # pairs across two texts
    pairs = np.bincount(pair[within[1:]], minlength=n * CLASSES * CLASSES)
    pairs = pairs.reshape(n, -1)
    total = np.maximum(pairs.sum(1, keepdims=True), 1)
    out[:, :CLASSES * CLASSES] = np.sqrt(pairs / total)
    # Words: hashed shares, how many differ in the passage and in the text, repeats next to each
    # other, lengths.
    hashed = word_hashes(data, starts, ends)
    number = np.maximum(np.bincount(mine, minlength=n), 1)
    at = CLASSES * CLASSES
    held = np.bincount(mine * BUCKETS + (hashed % U64(BUCKETS)).astype(np.int64),
                       minlength=n * BUCKETS).reshape(n, -1)
    out[:, at:at + BUCKETS] = np.sqrt(held / number[:, None])
    at += BUCKETS
    same = np.zeros(len(text), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (text[1:] == text[:-1])
    length = (ends - starts).astype(float)
    mean = np.bincount(mine, length, minlength=n) / number
    square = np.bincount(mine, length * length, minlength=n) / number
    out[:, at] = _unique(mine, hashed, n) / number
    out[:, at + 1] = np.bincount(mine, same, minlength=n) / number
    out[:, at + 2] = np.log1p(mean)
    out[:, at + 3] = np.log1p(np.sqrt(np.maximum(square - mean * mean, 0)))
    out[:, at + 4] = (_unique(text, hashed, n_texts) / np.maximum(count, 1))[owner]
    out[:, at + 5] = np.log1p(count)[owner]
    out[:, at + 6] = np.log1p(number)
    out[np.bincount(mine, minlength=n) == 0] = 0
    return owner, out


@dataclass
class Model:
    """The network. Its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]


def _forward(w, x, owner, n):
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    s = (t * g) @ w["w"]
    starts = np.searchsorted(owner, np.arange(n))  # every text has a passage
    e = np.exp(s - np.maximum.reduceat(s, starts)[owner])
    a = e / np.add.reduceat(e, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
    return h, t, g, a, z, p


def _gradient(w, x, owner, y):
    n = len(y)
    h, t, g, a, z, p = _forward(w, x, owner, n)
    out = (p - y) / n
    dz = np.outer(out, w["c"])
    da = (dz[owner] * h).sum(1)
    dh = a[:, None] * dz[owner]
    ds = a * (da - np.bincount(owner, a * da, minlength=n)[owner])
    dt, dg = ds[:, None] * w["w"] * g, ds[:, None] * w["w"] * t
    dt, dg = dt * (1 - t * t), dg * g * (1 - g)
    dh += dt @ w["V"].T + dg @ w["U"].T
    du = dh * (1 - h * h)
    return {"c": z.T @ out, "d": out.sum(keepdims=True), "w": (t * g).T @ ds, "V": h.T @ dt,
            "U": h.T @ dg, "W": x.T @ du, "b": du.sum(0)}


def _long_gradient(w, pieces, y):
    """The gradient of one bag that comes in pieces; pieces() reads them anew. The softmax is summed
    over the pieces first. z . dz is the weighted sum of da over the bag."""
    top, total, z = -np.inf, 0.0, 0.0
    for x in pieces():
        h = np.tanh(x @ w["W"] + w["b"])
        s = (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))) @ w["w"]
        high = max(top, float(s.max()))
        old, e = np.exp(top - high), np.exp(s - high)
        top, total, z = high, total * old + float(e.sum()), z * old + e @ h
    z = z / total
    p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"][0], -30, 30)))
    out = p - y
    dz = out * w["c"]
    sums = {"c": z * out, "d": np.array([out]), **{k: np.zeros_like(w[k]) for k in "wVUWb"}}
    for x in pieces():
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        a = np.exp((t * g) @ w["w"] - top) / total
        ds = a * (h @ dz - z @ dz)
        dt, dg = ds[:, None] * w["w"] * g, ds[:, None] * w["w"] * t
        dt, dg = dt * (1 - t * t), dg * g * (1 - g)
        du = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        for k, v in (("w", (t * g).T @ ds), ("V", h.T @ dt), ("U", h.T @ dg), ("W", x.T @ du),
                     ("b", du.sum(0))):
            sums[k] = sums[k] + v
    return sums


class Bags:
    """Encoded bags in a file of the driver's own: memory holds a piece of them."""

    def __init__(self):
        self.file, self.first, self.size, self.key, self.labels = (
            tempfile.TemporaryFile(), [], [], [], [])
        self.rows = 0

    def add(self, data: bytes, label: int, fresh: bool) -> None:
        """A bag, or the next piece of the one before."""
        if fresh:
            self.first.append(self.rows)
            self.size.append(0)
            self.key.append(hashlib.blake2b(digest_size=16))
            self.labels.append(int(label > 0))
        self.file.write(data)
        self.key[-1].update(data)
        n = len(data) // (4 * FEATURES)
        self.size[-1] += n
        self.rows += n

    def order(self) -> list[int]:
        """By content, so that it does not depend on how the rows lie."""
        return sorted(range(len(self.size)), key=lambda i: (self.key[i].digest(), self.labels[i]))

    def pieces(self, i: int) -> Iterator[np.ndarray]:
        for at in range(0, self.size[i], PIECE):
            n = min(PIECE, self.size[i] - at)
            self.file.seek((self.first[i] + at) * 4 * FEATURES)
            yield np.frombuffer(self.file.read(n * 4 * FEATURES), "<f4").reshape(n, FEATURES)


def _moments(bags: Bags, order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    mean = sum(x.sum(0, dtype=np.float64) for i in order for x in bags.pieces(i)) / bags.rows
    square = sum(((x - mean) ** 2).sum(0) for i in order for x in bags.pieces(i)) / bags.rows
    return mean.astype(np.float32), np.sqrt(square).astype(np.float32) + np.float32(0.02)


def batch_gradient(w, bags: Bags, part: list[int], scaled) -> dict[str, np.ndarray]:
    """The mean gradient over the bags `part`: short ones together, long ones in pieces."""
    groups, held = [[]], 0
    for i in part:
        if held + bags.size[i] > PIECE and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(i)
        held += bags.size[i]
    total = {k: np.zeros_like(x) for k, x in w.items()}
    for group in groups:
        if len(group) == 1 and bags.size[group[0]] > PIECE:
            i = group[0]
            grads = _long_gradient(w, lambda i=i: map(scaled, bags.pieces(i)), bags.labels[i])
        else:
            owner = np.repeat(np.arange(len(group)), [bags.size[i] for i in group])
            x = np.concatenate([p for i in group for p in bags.pieces(i)])
            grads = _gradient(w, scaled(x), owner,
                              np.array([bags.labels[i] for i in group], np.float32))
        for k, g in grads.items():
            total[k] = total[k] + (g * (len(group) / len(part))).astype(w[k].dtype)
    return total


def train(bags: Bags, seed: int = 7) -> Model:
    """Adam on the log-loss of the documents, in a fixed order of batches."""
    rng = np.random.default_rng(seed)
    order = bags.order()
    mean, scale = _moments(bags, order)

    def scaled(x):
        return ((x - mean) / scale).clip(-6, 6)
    f = FEATURES
    share = float(np.clip(np.mean(bags.labels), 0.01, 0.99))
    w = {"W": rng.normal(0, 1 / np.sqrt(f), (f, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)),
         "w": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN),
         "d": np.array([np.log(share / (1 - share))])}
    w = {k: x.astype(np.float32) for k, x in w.items()}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        dealt = [order[i] for i in rng.permutation(len(order))]
        for s in range(0, len(dealt), BATCH):
            grads = batch_gradient(w, bags, dealt[s:s + BATCH], scaled)
            step += 1
            for k, g in grads.items():
                g = g + DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, bounds in text_bytes(batch.column(0)):
            owner, x = passages(data, bounds)
            labels = batch.column(1).slice(row, len(bounds) - 1).to_pylist()
            for i, label in enumerate(labels):
                a, b = np.searchsorted(owner, [i, i + 1])
                for at in range(a, b, PIECE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[at:min(b, at + PIECE)].astype("<f4").tobytes()], pa.binary()),
                         pa.array([label], pa.int32()), pa.array([at == a])],
                        names=["bag", "label", "fresh"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        most: int = MOST_DOCUMENTS) -> Model | None:
    """Learns from at most `most` labelled documents, those with the least hash of their id.

    Rows without a label do not count; a document with several labels counts with the least one.
    None when nothing is labelled.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg(F.min(label).cast("int").alias("_label"))
    there = docs.select("doc_id").join(marked, "doc_id").distinct()
    chosen = stored(there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labelled")
    texts = stored(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "labelled_texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bags = Bags()
    with small_batches(docs.sparkSession):
        # A part at a time comes to the driver, and the pieces of a bag one after the other.
        for row in texts.repartition(1 + size // PART, "doc_id").select("text", "_label").mapInArrow(
                _bags, "bag binary, label int, fresh boolean").toLocalIterator():
            bags.add(row.bag, row.label, row.fresh)
    return train(bags) if bags.rows else None


def _score(model_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of()
        for batch in batches:
            for row, data, bounds in text_bytes(batch.column(1), 1 << 19):
                owner, x = passages(data, bounds)
                x = ((x - model.mean) / model.scale).clip(-6, 6)
                *_, a, _, p = _forward(model.weights, x, owner, len(bounds) - 1)
                most = np.maximum.reduceat(a, np.searchsorted(owner, np.arange(len(p))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(p)), pa.array(p, pa.float64()),
                     pa.array(np.bincount(owner, minlength=len(p)), pa.int32()),
                     pa.array(most, pa.float64())],
                    names=["doc_id", "score", "passages", "attention"])
    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Stored: doc_id, score (0 to 1), passages, attention (the largest weight of a passage).

    One row per row of `docs`; only the text is looked at, whole. A null text counts as empty and
    is scored as one passage without words. Without a model every score is 0.5.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"), F.lit(1).alias("passages"),
                           F.lit(1.0).alias("attention"))
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.mean, model.scale, model.weights))
    return stored(docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _score(lambda: Model(*sent.value)),
        f"doc_id {kind}, score double, passages int, attention double"), "scores")
