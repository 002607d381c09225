"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line has shape features of its own and of the line before and after; the chain links the labels (bad, good) of
neighbouring lines. A document's quality is the mean of its lines' marginal probabilities of being good, from the
forward-backward recursion, weighted by line length.

Labels are known per document only, so its lines all carry the document's label in training, and every document
weighs the same. Training reads a bounded sample: the ``MAX_DOCS`` labelled documents with the smallest hash of their
id, less those of over ``MAX_LINES`` lines. Scoring is one pass over the texts, piece by piece, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strikelake.llm import bytetext

MAX_DOCS = 3000
MAX_LINES = 400
ACCEPT = 0.3
STEPS, RATE, RIDGE = 150, 0.1, 1e-3

_SHAPES = ["lower", "upper", "digit", "space", "stop", "shout", "bar", "sign", "wide", "newline"]
_SHAPE = np.full(256, _SHAPES.index("sign"), np.int64)
for _name, _bytes in {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": bytes(range(48, 58)), "space": b" \t\r\x0b\x0c",
    "stop": b".,;:'\"?-()", "shout": b"!", "bar": b"|", "newline": b"\n", "wide": bytes(range(128, 256)),
}.items():
    _SHAPE[np.frombuffer(_bytes, np.uint8)] = _SHAPES.index(_name)
OWN = 15


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length, first line of each document and the end) of the lines of some documents.

    A document has one line more than newlines; an empty one has an empty line.
    """
    n_docs = len(bounds) - 1
    newline = np.flatnonzero(data == 10)
    of_doc = np.searchsorted(bounds, newline, "right") - 1
    first = np.arange(n_docs + 1) + np.searchsorted(newline, bounds)
    n = int(first[-1])
    start = np.empty(n, np.int64)
    start[first[:-1]] = bounds[:-1]
    after = of_doc + np.arange(len(newline)) + 1
    start[after] = newline + 1
    end = np.empty(n, np.int64)
    end[first[1:] - 1] = bounds[1:]
    end[after - 1] = newline
    length = end - start
    line = np.repeat(np.arange(n_docs), np.diff(bounds)) + np.cumsum(data == 10) - (data == 10)
    shapes = np.bincount(line * len(_SHAPES) + _SHAPE[data], minlength=n * len(_SHAPES)).reshape(n, len(_SHAPES))
    lower, upper, digit, space, stop, shout, bar, sign, wide, _ = shapes.T
    size = np.maximum(length, 1)
    words = bytetext.words_of(data, bounds, bytetext.SPACED, lower=False)
    at = line[words.start]
    count = np.bincount(at, minlength=n)
    known = np.maximum(count, 1)
    again = np.zeros(n)
    if len(at) > 1:
        same = (at[1:] == at[:-1]) & (words.hash[1:] == words.hash[:-1])
        again = np.bincount(at[1:][same], minlength=n)
    distinct = np.bincount(_firsts(at, words.hash), minlength=n)
    total = np.zeros(n, np.uint64)
    np.add.at(total, at, bytetext.mixed(words.hash, 3))
    owner = np.repeat(np.arange(n_docs), np.diff(first))
    order = np.lexsort((total, owner))
    twin = np.zeros(n, bool)
    pair = (owner[order][1:] == owner[order][:-1]) & (total[order][1:] == total[order][:-1])
    twin[order[1:][pair]] = True
    twin[order[:-1][pair]] = True
    signs = np.bincount(at, weights=_SHAPE[words.data[words.end - 1]] == _SHAPES.index("sign"), minlength=n)
    columns = [
        upper / np.maximum(upper + lower, 1), digit / size, space / size, stop / size, np.sqrt(shout / size),
        np.sqrt(bar / size), np.sqrt(sign / size), wide / size, again / known, distinct / known,
        np.minimum((length - space) / known, 30) / 10, np.log1p(count) / 5, twin & (count > 0), length == 0, signs / known,
    ]
    return np.stack(columns, axis=1).astype(float), length + 1.0, first


def _firsts(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The line of every distinct (line, word)."""
    order = np.lexsort((hashes, at))
    a, h = at[order], hashes[order]
    return a[np.r_[np.ones(min(len(a), 1), bool), (a[1:] != a[:-1]) | (h[1:] != h[:-1])]]


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0 where there is none), and a constant."""
    n, k = own.shape
    out = np.zeros((n, 3 * k + 3))
    out[:, :k] = own
    out[1:, k : 2 * k] = own[:-1]
    out[:-1, 2 * k : 3 * k] = own[1:]
    begin, last = first[:-1], first[1:] - 1
    out[begin, k : 2 * k] = 0
    out[last, 2 * k : 3 * k] = 0
    out[begin, 3 * k] = 1
    out[last, 3 * k + 1] = 1
    out[:, 3 * k + 2] = 1
    return out


def forward_backward(good: np.ndarray, links: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, log partition per line) in logs for scores of 'good' against 0 and 2 x 2 link scores."""
    n = len(good)
    node = np.stack([np.zeros(n), good], axis=1)
    alpha, beta = node.copy(), np.zeros((n, 2))
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begins, sizes = first[:-1][order], counts[order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0)), "left")  # longer than t lines
    for t, m in enumerate(active, 1):
        i = begins[:m] + t
        before = alpha[i - 1]
        for b in (0, 1):
            alpha[i, b] += np.logaddexp(before[:, 0] + links[0, b], before[:, 1] + links[1, b])
    for t, m in reversed(list(enumerate(active, 1))):
        i = begins[:m] + t
        after = beta[i] + node[i]
        for a in (0, 1):
            beta[i - 1, a] = np.logaddexp(after[:, 0] + links[a, 0], after[:, 1] + links[a, 1])
    both = alpha + beta
    return alpha, beta, np.logaddexp(both[:, 0], both[:, 1])


@dataclass(frozen=True)
class Model:
    """Weights of the field; ``score`` is what it is for."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    links: np.ndarray

    def marginals(self, own: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each line to be good."""
        good = with_neighbours((own - self.mean) / self.scale, first) @ self.weights
        alpha, beta, total = forward_backward(good, self.links, first)
        return np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - total, 0.0))

    def score(self, column: pa.Array) -> np.ndarray:
        """Length-weighted mean marginal of each text."""
        out = [np.zeros(0)]
        for _, _, data, bounds in bytetext.pieces(column):
            own, length, first = line_features(data, bounds)
            p = self.marginals(own, first) * length
            out.append(np.add.reduceat(p, first[:-1]) / np.add.reduceat(length, first[:-1]))
        return np.clip(np.concatenate(out), 0.0, 1.0)


def fit(features: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> Model:
    """The field's weights by penalized likelihood from line features and one label per document.

    Without documents, or with one label only, the weights fall back to a constant of that side.
    """
    own = np.concatenate(features) if features else np.zeros((0, OWN))
    mean = own.mean(axis=0) if len(own) else np.zeros(OWN)
    scale = np.maximum(own.std(axis=0), 0.02) if len(own) else np.ones(OWN)
    weights, links = np.zeros(3 * OWN + 3), np.zeros((2, 2))
    if not features or len(set(labels.tolist())) < 2:
        weights[-1] = 0.0 if not features else (4.0 if labels[0] else -4.0)
        return Model(mean, scale, weights, links)
    first = np.r_[0, np.cumsum([len(f) for f in features])]
    x = with_neighbours((own - mean) / scale, first)
    sizes = np.diff(first)
    y, share = np.repeat(labels, sizes).astype(float), np.repeat(1.0 / sizes, sizes)
    inner = np.ones(len(own), bool)
    inner[first[1:] - 1] = False
    i = np.flatnonzero(inner)
    flat = np.zeros(len(weights) + 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        w, t = flat[:-4], flat[-4:].reshape(2, 2)
        good = x @ w
        alpha, beta, total = forward_backward(good, t, first)
        p = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - total, 0.0))
        gradient = np.zeros_like(flat)
        gradient[:-4] = x.T @ ((p - y) * share)
        node = np.stack([np.zeros(len(good)), good], axis=1)
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(alpha[i, a] + t[a, b] + node[i + 1, b] + beta[i + 1, b] - total[i])
                seen = (y[i] == a) & (y[i + 1] == b)
                gradient[len(w) + 2 * a + b] = ((pair - seen) * share[i]).sum()
        gradient = gradient / len(labels) + RIDGE * flat
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        flat = flat - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, flat[:-4], flat[-4:].reshape(2, 2))


def fold(doc_id):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Model:
    """The model of the labelled documents outside fold 0 (a bounded sample of them, in a fixed order)."""
    known = labels.filter(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(
        F.avg("quality").alias("_quality"))  # several labels: the majority, bad if even
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).select(
        F.col("doc_id").alias("_id"), (F.col("_quality") > 0.5).alias("_good"))

    def cut(batches):
        for batch in batches:
            rows = []
            for _, _, data, bounds in bytetext.pieces(batch.column("text")):
                own, _, first = line_features(data, bounds)
                rows += [own[a:b].ravel() for a, b in zip(first[:-1], first[1:])]
            keep = pa.array([len(r) <= max_lines * OWN for r in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_good"), pa.array(rows, pa.list_(pa.float64()))],
                ["_id", "_good", "features"]).filter(keep)

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select(
        "_id", "_good", "text")  # at most max_docs ids are broadcast
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(cut, f"_id {kind}, _good boolean, features array<double>").collect()
    rows.sort(key=lambda r: (str(r["_id"]), r["features"]))
    return fit([np.array(r["features"]).reshape(-1, OWN) for r in rows[: 2 * max_docs]],
               np.array([r["_good"] for r in rows[: 2 * max_docs]], np.int64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are one empty line and get the score of that; a null id is not held out; repeated rows are
    scored one by one; other columns are ignored.
    """
    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(batch.column("text")))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (all columns) without the rows that the model rejects."""
    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(batch.column("text")) >= ACCEPT))

    return docs.mapInArrow(keep, docs.schema)


def op1_crf_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of the whole documents table."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, train(docs, labels))
