"""Language ID by string kernels: presence of n-grams, Nyström landmarks, one-versus-rest kernel ridge regression.

The blended-spectrum presence kernel of two texts is the number of n-grams, of all ``ORDERS``, that both have, over the
square root of how many each has. N-grams are runs of UTF-8 bytes, with A-Z lower-cased and every other ASCII character
but a-z a space; texts are compared on the n-grams that the landmarks have.

Landmarks are texts of the sample. With C the kernel of texts and landmarks and W that of the landmarks themselves, a
text's Nyström features are C W^-1/2, and one ridge regression per language on them (1 for the language, -1 for the rest,
languages weighing the same) folds into one matrix, so that a batch of texts is scored by two products: presence times
presence of the landmarks gives C, C times that matrix the scores.

Fitted on a bounded sample on the driver: for each language the ``PER_LANG`` documents with the smallest hash of their
id, ``SAMPLE`` in all, less those of over ``MAX_BYTES``. Scoring is one pass over the whole texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.llm import bytetext

ORDERS = (1, 2, 3, 4)
PER_LANG, SAMPLE, MAX_BYTES = 250, 2000, 1 << 15
SALTS = 64
LANDMARKS = 160  # in all
RIDGE, FLOOR = 1e-2, 1e-6
TEXTS = 128  # scored at a time
STRIDE = 1 << 18  # bytes whose n-grams are looked up at a time
PASSAGES = (3, 12)  # words of the short passages that each text of the sample adds to the fit
UNKNOWN = "und"
SLOT_BITS = 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The run of n bytes at every place, packed into a number."""
    out = np.zeros(max(len(data) - n + 1, 0), np.uint32)
    for i in range(n):
        out = (out << np.uint32(8)) | data[i : i + len(out)]
    return out


def _slots(packed: np.ndarray, n: int) -> np.ndarray:
    if 8 * n <= SLOT_BITS:
        return packed
    return (packed * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def distinct(data: np.ndarray) -> list[np.ndarray]:
    """The distinct n-grams of one text, order by order."""
    return [np.unique(grams(_FOLD[data], n)) for n in ORDERS]


class Vocabulary:
    """The n-grams that landmarks have, each with a column; of those that share a slot the most frequent stays."""

    def __init__(self, counted: list[tuple[np.ndarray, np.ndarray]]):
        """counted: (n-grams, in how many landmarks) per order."""
        self.packed, self.size = [], 0
        for n, (names, times) in zip(ORDERS, counted):
            order = np.lexsort((names, -times))
            _, first = np.unique(_slots(names[order], n), return_index=True)
            self.packed.append(np.sort(names[order][first]))
            self.size += len(first)
        self.tables = None

    def __getstate__(self):
        return {"packed": self.packed, "size": self.size, "tables": None}

    def _open(self) -> None:
        """Slot tables per order: column and n-gram; built where they are used."""
        self.tables, base = [], 0
        for n, names in zip(ORDERS, self.packed):
            column = np.full(1 << min(8 * n, SLOT_BITS), -1, np.int32)
            column[_slots(names, n)] = np.arange(base, base + len(names), dtype=np.int32)
            self.tables.append((column, np.r_[np.zeros(base, np.uint32), names, np.zeros(1, np.uint32)]))
            base += len(names)

    def presence(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which n-grams each of the texts data[bounds[i]:bounds[i+1]] has: texts x columns, 0 or 1."""
        if self.tables is None:
            self._open()
        out = np.zeros((len(bounds) - 1, self.size), np.float32)
        data = _FOLD[data]
        for begin in range(int(bounds[0]), int(bounds[-1]), STRIDE):
            end = min(begin + STRIDE, int(bounds[-1]))
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(np.clip(bounds, begin, end)))
            for n, (column, names) in zip(ORDERS, self.tables):
                packed = grams(data[begin : end + n - 1], n)
                own = doc[: len(packed)]
                at = column[_slots(packed, n)]
                ok = (at >= 0) & (names[at] == packed) & (begin + np.arange(len(packed)) + n <= bounds[own + 1])
                out[own[ok], at[ok]] = 1
        return out


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalized presence kernel of the rows of two presence matrices; 0 for rows without n-grams."""
    own, other = (np.sqrt(np.maximum(x.sum(axis=1, dtype=np.float64), 1)) for x in (a, b))
    return (a @ b.T) / own[:, None] / other[None, :]


@dataclass
class Model:
    """Languages, landmarks and weights; without languages everything is unknown."""

    langs: list[str]
    vocabulary: Vocabulary | None = None
    landmarks: np.ndarray | None = None  # packed bits, a row per landmark
    weights: np.ndarray | None = None  # landmarks and a constant x languages
    _held: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_held": None}

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Regression values of some texts, texts x languages."""
        if self._held is None:
            self._held = np.unpackbits(self.landmarks, axis=1, count=self.vocabulary.size).astype(np.float32)
        near = kernel(self.vocabulary.presence(data, bounds), self._held)
        return near @ self.weights[:-1] + self.weights[-1]

    def predict(self, column: pa.Array) -> tuple[list, np.ndarray]:
        """(language, score) of each text; equal scores go to the language that is first by code point."""
        langs, out = [], [np.zeros(0)]
        for a, b, data, bounds in bytetext.pieces(column):
            for i in range(0, b - a, TEXTS):
                j = min(i + TEXTS, b - a)
                if not self.langs:
                    langs += [UNKNOWN] * (j - i)
                    out.append(np.zeros(j - i))
                    continue
                scores = self.scores(data, bounds[i : j + 1])
                best = scores.argmax(axis=1)
                langs += [self.langs[k] for k in best]
                out.append(np.clip((1 + scores[np.arange(j - i), best]) / 2, 0, 1))
        return langs, np.concatenate(out)


def passages(text: bytes, seed: int) -> list[bytes]:
    """The text and short passages of it (by words), from places that the seed decides."""
    words, out = text.split(), [text]
    for size in PASSAGES:
        if len(words) > size:
            at = int(bytetext.mixed(np.array([seed * 64 + size], np.uint64))[0] % np.uint64(len(words) - size + 1))
            out.append(b" ".join(words[at : at + size]))
    return out


def fit(sample: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """The model of (language, text) rows. One language: that one always; none: everything unknown."""
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return Model([])
    by_lang = {lang: [t for own, t in sample if own == lang] for lang in langs}
    share = max(landmarks // len(langs), 1)
    chosen = [t for lang in langs for t in by_lang[lang][:share]]
    seen = [distinct(np.frombuffer(t, np.uint8)) for t in chosen]
    vocabulary = Vocabulary([np.unique(np.concatenate([s[i] for s in seen]), return_counts=True)
                             for i in range(len(ORDERS))])

    def present(texts: list[bytes]) -> np.ndarray:
        return vocabulary.presence(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])])

    held = present(chosen)
    rows = [(langs.index(lang), p) for i, (lang, t) in enumerate(sample) for p in passages(t, i)]
    near = np.concatenate([kernel(present([p for _, p in rows[i : i + TEXTS]]), held) for i in range(0, len(rows), TEXTS)])
    y = np.array([k for k, _ in rows])
    target = np.where(y[:, None] == np.arange(len(langs))[None, :], 1.0, -1.0)
    weight = 1.0 / np.bincount(y, minlength=len(langs))[y] / len(langs)
    values, vectors = np.linalg.eigh(kernel(held, held))
    keep = values > FLOOR * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # W^-1/2 on the space that the landmarks span
    x = np.c_[near @ root, np.ones(len(near))]
    penalty = ridge * np.eye(x.shape[1]) / len(langs)
    penalty[-1, -1] = 0
    solved = np.linalg.solve(x.T @ (x * weight[:, None]) + penalty, x.T @ (target * weight[:, None]))
    return Model(langs, vocabulary, np.packbits(held.astype(bool), axis=1), np.r_[root @ solved[:-1], solved[-1:]])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def sampled(docs: DataFrame, per_lang: int = PER_LANG, size: int = SAMPLE, max_bytes: int = MAX_BYTES) -> list:
    """(language, text) rows to learn from, in a fixed order, ``size`` at most, none of held-out documents."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 2)).filter(
        F.octet_length("text") <= max_bytes)
    ids = known.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64("doc_id").alias("_hash"))
    picked = ids.distinct().withColumn("_salt", F.pmod("_hash", F.lit(SALTS)))
    for group in (["_lang", "_salt"], ["_lang"]):  # what a language's task gets is SALTS * per_lang ids at most
        order = Window.partitionBy(*group).orderBy("_hash", "_id")
        picked = picked.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= per_lang)
    picked = picked.orderBy("_nth", "_hash", "_id", "_lang").limit(size).drop("_salt")
    mine = (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(picked), mine)  # at most ``size`` ids are broadcast
    rows = rows.groupBy("_nth", "_hash", "_id", "_lang").agg(F.min("text").alias("text"))
    return [(r["_lang"], r["text"].encode()) for r in sorted(
        rows.collect(), key=lambda r: (r["_nth"], r["_hash"], str(r["_id"]), r["_lang"]))]


def train(docs: DataFrame, **bounds) -> Model:
    """The model of the labelled documents that are not held out."""
    return fit(sampled(docs, **bounds))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Null texts, and texts without a letter, are 'und' with score 0; so is everything if the model knows no language.
    A null id is not held out; rows that repeat are predicted one by one; other columns are ignored. No documents: no
    rows.
    """
    def predict(batches):
        for batch in batches:
            langs, scores = model.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("letters"), pa.array(langs, pa.string()), pa.array(scores)],
                ["doc_id", "letters", "lang", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return docs.select("doc_id", "text", letters).mapInArrow(
        predict, f"doc_id {kind}, letters boolean, lang string, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        F.when(F.col("letters"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def op13_kernel_langid(spark, sf_dir: str) -> DataFrame:
    """Languages of the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identified(docs, train(docs))
