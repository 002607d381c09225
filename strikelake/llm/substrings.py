"""Substring deduplication by recompression: locally consistent names for long runs of words.

A text is a sequence of word names. First, runs of one word become one symbol each; then, round by round, every pair
of a 'left' and a 'right' symbol becomes one symbol (a symbol's side in a round is a bit of its name). A new name is a
fingerprint of what it replaces, so all documents agree on it without exchanging dictionaries. Equal passages
therefore break into equal symbols, except near their ends, and each symbol knows which words decided it (its
*support*): wherever those words stand, the same symbol stands.

1. The symbols of level ``ROUNDS`` whose support fits a window are counted: packed, named once per piece (about
   ``PIECE`` bytes of whole documents), shuffled by name. A symbol that only one document has rules out every window
   that covers its support.
2. The windows left over are verified: their exact word runs are shuffled the same way, for the smallest document.
3. Each piece gets that answer for its windows and removes the covered words.

Texts are shuffled once, compressed (both joins share one exchange); names travel as sorted arrays and answers as
bitmaps. A name costs one entry per piece, however often it occurs, so hot passages do not pile up in one task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strikelake.llm import bytetext
from strikelake.llm.bytetext import U, mixed
from strikelake.sources.storage import as_table

WINDOW = 13
ROUNDS = 3
PIECE = 1 << 20
ENTRIES = 1_000_000  # per bucket, about
LEAST_BUCKETS = 64
FAR = 1 << 40
NO_ID = np.iinfo(np.int64).max


def phrases(words: bytetext.Words, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, support start, support end, document) of the symbols after some rounds, in order.

    A support that would reach over the end of a document is out of reach (``FAR``): in other surroundings the symbol
    could be part of a longer one.
    """
    doc, n = words.doc, len(words.hash)
    same = np.zeros(n, bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    head = np.flatnonzero(~same)
    length = np.diff(np.r_[head, n])
    name, doc = words.hash[head].copy(), doc[head]
    run = length > 1
    name[run] = mixed(name[run] + U(0x9E37) * length[run].astype(U), 11)
    opens = np.r_[np.ones(min(len(doc), 1), bool), doc[1:] != doc[:-1]]
    closes = np.r_[opens[1:], np.ones(min(len(doc), 1), bool)]
    low = np.where(opens, -FAR, head - 1)  # that a run ends is decided by its neighbours
    high = np.where(closes, FAR, head + length + 1)
    for r in range(rounds):
        n = len(name)
        left = (mixed(name, 100 + r) >> U(40)) & U(1) == 1
        joined = np.zeros(n, bool)  # with the next symbol in one document
        joined[:-1] = doc[:-1] == doc[1:]
        pair = joined & left
        pair[:-1] &= ~left[1:]
        second = np.zeros(n, bool)
        second[1:] = pair[:-1]
        after = np.zeros(n, bool)
        after[1:] = joined[:-1]
        new_low, new_high = low.copy(), high.copy()
        i = np.flatnonzero(left & joined)  # paired with the next, or alone because of it
        new_low[i], new_high[i] = np.minimum(low[i], low[i + 1]), np.maximum(high[i], high[i + 1])
        new_high[left & ~joined] = FAR
        i = np.flatnonzero(~left & after & ~second)  # alone because of the one before
        new_low[i], new_high[i] = np.minimum(low[i], low[i - 1]), np.maximum(high[i], high[i - 1])
        new_low[~left & ~after] = -FAR
        new = name.copy()
        i = np.flatnonzero(pair)
        new[i] = mixed(name[i] * U(0x9E3779B97F4A7C15) + name[i + 1], 200 + r)
        name, low, high, doc = new[~second], new_low[~second], new_high[~second], doc[~second]
    return name, low, high, doc


class Piece:
    """A stored piece: documents with their ids and texts."""

    def __init__(self, ids: bytes, bounds: bytes, texts: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.bounds = np.frombuffer(bounds, np.int64)
        size = int(self.bounds[-1])
        raw = pa.Codec("zstd").decompress(texts, size) if size else b""
        self.data = np.frombuffer(raw, np.uint8)
        self.words = bytetext.words_of(self.data, self.bounds, bytetext.SPACED, lower=False)

    def symbols(self, window: int, rounds: int):
        """(names sorted and distinct, name no. of each useful symbol, start, end, whether two documents here have it).

        Ids decide what is another document: rows that repeat an id are one.
        """
        name, low, high, doc = phrases(self.words, rounds)
        useful = high - low <= window
        name, low, high, owner = name[useful], low[useful], high[useful], self.ids[doc[useful]]
        names, no = np.unique(name, return_inverse=True)
        least, most = np.full(len(names), NO_ID), np.full(len(names), np.iinfo(np.int64).min)
        np.minimum.at(least, no, owner)
        np.maximum.at(most, no, owner)
        return names, no, low, high, least < most

    def windows(self, window: int, rounds: int, shared: np.ndarray):
        """(first word, run name no., names sorted and distinct, smallest id here) of the windows left over."""
        _, no, low, high, _ = self.symbols(window, rounds)
        alone = ~shared[no]
        n = len(self.words.hash)
        depth = np.zeros(n + 1, np.int64)  # windows that start in [high - window, low] cover the support
        np.add.at(depth, np.maximum(high[alone] - window, 0), 1)
        np.add.at(depth, low[alone] + 1, -1)
        at, run = self.words.runs(window)
        left = np.cumsum(depth)[at] == 0
        at = at[left]
        names, no = np.unique(run[left], return_inverse=True)
        least = np.full(len(names), NO_ID)
        np.minimum.at(least, no, self.ids[self.words.doc[at]])
        return at, no, names, least


def cut(docs: DataFrame, piece_bytes: int) -> DataFrame:
    """Stored pieces of whole documents: piece, ids, bounds, texts (compressed), n_words."""
    def pack(batches):
        made = 0
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            rows = []
            for a, b, data, bounds in bytetext.pieces(batch.column("text"), piece_bytes):
                start, _ = bytetext.runs_of(data, bounds, bytetext.SPACED)
                rows.append((base + made, ids[a:b].tobytes(), bounds.astype(np.int64).tobytes(),
                             pa.Codec("zstd").compress(data.tobytes(), asbytes=True), len(start)))
                made += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, _PIECE.types)], schema=_PIECE)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return as_table(source.mapInArrow(
        pack, "piece bigint, ids binary, bounds binary, texts binary, n_words bigint"), "substring-pieces")


_PIECE = pa.schema([("piece", pa.int64()), ("ids", pa.binary()), ("bounds", pa.binary()), ("texts", pa.binary()),
                    ("n_words", pa.int64())])
_PAYLOAD = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), ("payload", pa.binary())])
PAYLOAD = "bucket bigint, piece bigint, payload binary"


def _each(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "n_words"}
        yield row["piece"], Piece(row["ids"], row["bounds"], row["texts"]), row


def _edges(names: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted names change to the next bucket; buckets are equal ranges of names."""
    limits = np.array([(i << 64) // buckets for i in range(1, buckets)], U)
    return np.r_[0, np.searchsorted(names, limits, "left"), len(names)]


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _open(payload: bytes) -> bytes:
    return bytes(pa.Codec("zstd").decompress(payload[8:], int.from_bytes(payload[:8], "little")))


def _flags(rows, names: np.ndarray, buckets: int) -> np.ndarray:
    """Bits of (bucket, payload) answers as one array over the sorted names; buckets without an answer are 0."""
    out, edge = np.zeros(len(names), bool), _edges(names, buckets)
    for row in rows or []:
        a, b = edge[row["bucket"]], edge[row["bucket"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(row["payload"], np.uint8), count=b - a)
    return out


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, _PAYLOAD.types)], schema=_PAYLOAD)


def shared_symbols(pieces: DataFrame, buckets: int, window: int, rounds: int) -> DataFrame:
    """(bucket, piece, payload): which of a piece's names in that bucket two documents have, as bits."""
    def send(batches):
        for batch in batches:
            for piece, own, _ in _each(batch):
                names, _, _, _, twice = own.symbols(window, rounds)
                edge = _edges(names, buckets)
                low = (names & U(2**48 - 1)).view(np.uint16).reshape(-1, 4)[:, :3]  # the bucket and 48 bits
                yield _batch([(i, piece, np.int64(b - a).tobytes() + low[a:b].tobytes()
                               + np.packbits(twice[a:b]).tobytes())
                              for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if a < b])

    def meet(table: pa.Table) -> pa.Table:
        keys, twice, sizes = [], [], []
        for payload in table.column("payload").to_pylist():
            n = int.from_bytes(payload[:8], "little")
            short = np.zeros((n, 4), np.uint16)
            short[:, :3] = np.frombuffer(payload, np.uint16, 3 * n, 8).reshape(n, 3)
            keys.append(short.view(U)[:, 0])
            twice.append(np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 + 6 * n), count=n).astype(bool))
            sizes.append(n)
        key, flag = np.concatenate(keys), np.concatenate(twice)
        order = np.argsort(key, kind="stable")
        head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        many = (np.diff(np.r_[head, len(key)]) > 1) | np.logical_or.reduceat(flag[order], head)
        out = np.empty(len(key), bool)
        out[order] = np.repeat(many, np.diff(np.r_[head, len(key)]))
        bits = [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])]
        return pa.table([table.column("bucket"), table.column("piece"), pa.array(bits, pa.binary())], schema=_PAYLOAD)

    return pieces.select("piece", "ids", "bounds", "texts").mapInArrow(send, PAYLOAD).groupBy("bucket").applyInArrow(
        meet, PAYLOAD)


def smallest_documents(joined: DataFrame, symbol_buckets: int, buckets: int, window: int, rounds: int) -> DataFrame:
    """(bucket, piece, payload): for a piece's windows in that bucket, whether a smaller id than here has it, and it."""
    def send(batches):
        for batch in batches:
            for piece, own, row in _each(batch):
                shared = _flags(row["symbols"], own.symbols(window, rounds)[0], symbol_buckets)
                _, _, names, least = own.windows(window, rounds, shared)
                edge = _edges(names, buckets)
                yield _batch([(i, piece, _squeeze(np.int64(b - a).tobytes() + names[a:b].tobytes()
                                                  + least[a:b].tobytes()))
                              for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if a < b])

    def meet(table: pa.Table) -> pa.Table:
        keys, ids, sizes = [], [], []
        for payload in map(_open, table.column("payload").to_pylist()):
            n = int.from_bytes(payload[:8], "little")
            keys.append(np.frombuffer(payload, U, n, 8))
            ids.append(np.frombuffer(payload, np.int64, n, 8 + 8 * n))
            sizes.append(n)
        key, own = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(key, kind="stable")
        head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        least = np.empty(len(key), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(own[order], head), np.diff(np.r_[head, len(key)]))
        smaller, ends = least < own, np.cumsum(sizes)
        out = [_squeeze(np.packbits(smaller[a:b]).tobytes() + least[a:b][smaller[a:b]].tobytes()) for a, b in
               zip((ends - sizes).tolist(), ends.tolist())]
        return pa.table([table.column("bucket"), table.column("piece"), pa.array(out, pa.binary())], schema=_PAYLOAD)

    return joined.mapInArrow(send, PAYLOAD).groupBy("bucket").applyInArrow(meet, PAYLOAD)


def _gathered(answers: DataFrame, name: str) -> DataFrame:
    """The answers of a piece as one row; a piece has at most one per bucket, and no more than its names."""
    return answers.groupBy("piece").agg(F.collect_list(F.struct("bucket", "payload")).alias(name))


def deduplicated(
    docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, piece_bytes: int = PIECE, with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text on request).

    A word is removed if a window of ``window`` words covers it whose words also start in a document with a smaller
    doc_id; all windows are judged on the input. Null and empty texts have no words; rows that repeat a doc_id are one
    document in that comparison and keep a row each; a null doc_id is larger than all others. Other columns are
    ignored; doc_id is read as a long.
    """
    pieces = cut(docs, piece_bytes)
    words = pieces.agg(F.sum("n_words")).first()[0] or 0
    symbol_buckets = max(LEAST_BUCKETS, math.ceil(words / 2 / ENTRIES))
    window_buckets = max(LEAST_BUCKETS, math.ceil(words / ENTRIES))
    symbols = _gathered(shared_symbols(pieces, symbol_buckets, window, rounds), "symbols")
    texts = pieces.select("piece", "ids", "bounds", "texts")
    joined = texts.join(symbols, "piece", "left")
    answers = _gathered(smallest_documents(joined, symbol_buckets, window_buckets, window, rounds), "smaller")

    def remove(batches):
        for batch in batches:
            for _, own, row in _each(batch):
                shared = _flags(row["symbols"], own.symbols(window, rounds)[0], symbol_buckets)
                at, no, names, least = own.windows(window, rounds, shared)
                edge = _edges(names, window_buckets)
                for answer in row["smaller"] or []:
                    a, b = edge[answer["bucket"]], edge[answer["bucket"] + 1]
                    raw = _open(answer["payload"])
                    n = (b - a + 7) // 8
                    here = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, n), count=b - a)) + a
                    least[here] = np.frombuffer(raw[n:], np.int64)
                words, doc = own.words, own.words.doc
                gone = bytetext.marked(len(words.hash), at[least[no] < own.ids[doc[at]]], window)
                count = np.r_[0, np.cumsum(gone)]
                removed = count[words.first[1:]] - count[words.first[:-1]]
                texts = []
                raw = own.data.tobytes()
                for i in range(len(own.ids)):
                    if removed[i]:
                        a, b = words.first[i], words.first[i + 1]
                        keep = np.flatnonzero(~gone[a:b]) + a
                        kept = b" ".join([raw[s:e] for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist())])
                    else:
                        kept = b" ".join(raw[own.bounds[i] : own.bounds[i + 1]].split())
                    texts.append(kept)
                ids = pa.array(own.ids, mask=own.ids == NO_ID)
                columns = [ids, pa.array(np.diff(words.first)), pa.array(removed),
                           pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode() for t in texts], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    return joined.join(answers, "piece", "left").mapInArrow(remove, schema)


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
        FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)),
least_of AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT rid, list(DISTINCT i + k) AS places FROM win JOIN least_of USING (g), unnest(range(0, {WINDOW})) AS u(k)
         WHERE m < doc_id GROUP BY rid),
one AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT one.rid, string_agg(word, ' ' ORDER BY i) AS s FROM one LEFT JOIN gone USING (rid)
         WHERE NOT coalesce(list_contains(places, i), false) GROUP BY one.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""


def op3_recompression_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of the whole documents table."""
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
