"""Benchmark decontamination: a prefix-filtered join of document words with item-sized windows of benchmark items.

A window is contained in a text only if all its words are, so the prefix that a candidate must share is one token:
the window's rarest word by document frequency over the whole corpus. Where that word stands in a document fixes
where the window would start (positional bound) and whether it fits (length bound); the remaining words are then
compared one by one. Documents stay where they are read: nothing of them is shuffled.

The windows are broadcast in blocks of about ``BLOCK_WINDOWS`` at most (100 bytes each), and every block meets every
document; a task holds one block at a time, so the size of the benchmark changes the time and not a task's memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strikelake.llm import bytetext
from strikelake.sources.storage import as_table

WINDOW = 10
BLOCK_WINDOWS = 200_000
CANDIDATES = 1 << 20


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, n, words) of every window: the hashes of its n words."""
    def cut(batches):
        for batch in batches:
            ids, rows, ns, flat = batch.column("item_id").to_pylist(), [], [], []
            for a, _, words in bytetext.words_in(batch.column("text"), bytetext.ALNUM, lower=True):
                for i in range(len(words.first) - 1):
                    own = words.hash[words.first[i] : words.first[i + 1]].view(np.int64)
                    n = min(size, len(own))
                    for s in range(len(own) - n + 1 if n else 0):
                        rows.append(ids[a + i])
                        ns.append(n)
                        flat.append(own[s : s + n])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.string()), pa.array(ns, pa.int32()), pa.array(flat, pa.list_(pa.int64()))],
                ["item_id", "n", "words"])

    source = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return source.mapInArrow(cut, "item_id string, n int, words array<bigint>")


def frequencies(docs: DataFrame, vocabulary: list) -> DataFrame:
    """(word, docs): how many documents hold each word of the blocks of sorted hashes."""
    def count(batches):
        totals = None
        for batch in batches:
            column = batch.column("text")
            totals = totals or [np.zeros(len(v), np.int64) for v in opened(vocabulary)]
            for _, _, words in bytetext.words_in(column, bytetext.ALNUM, lower=True):
                doc = words.doc
                for total, known in zip(totals, opened(vocabulary)):
                    at = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
                    hit = known[at] == words.hash
                    seen = np.unique(doc[hit] * len(known) + at[hit])
                    total += np.bincount(seen % len(known), minlength=len(known))
        for total, known in zip(totals or [], opened(vocabulary)):
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[held].view(np.int64)), pa.array(total[held])], ["word", "docs"])

    return docs.select("text").mapInArrow(count, "word bigint, docs bigint").groupBy("word").agg(
        F.sum("docs").alias("docs"))


def _named(item: str | None) -> tuple[bool, str]:
    """Order of item names: null, which no name equals, comes first."""
    return item is not None, item or ""


class Index:
    """Windows sorted by their rarest word: key, its place in the window, length, words (padded) and item."""

    def __init__(self, rows, size: int):
        order = sorted(rows, key=lambda r: (r["key"], _named(r["item_id"]), r["words"]))
        self.key = np.array([r["key"] for r in order], np.int64).view(np.uint64)
        by_key = np.argsort(self.key, kind="stable")
        self.key = self.key[by_key]
        order = [order[i] for i in by_key]
        self.place = np.array([r["place"] for r in order], np.int64)
        self.n = np.array([r["n"] for r in order], np.int64)
        self.words = np.zeros((len(order), size), np.int64)
        for i, r in enumerate(order):
            self.words[i, : r["n"]] = r["words"]
        self.words = self.words.view(np.uint64)
        self.item = [r["item_id"] for r in order]
        names = {name: i for i, name in enumerate(sorted(set(self.item), key=_named))}
        self.names, self.item_no = list(names), np.array([names[x] for x in self.item], np.int64)

    def occurrences(self, words: bytetext.Words):
        """(first word, window) of every occurrence of a window in the documents."""
        a = np.searchsorted(self.key, words.hash, "left")
        found = np.flatnonzero((a < len(self.key)) & (self.key[np.minimum(a, len(self.key) - 1)] == words.hash))
        a = a[found]
        many = np.searchsorted(self.key, words.hash[found], "right") - a
        lo = np.repeat(words.first[:-1], np.diff(words.first))
        hi = np.repeat(words.first[1:], np.diff(words.first))
        ends = np.cumsum(many)
        i = 0
        while i < len(found):  # candidates are expanded in slices of bounded size
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CANDIDATES, "right")))
            m = many[i:j]
            pos = np.repeat(found[i:j], m)
            win = np.repeat(a[i:j] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            start = pos - self.place[win]
            ok = (start >= lo[pos]) & (start + self.n[win] <= hi[pos])
            start, win = start[ok], win[ok]
            for k in range(self.words.shape[1]):
                if not len(start):
                    break
                same = (k >= self.n[win]) | (self.words[win, k] == words.hash[np.minimum(start + k, len(words.hash) - 1)])
                start, win = start[same], win[same]
            yield start, win
            i = j


def blocks(windows: DataFrame, size: int, block_windows: int) -> list:
    """Broadcast blocks of the windows of a table that has the columns of Index."""
    spark = windows.sparkSession
    n = windows.count()
    parts = max(1, -(-n // max(1, block_windows // 2)))  # hashed parts vary in size: half full on average
    where = F.pmod(F.xxhash64("item_id", "words", "key"), F.lit(parts))
    return [spark.sparkContext.broadcast(Index(rows, size)) for p in range(parts)
            if (rows := windows.filter(where == p).collect())]


def opened(index: list):
    """The blocks one by one; with several, a task holds no more than one at a time."""
    for block in index:
        yield block.value
        if len(index) > 1:
            vars(block).pop("_value", None)  # what a broadcast keeps after its first use


def indexed(docs: DataFrame, benchmark: DataFrame, window: int, block_windows: int) -> list:
    """The benchmark's windows, keyed by their rarest word in ``docs``, as broadcast blocks."""
    spark = docs.sparkSession
    windows = as_table(item_windows(benchmark, window).distinct(), "benchmark-windows")
    vocabulary = as_table(windows.select(F.explode("words").alias("word")).distinct(), "benchmark-words")
    parts = max(1, -(-vocabulary.count() // (block_windows * 5)))
    known = []
    for p in range(parts):
        rows = vocabulary.filter(F.pmod(F.xxhash64("word"), F.lit(parts)) == p).collect()
        if rows:
            known.append(spark.sparkContext.broadcast(
                np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))))
    if not known:
        return []
    counted = as_table(frequencies(docs, known), "benchmark-frequencies")
    exploded = windows.select("*", F.posexplode("words").alias("place", "word")).join(counted, "word", "left")
    rare = F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), F.col("word"), F.col("place"))
    keyed = exploded.groupBy("item_id", "n", "words").agg(F.min(rare).alias("rare"))
    keyed = as_table(keyed.select("item_id", "n", "words", F.col("rare.word").alias("key"), F.col("rare.place").alias(
        "place")), "benchmark-keys")
    return blocks(keyed, window, block_windows)


def hits(column: pa.Array, index: list) -> tuple[np.ndarray, np.ndarray, list[list[str | None]]]:
    """Per text: its words, its hit words, and the sorted items that occur in it."""
    n_words, n_hit, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for _, _, words in bytetext.words_in(column, bytetext.ALNUM, lower=True):
        covered = np.zeros(len(words.hash), bool)
        doc, items = words.doc, [set() for _ in range(len(words.first) - 1)]
        for block in opened(index):
            pairs = [np.zeros(0, np.int64)]
            for start, win in block.occurrences(words):
                covered |= bytetext.marked(len(covered), start, block.n[win])
                pairs.append(doc[start] * len(block.names) + block.item_no[win])
            for p in np.unique(np.concatenate(pairs)).tolist():
                items[p // len(block.names)].add(block.names[p % len(block.names)])
        before = np.r_[0, np.cumsum(covered)]
        n_words.append(np.diff(words.first))
        n_hit.append(before[words.first[1:]] - before[words.first[:-1]])
        found += [sorted(own, key=_named) for own in items]
    return np.concatenate(n_words), np.concatenate(n_hit), found


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_ratio.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item (all words of a shorter
    item). Null and empty texts and items have no words. Repeated rows are judged one by one; items with equal texts
    count each; an empty benchmark hits nothing; other columns are ignored. Items whose item_id is null hit like any
    other; together they are one item without a name: counted in n_items, not listed in items_sha256.
    """
    index = indexed(docs, benchmark, window, block_windows)

    def judge(batches):
        for batch in batches:
            total, hit, items = hits(batch.column("text"), index)
            sha = [hashlib.sha256(",".join(x for x in own if x is not None).encode()).hexdigest() for own in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total), pa.array(hit), pa.array(map(len, items), pa.int64()),
                 pa.array(sha, pa.string()), pa.array(hit > 0), pa.array(hit / np.maximum(total, 1))],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_ratio"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        judge, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
               "contaminated boolean, hit_ratio double")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` (all columns) without the rows whose text holds a window of a benchmark item."""
    index = indexed(docs.select("text"), benchmark, window, block_windows)

    def clean(batches):
        for batch in batches:
            yield batch.filter(pa.array(hits(batch.column("text"), index)[1] == 0))

    return docs.mapInArrow(clean, docs.schema)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark),
win AS (SELECT item, least({WINDOW}, len(w)) AS n, w[i:i + least({WINDOW}, len(w)) - 1] AS g
        FROM b, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT DISTINCT rid, i, n, item FROM (
          SELECT rid, i, n, w[i:i + n - 1] AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)) JOIN win USING (n, g)),
hit AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM occ, unnest(range(0, n)) AS u(k) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       (coalesce(n_hit, 0) / greatest(len(w), 1))::DOUBLE AS hit_ratio
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""


def op6_prefix_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contamination of the whole documents table by the whole benchmark."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
