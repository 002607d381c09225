"""Token counts attributed to sections of documents by the tokens' place in the text.

A document is encoded once and whole, so merges across section borders are those of the real text. The lengths of the
tokens give each token's span; spans are joined with the sections' spans by binary search, and a token that crosses a
border is allocated by an explicit rule. Sections are counted where the text is read: nothing is shuffled.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before this vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most")
RULE = "most"


@lru_cache(maxsize=2)
def encoder(ranks: bytes):
    """(encoding, bytes of each token) of a rank file; once per worker process."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    sizes = np.zeros(max(table.values()) + 1, np.int64)
    for token, rank in table.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), sizes


def vocabulary(spark: SparkSession, path: str):
    """The rank file as a broadcast; a file of bounded size that only the driver needs to see."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def line_bounds(text: bytes) -> np.ndarray:
    """Borders of the lines of a text, each with its newline: one line more than newlines."""
    return np.r_[0, np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1, len(text)]


def allocate(sizes: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str = RULE) -> tuple[np.ndarray, int]:
    """Section of every token, given sorted disjoint sections by byte, and how many tokens cross a border.

    A token inside one section belongs to it. One that crosses goes to the first or last section it touches, or to
    the one with most of its bytes (ties: the earlier); one that touches none has section -1. Empty sections get no
    token.
    """
    stop = np.cumsum(sizes)
    begin = stop - sizes
    if not len(starts) or not len(sizes):
        return np.full(len(sizes), -1), 0
    lo = np.searchsorted(ends, begin, "right")  # the first section that ends after the token begins
    hi = np.searchsorted(starts, stop, "left") - 1  # the last that starts before it stops
    none = lo > hi
    whole = np.minimum(lo, len(starts) - 1)
    inside = ~none & (lo == hi) & (starts[whole] <= begin) & (stop <= ends[whole])
    out = np.where(none, -1, lo if rule != "last" else hi)
    if rule == "most":
        for t in np.flatnonzero(~none & (lo < hi)).tolist():
            a, b = int(lo[t]), int(hi[t]) + 1
            held = np.minimum(ends[a:b], stop[t]) - np.maximum(starts[a:b], begin[t])
            out[t] = a + int(held.argmax())
    return out, int((~none & ~inside).sum())


def _counts(text: str, spans, vocab: bytes, rule: str):
    encoding, sizes = encoder(vocab)
    raw = text.encode()
    lengths = sizes[np.array(encoding.encode_ordinary(text), np.int64)] if text else np.zeros(0, np.int64)
    if spans is None:
        bounds = line_bounds(raw)
        starts, ends, order = bounds[:-1], bounds[1:], None
        if not text:
            starts = ends = np.zeros(1, np.int64)
    else:
        point = np.r_[np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw)]
        inside = np.clip(np.array([(s["start"], s["end"]) for s in spans], np.int64).reshape(-1, 2), 0, len(point) - 1)
        order = np.lexsort((inside[:, 1], inside[:, 0]))
        starts, ends = point[inside[order]].T
    section, crossing = allocate(lengths, starts, ends, rule)
    counts = np.bincount(section[section >= 0], minlength=len(starts))
    if order is not None:
        given = np.zeros(len(starts), np.int64)
        given[order] = counts
        counts = given
    return len(lengths), counts, crossing


def attribute(docs: DataFrame, path: str = VOCABULARY, rule: str = RULE, sections: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_sections, n_crossing, n_outside, section_tokens.

    ``sections`` names an array<struct<start, end>> column of disjoint spans in code points, in any order; without it
    the sections are the lines, each with its newline. section_tokens follows the order given; its sum and n_outside
    make n_tokens. Null and empty texts have no tokens and one empty line; null sections are none. Rows that repeat
    are counted one by one; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocab = vocabulary(docs.sparkSession, path)

    def count(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = batch.column("spans").to_pylist() if sections else [None] * len(texts)
            n, per, crossing = [], [], []
            for text, own in zip(texts, spans):
                own = [s for s in own or [] if s] if sections else None
                total, counts, crossed = _counts(text or "", own, vocab.value, rule)
                n.append(total)
                per.append(counts)
                crossing.append(crossed)
            held = pa.array([int(c.sum()) for c in per], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(map(len, per), pa.int64()),
                 pa.array(crossing, pa.int64()), pa.array([a - b.as_py() for a, b in zip(n, held)], pa.int64()),
                 pa.array(per, pa.list_(pa.int64()))],
                ["doc_id", "n_tokens", "n_sections", "n_crossing", "n_outside", "section_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "text"] + ([F.col(sections).alias("spans")] if sections else [])
    return docs.select(*columns).mapInArrow(
        count, f"doc_id {kind}, n_tokens bigint, n_sections bigint, n_crossing bigint, n_outside bigint, "
               "section_tokens array<bigint>")


def op4_offset_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of the whole documents table."""
    return attribute(spark.read.parquet(f"{sf_dir}/documents.parquet"))
