"""Fill-in-middle transformation: texts are cut in three and reordered behind sentinels, with memoized chunks.

Cuts are counted in code points, texts are stored in bytes. A rolling hash over ``WINDOW`` bytes ends a chunk wherever
its upper bits are zero, so that passages which texts share break into the same chunks, wherever they stand. A chunk's
*summary* is how many code points start in it, whether it holds a sentinel, and its edges (two bytes on either side,
where a sentinel may reach over a border). Summaries are cached by fingerprint; a hit counts only if the bytes are the
cached ones. The counts of a text's chunks, added up, give its length and tell which chunk a cut falls into, and only
that chunk is read for it. Summaries of a text's chunks combine in order, so no text is decoded.

A task's cache holds ``CACHE`` bytes of chunks, the oldest go first; what is not there is summarized again. Nothing is
shuffled: a row's result depends on that row alone.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strikelake.llm import bytetext
from strikelake.llm.bytetext import U, mixed

# The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = tuple(s.encode() for s in (PREFIX, SUFFIX, MIDDLE))
EDGE = 2  # bytes of a sentinel that may lie before or after a border

RATE, SPM = 90, 20
SEED = "1"
WINDOW = 32
BITS = 10  # chunks of about 1024 bytes
LEAST, MOST = 64, 8192
CACHE = 1 << 26

_BYTE = mixed(np.arange(256, dtype=U), 31)
_UP = np.cumprod(np.r_[U(1), np.full(WINDOW - 1, 0x9E3779B97F4A7C15, U)])


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash of every window of WINDOW bytes, in windows of doubling size."""
    h, size = _BYTE[data], 1
    while size < WINDOW:
        h = h[: len(h) - size] * _UP[size] + h[size:]
        size *= 2
    return h


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of the documents data[bounds[i]:bounds[i+1]], the ends of the documents among them.

    Where windows end chunks closely one after another (a repeated pattern) the first of LEAST bytes counts; a chunk of
    over MOST bytes is cut every MOST bytes from its start.
    """
    ends = np.zeros(0, np.int64)
    if len(data) > WINDOW:
        at = np.flatnonzero(mixed(_window_hashes(data), 32) >> U(64 - BITS) == 0) + WINDOW
        doc = np.searchsorted(bounds, at - 1, "right") - 1
        at = at[at - WINDOW >= bounds[doc]]  # a window over the start of a document is none of its own
        ends = at[np.diff(at, prepend=-LEAST) >= LEAST]
    ends = np.union1d(ends, bounds[1:])
    start = np.r_[bounds[0], ends[:-1]]
    times = np.maximum(ends - start - 1, 0) // MOST
    if times.any():
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        ends = np.union1d(ends, np.repeat(start, times) + (nth + 1) * MOST)
    return ends[ends > bounds[0]]


def fingerprints(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[int]:
    """A 64-bit name of the bytes of each chunk."""
    up, down = bytetext.word_powers(len(data) + 1)
    sums = np.r_[U(0), np.cumsum(_BYTE[data] * up[: len(data)])]
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(U), 33).tolist()


def leads(chunk: bytes) -> np.ndarray:
    """Which bytes start a code point."""
    return (np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80


class Memo:
    """Summaries of chunks by fingerprint, verified by content; at most ``room`` bytes of chunks are held."""

    def __init__(self, room: int = CACHE):
        self.room, self.held, self.known = room, 0, {}
        self.hits = self.misses = 0

    def summary(self, name: int, chunk: bytes) -> tuple[int, bool]:
        """(code points that start in the chunk, whether it holds a sentinel)."""
        entry = self.known.get(name)
        if entry is not None and entry[0] == chunk:
            self.hits += 1
            return entry[1]
        self.misses += 1
        found = (int(np.count_nonzero(leads(chunk))), b"<" in chunk and any(s in chunk for s in SENTINELS))
        if entry is None:
            self.known[name] = (chunk, found)
            self.held += len(chunk)
            while self.held > self.room:
                self.held -= len(self.known.pop(next(iter(self.known)))[0])
        return found


class Chunked:
    """A text as its chunks: byte ends, code points before each chunk, and whether it holds a sentinel."""

    def __init__(self, raw: bytes, start: int, ends: list[int], names: list[int], memo: Memo):
        self.raw, self.start, self.ends = raw, start, ends
        self.before, self.marked, edge, at = [0], False, b"", start
        for end, name in zip(ends, names):
            chunk = raw[at:end]
            n, marked = memo.summary(name, chunk)
            self.before.append(self.before[-1] + n)
            border = edge + chunk[:EDGE]
            self.marked |= marked or any(s in border for s in SENTINELS)
            edge = (edge + chunk[-EDGE:])[-EDGE:]
            at = end

    @property
    def n(self) -> int:
        return self.before[-1]

    def offset(self, point: int) -> int:
        """The byte at which a code point starts; the end for the number of code points."""
        if point >= self.n:
            return self.ends[-1] if self.ends else self.start
        k = bisect_right(self.before, point) - 1
        begin = self.ends[k - 1] if k else self.start
        return begin + int(np.flatnonzero(leads(self.raw[begin : self.ends[k]]))[point - self.before[k]])


def chunked(column: pa.Array, memo: Memo):
    """(row, Chunked) of every text of a column, with the bytes of its piece; null texts are empty."""
    for a, b, data, bounds in bytetext.pieces(column):
        ends = chunk_ends(data, bounds)
        start = np.r_[bounds[0], ends[:-1]] if len(ends) else ends
        names, raw = fingerprints(data, start, ends), data.tobytes()
        cut = np.searchsorted(ends, bounds, "right")
        for i in range(b - a):
            x, y = int(cut[i]), int(cut[i + 1])
            yield a + i, Chunked(raw, int(bounds[i]), ends[x:y].tolist(), names[x:y], memo)


def rewritten(text: Chunked, h: tuple, rate: int, spm: int) -> tuple[str, int | None, int | None, bytes]:
    """(form, code points of prefix and middle, output) for four hash values."""
    whole = text.raw[text.start : text.ends[-1]] if text.ends else b""
    if not text.n or text.marked or h[2] % 100 >= rate:
        return "plain", None, None, whole
    low, high = sorted((h[0] % (text.n + 1), h[1] % (text.n + 1)))
    i, j = text.offset(low) - text.start, text.offset(high) - text.start
    p, s, m = SENTINELS
    if h[3] % 100 < spm:
        return "spm", low, high - low, b"".join((s, whole[j:], p, whole[:i], m, whole[i:j]))
    return "psm", low, high - low, b"".join((p, whole[:i], s, whole[j:], m, whole[i:j]))


def hashes(doc_id: Column, seed: str = SEED) -> list[Column]:
    """The first four groups of eight hex digits of the SHA-256 of ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, n_chunks, output.

    Form is 'plain' for empty texts, texts that hold a sentinel and 100 - ``rate`` in 100 of the others; of the rest
    ``spm`` in 100 are 'spm' (suffix, prefix, middle), the others 'psm' (prefix, suffix, middle). Null texts are empty.
    A null doc_id is hashed as an empty one; rows that repeat a doc_id have the same hashes, and cuts by their own
    length. Other columns are ignored. No documents: no rows.
    """
    def rewrite(batches):
        memo = Memo()
        for batch in batches:
            h = list(zip(*(batch.column(f"h{i + 1}").to_pylist() for i in range(4))))
            rows, size, first = [], 0, 0
            for row, text in chunked(batch.column("text"), memo):
                form, prefix, middle, output = rewritten(text, h[row], rate, spm)
                rows.append((text.n, form, prefix, middle, len(text.ends), output))
                size += len(output)
                if size > bytetext.CHUNK or row + 1 == len(h):
                    columns = list(zip(*rows))
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    out = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(first, len(rows)), *out[:-1], out[-1].cast(pa.string())],
                        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "n_chunks", "output"])
                    rows, size, first = [], 0, row + 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *hashes(F.col("doc_id"), seed)).mapInArrow(
        rewrite, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, n_chunks bigint, "
                 "output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output and its form were made from."""
    def parts(second: str) -> str:  # the part after the first sentinel, that after the second, that after the third
        i, j = f"locate('{second}', {output})", f"locate('{MIDDLE}', {output}, locate('{second}', {output}) + 3)"
        return (f"substring({output}, 4, {i} - 4)", f"substring({output}, {i} + 3, {j} - {i} - 3)",
                f"substring({output}, {j} + 3)")

    prefix, suffix, middle = parts(SUFFIX)
    psm = f"concat({prefix}, {middle}, {suffix})"
    suffix, prefix, middle = parts(PREFIX)
    spm = f"concat({prefix}, {middle}, {suffix})"
    return F.expr(f"CASE {form} WHEN 'psm' THEN {psm} WHEN 'spm' THEN {spm} ELSE {output} END")


SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
numbers AS (
  SELECT doc_id, text, length(text)::BIGINT AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
         ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM hashed),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substring(text, 1, lo) AS p, substring(text, lo + 1, hi - lo) AS m, substring(text, hi + 1) AS s FROM cuts),
outputs AS (
  SELECT *, CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END AS output
  FROM parts),
found AS (
  SELECT *, CASE form WHEN 'psm' THEN strpos(output, '<S>') ELSE strpos(output, '<P>') END AS i,
         strpos(output, '<M>') AS j
  FROM outputs)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form
         WHEN 'psm' THEN substring(output, 4, i - 4) || substring(output, j + 3) || substring(output, i + 3, j - i - 3)
         WHEN 'spm' THEN substring(output, i + 3, j - i - 3) || substring(output, j + 3) || substring(output, 4, i - 4)
         ELSE output END) AS restored_sha256
FROM found
"""


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Fill-in-middle forms of the whole documents table, as digests."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))
