"""Secret scans: fixed patterns, and a randomness test battery over every long token.

Every maximal run of ``TOKEN`` characters of at least ``MIN_LENGTH`` is a candidate. The smallest alphabet that holds
it is its encoding; over that alphabet's numbers the battery runs a chi-squared test of uniformity, a runs test about
the middle and a lag-1 serial-correlation test, combined by Fisher's method into one p-value of randomness.

Not being refuted says little about a short token, so the discovery itself is controlled against ordinary text: with
the symbol frequencies of the whole corpus, the chi-squared statistic that a token of this length and encoding would
have in prose is known, and one far below it is evidence. Benjamini-Hochberg at ``FDR`` runs over all candidates of
the corpus, in strata of encoding and length (powers of two). A discovery must also pass the battery (``ALPHA``).

Beside one slim row per document (stored, no text), only 128 symbol counts and a histogram of bounded size are
gathered, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strikelake.llm import bytetext
from strikelake.sources.storage import as_table

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

MIN_LENGTH = 20
FDR = 0.01
ALPHA = 1e-4
STEP, FLOOR = 0.05, -35.0
MASK = "[SECRET]"

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, smaller alphabets first, in their usual numbering.
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UP + "234567", "lower36": _DIGITS + _LOW,
    "upper36": _DIGITS + _UP, "base62": _UP + _LOW + _DIGITS, "base64": _UP + _LOW + _DIGITS + "+/",
    "base64url": _UP + _LOW + _DIGITS + "-_", "any66": _UP + _LOW + _DIGITS + "+/-_",
}


def _table(alphabet: str) -> np.ndarray:
    numbers = np.full(256, -1, np.int64)
    numbers[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return numbers


NUMBERS = [_table(a) for a in ALPHABETS.values()]
TOKEN = NUMBERS[-1] >= 0
HEX = NUMBERS[0] >= 0


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: np.ndarray) -> tuple[int, float, float]:
    """(encoding, chi-squared, p of randomness) of a token's bytes; the encoding counts in ALPHABETS."""
    code, x = next((i, x) for i, t in enumerate(NUMBERS) if (x := t[token]).min() >= 0)
    n, k = len(x), len(list(ALPHABETS.values())[code])
    counts = np.bincount(x, minlength=k)
    chi2 = float(((counts - n / k) ** 2).sum() * k / n)
    free = k - 1
    cube = ((chi2 / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    uniform = 0.5 * math.erfc(cube / math.sqrt(2))
    high = x >= k / 2
    n1 = int(high.sum())
    n2 = n - n1
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if n1 and n2:
        mean = 2 * n1 * n2 / n + 1
        spread = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p_runs = _two_sided((runs - mean) / math.sqrt(spread))
    else:
        p_runs = 2.0 ** (1 - n) if n < 1000 else 0.0
    away = x - x.mean()
    power = float((away * away).sum())
    p_serial = _two_sided(float((away[1:] * away[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, p_runs, p_serial))
    return code, chi2, math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str, hex_runs) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; hex runs are given."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return sorted(spans + [(s, 2, e) for s, e in hex_runs])


def findings(column: pa.Array):
    """Per piece of a text column: first row, rows, base spans and candidates by row, and counts of ASCII symbols."""
    for a, b, data, bounds in bytetext.pieces(column):
        base, tokens = [[] for _ in range(b - a)], [[] for _ in range(b - a)]
        point = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        place = lambda doc, at: int(point[at] - point[bounds[doc]])
        hexes = [[] for _ in range(b - a)]
        start, end = bytetext.runs_of(data, bounds, HEX)
        for s, e in zip(*(v[end - start >= MIN_HEX].tolist() for v in (start, end))):
            doc = int(np.searchsorted(bounds, s, "right")) - 1
            hexes[doc].append((place(doc, s), place(doc, e)))
        start, end = bytetext.runs_of(data, bounds, TOKEN)
        for s, e in zip(*(v[end - start >= MIN_LENGTH].tolist() for v in (start, end))):
            doc = int(np.searchsorted(bounds, s, "right")) - 1
            tokens[doc].append((place(doc, s), place(doc, e), *battery(data[s:e])))
        raw, asked = data.tobytes(), {i for i, h in enumerate(hexes) if h}
        for text, hint in [(raw.lower(), h) for h in HINTS] + [(raw, b"AKIA")]:
            at = text.find(hint)
            while at >= 0:
                doc = int(np.searchsorted(bounds, at, "right")) - 1
                asked.add(doc)
                at = text.find(hint, int(bounds[doc + 1]))  # the rest of this document is asked for already
        for doc in asked:
            base[doc] = base_spans(raw[bounds[doc] : bounds[doc + 1]].decode(), hexes[doc])
        yield a, b, base, tokens, np.bincount(data[data < 128], minlength=128)


def _slim(docs: DataFrame) -> DataFrame:
    """Stored: a row per document with base spans and candidates, and rows of symbol counts (counts not null)."""
    spans = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    candidates = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("code", pa.int32()), ("x2", pa.float64()),
                                     ("p", pa.float64())]))

    def scan(batches):
        for batch in batches:
            base, tokens, counts = [], [], np.zeros(128, np.int64)
            for _, _, b, t, c in findings(batch.column("text")):
                base += b
                tokens += t
                counts += c
            ids = batch.column("doc_id")
            ids = pa.concat_arrays([ids, pa.nulls(1, ids.type)])
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([[dict(zip("ske", x)) for x in b] for b in base] + [None], spans),
                pa.array([[dict(zip(("s", "e", "code", "x2", "p"), x)) for x in t] for t in tokens] + [None], candidates),
                pa.array([None] * len(base) + [counts.tolist()], pa.list_(pa.int64())),
            ], ["doc_id", "base", "candidates", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return as_table(docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, base array<struct<s: int, k: int, e: int>>, candidates array<struct<s: int, e: int, "
              "code: int, x2: double, p: double>>, counts array<bigint>"), "secret-candidates")


def prose(counts: np.ndarray) -> list[tuple[float, float]]:
    """Sums of squares and cubes of each encoding's symbol frequencies in the corpus (128 counts)."""
    out = []
    for alphabet in ALPHABETS.values():
        q = counts[np.frombuffer(alphabet.encode(), np.uint8)] + 0.5
        q = q / q.sum()
        out.append((float((q**2).sum()), float((q**3).sum())))
    return out


def text_score(x2, n, size, squares, cubes, root):
    """Standard score of a chi-squared statistic under ordinary text; far below 0 is unlike text. Numbers or columns."""
    mean = size * (1 - squares) + n * size * squares - n
    spread = 4 * n * size * size * (cubes - squares * squares) + 2 * size * size * squares
    return (x2 - mean) / root(spread)


def thresholds(histogram: list[tuple], fdr: float = FDR) -> dict[tuple[int, int], float]:
    """Benjamini-Hochberg per stratum over (code, band, bin, count): the largest score that is a discovery."""
    out: dict[tuple[int, int], float] = {}
    strata: dict[tuple[int, int], list] = {}
    for code, band, step, count in histogram:
        strata.setdefault((code, band), []).append((step, count))
    for stratum, bins in strata.items():
        m, below = sum(c for _, c in bins), 0
        for step, count in sorted(bins):
            below += count
            upper = (step + 1) * STEP
            if 0.5 * math.erfc(-upper / math.sqrt(2)) <= fdr * below / m:
                out[stratum] = upper
    return out


def _scored(slim: DataFrame) -> tuple[Column, list[tuple[float, float]]]:
    """The score of a candidate ``c`` as a column function, and the frequencies' sums."""
    sums = slim.filter(F.col("counts").isNotNull()).select(F.posexplode("counts").alias("i", "n")).groupBy("i").agg(
        F.sum("n").alias("n")).collect()  # 128 rows
    counts = np.zeros(128)
    for r in sums:
        counts[r["i"]] = r["n"]
    q = prose(counts)
    table = F.array(*[F.struct(F.lit(float(len(a))).alias("size"), F.lit(s).alias("s"), F.lit(c).alias("c"))
                      for a, (s, c) in zip(ALPHABETS.values(), q)])

    def score(c: Column) -> Column:
        row = F.element_at(table, c["code"] + 1)
        return text_score(c["x2"], (c["e"] - c["s"]).cast("double"), row["size"], row["s"], row["c"], F.sqrt)

    return score, q


def _band(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


def limits(slim: DataFrame, fdr: float = FDR):
    """(score function, sums, {(encoding, length band): score of a discovery}) of the stored candidates."""
    score, q = _scored(slim)
    each = slim.select(F.explode("candidates").alias("c")).select(
        F.col("c.code").alias("code"), _band(F.col("c.e") - F.col("c.s")).alias("band"),
        F.floor(F.greatest(score(F.col("c")), F.lit(FLOOR)) / STEP).cast("int").alias("bin"))
    bins = each.filter(F.col("bin") < 0).groupBy("code", "band", "bin").agg(F.count(F.lit(1)).alias("n"))
    above = each.filter(F.col("bin") >= 0).groupBy("code", "band").agg(F.count(F.lit(1)).alias("n"))
    rows = [tuple(r) for r in bins.collect()]  # at most encodings x bands x 700
    rows += [(r["code"], r["band"], 1000, r["n"]) for r in above.collect()]
    return score, q, thresholds(rows, fdr)


def scan(docs: DataFrame, fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are ``kind:start:end`` in code points, by start and then kind. The battery's own spans have the kind
    'random' and never overlap a base span. Null and empty texts have no spans; rows that repeat are kept, and count
    as often in the corpus statistics; other columns are ignored.
    """
    slim = _slim(docs)
    score, _, limit = limits(slim, fdr)
    rows = slim.filter(F.col("counts").isNull())
    own = F.array().cast("array<struct<s: int, k: int, e: int>>")
    if limit:
        bound = F.create_map(*[x for (c, b), z in limit.items() for x in (F.lit(c * 100 + b), F.lit(z))])
        found = F.filter("candidates", lambda c: (c["p"] >= alpha) & (score(c) < F.coalesce(
            F.element_at(bound, c["code"] * 100 + _band(c["e"] - c["s"])), F.lit(-1e9))) & ~F.exists(
                "base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
        own = F.transform(found, lambda c: F.struct(c["s"].alias("s"), F.lit(3).alias("k"), c["e"].alias("e")))
    names = F.array(*map(F.lit, KINDS))
    line = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return rows.select("doc_id", "base", own.alias("own")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.concat("base", "own")).alias("spans"),
        F.size("own").cast("long").alias("n_random"))


def redacted(docs: DataFrame, fdr: float = FDR, alpha: float = ALPHA) -> DataFrame:
    """``docs`` (all columns) with every span replaced by ``MASK`` and n_chars, if there, set to the new length."""
    _, q, limit = limits(_slim(docs.select(F.lit(0).alias("doc_id"), "text")), fdr)
    sizes = [len(a) for a in ALPHABETS.values()]

    def mask(batches):
        for batch in batches:
            texts = batch.column("text")
            out = {}
            for a, _, base, tokens, _ in findings(texts):
                for i, (spans, own) in enumerate(zip(base, tokens)):
                    spans = [(s, e) for s, _, e in spans]
                    for s, e, code, x2, p in own:
                        n = e - s
                        if p >= alpha and not any(b < e and s < f for b, f in spans) and text_score(
                                x2, n, sizes[code], *q[code], math.sqrt) < limit.get((code, n.bit_length() - 1), -1e9):
                            spans.append((s, e))
                    if spans:
                        out[a + i] = spans
            if out:
                texts = texts.to_pylist()
                for i, spans in out.items():
                    parts, at = [], 0
                    for s, e in sorted(spans):
                        if s >= at:
                            parts += [texts[i][at:s], MASK]
                        at = max(at, e)
                    texts[i] = "".join([*parts, texts[i][at:]])
                names = batch.schema.names
                columns = list(batch.columns)
                columns[names.index("text")] = pa.array(texts, batch.schema.field("text").type)
                if "n_chars" in names:
                    old = columns[names.index("n_chars")].to_pylist()
                    columns[names.index("n_chars")] = pa.array(
                        [len(texts[i]) if i in out else x for i, x in enumerate(old)], batch.schema.field("n_chars").type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(mask, docs.schema)


def base_digest(spans) -> str:
    """SHA-256 of (start, kind, end) spans in the form of base_sha256."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)).encode()).hexdigest()


def op5_randomness_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of the whole documents table."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
