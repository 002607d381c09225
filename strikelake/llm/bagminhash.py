"""MinHash near-duplicates by BagMinHash: signatures of multisets whose agreement is the weighted Jaccard similarity.

A text is the multiset of its runs of ``SHINGLE`` words. For every distinct run, the weight axis is cut at 0, 1, 2, 4,
8, ...; each interval carries a Poisson process of points (value, weight level, signature place) seeded by the run and
the interval alone. A point counts for a text if its level is within the run's weight there, and a signature keeps the
smallest value per place; two texts agree at a place with probability sum(min weights) / sum(max weights). Values are
drawn in rising order up to a limit at which all places are expected to be taken, so that a text of n runs costs about
n + m log m draws for m places; a text with places left over draws on up to a higher limit.

Signatures are banded; the members of a bucket are compared with the bucket's *leader*, the one that meets most other
texts in all its buckets (ties: the smallest id). Then, among all texts that share a leader (so among all that share a bucket), those still in different
components are compared exactly, in pairs of blocks of ``BLOCK`` texts: a task holds two blocks, works out all
intersections at once and returns the edges of a spanning forest, never the pairs. Every link is one of whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strikelake.llm import bytetext
from strikelake.llm.bytetext import U, mixed
from strikelake.llm.components import components, forest, keyed_join
from strikelake.sources.storage import as_table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 6
PLACES = BANDS * ROWS
BLOCK = 128
COLUMNS = 8192  # runs that are counted at a time
SLACK = 6.0  # standard errors below SIMILARITY at which a signature still asks for verification
ID_BITS, BITMAP_BITS = 26, 15  # of the filter of ids that is broadcast: 8 MB, in bitmaps of 4 KB


def shingles(words: bytetext.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, run hash), one row per run; a text of fewer words is one run."""
    at, run = words.runs(size)
    doc, counts = words.doc, np.diff(words.first)
    docs, runs = [doc[at]], [run]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            start, own = words.runs(n)
            first = start[np.isin(start, words.first[short])]
            hashes = own[np.isin(start, words.first[short])]
            mine = counts[doc[first]] == n
            docs.append(doc[first][mine])
            runs.append(hashes[mine])
    return np.concatenate(docs), np.concatenate(runs)


def bags(doc: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, run, weight) of the distinct runs of each document."""
    if not len(run):
        return doc, run, np.zeros(0, np.int64)
    order = np.argsort(mixed(run ^ mixed(doc.astype(U), 5), 6), kind="stable")
    d, r = doc[order], run[order]
    head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1])])
    return d[head], r[head], np.diff(np.r_[head, len(r)])


def _draw(seed: np.ndarray) -> np.ndarray:
    return ((seed >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, run: np.ndarray, weight: np.ndarray, n_docs: int, places: int = PLACES) -> np.ndarray:
    """Smallest values, n_docs x places; infinite for documents without runs."""
    out = np.full(n_docs * places, np.inf)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = (np.log(places) + 3) / np.maximum(total, 1)
    todo = total > 0
    top = int(weight.max()) if len(weight) else 0
    while todo.any():
        own = todo[doc]
        d0, r0, w0 = doc[own], run[own], weight[own]
        low, width, block = 0, 1, 0
        while low < top:
            here = w0 > low
            d, w = d0[here], w0[here]
            seed = mixed(r0[here], 1000 + block)
            rate, value, i = float(width * places), np.zeros(len(d)), 0
            while len(d):
                k = int(min(max(4096 // len(d), 1), 64))
                steps = mixed(seed[:, None] + (np.arange(i, i + k, dtype=U) * U(0xD1342543DE82EF95))[None, :], 7)
                values = np.cumsum(np.c_[value, -np.log(_draw(steps)) / rate], axis=1)[:, 1:]
                row, column = np.nonzero(values <= limit[d][:, None])
                place = mixed(steps[row, column], 8)
                level = low + 1 + (_draw(mixed(place, 9)) * width).astype(np.int64)
                fits = level <= w[row]
                np.minimum.at(out, (d[row] * places + (place % U(places)).astype(np.int64))[fits],
                              values[row, column][fits])
                value, i = values[:, -1], i + k
                on = value <= limit[d]
                d, w, seed, value = d[on], w[on], seed[on], value[on]
            low, width, block = low + width, max(low + width, 1), block + 1
        # every point up to the limit is known: only values under it are final
        todo &= (out.reshape(n_docs, places) > limit[:, None]).any(axis=1)
        limit[todo] *= 2
    return out.reshape(n_docs, places)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """Bucket keys, one per band."""
    bits = mixed(signature.view(U).reshape(len(signature), BANDS, ROWS), 12)
    key = np.zeros((len(signature), BANDS), U)
    for r in range(ROWS):
        key = mixed(key * U(0x9E3779B97F4A7C15) + bits[:, :, r], 13)
    return mixed(key + np.arange(BANDS, dtype=U)[None, :], 14).view(np.int64)


def similarity(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the runs of two columns of texts, row by row; 0 if both have none."""
    out = []
    for i, j, data, bounds in bytetext.pieces(a):
        sides = []
        other = b.slice(i, j - i)
        left = bytetext.words_of(data, bounds, bytetext.ALNUM, lower=True)
        right = [w for _, _, w in bytetext.words_in(other, bytetext.ALNUM, lower=True)]
        sides.append(shingles(left))
        shift, docs, runs = 0, [], []
        for w in right:
            d, r = shingles(w)
            docs.append(d + shift)
            runs.append(r)
            shift += len(w.first) - 1
        sides.append((np.concatenate(docs), np.concatenate(runs)))
        doc, run, weight = (np.concatenate(x) for x in zip(*(bags(*s) for s in sides)))
        order = np.lexsort((run, doc))
        doc, run, weight = doc[order], run[order], weight[order]
        twin = np.r_[(doc[1:] == doc[:-1]) & (run[1:] == run[:-1]), False] if len(doc) else np.zeros(0, bool)
        both = np.zeros(len(doc), np.int64)
        both[:-1] = np.where(twin[:-1], np.minimum(weight[:-1], weight[1:]), 0)
        shared = np.bincount(doc, weights=both, minlength=j - i)
        total = np.bincount(doc, weights=weight, minlength=j - i)
        out.append(shared / np.maximum(total - shared, 1))
    return np.concatenate(out) if out else np.zeros(0)


def _word_keys(words: bytetext.Words) -> list[np.ndarray]:
    """Two names, 64 bits each, of the words of each text."""
    n, first, keys = len(words.hash), words.first, []
    for seed in (0, 21):
        up, down = bytetext.word_powers(n + 1)
        sums = np.r_[U(0), np.cumsum(mixed(words.hash, seed) * up[:n])]
        whole = (sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]]
        keys.append(mixed(whole + np.diff(first).astype(U), 22).view(np.int64))
    return keys


def _filtered(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` whose doc_id (long) may be in ``ids``, rows whose doc_id is not), without a shuffle of docs.

    A filter of one hash and a fixed size is broadcast, so nothing here grows with the ids; where they are so many
    that it fills up, more rows may be. The join that follows decides.
    """
    def place(doc_id):
        slot = F.pmod(F.xxhash64(doc_id), F.lit(1 << ID_BITS))
        return F.shiftright(slot, BITMAP_BITS).alias("__bitmap"), slot.bitwiseAND((1 << BITMAP_BITS) - 1).alias("__bit")

    bitmaps = ids.select(*place("doc_id")).groupBy("__bitmap").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    bitmaps = F.broadcast(as_table(bitmaps, "bag-filter"))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright("__bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = docs.select("*", *place("doc_id")).join(bitmaps, "__bitmap", "left")
    may = F.coalesce(F.expr("1 << cast(__bit & 7 AS int)").bitwiseAND(byte) != 0, F.lit(False))
    return held.filter(may).select(*docs.columns), held.filter(~may).select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with k1 and k2, the names of the words of text, as the columns _k1 and _k2."""
    def name(batches):
        for batch in batches:
            parts = [_word_keys(w) for _, _, w in bytetext.words_in(batch.column("text"), bytetext.ALNUM, lower=True)]
            for i, c in enumerate(("_k1", "_k2")):
                column = np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
                batch = batch.append_column(c, pa.array(column))
            yield batch

    schema = StructType([*docs.schema.fields, StructField("_k1", LongType()), StructField("_k2", LongType())])
    return docs.mapInArrow(name, schema)


def _signed(docs: DataFrame) -> DataFrame:
    """Stored, one row per document: doc_id, k1 and k2 (its words, 128 bits), n runs, bands, sketch (a byte a place)."""
    def sign(batches):
        for batch in batches:
            columns = [[], [], [], [], []]
            for a, b, words in bytetext.words_in(batch.column("text"), bytetext.ALNUM, lower=True):
                doc, run, weight = bags(*shingles(words))
                signature = signatures(doc, run, weight, b - a)
                for i, key in enumerate(_word_keys(words)):
                    columns[i].append(key)
                columns[2].append(np.bincount(doc, weights=weight, minlength=b - a).astype(np.int64))
                columns[3] += [r.tobytes() for r in bands_of(signature)]
                columns[4] += [r.tobytes() for r in mixed(signature.view(U), 15).astype(np.uint8)]
            k1, k2, n = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns[:3])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(k1), pa.array(k2), pa.array(n), pa.array(columns[3], pa.binary()),
                 pa.array(columns[4], pa.binary())], ["doc_id", "k1", "k2", "n", "bands", "sketch"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return as_table(source.mapInArrow(
        sign, "doc_id bigint, k1 bigint, k2 bigint, n bigint, bands binary, sketch binary"), "bag-signatures")


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, id) of every text in every band."""
    def spread(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            ids = np.repeat(batch.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["band", "id"])

    return classes.select("id", "bands").mapInArrow(spread, "band bigint, id bigint")


def _alike(pairs: DataFrame, classes: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar; sizes and sketches are asked first."""
    side = lambda x: classes.select(
        F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("na", "nb") >= similar * F.greatest("na", "nb") - 1e-9)
    least = similar - SLACK * (similar * (1 - similar) / PLACES) ** 0.5

    def sketched(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint8).reshape(-1, PLACES)
                    for x in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= least))

    asked = as_table(close.select("a", "b", "sa", "sb").mapInArrow(sketched, "a bigint, b bigint"), "bag-asked")
    text = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))

    def verified(batches):
        for batch in batches:
            yield batch.select(["a", "b"]).filter(
                pa.array(similarity(batch.column("ta"), batch.column("tb")) >= similar - 1e-12))

    return as_table(asked.join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb").mapInArrow(
        verified, "a bigint, b bigint"), "bag-links")


def links_between(column: pa.Array, left: np.ndarray, right: np.ndarray, similar: float) -> np.ndarray:
    """Which texts of two sets of rows of a column are similar, as a matrix, from all their runs at once."""
    docs, runs, weights, shift = [], [], [], 0
    for a, b, words in bytetext.words_in(column, bytetext.ALNUM, lower=True):
        doc, run, weight = bags(*shingles(words))
        docs.append(doc + shift)
        runs.append(run)
        weights.append(weight)
        shift += b - a
    doc, run, weight = np.concatenate(docs), np.concatenate(runs), np.concatenate(weights)
    total = np.bincount(doc, weights=weight, minlength=shift)
    doc, run = np.repeat(doc, weight), np.repeat(run, weight)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(weight) - weight, weight)
    _, column_no, times = np.unique(mixed(run ^ mixed(nth.astype(U), 17), 18), return_inverse=True, return_counts=True)
    shared = times[column_no] > 1  # a run of one text alone takes no part
    new = np.cumsum(times > 1) - 1
    doc, column_no = doc[shared], new[column_no[shared]]
    order = np.argsort(column_no, kind="stable")
    doc, column_no = doc[order], column_no[order]
    both = np.zeros((len(left), len(right)), np.float64)
    n = int(column_no[-1]) + 1 if len(column_no) else 0
    for start in range(0, n, COLUMNS):
        i, j = np.searchsorted(column_no, [start, start + COLUMNS])
        held = np.zeros((shift, min(COLUMNS, n - start)), np.float32)
        held[doc[i:j], column_no[i:j] - start] = 1
        both += held[left] @ held[right].T
    return both / np.maximum(total[left][:, None] + total[right][None, :] - both, 1) >= similar - 1e-12


def _apart(stars: DataFrame, found: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) between texts that share a leader and are in different components so far."""
    members = stars.select("a", F.col("b").alias("id")).unionByName(
        stars.select("a", F.col("a").alias("id")).distinct())
    at = as_table(members.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "a", "id", F.coalesce("component", "id").alias("c")), "bag-members")
    open_groups = at.groupBy("a").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size")).filter(
        "lo < hi").select("a", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    part = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    spread = at.join(as_table(open_groups, "bag-open"), "a").withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = spread.select("a", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "id", "c")

    def meet(table: pa.Table) -> pa.Table:
        part, ids, c = (table.column(n).to_numpy() for n in ("part", "id", "c"))
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        left, right = np.flatnonzero(part == x), np.flatnonzero(part == y)
        edges = []
        if len(left) and len(right) and (c != c[0]).any():
            linked = links_between(table.column("text").combine_chunks(), left, right, similar)
            edges = forest(linked & (c[left][:, None] != c[right][None, :]), ids[left], ids[right])
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return as_table(rows.join(texts, "id").groupBy("a", "x", "y").applyInArrow(meet, "a bigint, b bigint"), "bag-more")


def _classified(docs: DataFrame, similar: float) -> DataFrame:
    """near_duplicates with k1 and k2, the names of a row's words, and leads: no class in its component is before its own.

    Classes have numbers of their own, in the order of (smallest doc_id, k1, k2): different texts may share a doc_id.
    """
    signed = _signed(docs)
    real = signed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    named = real.groupBy("k1", "k2").agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"))
    named = as_table(named.orderBy("copy_id", "k1", "k2").withColumn("id", F.monotonically_increasing_id()), "bag-classes")
    lead = signed.join(named.withColumnRenamed("copy_id", "doc_id"), ["doc_id", "k1", "k2"])
    classes = as_table(lead.select("id", "n", "bands", "sketch").dropDuplicates(["id"]), "bag-leads")
    rows = as_table(_buckets(classes), "bag-bands")
    full = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = as_table(rows.join(full, "band"), "bag-buckets")
    met = rows.groupBy("id").agg(F.sum("size").alias("met"))
    # of equally met members the smallest id; plain minima and maxima are reduced before the shuffle
    ranked = rows.join(met, "id").groupBy("band", "met").agg(F.min("id").alias("id"))
    leaders = ranked.groupBy("band").agg(F.max_by("id", "met").alias("a"))
    wanted = as_table(named.join(met, "id", "left_semi").select(
        F.col("copy_id").alias("doc_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "id"), "bag-wanted")
    asked, _ = _filtered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted)
    texts = _keyed(asked).join(wanted, ["doc_id", "_k1", "_k2"]).select("id", "text")
    texts = as_table(texts.dropDuplicates(["id"]), "bag-texts")
    stars = as_table(rows.join(leaders, "band").filter("id != a").select("a", F.col("id").alias("b")).distinct(), "bag-stars")
    links = _alike(stars, classes, texts, similar)
    found = components(links, "bag-components")
    more = _apart(stars, found, texts, similar)
    so_far = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(so_far.unionByName(more), "bag-components")
    first = as_table(found.select(F.col("component").alias("id")).distinct().join(named, "id").select(
        F.col("id").alias("component"), F.col("copy_id").alias("first_id")), "bag-first")
    found = found.join(first, "component").select(F.col("node").alias("id"), "component", "first_id")
    found = as_table(named.join(found, "id", "left").select(
        "k1", "k2", "copy_id", F.coalesce("first_id", "copy_id").alias("class_id"), "n_copies",
        (F.coalesce("component", "id") == F.col("id")).alias("leads")), "bag-found")
    out = keyed_join(signed.select("doc_id", "k1", "k2", "n"), signed.count(), found, ["k1", "k2"], "n_copies", "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    mine = lambda c: F.when(alone | F.col(c).isNull(), F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select(
        "doc_id", "k1", "k2", mine("class_id"), mine("copy_id"),
        F.when(alone | F.col("n_copies").isNull(), F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        (alone | F.coalesce("leads", F.lit(True))).alias("leads"),
    ).withColumn("kept", F.coalesce(F.col("leads") & (F.col("doc_id") == F.col("copy_id")), F.lit(True)))


def near_duplicates(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_copies, kept.

    class_id is the smallest doc_id reachable by links of at least ``similar``; kept marks the rows of that doc_id that
    have the class' first words. copy_id is the smallest doc_id with the same words, and n_copies counts the rows with
    those words. Texts without words (null, empty) are classes of their own and link with nothing; so are rows without
    a doc_id, whose ids are null and which are kept. Rows that repeat a doc_id get a row each, by their own text:
    different texts of one doc_id are classes of their own, which may share a class_id without being near each other.
    Of near texts that share the smallest doc_id one is kept. Other columns are ignored; doc_id is read as a long.
    """
    return _classified(docs, similar).select("doc_id", "class_id", "copy_id", "n_copies", "kept")


def deduplicated(docs: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """``docs`` (all columns) with one document of each component: the one with the smallest doc_id.

    Of rows that repeat a doc_id each is judged by its own text, and of kept ones with the same words one stays; rows
    without a doc_id all stay.
    """
    found = _classified(docs, similar).filter(F.col("doc_id").isNotNull())
    judged = as_table(found.groupBy("doc_id", "k1", "k2").agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("times")), "bag-judged")
    by_id = judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.sum("times").alias("times"))
    # the ids to drop are fewer than those to keep, and texts of others are not shuffled for them
    apart = as_table(by_id.filter("NOT kept OR times > 1").select("doc_id", "kept"), "bag-gone")
    twice = as_table(apart.filter("kept").select("doc_id"), "bag-twice")
    right = as_table(judged.filter("kept").join(twice, "doc_id", "left_semi").select(
        "doc_id", F.col("k1").alias("_k1"), F.col("k2").alias("_k2")), "bag-right")
    # carried as one column, so that names of the input meet none of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"))
    asked, others = _filtered(rows, apart)
    stay = asked.join(apart.select("doc_id"), "doc_id", "left_anti").select("row.*").unionAll(others.select("row.*"))
    again = _keyed(_filtered(rows, twice)[0].join(twice, "doc_id", "left_semi").select("doc_id", "row", "row.text"))
    again = again.join(right, ["doc_id", "_k1", "_k2"], "left_semi").dropDuplicates(["doc_id", "_k1", "_k2"])
    return stay.unionAll(again.select("row.*"))


def op9_bagminhash_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of the whole documents table."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
