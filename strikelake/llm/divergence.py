"""Source divergence audit: how far the term frequencies of each source of a language are from those of the others.

1. Inside ``mapInArrow``, Arrow's own kernels count: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``, and
   hash ``group_by`` over (text, term) and then (group, term). A task holds at most ``HELD`` partial counts, merges them
   as they grow and hands them on; no list of terms outlives its piece of about ``PIECE`` bytes of whole texts.
2. Spark merges the partial counts by (lang, source, term), and keeps the terms of each language that enough of its
   documents have. Both are sums that are reduced before the shuffle; a term as frequent as 'the' is one row per task.
3. Terms are dealt to shards of about ``TERMS`` terms of one language, sources to blocks of about ``SOURCES``. A task
   holds one shard for one pair of blocks as a matrix, adds up the distances of all its sources, and Spark adds up the
   shards. A term that a source lacks has the source's smallest probability, so only terms that one of the two has are
   in the matrix: the rest of the vocabulary is a product.

Probabilities are whole numbers of 1e-9, worked out in decimals, so that results are the same in any order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from strikelake.sources.storage import as_table

SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
PRIOR = 5
UNIT = 1_000_000_000
TOP = 50
PIECE = 1 << 22
HELD = 400_000
TERMS, SOURCES = 2048, 256

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                     ("docs", pa.int64())])


def text_pieces(column: pa.Array, size: int = PIECE):
    """(from row, to row) of whole texts of about ``size`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(column):
        before = ends[a - 1] if a else 0
        b = min(max(a + 1, int(np.searchsorted(ends, before + size, "right"))), len(column))
        yield a, b
        a = b


def counted(text: pa.Array, lang: pa.Array, source: pa.Array) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of some rows, by Arrow kernels; nulls are empty."""
    lang, source = pc.fill_null(lang, ""), pc.fill_null(source, "")
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(text, "")), SEPARATORS)
    row, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.not_equal(term, "")
    coded = pc.dictionary_encode(term.filter(real))
    each = pa.table({"row": row.filter(real), "code": coded.indices})
    per_text = each.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    group = pa.table({"lang": lang, "source": source}).take(per_text["row"])
    merged = pa.table({
        "lang": pc.dictionary_encode(group["lang"]), "source": pc.dictionary_encode(group["source"]),
        "code": per_text["code"], "n": per_text["count_all"],
    }).group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    plain = lambda c: pc.cast(merged[c], pa.string())
    return pa.table([plain("lang"), plain("source"), pc.take(coded.dictionary, merged["code"]), merged["n_sum"],
                     merged["n_count"]], schema=_COUNTS)


def merged(tables: list[pa.Table]) -> pa.Table:
    """Partial counts added up."""
    both = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate(
        [("n", "sum"), ("docs", "sum")])
    return both.rename_columns(_COUNTS.names).cast(_COUNTS)


def partial_counts(docs: DataFrame, piece: int = PIECE, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs) of parts of ``docs``: several rows for a key, to be added up.

    Each group that occurs has a row with the term '' and no occurrences, so that groups without terms are known.
    """
    def count(batches):
        tables, rows, groups = [], 0, set()
        for batch in batches:
            text, lang, source = (batch.column(c) for c in ("text", "lang", "source"))
            names = pa.table({"lang": pc.fill_null(lang, ""), "source": pc.fill_null(source, "")}).group_by(
                ["lang", "source"], use_threads=False).aggregate([])
            new = set(zip(names["lang"].to_pylist(), names["source"].to_pylist())) - groups
            if new:
                groups |= new
                yield from pa.table([pa.array([g[0] for g in new], pa.string()), pa.array([g[1] for g in new], pa.string()),
                                     pa.array([""] * len(new)), pa.array([0] * len(new)), pa.array([0] * len(new))],
                                    schema=_COUNTS).to_batches()
            if len(groups) > held:
                groups = set()
            for a, b in text_pieces(text, piece):
                tables.append(counted(text.slice(a, b - a), lang.slice(a, b - a), source.slice(a, b - a)))
                rows += len(tables[-1])
                if rows > held:
                    tables = [merged(tables)]
                    rows = len(tables[0])
                    if rows > held // 2:
                        yield from tables[0].to_batches()
                        tables, rows = [], 0
        if tables:
            yield from merged(tables).to_batches()

    return docs.select(*(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source"))).mapInArrow(
        count, "lang string, source string, term string, n bigint, docs bigint")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * kept)), in decimals; null without kept terms."""
    wide = (F.lit(UNIT).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(19,0)")).alias("w")
    under = (total + PRIOR * kept).cast("decimal(19,0)")
    return F.when(kept > 0, (F.call_function("div", wide, under) + 1).cast("long"))


def rated(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Stored (groups, terms).

    groups: lang, source, kept (terms of the language), least (the probability of a term the group lacks).
    terms: lang, source, term, p, q for each kept term that the group has; q is the language's probability.
    """
    counts = as_table(partial_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = as_table(counts.filter("term != ''").groupBy("lang", "term").agg(
        F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs"),
        "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all_n").alias("lang_n"))
    own = as_table(counts.filter("term != ''").join(kept, ["lang", "term"]).select(
        "lang", "source", "term", "n", "all_n"), "divergence-own")
    sums = own.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = as_table(counts.filter("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(
        langs, "lang", "left").select("lang", "source", none("group_n"), none("kept"), none("lang_n")), "divergence-groups")
    terms = own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("group_n"), F.col("kept")).alias("p"),
        share(F.col("all_n"), F.col("lang_n"), F.col("kept")).alias("q"))
    groups = groups.withColumn("least", share(F.lit(0).cast("long"), F.col("group_n"), F.col("kept")))
    return as_table(groups.select("lang", "source", "kept", "least"), "divergence-rated"), as_table(terms, "divergence-terms")


def distances(table: pa.Table) -> pa.Table:
    """(lang, source, item, value) of the sources of block x against those of block y over one shard, one row a pair.

    Rows without a term are the sources themselves, p their smallest probability and kept the terms to count for them
    all (0 but for the first shard); a term that neither of a pair has counts there, and is taken off here if it is
    in the matrix.
    """
    x, y, lang = (table.column(c)[0].as_py() for c in ("x", "y", "lang"))
    base = table.filter(pc.is_null(table["term"]))
    names, part = base["source"].to_pylist(), base["part"].to_numpy()
    least, kept = base["p"].fill_null(0).to_numpy().astype(np.int64), int(base["kept"].to_numpy().max())
    own = table.filter(pc.is_valid(table["term"]))
    coded = pc.dictionary_encode(own["term"].combine_chunks()) if len(own) else None
    n_terms = len(coded.dictionary) if coded else 0
    matrix = np.repeat(least[:, None], n_terms, axis=1)
    if n_terms:
        at = {s: i for i, s in enumerate(names)}
        sources = pc.dictionary_encode(own["source"].combine_chunks())
        place = np.array([at[s] for s in sources.dictionary.to_pylist()], np.int64)
        matrix[place[sources.indices.to_numpy()], coded.indices.to_numpy()] = own["p"].to_numpy()
    left, right = np.flatnonzero(part == x), np.flatnonzero(part == y)
    a, b, value = [], [], []
    for i in left:
        far = np.abs(matrix[right] - matrix[i]).sum(axis=1) + (kept - n_terms) * np.abs(least[right] - least[i])
        for j, v in zip(right.tolist(), far.tolist()):
            if j != i:
                a.append(names[i])
                b.append(names[j])
                value.append(v)
    if x != y:  # a pair of two blocks is met once, and stands for both directions
        a, b, value = a + b, b + a, value + value
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": pa.array(a, pa.string()),
                     "item": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def pair_distances(groups: DataFrame, terms: DataFrame, shard: int = TERMS, block: int = SOURCES) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    sizes = as_table(groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
        F.ceil(F.greatest(F.max("kept"), F.lit(1)) / shard).cast("int").alias("shards")), "divergence-sizes")
    row = ["lang", "source", "part", "term", "p", "kept"]
    part = F.pmod(F.xxhash64("source"), "blocks").cast("int").alias("part")
    base = groups.join(sizes, "lang").select(
        "lang", "source", part, F.lit(None).cast("string").alias("term"), F.col("least").alias("p"), "kept", "blocks",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    base = base.withColumn("kept", F.when(F.col("shard") == 0, F.col("kept")).otherwise(F.lit(0)))
    own = terms.join(sizes, "lang").select(
        "lang", "source", part, "term", "p", F.lit(0).cast("long").alias("kept"), "blocks",
        F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"))
    dealt = base.unionByName(own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *row, "shard", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))
    return dealt.groupBy("lang", "shard", "x", "y").applyInArrow(
        distances, "lang string, source string, item string, value bigint").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: distances between sources ('pair') and the terms a source has most too
    often ('term', ranks up to ``top``).

    Null text, lang and source are empty strings, and group like them. A document is a row: rows that repeat count
    again. A group without kept terms has the probabilities of its prior; a language without kept terms has pairs at
    distance 0 and no terms; a language of one source has no pairs. Equal values are ranked by the item's UTF-8. No
    documents: no rows. Other columns are ignored.
    """
    groups, terms = rated(docs, min_docs)
    pairs = pair_distances(groups, terms).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranks))
    over = terms.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(over.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM words GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL HAVING sum(docs) >= 30),
langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
pairs_of AS (
  SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS total, k.n AS lang_n
  FROM pairs_of g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (cells.total + 5 * v) AS p,
         1 + 1000000000 * (lang_n + 5) // (langs.total + 5 * v) AS q
  FROM cells JOIN langs USING (lang)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value
  FROM pairs_of a JOIN pairs_of b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM ranked
QUALIFY part = 'pair' OR rank <= 50
"""


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Divergence of the sources of the whole documents table."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
