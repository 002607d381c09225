"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Sources ask for a share of the corpus by weight. Integer numbers of equal-token blocks go to the sources by the
highest quotients ``target / (2k - 1)``, then from each source to its shards (bounded slices of its documents) by the
highest quotients again; each shard lays its documents out in a seeded order, cuts that stream into blocks and takes the
first ones. Blocks are small beside the smallest target, so that a long tail of small sources gets its words.

DataFrame functions only. A hot source is cut into shards of about ``rows_per_shard`` rows before anything ordered
happens, and only sums per source and per shard are shuffled beside one narrow row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strikelake.sources.storage import as_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
BLOCK_WORDS = 100
FINE = 20  # blocks in the smallest target, at least, while a block has a word
ROWS_PER_SHARD = 4000
SEED = "mix-1"


def words_in(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds ``source_no``, ``weight`` and ``target`` to (source, source_size): weighted shares of ``share`` times all
    sizes, none above ``repeat`` times its source's size, the excess reshared by weight.

    With sources ordered by cap / weight, the ones at their cap are a prefix, and the level ``rest / weights left``
    rises along that prefix and falls after it: its maximum is the level at which nothing is left to reshare.
    """
    everything = F.lit(0)
    by_name = W.partitionBy(everything).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("source_no") % len(weights) + 1)
    by_room = W.partitionBy(everything).orderBy("room", "source_no")
    total = F.sum("source_size").over(W.partitionBy(everything)) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing))
    return (
        sources.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", weight)
        .withColumn("cap", (F.col("source_size") * repeat).cast("double"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumns({"total": total, "level": (total - before) / left})
        .withColumn("level", F.max("level").over(W.partitionBy(everything)))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    )


def sainte_lague(parties: DataFrame, group: str, party: str, votes: str, seats: str, out: str) -> DataFrame:
    """Seats per party of each group by the highest quotients ``votes / (2k - 1)``; ties go to the smaller party.

    Rounding ``votes / (all votes / seats)`` leaves few seats to hand out or take back, so only quotients near that
    point are listed: twice a party's proportional part of the difference, and three more; a party that gets or gives
    all that are listed has four times as many listed, until none does.
    """
    whole = W.partitionBy(group)
    price = F.sum(votes).over(whole) / F.col(seats)
    first = parties.withColumn("_near", F.when((F.col(seats) > 0) & (price > 0), F.floor(F.col(votes) / price + 0.5))
                               .otherwise(0).cast("long"))
    first = first.withColumns({"_miss": F.when(F.sum(votes).over(whole) > 0, F.col(seats)).otherwise(0)
                               - F.sum("_near").over(whole), "_all": F.sum(votes).over(whole)})
    reach = (F.ceil(F.abs("_miss") * F.col(votes) / F.greatest("_all", F.lit(1e-9))) * 2 + 3).cast("long")
    first = as_table(first.withColumn("_reach", F.least(reach, F.abs("_miss"))), "mix-near")
    while True:
        joined = as_table(first.join(_handed(first, group, party, votes), [group, party], "left"), "mix-handed")
        short = F.coalesce(F.abs("_more") == F.col("_reach"), F.lit(False)) & (F.col("_reach") < F.abs("_miss"))
        if joined.filter(short).isEmpty():
            break
        more = F.when(short, F.least(F.col("_reach") * 4, F.abs("_miss"))).otherwise(F.col("_reach"))
        first = joined.withColumn("_reach", more).drop("_more")
    return joined.withColumn(out, F.col("_near") + F.coalesce("_more", F.lit(0))).drop(
        "_near", "_miss", "_all", "_reach", "_more")


def _handed(first: DataFrame, group: str, party: str, votes: str) -> DataFrame:
    """(group, party, _more): the listed seats that are handed out or, below 0, taken back."""
    steps = F.when(F.col("_miss") > 0, F.sequence(F.col("_near") + 1, F.col("_near") + F.col("_reach"))).when(
        (F.col("_miss") < 0) & (F.col("_near") > 0),
        F.sequence(F.greatest(F.col("_near") - F.col("_reach") + 1, F.lit(1)), F.col("_near")))
    return (
        first.withColumn("_k", F.explode(steps))
        .withColumn("_q", F.col(votes) / (2 * F.col("_k") - 1))
        .withColumn("_high", F.row_number().over(W.partitionBy(group).orderBy(F.desc("_q"), party)))
        .withColumn("_low", F.row_number().over(W.partitionBy(group).orderBy("_q", F.desc(party))))
        .filter(F.when(F.col("_miss") > 0, F.col("_high") <= F.col("_miss")).otherwise(F.col("_low") <= -F.col("_miss")))
        .groupBy(group, party).agg(F.sum(F.signum("_miss")).cast("long").alias("_more"))
    )


def mix(
    docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, repeat: int = MAX_REPEAT,
    block_words: int = BLOCK_WORDS, rows_per_shard: int = ROWS_PER_SHARD, seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shard, shard_blocks.

    Needs doc_id, text and source; other columns are ignored, whatever their names. A null text has size 0 and is
    never taken; the null source is a source of its own, ordered last; repeated rows are mixed one by one; an empty
    table gives an empty result. A block has ``block_words`` words, or fewer where the smallest target is below ``FINE``
    such blocks: then as many as go ``FINE`` times into it (one word at least), so that rounding to blocks costs no
    source more than a small part of its target. ``taken`` never exceeds ``repeat`` times ``size``, and a rerun gives the
    same rows.
    """
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = as_table(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), order.alias("_order")),
                     "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(W.partitionBy(F.lit(0)))
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.coalesce(smallest, F.lit(0.0)) / FINE)))
    sources = capped_targets(sources, weights, share, repeat).withColumns({
        "_all": F.lit(0), "_shards": F.greatest(F.lit(1), F.ceil(F.col("_rows") / rows_per_shard)).cast("long"),
        "_block": block.cast("long")}).withColumn("_seats", F.round(F.col("total") / F.col("_block")).cast("long"))
    sources = as_table(
        sainte_lague(sources, "_all", "source_no", "target", "_seats", "_blocks")
        .select("source", "source_no", "source_size", "target", "_shards", "_block", "_blocks"), "mix-sources")
    shard = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % F.col("_shards")
    placed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "size", "_order", "source_no", "source_size", "target", "_block", "_blocks", shard.alias("shard"))
    shards = placed.groupBy("source_no", "shard").agg(
        F.sum("size").alias("_shard_size"), F.max("_blocks").alias("_blocks"))
    quotas = as_table(sainte_lague(shards, "source_no", "shard", "_shard_size", "_blocks", "shard_blocks")
                      .select("source_no", "shard", "_shard_size", "shard_blocks"), "mix-shards")
    line = W.partitionBy("source_no", "shard").orderBy("_order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rest = F.col("shard_blocks") * F.col("_block") - F.coalesce(F.sum("size").over(line), F.lit(0))
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - i * F.col("_shard_size")))
                 for i in range(repeat)), F.lit(0))
    return placed.drop("_blocks").join(quotas, ["source_no", "shard"]).withColumn("_rest", rest).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "shard", "shard_blocks")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0, 1.0, 2.0][(no % 3 + 1)::INT]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM src),
levels AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM src) - coalesce(sum(b.cap), 0)) /
         (SELECT sum(c.w) FROM weighed c WHERE (c.cap / c.w, c.no) >= (a.cap / a.w, a.no)) AS level
  FROM weighed a LEFT JOIN weighed b ON (b.cap / b.w, b.no) < (a.cap / a.w, a.no) GROUP BY a.no, a.cap, a.w),
tgt AS (SELECT *, least(cap, (SELECT max(level) FROM levels) * w) AS target,
        greatest(1, ceil(n / {ROWS_PER_SHARD}.0))::BIGINT AS shards FROM weighed),
block AS (SELECT greatest(1, least({BLOCK_WORDS}, floor(coalesce(min(target), 0) / {FINE})))::BIGINT AS words
          FROM tgt WHERE target > 0),
seats AS (SELECT round(1.5::DOUBLE * sum(source_size) / any_value(words))::BIGINT AS seats FROM src, block),
quotients AS (
  SELECT no, target / (2 * k - 1) AS q FROM tgt, block,
         unnest(range(1, (2 * target / words)::BIGINT + 5)) AS u(k)),
won AS (SELECT no, count(*) AS blocks FROM
        (SELECT no, row_number() OVER (ORDER BY q DESC, no) AS r FROM quotients WHERE q > 0), seats WHERE r <= seats GROUP BY no),
placed AS (
  SELECT doc_id, size, o, no, source_size, target, coalesce(blocks, 0) AS blocks,
         ('0x' || substr(o, 1, 8))::BIGINT % shards AS shard
  FROM sized JOIN tgt ON sized.source IS NOT DISTINCT FROM tgt.source LEFT JOIN won USING (no)),
shard AS (SELECT no, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM placed GROUP BY no, shard),
shard_q AS (
  SELECT no, shard, blocks, shard_size::DOUBLE / (2 * k - 1) AS q
  FROM shard, block, unnest(range(1, (4 * shard_size / words)::BIGINT + 5)) AS u(k)),
shard_won AS (
  SELECT no, shard, count(*) AS shard_blocks FROM
    (SELECT no, shard, blocks, row_number() OVER (PARTITION BY no ORDER BY q DESC, shard) AS r FROM shard_q WHERE q > 0)
  WHERE r <= blocks GROUP BY no, shard),
line AS (
  SELECT placed.*, shard_size, coalesce(shard_blocks, 0)::BIGINT AS shard_blocks,
         coalesce(shard_blocks, 0) * words - coalesce(sum(size) OVER (PARTITION BY no, shard
         ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM placed JOIN shard USING (no, shard) LEFT JOIN shard_won USING (no, shard), block)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, rest)) + greatest(0, least(size, rest - shard_size)))::BIGINT AS taken, shard,
       shard_blocks
FROM line
"""


def op10_sainte_lague_mix(spark, sf_dir: str) -> DataFrame:
    """Mix of the whole documents table."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
