"""WARC fixity audit: Merkle trees over records and ordered ranges of them, compared between replicas.

Level 0 holds one node per record, level l one node per range of ``fanout ** l`` consecutive record numbers of a
file; a node's digest covers its children's digests, counts and lengths in order. Two replicas are compared at the
roots; only the children of ranges that differ are read on, down to the records. Byte offsets are worked out on the
way down, as the parent's offset plus the lengths of the siblings before.

Contents are hashed once, where they are read; digests are all that is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from strikelake.sources.storage import as_table

FANOUT = 16
RECORDS_PER_FILE = 1000
LANES = 8


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC resource record as text; nulls are empty."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def leaves(records: DataFrame, name: str) -> DataFrame:
    """Stored level 0 of (file_id, record_no, record): digest, records and bytes per record number.

    Rows that repeat a number (or have none, which counts as -1) are one leaf: the sums of their SHA-256 in eight
    lanes of 32 bits, so that any number of them is reduced where it is read.
    """
    sha = records.select(
        F.coalesce("file_id", F.lit(-1)).cast("long").alias("file_id"),
        F.coalesce("record_no", F.lit(-1)).cast("long").alias("node"),
        F.sha2(F.coalesce("record", F.lit("")), 256).alias("_sha"),
        F.octet_length(F.coalesce("record", F.lit(""))).cast("long").alias("bytes"))
    lane = [F.sum(F.conv(F.substring("_sha", 8 * i + 1, 8), 16, 10).cast("long")) for i in range(LANES)]
    summed = sha.groupBy("file_id", "node").agg(
        F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"), F.concat_ws(":", *lane).alias("_lanes"))
    return as_table(summed.select(
        "file_id", "node", "records", "bytes",
        F.sha2(F.concat_ws("|", "records", "bytes", "_lanes"), 256).alias("digest")), name)


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above: one node for ``fanout`` numbers, its digest over the children's in order."""
    child = F.struct("node", "records", "bytes", "digest")
    grouped = nodes.groupBy("file_id", F.floor(F.col("node") / fanout).alias("parent")).agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"),
        F.sort_array(F.collect_list(child)).alias("_children"))  # at most fanout of them
    text = F.transform("_children", lambda c: F.concat_ws(":", c["node"], c["records"], c["bytes"], c["digest"]))
    return grouped.select(
        "file_id", F.col("parent").alias("node"), "records", "bytes",
        F.sha2(F.concat_ws("|", text), 256).alias("digest"))


def tree(level0: DataFrame, name: str, levels: int, fanout: int) -> list[DataFrame]:
    """All levels, leaves first; the last has one root per file."""
    out = [level0]
    for i in range(levels):
        out.append(as_table(parents(out[-1], fanout), f"{name}-{i + 1}"))
    return out


def compared(mine: DataFrame, other: DataFrame) -> DataFrame:
    """Nodes whose digests differ, or that one side lacks."""
    other = other.select("file_id", "node", F.col("records").alias("replica_records"),
                         F.col("bytes").alias("replica_bytes"), F.col("digest").alias("replica_digest"))
    return mine.join(other, ["file_id", "node"], "full_outer").filter(
        ~F.col("digest").eqNullSafe(F.col("replica_digest")))


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Damaged records of a replica of (file_id, record_no, record).

    Returns file_id, record_no, kind ('missing' in the replica, 'extra' in it, 'repeated' for another number of
    records with that number, 'altered'), offset and bytes in the primary file (ordered by record_no; null for extra
    ones), replica_bytes, and root and replica_root of the file (null where the file lacks). Equal replicas and
    empty tables give no row. Other columns are ignored; see ``leaves`` for nulls and repeated numbers.
    """
    mine, other = leaves(primary, "fixity-mine"), leaves(replica, "fixity-other")
    top = mine.select("node").union(other.select("node")).agg(F.max("node"), F.min("node")).first()
    span, levels = max(abs(top[0] or 0), abs(top[1] or 0), 1), 1
    while fanout ** levels <= span:
        levels += 1
    if (top[1] or 0) < 0:
        levels += 1  # floor() leaves -1 beside 0 on every level; roots are then compared per sign
    a, b = tree(mine, "fixity-mine", levels, fanout), tree(other, "fixity-other", levels, fanout)
    before = W.partitionBy("file_id").orderBy("node").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    roots = compared(a[-1].withColumn("offset", start), b[-1])  # one or two rows per file
    bad = as_table(roots, "fixity-bad")
    tops = bad.select("file_id", F.col("digest").alias("root"), F.col("replica_digest").alias("replica_root"),
                      F.col("node").alias("_top"))
    for level in range(levels - 1, -1, -1):
        branch = bad.select("file_id", F.col("node").alias("_parent"), F.col("offset").alias("_from"))
        up = F.floor(F.col("node") / fanout)
        part = a[level].withColumn("_parent", up).join(branch, ["file_id", "_parent"])
        siblings = W.partitionBy("file_id", "_parent").orderBy("node").rowsBetween(W.unboundedPreceding, -1)
        part = part.withColumn("offset", F.col("_from") + F.coalesce(F.sum("bytes").over(siblings), F.lit(0)))
        there = b[level].withColumn("_parent", up).join(branch, ["file_id", "_parent"], "left_semi").drop("_parent")
        bad = as_table(compared(part.drop("_parent", "_from"), there), "fixity-bad")
    kind = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").when(
        F.col("records") != F.col("replica_records"), "repeated").otherwise("altered")
    side = F.when(F.col("node") < 0, -1).otherwise(0)
    return bad.withColumn("_top", side.cast("long")).join(
        tops.withColumn("_top", F.when(F.col("_top") < 0, -1).otherwise(0).cast("long")), ["file_id", "_top"],
    ).select("file_id", F.col("node").alias("record_no"), kind.alias("kind"), "offset", "bytes", "replica_bytes",
             "root", "replica_root")


def page_records(pages: DataFrame, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Pages as records of WARC files of bounded size."""
    return pages.select(
        F.floor(F.col("page_id") / records_per_file).alias("file_id"), F.col("page_id").alias("record_no"),
        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica with planted faults: lost, cut, altered and repeated pages, chosen by page number."""
    n, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    hurt = F.when(n % 211 == 5, F.concat(html, F.lit("#"))).when(
        n % 223 == 7, F.substring(html, 1, 64)).otherwise(html)
    kept = pages.filter(n.isNull() | (n % 227 != 9)).select(n, "url", hurt.alias("html"))
    return kept.unionByName(pages.filter(n % 229 == 11).select(n, "url", "html"))


SQL = f"""
WITH rec AS (
  SELECT page_id, floor(page_id / {RECORDS_PER_FILE}.0)::BIGINT AS file_id, coalesce(url, '') AS url,
         coalesce(html, '') AS html FROM pages),
lengths AS (
  SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) AS h,
         strlen('WARC/1.1__WARC-Type: resource__WARC-Record-ID: <urn:page:' || page_id || '>__WARC-Target-URI: ' || url
                || '__Content-Type: text/html__Content-Length: ' || strlen(html) || '____' || html || '____') AS bytes
  FROM rec),
placed AS (SELECT *, coalesce(sum(bytes) OVER (PARTITION BY file_id ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING
                  AND 1 PRECEDING), 0) AS "offset" FROM lengths),
hurt AS (
  SELECT *, CASE WHEN page_id % 211 = 5 THEN html || '#' WHEN page_id % 223 = 7 THEN substring(html, 1, 64) ELSE html END
         AS html2 FROM placed),
sized AS (
  SELECT *, bytes - strlen(html) - strlen(strlen(html)::VARCHAR) + strlen(html2) + strlen(strlen(html2)::VARCHAR) AS bytes2
  FROM hurt)
SELECT file_id, page_id,
       CASE WHEN page_id % 227 = 9 AND page_id % 229 <> 11 THEN 'missing'
            WHEN page_id % 227 <> 9 AND page_id % 229 = 11 THEN 'repeated' ELSE 'altered' END AS kind,
       "offset"::BIGINT AS "offset", bytes::BIGINT AS bytes,
       (CASE WHEN page_id % 227 = 9 THEN CASE WHEN page_id % 229 = 11 THEN bytes END
             WHEN page_id % 229 = 11 THEN bytes + bytes2 ELSE bytes2 END)::BIGINT AS replica_bytes
FROM sized
WHERE page_id % 227 = 9 AND page_id % 229 <> 11 OR page_id % 227 <> 9 AND (page_id % 229 = 11 OR html2 <> html)
"""


def op2_merkle_fixity(spark, sf_dir: str) -> DataFrame:
    """Audit of the pages as WARC files against a damaged replica: one row per damaged record."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = audit(page_records(pages), page_records(damaged(pages)))
    return found.select("file_id", F.col("record_no").alias("page_id"), "kind", "offset", "bytes", "replica_bytes")
