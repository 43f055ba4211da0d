"""Fixity audit of WARC replicas by Merkle trees.

Every record has a digest. Records of a file lie in ranges of offsets of
2 ** RANGE_BITS bytes; the digest of a range covers its records in the order of
their offsets, and FANOUT_BITS more bits of the offset make the next level, up to
one root for each file. Two replicas compare roots; only the children of nodes
that differ are compared further, down to ranges, and only records of differing
ranges are compared themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

RANGE_BITS = 20
FANOUT_BITS = 4
#: Shifts of the levels, from ranges up; the last one takes any offset: the root.
SHIFTS = (*range(RANGE_BITS, 44, FANOUT_BITS), 63)


def record_bytes(url: Column, body: Column) -> Column:
    """A WARC response record of a page as text; null counts as empty."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
        F.lit("\r\n\r\n"),
    )


def replica(records: DataFrame) -> DataFrame:
    """Records (file, offset, length, digest) with their number of copies: equal
    rows count as one record with more copies. A null file is the file "" and a
    null offset is -1."""
    return records.select(
        F.coalesce("file", F.lit("")).alias("file"), F.coalesce("offset", F.lit(-1)).cast("long").alias("offset"),
        F.coalesce("length", F.lit(-1)).cast("long").alias("length"), F.coalesce("digest", F.lit("")).alias("digest"),
    ).groupBy("file", "offset", "length", "digest").agg(F.count("*").alias("copies"))


def merkle_levels(records: DataFrame) -> list[DataFrame]:
    """(file, node, digest) of every level, ranges first. A node has as many
    children as fit its span of offsets."""
    line = F.concat_ws(" ", F.lpad("offset", 20, "0"), "length", "digest", "copies")
    level = records.groupBy("file", F.shiftright("offset", SHIFTS[0]).alias("node")).agg(
        F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(line))), 256).alias("digest")
    )
    levels = [level]
    for below, shift in zip(SHIFTS, SHIFTS[1:]):
        line = F.struct("node", "digest")
        level = level.groupBy("file", F.shiftright("node", shift - below).alias("up")).agg(
            F.array_sort(F.collect_list(line)).alias("children")
        ).select(
            "file", F.col("up").alias("node"),
            F.sha2(
                F.concat_ws("\n", F.transform("children", lambda c: F.concat_ws(" ", c.node, c.digest))), 256
            ).alias("digest"),
        )
        levels.append(level)
    return levels


def _differing(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys on one side only or with other values; values as left_ and right_."""
    a = left.select(*keys, *(F.col(v).alias(f"left_{v}") for v in values))
    b = right.select(*keys, *(F.col(v).alias(f"right_{v}") for v in values))
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"left_{v}").eqNullSafe(F.col(f"right_{v}"))
    return a.join(b, keys, "full_outer").where(~same)


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, offset, damage, left_digest, right_digest) of records on which the
    replicas differ: missing in the right one, extra there, or changed.

    Equal replicas, and two empty ones, give no rows. Records of one offset are
    compared as sets of (length, digest, copies); where several differ, each side
    is listed in order, joined by commas.
    """
    left, right = (stored(replica(side), f"fixity-{n}") for n, side in (("left", left), ("right", right)))
    trees = [
        [stored(level, f"fixity-level-{n}") if n in (0, len(SHIFTS) - 1) else level
         for n, level in enumerate(merkle_levels(side))]
        for side in (left, right)
    ]
    wrong = _differing(trees[0][-1], trees[1][-1], ["file", "node"], ["digest"]).select("file", "node")
    for level in range(len(SHIFTS) - 2, -1, -1):
        wrong = stored(wrong.toDF("file", "up"), "fixity-wrong")
        up = F.shiftright("node", SHIFTS[level + 1] - SHIFTS[level])
        below = [
            tree[level].withColumn("up", up).join(wrong, ["file", "up"], "left_semi").drop("up") for tree in trees
        ]
        wrong = _differing(*below, ["file", "node"], ["digest"]).select("file", "node")
    wrong = stored(wrong, "fixity-ranges")
    sides = []
    for side in (left, right):
        part = side.withColumn("node", F.shiftright("offset", SHIFTS[0])).join(wrong, ["file", "node"], "left_semi")
        content = F.array_sort(F.collect_list(F.struct("length", "digest", "copies")))
        sides.append(part.groupBy("file", "offset").agg(content.alias("content")))
    found = _differing(*sides, ["file", "offset"], ["content"])
    return found.select(
        "file", "offset",
        F.when(F.col("right_content").isNull(), "missing").when(F.col("left_content").isNull(), "extra")
        .otherwise("changed").alias("damage"),
        F.array_join("left_content.digest", ",").alias("left_digest"),
        F.array_join("right_content.digest", ",").alias("right_digest"),
    )


def page_records(pages: DataFrame, body: Column, file_pages: int = 1000) -> DataFrame:
    """Records of pages as they lie in WARC files of ``file_pages`` page ids each:
    (page_id, file, offset, length, digest of the record with ``body``). Offsets
    are those of the undamaged records. Pages of null id are dealt to files by a
    hash of their URL."""
    whole = record_bytes(F.col("url"), F.col("html"))
    file = F.coalesce(
        F.floor(F.col("page_id") / file_pages).cast("string"),
        F.concat(F.lit("none-"), F.pmod(F.xxhash64("url"), F.lit(1024)).cast("string")),
    )
    records = pages.select(
        "page_id", F.concat(F.lit("warc-"), file).alias("file"), F.octet_length(whole).alias("length"),
        F.sha2(whole, 256).alias("original"), F.sha2(record_bytes(F.col("url"), body), 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("page_id", "original").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("original")


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' records against a second copy: there, a page in 101 has its last
    character lost or replaced and a page in 211 is missing."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    html = F.coalesce(F.col("html"), F.lit(""))
    worn = F.when(F.col("page_id") % 101 == 7, F.concat(F.substring(html, 1, F.length(html) - 1), F.lit("~")))
    copy = page_records(pages, worn.otherwise(html)).where(
        F.col("page_id").isNull() | (F.col("page_id") % 211 != 11)
    )
    return audit(page_records(pages, html), copy)


QUERIES = {"op2_warc_fixity": op2_warc_fixity}

ORACLE = {
    "op2_warc_fixity": r"""
WITH bodies AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         CASE WHEN page_id % 101 = 7 THEN left(coalesce(html, ''), greatest(length(coalesce(html, '')) - 1, 0)) || '~'
              ELSE coalesce(html, '') END AS worn
  FROM pages
), records AS (
  SELECT page_id, 'warc-' || CAST(page_id // 1000 AS VARCHAR) AS file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
           || chr(13) || chr(10) || 'Content-Length: ' AS head,
         chr(13) || chr(10) || chr(13) || chr(10) AS gap, html, worn
  FROM bodies
), full_records AS (
  SELECT page_id, file, head || strlen(html) || gap || html || gap AS good,
         head || strlen(worn) || gap || worn || gap AS bad
  FROM records
), placed AS (
  SELECT page_id, file, sha256(good) AS left_digest, sha256(bad) AS bad_digest,
         CAST(sum(strlen(good)) OVER (PARTITION BY file ORDER BY page_id, sha256(good)) - strlen(good) AS BIGINT)
           AS "offset"
  FROM full_records
)
SELECT file, "offset", CASE WHEN page_id % 211 = 11 THEN 'missing' ELSE 'changed' END AS damage, left_digest,
       CASE WHEN page_id % 211 = 11 THEN NULL ELSE bad_digest END AS right_digest
FROM placed WHERE page_id % 211 = 11 OR page_id % 101 = 7
"""
}
