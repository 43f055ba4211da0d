"""Line deduplication across documents with a pair of Bloom filters.

1. Every task hashes the distinct line keys of each document and writes down
   which filter bits they set once and which at least twice.
2. The parts meet by filter segment: a bit set in two parts is set twice. A key
   of two documents therefore has all its bits in the filter of twice-seen bits.
3. The twice-seen filter, of ``FILTER_BITS`` bits at most whatever the input,
   goes to the tasks. A line outside of it is unique for certain.
4. Only the suspects shuffle, as (document, 128-bit digest): the smallest and
   largest document of each digest confirm the repeat and choose the keeper.
5. Each document gets its list of lines to lose.

A fuller filter lets more unique lines through to step 4 and never changes the
result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.llm.common import fresh, stored, table

#: Bits of each filter (64 MiB); about a billion distinct lines keep it useful.
FILTER_BITS = 1 << 29
SEGMENT_BITS = 1 << 20
#: Digests gathered before a task writes a part of the filters.
PART_LINES = 300_000
MIN_KEY = 10


def line_keys(text: str | None) -> list[bytes]:
    """Key of each line: blanks stripped at both ends, A-Z in lower case, UTF-8."""
    whole = (text or "").encode("utf-8", "surrogatepass").lower()
    return [line.strip() for line in whole.split(b"\n")]


def long_enough(key: bytes, least: int = MIN_KEY) -> bool:
    """At least that many code points."""
    n = len(key)
    if n < least:
        return False
    return n >= 4 * least or sum((b & 0xC0) != 0x80 for b in key) >= least


def digests(text: str | None, least: int) -> set[bytes]:
    return {xxhash.xxh3_128_digest(k) for k in set(line_keys(text)) if long_enough(k, least)}


def _positions(found: list[bytes], bits: int) -> np.ndarray:
    """Two filter bits for each digest."""
    words = np.frombuffer(b"".join(found), dtype="<u8").reshape(-1, 2)
    where = (words & np.uint64(bits - 1)).astype(np.uint32)
    where[:, 1] ^= where[:, 1] == where[:, 0]
    return where


def _filter_parts(bits: int, least: int):
    def parts(found: list[bytes]) -> pd.DataFrame:
        where = _positions(found, bits)
        once, counts = np.unique(where, return_counts=True)
        segment = once // SEGMENT_BITS
        cut = np.flatnonzero(np.diff(segment)) + 1
        rows = [
            (int(s[0]), p.tobytes(), p[c > 1].tobytes())
            for s, p, c in zip(
                np.split(segment, cut), np.split(once % SEGMENT_BITS, cut), np.split(counts, cut)
            )
        ]
        return pd.DataFrame(rows, columns=["segment", "once", "twice"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[bytes] = []
        for batch in batches:
            for text in batch["text"]:
                found.extend(digests(text, least))
                if len(found) >= PART_LINES:
                    yield parts(found)
                    found = []
        if found:
            yield parts(found)

    return run


def _merge_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: dict[int, np.ndarray] = {}  # how often a bit was set: 0, 1, or 2 for more
    for batch in batches:
        for segment, one, two in batch.itertuples(index=False):
            counts = seen.setdefault(segment, np.zeros(SEGMENT_BITS, dtype=np.uint8))
            one = np.frombuffer(one, dtype=np.uint32)
            counts[one] = np.minimum(counts[one] + 1, 2)
            counts[np.frombuffer(two, dtype=np.uint32)] = 2
    for segment, counts in seen.items():
        twice = counts > 1
        if twice.any():
            packed = zlib.compress(np.packbits(twice).tobytes(), 1)
            yield pd.DataFrame([(segment, packed)], columns=["segment", "bits"])


def _unpacked(parts: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    """The filter as bytes."""
    whole = np.zeros(bits // 8, dtype=np.uint8)
    size = SEGMENT_BITS // 8
    for segment, packed in parts:
        part = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
        whole[segment * size : (segment + 1) * size] = part[: len(whole)]
    return whole


def _suspects(shared, bits: int, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = _unpacked(shared.value, bits)  # of this task only
        for batch in batches:
            for k in range(0, len(batch), 1024):
                part = batch.iloc[k : k + 1024]
                ids, found = [], []
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    own = digests(text, least)
                    found.extend(own)
                    ids.extend([doc_id] * len(own))
                if not found:
                    continue
                where = _positions(found, bits)
                hit = ((filled[where >> 3] << (where & 7).astype(np.uint8)) & 128).all(axis=1)
                keep = np.flatnonzero(hit).tolist()
                yield pd.DataFrame(
                    {"doc_id": [ids[i] for i in keep], "digest": [found[i] for i in keep]}
                )

    return run


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc_id, digests of the lines it loses), for documents that lose any."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.select("text").mapInPandas(
        _filter_parts(filter_bits, min_key), "segment int, once binary, twice binary"
    )
    # At most filter_bits / SEGMENT_BITS rows of SEGMENT_BITS / 8 bytes reach the driver.
    twice = parts.repartition("segment").mapInPandas(_merge_parts, "segment int, bits binary")
    shared = spark.sparkContext.broadcast([(r.segment, bytes(r.bits)) for r in twice.collect()])
    suspects = stored(
        rows.mapInPandas(
            _suspects(shared, filter_bits, min_key), f"doc_id {id_type}, digest binary"
        ),
        "line-suspects",
    )
    repeats = stored(
        suspects.groupBy("digest")
        .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        .where("keeper < last")
        .select("digest", "keeper"),
        "line-repeats",
    )
    return (
        suspects.join(repeats, "digest")
        .where("doc_id <> keeper")
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("lost"))
    )


_RESULT = T.StructType(
    [
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


@F.pandas_udf(_RESULT)
def _without(text: pd.Series, lost: pd.Series) -> pd.DataFrame:
    out = []
    for whole, gone in zip(text, lost):
        lines = (whole or "").split("\n")
        kept = lines
        if gone is not None and len(gone):
            drop = set(map(bytes, gone))
            kept = [
                line
                for line, key in zip(lines, line_keys(whole))
                if xxhash.xxh3_128_digest(key) not in drop
            ]
        rest = "\n".join(kept)
        out.append(
            (
                len(lines),
                len(lines) - len(kept),
                rest,
                hashlib.sha256(rest.encode("utf-8", "surrogatepass")).hexdigest(),
            )
        )
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "text", "kept_sha256"])


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, str]:
    """Documents with all their columns and one more, whose name is returned: a
    struct of n_lines, n_dropped, text (what is left) and kept_sha256.

    A key found under two or more ids stays in the smallest id, with all its
    lines there. Null text is one empty line. Rows of null id are left as they
    are and take no part. Rows that repeat an id count as one document. A
    document that loses every line has the empty text.
    """
    lost_id, lost, result = fresh(docs, "lost_id", "lost", "line_dedup")
    gone = repeated_lines(docs, id_col, text_col, min_key, filter_bits).select(
        F.col("doc_id").alias(lost_id), F.col("lost").alias(lost)
    )
    joined = docs.join(gone, F.col(id_col) == F.col(lost_id), "left")
    return (
        joined.withColumn(result, _without(F.col(text_col), F.col(lost))).drop(lost_id, lost),
        result,
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, result = dedup_lines(docs)
    return out.select(
        "doc_id", *(F.col(f"{result}.{c}").alias(c) for c in ("n_lines", "n_dropped", "kept_sha256"))
    )


QUERIES = {"op1_line_dedup": op1_line_dedup}

ORACLE = {
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines
), repeats AS (
  SELECT line_key, min(doc_id) AS keeper FROM keyed
  WHERE length(line_key) >= 10 GROUP BY 1 HAVING min(doc_id) < max(doc_id)
), marked AS (
  SELECT k.doc_id, k.pos, k.line, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN repeats r USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
}
