"""Substring deduplication with fixed-block anchors.

Of two equal runs of ``window`` words each holds, whole, one block of
``(window + 1) // 2`` words that starts at a multiple of that length in its own
document. So the blocks of all documents are the reference, and every rolling
window of a block's length is a probe:

1. The digests of the non-overlapping blocks go into an index of bits.
2. All rolling windows are probed. Those found in the index set bits of a second
   index, which keeps what was set at two places: a block itself is one of them.
3. A probe whose bits were set twice is a hit. It is extended to the windows of
   full length that hold it; their 128-bit digests alone are shuffled, counted on
   the map side first. A digest that occurs once names its only document, so the
   windows to be let go again need no join by digest: a passage that a third of
   the documents share has no hot key.
4. Each document takes its extended hits, less the ones let go; those that touch
   or overlap form its maximal exact repeats.

Both indexes have ``INDEX_BITS`` bits at most, whatever the input. A fuller one
lets more windows through to step 3 and never changes the result.
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

from millpulse.llm.common import fresh, table

WINDOW = 35
#: Bits of each index (64 MiB), and of the parts in which it is put together.
INDEX_BITS = 1 << 29
SEGMENT_BITS = 1 << 20
#: Digests gathered before a task writes a part of an index.
PART_DIGESTS = 1 << 20
#: Odd multipliers of the two rolling sums.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers for each word."""
    if not words:
        return np.zeros((2, 0), dtype=np.uint64)
    joined = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.ascontiguousarray(np.frombuffer(joined, dtype="<u8").reshape(-1, 2).T)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """A 64-bit sum of each run of ``size`` words, the same wherever it stands."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(n, base), out=sums[1:])
    back = _powers(n - size + 1, pow(base, -1, 1 << 64))
    return (sums[size:] - sums[: n - size + 1]) * back


def window_digests(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(rolling(h, size, base) for h, base in zip(hashes, _BASES))


def _spread(probe: np.ndarray) -> np.ndarray:
    probe = (probe ^ (probe >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return probe ^ (probe >> np.uint64(32))


def _bits(probe: np.ndarray, bits: int) -> np.ndarray:
    """The two index bits of each digest."""
    mixed = _spread(probe)
    one = (mixed & np.uint64(bits - 1)).astype(np.uint32)
    two = ((mixed >> np.uint64(34)) & np.uint64(bits - 1)).astype(np.uint32)
    return np.stack([one, two ^ (one == two)])


def _found(index: np.ndarray, probe: np.ndarray, bits: int) -> np.ndarray:
    where = _bits(probe, bits)
    return (((index[where >> 3] << (where & 7).astype(np.uint8)) & 128) > 0).all(axis=0)


def _part(found: list[np.ndarray], bits: int) -> pd.DataFrame:
    """Per segment: the bits set, and those set by two or more digests."""
    where, counts = np.unique(_bits(np.concatenate(found), bits), return_counts=True)
    segment = where // SEGMENT_BITS
    cut = np.flatnonzero(np.diff(segment)) + 1
    return pd.DataFrame(
        [
            (int(s[0]), zlib.compress(p.tobytes(), 1), zlib.compress(p[c > 1].tobytes(), 1))
            for s, p, c in zip(
                np.split(segment, cut), np.split(where % SEGMENT_BITS, cut), np.split(counts, cut)
            )
        ],
        columns=["segment", "once", "twice"],
    )


def _parts(chosen, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size, choose = [], 0, chosen()
        for batch in batches:
            for text in batch["text"]:
                own = choose(words_of(text))
                if len(own):
                    found.append(own)
                    size += len(own)
                if size >= PART_DIGESTS:
                    yield _part(found, bits)
                    found, size = [], 0
        if found:
            yield _part(found, bits)

    return run


def _merge(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, once, twice in batch.itertuples(index=False):
                counts = seen.setdefault(segment, np.zeros(SEGMENT_BITS, dtype=np.uint8))
                once = np.frombuffer(zlib.decompress(once), dtype=np.uint32)
                counts[once] = np.minimum(counts[once] + 1, 2)
                counts[np.frombuffer(zlib.decompress(twice), dtype=np.uint32)] = 2
        for segment, counts in seen.items():
            kept = counts >= least
            if kept.any():
                packed = zlib.compress(np.packbits(kept).tobytes(), 1)
                yield pd.DataFrame([(segment, packed)], columns=["segment", "bits"])

    return run


def _unpacked(parts: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    whole = np.zeros(max(bits, SEGMENT_BITS) // 8, dtype=np.uint8)
    size = SEGMENT_BITS // 8
    for segment, packed in parts:
        whole[segment * size : (segment + 1) * size] = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
    return whole


def _index(texts: DataFrame, chosen, bits: int, least: int):
    """Broadcast index of the bits that ``least`` of the chosen digests set."""
    parts = texts.mapInPandas(_parts(chosen, bits), "segment int, once binary, twice binary")
    merged = parts.repartition("segment").mapInPandas(_merge(least), "segment int, bits binary")
    # At most bits / SEGMENT_BITS rows of SEGMENT_BITS / 8 bytes reach the driver.
    return texts.sparkSession.sparkContext.broadcast([(r.segment, bytes(r.bits)) for r in merged.collect()])


def _blocks(block: int):
    def chosen():
        return lambda words: rolling(word_hashes(words)[0], block, _BASES[0])[::block]

    return chosen


def _probes(shared, block: int, bits: int):
    def chosen():
        index = _unpacked(shared.value, bits)

        def choose(words: list[bytes]) -> np.ndarray:
            probe = rolling(word_hashes(words)[0], block, _BASES[0])
            return probe[_found(index, probe, bits)] if len(probe) else probe

        return choose

    return chosen


def extended(index: np.ndarray, hashes: np.ndarray, block: int, window: int, bits: int) -> np.ndarray:
    """Starts of the windows of full length that hold a hit."""
    if hashes.shape[1] < window:
        return np.zeros(0, dtype=np.int64)
    hit = _found(index, rolling(hashes[0], block, _BASES[0]), bits)
    ahead = np.concatenate([[0], np.cumsum(hit)])
    reach = window - block + 1  # places of a block within a window
    return np.flatnonzero(ahead[reach:] > ahead[:-reach])


def _suspects(shared, block: int, window: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _unpacked(shared.value, bits)  # of this task only
        for batch in batches:
            ids, ones, twos, size = [], [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                hashes = word_hashes(words_of(text))
                starts = extended(index, hashes, block, window, bits)
                if len(starts):
                    one, two = window_digests(hashes, window)
                    ids.append(np.repeat(np.array([doc_id]), len(starts)))
                    ones.append(one[starts])
                    twos.append(two[starts])
                    size += len(starts)
                if size >= PART_DIGESTS:
                    yield _rows(ids, ones, twos)
                    ids, ones, twos, size = [], [], [], 0
            if size:
                yield _rows(ids, ones, twos)

    return run


def _rows(ids, ones, twos) -> pd.DataFrame:
    one, two = (np.concatenate(x).view(np.int64) for x in (ones, twos))
    return pd.DataFrame({"doc_id": np.concatenate(ids), "one": one, "two": two})


_RESULT = "n_words long, n_removed long, text string, kept_sha256 string"


def _without(shared, block: int, window: int, bits: int):
    @F.pandas_udf(_RESULT)
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        index = _unpacked(shared.value, bits)
        for texts, ids, *single in parts:
            out = []
            for text, doc_id, first, second in zip(texts, ids, *single):
                words = words_of(text)
                kept = words
                if not pd.isna(doc_id) and len(words) >= window:
                    hashes = word_hashes(words)
                    starts = extended(index, hashes, block, window, bits)
                    if len(starts) and first is not None:
                        one, two = (x[starts].view(np.int64).tolist() for x in window_digests(hashes, window))
                        once = set(zip(first.tolist(), second.tolist()))
                        starts = starts[[pair not in once for pair in zip(one, two)]]
                    if len(starts):
                        change = np.zeros(len(words) + 1, dtype=np.int64)
                        change[starts] += 1
                        change[starts + window] -= 1
                        kept = [w for w, n in zip(words, np.cumsum(change[:-1]).tolist()) if not n]
                rest = b" ".join(kept)
                out.append(
                    (
                        len(words), len(words) - len(kept), rest.decode("utf-8", "surrogatepass"),
                        hashlib.sha256(rest).hexdigest(),
                    )
                )
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "text", "kept_sha256"])

    return run


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    index_bits: int = INDEX_BITS,
) -> tuple[DataFrame, str]:
    """Documents with all their columns and one more, whose name is returned: a
    struct of n_words, n_removed, text (the kept words, joined by a space) and
    kept_sha256.

    A word goes if a run of ``window`` words that covers it starts at another
    place too, in any document. Null text has no words. Shorter texts lose
    nothing. Rows of null id keep all their words and take no part. Rows that
    repeat an id are places of their own, so a repeated row loses what it
    repeats. Words are compared by 128-bit digests of their runs.
    """
    block = (window + 1) // 2
    single_id, single, result = fresh(docs, "single_id", "single", "substring_dedup")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    blocks = _index(rows.select("text"), _blocks(block), index_bits, 1)
    twice = _index(rows.select("text"), _probes(blocks, block, index_bits), index_bits, 2)
    suspects = rows.mapInPandas(
        _suspects(twice, block, window, index_bits), f"doc_id {id_type}, one long, two long"
    )
    once = (
        suspects.groupBy("one", "two").agg(F.count("*").alias("n"), F.min("doc_id").alias(single_id))
        .where("n = 1").groupBy(single_id).agg(F.collect_list(F.struct("one", "two")).alias(single))
    )
    joined = docs.join(once, F.col(id_col) == F.col(single_id), "left")
    found = _without(twice, block, window, index_bits)(
        F.col(text_col), F.col(id_col), F.col(f"{single}.one"), F.col(f"{single}.two")
    )
    return joined.withColumn(result, found).drop(single_id, single), result


def op13_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, result = drop_repeats(docs)
    return out.select(
        "doc_id", *(F.col(f"{result}.{c}").alias(c) for c in ("n_words", "n_removed", "kept_sha256"))
    )


QUERIES = {"op13_block_anchors": op13_block_anchors}

ORACLE = {
    "op13_block_anchors": r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS place,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), starts AS (
  SELECT place, words, unnest(range(len(words) - 34)) AS start FROM texts WHERE len(words) >= 35
), windows AS (
  SELECT place, start, md5(array_to_string(words[start + 1 : start + 35], ' ')) AS digest FROM starts
), repeated AS (
  SELECT place, start FROM windows
  WHERE digest IN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT place, start + unnest(range(35)) AS pos FROM repeated
), spread AS (
  SELECT place, unnest(words) AS word, unnest(range(len(words))) AS pos FROM texts
), kept AS (
  SELECT s.place, count(c.pos) AS n_removed,
         string_agg(s.word, ' ' ORDER BY s.pos) FILTER (c.pos IS NULL) AS rest
  FROM spread s LEFT JOIN covered c ON s.place = c.place AND s.pos = c.pos GROUP BY s.place
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (place)
"""
}
