"""Ranked lexical search by range maxima over posting lists.

The items are answered in blocks, so that the terms of a block fit a task. For a
block,

1. every task reads whole texts, counts terms, and writes posting lists of the
   block's terms in shards of ``SHARD_POSTINGS`` postings at most; the shards
   also say how many documents and terms were read, which gives N, L and df;
2. each shard gets a sparse table over all its posting lists: for every posting
   and power of two, the place of the greatest impact among the postings ahead.
   The greatest impact of a term among any interval of documents is then one
   comparison of two entries;
3. the sum of these maxima bounds the score of every document of an interval. The
   intervals with the highest bounds are opened first: the document that holds
   the greatest single impact is scored and splits its interval in two. An
   interval goes once its bound cannot enter the ten best, which a task keeps
   from shard to shard;
4. the best of all tasks are ranked, first in salted parts of an item.

The search is exact: an interval is left closed only if its bound is below the
least score held, or equal to it with larger ids only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

TOP = 10
#: Terms of a block of items on average: they are sent to all tasks.
BLOCK_TERMS = 1 << 18
#: Postings and documents of a shard; one document may exceed the first.
SHARD_POSTINGS = 1 << 19
SHARD_DOCS = 1 << 14
#: Intervals opened at a time, growing while a search lasts.
OPEN_FIRST, OPEN_MOST = 16, 256
SALTS = 64

#: Bytes that end a term, as blanks; A-Z in lower case.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(
    range(128, 256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _shards(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = {t: k for k, t in enumerate(shared.value)}
        known = vocabulary.keys()
        ids, lengths, terms, places, counts = [], [], [], [], []
        docs = words = 0

        def shard():
            order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
            at = np.empty(len(order), dtype=np.int32)
            at[order] = np.arange(len(order), dtype=np.int32)
            place, term = at[np.array(places, dtype=np.int64)], np.array(terms, dtype=np.int32)
            by = np.lexsort((place, term))
            return pd.DataFrame(
                {
                    "n_docs": [docs], "n_terms": [words],
                    "ids": [np.array(ids, dtype=np.int64)[order]], "lengths": [np.array(lengths, dtype=np.int64)[order]],
                    "terms": [term[by]], "places": [place[by]], "counts": [np.array(counts, dtype=np.int64)[by]],
                }
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"]):
                found = terms_of(text)
                if not found:
                    continue
                docs += 1
                words += len(found)
                seen = Counter(found)
                own = known & seen.keys()
                if own:
                    places += [len(ids)] * len(own)
                    terms += [vocabulary[t] for t in own]
                    counts += [seen[t] for t in own]
                    ids.append(doc_id)
                    lengths.append(len(found))
                if len(terms) >= SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                    yield shard()
                    ids, lengths, terms, places, counts = [], [], [], [], []
                    docs = words = 0
        if docs:
            yield shard()

    return run


_SHARD = "n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<int>, places array<int>, counts array<long>"


class RangeMaxima:
    """Posting lists one after the other, and for each level k the place of the
    greatest impact among the 2**k postings from each posting on."""

    def __init__(self, impacts: np.ndarray, longest: int):
        self.impacts = impacts
        best = np.arange(len(impacts), dtype=np.int32)
        self.levels = [best]
        half = 1
        while 2 * half <= longest:
            left, right = best[:-half], best[half:]
            ahead = best.copy()
            ahead[: len(left)] = np.where(impacts[right] > impacts[left], right, left)
            best = ahead
            self.levels.append(best)
            half *= 2
        self.table = np.stack(self.levels)

    def places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the greatest impact of each half-open range; ``low`` where empty."""
        size = np.maximum(high - low, 1)
        level = np.frexp(size.astype(np.float64))[1] - 1
        left = self.table[level, np.minimum(low, len(self.impacts) - 1)]
        right = self.table[level, np.clip(high - (1 << level), 0, len(self.impacts) - 1)]
        return np.where((self.impacts[right] > self.impacts[left]) & (high > low), right, left)

    def greatest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(impact, place); 0 where the range is empty."""
        at = self.places(low, high)
        return np.where(high > low, self.impacts[at], 0), at


class Best:
    """The best (score, id) of one item so far."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]

    def may_enter(self, bounds: np.ndarray, least_ids: np.ndarray) -> np.ndarray:
        """Whether documents of at most this score, and at least this id, could."""
        if len(self.scores) < self.top:
            return bounds > 0
        last, last_id = self.scores[-1], self.ids[-1]
        return (bounds > last) | ((bounds == last) & (least_ids < last_id))


def search(
    best: Best, ids: np.ndarray, places: np.ndarray, maxima: RangeMaxima, starts: np.ndarray, ends: np.ndarray,
    keys: np.ndarray, ranks: np.ndarray, weights: np.ndarray,
) -> int:
    """Best-first over intervals of the shard's documents, for one item. ``starts``
    and ``ends`` are its terms' posting lists, ``keys`` sort all postings by list
    (``ranks``) and document. Returns the number of documents scored."""
    n = len(ids)
    low, high = starts[None, :], ends[None, :]
    impact, at = maxima.greatest(low, high)
    first = np.zeros(1, dtype=np.int64)
    bound, split = (impact * weights).sum(axis=1), _split(impact * weights, at, places)
    scored, width = 0, OPEN_FIRST
    while True:
        alive = np.flatnonzero(best.may_enter(bound, ids[np.minimum(first, n - 1)]))
        if not len(alive):
            return scored
        chosen = alive
        if len(alive) > width:
            chosen = alive[np.argpartition(-bound[alive], width - 1)[:width]]
            width = min(2 * width, OPEN_MOST)
        rest = np.setdiff1d(alive, chosen, assume_unique=True) if len(chosen) < len(alive) else alive[:0]
        doc = split[chosen]
        own_low, own_high = low[chosen], high[chosen]
        where = np.searchsorted(keys, (ranks[None, :] * n + doc[:, None]).ravel()).reshape(own_low.shape)
        inside = np.minimum(where, len(places) - 1)
        held = (where < own_high) & (where >= own_low) & (places[inside] == doc[:, None])
        best.add((np.where(held, maxima.impacts[inside], 0) * weights).sum(axis=1), ids[doc])
        scored += len(doc)
        middle = np.clip(where, own_low, own_high)
        new_low = np.concatenate([own_low, middle + held])
        new_high = np.concatenate([middle, own_high])
        impact, at = maxima.greatest(new_low, new_high)
        impact = impact * weights
        low, high = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high])
        bound = np.concatenate([bound[rest], impact.sum(axis=1)])
        split = np.concatenate([split[rest], _split(impact, at, places)])
        first = np.concatenate([first[rest], first[chosen], doc + 1])


def _split(impact: np.ndarray, at: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The document with the greatest single impact of each interval."""
    row = np.arange(len(impact))
    return places[at[row, impact.argmax(axis=1)]].astype(np.int64)


def _searches(shared, totals: tuple[int, int], top: int):
    n_docs, n_terms = totals

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, weight = shared.value  # (terms, times) of each item; weight of each term
        best = [Best(top) for _ in items]
        for batch in batches:
            for ids, lengths, terms, places, counts in batch.itertuples(index=False):
                if not len(ids):
                    continue
                m = 25 + (75 * lengths * n_docs) // n_terms
                impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m[places])
                edges = np.searchsorted(terms, np.arange(len(weight) + 1)).astype(np.int32)
                maxima = RangeMaxima(impacts, int(np.diff(edges).max()))
                keys = terms.astype(np.int64) * len(ids) + places
                for (own, times), held in zip(items, best):
                    there = edges[own + 1] > edges[own]
                    if there.any():
                        here, factor = own[there], (weight[own] * times)[there]
                        search(held, ids, places, maxima, edges[here], edges[here + 1], keys, here, factor)
        rows = [(k, *row) for k, held in enumerate(best) for row in zip(held.ids.tolist(), held.scores.tolist())]
        yield pd.DataFrame(rows, columns=["item", "doc_id", "score"], dtype="int64")

    return run


def _holders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many documents hold each term."""
    seen: Counter = Counter()
    for batch in batches:
        for terms in batch["terms"]:
            which, n = np.unique(terms, return_counts=True)
            seen.update(dict(zip(which.tolist(), n.tolist())))
    yield pd.DataFrame({"term": list(seen), "n": list(seen.values())}, dtype="int64")


def best_of_block(docs: DataFrame, items: list[Counter], top: int = TOP) -> DataFrame:
    """(item, doc_id, score): the best of every task for each of these items, given
    as their terms and times; ``docs`` has doc_id and text, no null id."""
    context = docs.sparkSession.sparkContext
    vocabulary = sorted(set().union(*items))
    number = {t: k for k, t in enumerate(vocabulary)}
    shards = stored(docs.mapInPandas(_shards(context.broadcast(vocabulary)), _SHARD), "search-shards")
    totals = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = (int(n or 0) for n in totals)
    holders = shards.select("terms").mapInPandas(_holders, "term int, n long").groupBy("term").agg(F.sum("n"))
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in holders.collect():  # a row for each term of the block at most
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    asked = []
    for item in items:
        own = sorted((number[t], times) for t, times in item.items())
        asked.append(tuple(np.array(x, dtype=np.int64) for x in (zip(*own) if own else ([], []))))
    shared = context.broadcast((asked, weight))
    return shards.select("ids", "lengths", "terms", "places", "counts").mapInPandas(
        _searches(shared, (n_docs, max(n_terms, 1)), top), "item int, doc_id long, score long"
    )


def search_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each item, highest score
    first, ties by smaller id.

    Null or empty texts have no terms; an item without terms has no rows. Rows of
    null doc_id take no part and are not counted; rows that repeat an id are
    documents of their own. Equal rows of items are one item, and different texts
    under one item_id are answered each with its own ranks; a null item_id is an
    id like any other. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.where("doc_id IS NOT NULL")
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    size = F.regexp_count("text", F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    total = asked.agg(F.sum(size)).first()[0] or 0
    blocks = -(-total // block_terms)
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        block_items = [(r.item_id, Counter(terms_of(r.text))) for r in own.orderBy("item_id", "text").collect()]
        names = spark.createDataFrame(
            [(block, k, i) for k, (i, _) in enumerate(block_items)],
            f"block int, item int, item_id {asked.schema['item_id'].dataType.simpleString()}",
        )
        best = best_of_block(rows, [t for _, t in block_items], top).join(names, "item")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).where("false")
    order = (F.desc("score"), F.asc("doc_id"))
    part = Window.partitionBy("block", "item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("block", "item").orderBy(*order)
    parts = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return (
        parts.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_ranked_search": op12_ranked_search}

ORACLE = {
    "op12_ranked_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term, n_docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""
}
