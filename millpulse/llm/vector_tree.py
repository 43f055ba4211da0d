"""Nearest neighbours through a hierarchical k-means tree.

The tree is fitted on at most ``SAMPLE`` vectors and has at most ``MAX_LEAVES``
leaves; every row is then put into a leaf by walking down to the nearest centre.
A query walks the tree best bin first: a priority queue holds nodes by the
distance of their centres, the nearest is opened, and leaves come out in the order
of their visits. How many leaves a search visits is calibrated: for ``CALIBRATED``
queries the true neighbours come from a scan, and visits widen until the wanted
recall is reached.

Leaves are joined with the queries that visit them, in blocks of bounded size on
both sides; every block returns its nearest rows for each query. Distances are
computed exactly, on the original vectors. Of rows with equal vectors only the
k + 1 smallest ids can be among the k nearest (ties go to smaller ids), so no more
of them enter the leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

SAMPLE = 20_000
MAX_LEAVES = 4096
LEAF_ROWS = 500
BRANCHES = 8
CALIBRATED = 200
RECALL = 0.98
BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096
QUERY_STEP = 100


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _squared(x, centers).argmin(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=k)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers, _squared(x, centers).argmin(1)


@dataclass
class Tree:
    centers: np.ndarray  # of all nodes; the root is 0
    children: list[list[int]]  # none: a leaf
    leaf: list[int]  # number of the leaf, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        active = np.arange(len(x)) if self.children[0] else np.zeros(0, dtype=np.int64)
        while len(active):
            for parent in np.unique(node[active]).tolist():
                rows = active[node[active] == parent]
                below = np.array(self.children[parent])
                node[rows] = below[_squared(x[rows], self.centers[below]).argmin(1)]
            active = active[[bool(self.children[n]) for n in node[active].tolist()]]
        return np.array(self.leaf)[node] if len(x) else node

    def visits(
        self, q: np.ndarray, most: int, sizes: list[int] | None = None, least: int = 0
    ) -> list[list[int]]:
        """For each query the first leaves, best bin first: ``most`` of them, and
        more until their rows (``sizes`` by leaf) are ``least``. Only the centers
        below an opened node are measured."""
        out = []
        for one in q:
            queue, found, held = [(0.0, 0)], [], 0
            while queue and (len(found) < most or held < least):
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    found.append(self.leaf[node])
                    held += sizes[self.leaf[node]] if sizes else least
                below = self.children[node]
                if below:
                    away = ((self.centers[below] - one) ** 2).sum(1).tolist()
                    for child, distance in zip(below, away):
                        heapq.heappush(queue, (distance, child))
            out.append(found)
        return out


def fit_tree(sample: np.ndarray, leaves: int, seed: int = 0) -> Tree:
    """Nodes are split by k-means, the largest first, up to so many leaves."""
    rng = np.random.default_rng(seed)
    x = np.unique(sample, axis=0) if len(sample) else sample
    tree = Tree(np.zeros((1, x.shape[1] if x.ndim == 2 else 1)), [[]], [0])
    if not len(x):
        return tree
    centers, children = [x.mean(0)], [[]]
    queue = [(-len(x), 0, np.arange(len(x)))]
    count = 1
    while queue and count < leaves:
        n, node, rows = heapq.heappop(queue)
        k = min(BRANCHES, len(rows), leaves - count + 1)
        if k < 2:
            continue
        c, own = _kmeans(x[rows], k, rng)
        parts = [(j, rows[own == j]) for j in range(k) if (own == j).any()]
        if len(parts) < 2:
            continue
        for j, part in parts:
            children[node].append(len(centers))
            heapq.heappush(queue, (-len(part), len(centers), part))
            centers.append(c[j])
            children.append([])
        count += len(parts) - 1
    number = iter(range(len(centers)))
    return Tree(np.array(centers), children, [-1 if below else next(number) for below in children])


def nearest_in_block(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, distance) of the k nearest rows of each query, not
    itself. A product of matrices screens; what could be among the k nearest gets
    its exact distance."""
    norms = (rows * rows).sum(1)
    out_q, out_v, out_d = [], [], []
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        own = (q * q).sum(1)
        rough = own[:, None] + norms[None] - 2 * q @ rows.T
        slack = 1e-9 * (own + norms.max())
        rough[query_ids[at : at + 256, None] == row_ids[None]] = np.inf
        kth = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
        kth = np.where(np.isfinite(kth), kth, np.finfo(float).max)
        for i in range(len(q)):
            near = np.flatnonzero(rough[i] <= kth[i] + slack[i])
            exact = np.sqrt(((rows[near] - q[i]) ** 2).sum(1))
            best = np.lexsort((row_ids[near], exact))[:k]
            out_q.append(np.full(len(best), query_ids[at + i]))
            out_v.append(row_ids[near][best])
            out_d.append(exact[best])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_d)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _result(q, v, d, **more) -> pd.DataFrame:
    return pd.DataFrame({"query_id": q, "vec_id": v, "score": d, **more})


def _to_leaf(tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.assign(_matrix(batch["embedding"])).astype("int32"))

    return run


def _scan(query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Nearest rows of a few queries among all rows, by task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids = batch["vec_id"].to_numpy()
            q, v, d = nearest_in_block(queries, query_ids, _matrix(batch["embedding"]), ids, k)
            leaf = dict(zip(ids.tolist(), batch["leaf"].tolist()))
            yield _result(q, v, d, leaf=[leaf[i] for i in v.tolist()])

    return run


def _visited(tree: Tree, most: int, sizes: list[int], least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found = tree.visits(_matrix(batch["query"]), most, sizes, least)
            n = [len(f) for f in found]
            yield pd.DataFrame(
                {
                    "query_id": batch["query_id"].repeat(n).to_numpy(),
                    "query": batch["query"].repeat(n).to_numpy(),
                    "leaf": np.array([x for f in found for x in f], dtype="int32"),
                }
            )

    return run


def _search(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return _result([], [], [])
        return _result(
            *nearest_in_block(
                _matrix(queries["query"]), queries["query_id"].to_numpy(),
                _matrix(rows["embedding"]), rows["vec_id"].to_numpy(), k,
            )
        )

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row for
    which the condition ``is_query`` holds, by Euclidean distance.

    Null ids, and vectors that are null, zero, of another length than most or hold
    a null or non-finite component take no part. Rows that repeat an id with the
    same vector count once; a row is never its own neighbour. A query visits leaves
    until they hold k other ids, so it gets fewer only if there are no more.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(
        v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    length = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return spark.range(0).select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
            F.lit(0.0).alias("score"),
        )
    rows = rows.where(F.size(v) == length.n)
    # a row of an id and vector, however often it is there; it asks if any of them does
    rows = stored(rows.groupBy("vec_id", "embedding").agg(F.max("asks").alias("asks")), "vectors")
    total = rows.count()
    same_id = rows.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    sample = _matrix(
        pd.Series([r.embedding for r in rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()])
    )
    tree = fit_tree(sample, min(MAX_LEAVES, max(1, total // LEAF_ROWS)))
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    leaves = stored(
        rows.select("vec_id", "embedding").withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= k + 1).select("vec_id", "embedding")
        .mapInPandas(_to_leaf(tree), "vec_id long, embedding array<double>, leaf int"),
        "vector-leaves",
    )
    queries = rows.where("asks").select(F.col("vec_id").alias("query_id"), v.alias("query"))
    test = (
        queries.orderBy(F.xxhash64(F.lit(5), "query_id"), "query_id").limit(CALIBRATED).collect()
    )
    if not test:
        most = 1
    else:
        test_ids = np.array([r.query_id for r in test])
        test_vectors = _matrix(pd.Series([r.query for r in test]))
        true = _top(
            leaves.mapInPandas(
                _scan(test_ids, test_vectors, k), "query_id long, vec_id long, score double, leaf int"
            ),
            k,
        ).select("query_id", "leaf").collect()
        order = {
            i: {leaf: n for n, leaf in enumerate(f)}
            for i, f in zip(test_ids.tolist(), tree.visits(test_vectors, tree.leaves))
        }
        needed = sorted(order[r.query_id][r.leaf] + 1 for r in true)
        most = needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)] if needed else 1
    # a row for each leaf at most
    sizes, row_blocks, query_blocks = [0] * tree.leaves, [1] * tree.leaves, [1] * tree.leaves
    for leaf, n in leaves.groupBy("leaf").count().collect():
        sizes[leaf], row_blocks[leaf] = n, math.ceil(n / BLOCK_ROWS)
    # k ids beside the query's own; an id may have several vectors
    visited = stored(
        queries.mapInPandas(
            _visited(tree, most, sizes, (k + 1) * same_id), "query_id long, query array<double>, leaf int"
        ),
        "vector-visits",
    )
    for leaf, n in visited.groupBy("leaf").count().collect():
        query_blocks[leaf] = math.ceil(n / BLOCK_QUERIES)

    def of_leaf(numbers: list[int]):
        return F.element_at(F.array(*map(F.lit, numbers)), F.col("leaf") + 1)

    def every(numbers: list[int]):
        return F.explode(F.sequence(F.lit(0), of_leaf(numbers) - 1))

    left = visited.withColumn("query_block", F.pmod(F.xxhash64("query_id"), of_leaf(query_blocks)).cast("int"))
    left = left.withColumn("row_block", every(row_blocks))
    right = leaves.withColumn("row_block", F.pmod(F.xxhash64("vec_id"), of_leaf(row_blocks)).cast("int"))
    right = right.withColumn("query_block", every(query_blocks))
    keys = ("leaf", "row_block", "query_block")
    found = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInPandas(_search(k), "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")


def op6_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, F.col("vec_id") % QUERY_STEP == 0)


QUERIES = {"op6_vector_tree": op6_vector_tree}
ORACLE: dict[str, str] = {}
