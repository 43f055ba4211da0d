"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

The trie of all fingerprints is never built in one place. Its upper levels are
traversed by Spark: every fingerprint is dealt to the pairs of prefixes (trie
nodes) that its own prefix forms with prefixes within the Hamming budget. A pair
of nodes that holds too much is descended further before it becomes a task.
Below that, a task walks the two subtrees together: each step takes a pair of
nodes to pairs of their children, adds the differing bits and prunes beyond the
budget. A pair whose leaves are all in one component already is not descended,
so a group of near copies costs about its members, not its pairs; a task returns
a spanning forest only.

Components of these links come from alternating star contractions, each round
written to the shared folder.

A wider budget cannot be dealt out that way: a fingerprint would take part in most
pairs of nodes. ``near_classes`` therefore takes several fingerprints of a text and
several rotations of each, and looks within single nodes of their tries, where
subtrees are joined as before: near texts that part in the upper levels of one trie
meet in another one.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import fresh, stored, table

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints of a subtree on average, and of both sides of a task at most.
SUBTREE = 1 << 11
TASK = 1 << 16
#: Bits by which a pair of too full nodes is descended at once.
DESCENT = 6
#: Node pairs walked at a time.
FRONTIER = 1 << 18
#: Of near_classes: rotations of a fingerprint at most, leaves of a node that are
#: compared in blocks of so many pairs (more are walked).
ROTATIONS = 8
FEW_LEAVES, BLOCK = 1 << 12, 1 << 18


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, repeats counted; 0 without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [digest(joined, SEED)]
    else:
        ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
        starts = itertools.chain((0,), ends)
        hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[words - 1 :])]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of 64-bit hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(bits), 255):
        counts += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "little")


def fingerprints(hashes: np.ndarray, n: int) -> list[int]:
    """``n`` signed fingerprints of shingle hashes: of the hashes themselves, then of
    hashes mixed anew (SplitMix64)."""
    out = []
    for k in range(n):
        own = hashes
        if k:
            own = own + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            own = (own ^ own >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            own = (own ^ own >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            own ^= own >> np.uint64(31)
        out.append(_signed(majority(np.ascontiguousarray(own, dtype="<u8"))))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_udf(words: int = SHINGLE_WORDS):
    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, words)) for t in text], dtype="int64")

    return of


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class Forest:
    """Components of the leaves of one task; a root is the smallest index."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        a, b = root[i], root[j]
        while True:
            differ = a != b
            if not differ.any():
                break
            a, b = a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
            a, b = root[a], root[b]
        self.root = root

    def changes(self, part: slice) -> np.ndarray:
        own = self.root[part]
        return np.concatenate([[0], np.cumsum(own[1:] != own[:-1])]) if len(own) else own


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, budget: int = MAX_BITS) -> np.ndarray:
    """Component root of each leaf of ``left`` followed by ``right``.

    Both are sorted, without repeats, and share their first ``depth`` bits
    within themselves. Without ``right``, ``left`` is joined with itself.
    """
    same = right is None
    a, b = left, left if same else right
    shift = 0 if same else len(a)
    forest = Forest(len(a) + (0 if same else len(b)))
    if not len(a) or not len(b):
        return forest.root
    if same:
        spent = np.zeros(1, dtype=np.int8)
    else:
        top = np.uint64(64 - depth)
        spent = popcount((a[:1] ^ b[:1]) >> top) if depth else np.zeros(1, dtype=np.uint8)
        spent = spent.astype(np.int8)
    one = np.array([0])
    stack = [(depth, one, one + len(a), one, one + len(b), spent)]
    while stack:
        depth, al, ah, bl, bh, spent = stack.pop()
        # leaves of both nodes in one component: nothing to gain below
        ca = forest.changes(slice(0, len(a)))
        cb = ca if same else forest.changes(slice(shift, None))
        joined = (ca[ah - 1] == ca[al]) & (cb[bh - 1] == cb[bl])
        joined &= forest.root[al] == forest.root[bl + shift]
        keep = ~joined
        al, ah, bl, bh, spent = (x[keep] for x in (al, ah, bl, bh, spent))
        if not len(al):
            continue
        few = (ah - al) * (bh - bl) <= 16
        if depth >= 64:
            few[:] = True
        if few.any():
            na, nb = (ah - al)[few], (bh - bl)[few]
            n = na * nb
            at = np.repeat(np.cumsum(n) - n, n)
            k = np.arange(n.sum()) - at
            width = np.repeat(nb, n)
            i = np.repeat(al[few], n) + k // width
            j = np.repeat(bl[few], n) + k % width
            near = popcount(a[i] ^ b[j]) <= budget
            if near.any():
                forest.unite(i[near], j[near] + shift)
        al, ah, bl, bh, spent = (x[~few] for x in (al, ah, bl, bh, spent))
        if not len(al):
            continue
        bit = np.uint64(63 - depth)

        def middle(x, low, high):
            base = (x[low] >> bit | np.uint64(1)) << bit  # first value with this bit set
            return np.minimum(np.maximum(np.searchsorted(x, base), low), high)

        am, bm = middle(a, al, ah), middle(b, bl, bh)
        twin = (al == bl) if same else np.zeros(len(al), dtype=bool)
        children = [
            (al, am, bm, bh, spent + 1, None),
            (am, ah, bl, bm, spent + 1, ~twin),
            (am, ah, bm, bh, spent, None),
            (al, am, bl, bm, spent, None),
        ]
        rows = []
        for x in children:
            alive = (x[0] < x[1]) & (x[2] < x[3]) & (x[4] <= budget)
            if x[5] is not None:
                alive &= x[5]
            rows.append([y[alive] for y in x[:5]])
        rows = [np.concatenate(y) for y in zip(*rows)]
        order = np.argsort(rows[4], kind="stable")  # near nodes first: they join components
        for k in reversed(range(0, len(order), FRONTIER)):
            stack.append((depth + 1, *(y[order[k : k + FRONTIER]] for y in rows)))
    return forest.root


def _linker(budget: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        """Spanning links (child, parent) of representatives within one task."""
        depth = int(group["depth"].iloc[0])
        a, b = int(group["node_a"].iloc[0]), int(group["node_b"].iloc[0])
        fps = group["fp"].to_numpy().view(np.uint64)
        order = np.argsort(fps, kind="stable")
        fps, reps = fps[order], group["rep"].to_numpy()[order]
        if a == b:
            root = walk(fps, None, depth, budget)
        else:
            side = (fps >> np.uint64(64 - depth)) == np.uint64(a)
            parts = np.concatenate([np.flatnonzero(side), np.flatnonzero(~side)])
            root = walk(fps[side], fps[~side], depth, budget)
            reps = reps[parts]
        least = reps.copy()
        np.minimum.at(least, root, reps)
        parent = least[root]
        out = parent != reps
        return pd.DataFrame({"child": reps[out], "parent": parent[out]})

    return link


def _masks(bits: int, budget: int) -> list[int]:
    return [
        sum(1 << k for k in chosen)
        for n in range(min(budget, bits) + 1)
        for chosen in itertools.combinations(range(bits), n)
    ]


def _node(depth: int):
    """The first bits of a fingerprint as a number; 0 at the root."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def node_pairs(unique: DataFrame, depth: int, budget: int) -> DataFrame:
    """Each fingerprint in every pair of nodes of this depth it takes part in."""
    masks = F.array(*(F.lit(m).cast("long") for m in _masks(depth, budget)))
    node = _node(depth)
    other = F.col("node").bitwiseXOR(F.col("mask"))
    return (
        unique.select("fp", "rep", node.alias("node"), F.explode(masks).alias("mask"))
        .select(
            F.lit(depth).alias("depth"),
            F.least("node", other).alias("node_a"),
            F.greatest("node", other).alias("node_b"),
            "fp",
            "rep",
        )
    )


def descend(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """Rows of pairs at ``depth`` dealt anew to pairs of nodes DESCENT bits below.

    A pair of equal nodes gives each pair of children once; otherwise the side
    that a fingerprint is on stays the same.
    """
    step = DESCENT
    masks = F.array(*(F.lit(m).cast("long") for m in _masks(step, budget)))
    own, up = _node(depth + step), _node(depth)
    spent = F.bit_count(F.col("node_a").bitwiseXOR(F.col("node_b")))
    dealt = rows.withColumn("mask", F.explode(masks)).where(
        spent + F.bit_count("mask") <= budget
    )
    # the other side's child: its parent's bits, own lower bits with the mask applied
    across = F.when(up == F.col("node_a"), F.col("node_b")).otherwise(F.col("node_a"))
    low = own.bitwiseAND(F.lit((1 << step) - 1).cast("long")).bitwiseXOR(F.col("mask"))
    other = F.shiftleft(across, step).bitwiseOR(low)
    return dealt.select(
        F.lit(depth + step).alias("depth"),
        F.least(own, other).alias("node_a"),
        F.greatest(own, other).alias("node_b"),
        "fp",
        "rep",
    )


def near_links(unique: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Links (child > parent) between representatives of fingerprints at most
    ``budget`` bits apart; their components are those of all such links."""
    depth = min(24, max(5, math.ceil(math.log2(max(1, unique.count()) / SUBTREE))))
    rows = node_pairs(unique, depth, budget)
    done = []
    while depth <= 63 - DESCENT:
        full = (
            rows.groupBy("node_a", "node_b").agg(F.count("*").alias("size"))
            .where(F.col("size") > TASK)
        )
        full = stored(full.select("node_a", "node_b"), "full-nodes")
        if full.isEmpty():
            break
        done.append(rows.join(full, ["node_a", "node_b"], "left_anti").select(*rows.columns))
        rows = rows.join(full, ["node_a", "node_b"], "left_semi").select(*rows.columns)
        rows = descend(rows, depth, budget)
        depth += DESCENT
    for part in done:
        rows = rows.unionByName(part)
    links = rows.groupBy("depth", "node_a", "node_b").applyInPandas(
        _linker(budget), "child long, parent long"
    )
    return stored(links.distinct(), "near-links")


def leaf_classes(leaves: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Component root of each leaf of a node; sorted, without repeats."""
    n = len(leaves)
    if n > FEW_LEAVES:
        return walk(leaves, None, depth, budget)
    forest = Forest(n)
    step = max(1, BLOCK // max(1, n))
    for k in range(0, n, step):
        i, j = np.nonzero(popcount(leaves[k : k + step, None] ^ leaves[None, k:]) <= budget)
        above = i < j
        if above.any():
            forest.unite(i[above] + k, j[above] + k)
    return forest.root


def _classifier(depth: int, budget: int):
    def classify(group: pd.DataFrame) -> pd.DataFrame:
        """Members of the classes of at least two rows within one node."""
        leaves, at = np.unique(group["fp"].to_numpy().view(np.uint64), return_inverse=True)
        root = leaf_classes(leaves, depth, budget)[at]
        many = np.bincount(root)[root] > 1
        return pd.DataFrame(
            {"digest": group["digest"][many], "node": group["node"][many], "leaf": leaves[root[many]].view(np.int64)}
        )

    return classify


def near_classes(texts: DataFrame, count: int, budget: int, subtree: int = SUBTREE) -> DataFrame:
    """(digest, key) of texts (digest, prints), ``prints`` an array of ``count``
    fingerprints. Texts share a key if one of the fingerprints takes them to the
    same node and links them there, by ``budget`` differing bits or over others.
    """
    depth = min(24, max(0, math.ceil(math.log2(max(1, texts.count()) / subtree))))
    leaves = []
    for number in range(count):
        for turn in range(min(ROTATIONS, 64 // depth) if depth else 1):
            fp, bits = F.get("prints", F.lit(number)), turn * depth
            if bits:
                fp = F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))
            top = F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")
            node = F.lit((number * ROTATIONS + turn) << depth).cast("long") + top
            leaves.append(F.struct(node.alias("node"), fp.alias("fp")))
    rows = texts.select("digest", F.explode(F.array(*leaves)).alias("leaf")).select("digest", "leaf.node", "leaf.fp")
    found = rows.groupBy("node").applyInPandas(_classifier(depth, budget), "digest binary, node long, leaf long")
    return found.select("digest", F.xxhash64("node", "leaf").alias("key"))


def components(links: DataFrame) -> DataFrame:
    """(member, component): the smallest id reachable, for every linked id but
    the smallest ones themselves. Alternates large-star and small-star."""
    edges = links
    before = None
    while True:
        both = edges.union(edges.select("parent", "child")).toDF("child", "parent")
        least = stored(
            both.groupBy("child").agg(F.min("parent").alias("least"))
            .select(F.col("child").alias("hub"), F.least("child", "least").alias("least")),
            "star-large",
        )
        large = stored(
            both.where("child > parent").select("child", F.col("parent").alias("hub"))
            .join(least, "hub").select("child", F.col("least").alias("parent")).distinct(),
            "edges-large",
        )
        least = stored(
            large.groupBy("child").agg(F.min("parent").alias("least"))
            .select(F.col("child").alias("hub"), "least"),
            "star-small",
        )
        moved = large.select(F.col("child").alias("hub"), "parent").join(least, "hub")
        edges = stored(
            moved.where("parent <> least").select(F.col("parent").alias("child"), F.col("least").alias("parent"))
            .union(least.select("hub", "least")).distinct(),
            "edges-small",
        )
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("child", "parent")), F.bit_xor(F.xxhash64("parent", "child"))
        ).first()
        if now == before:
            return edges.toDF("member", "component")
        before = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE_WORDS, budget: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of documents.

    Null or empty text has fingerprint zero and links like any other. Rows of
    null id keep their fingerprint and get a null component; they link nothing.
    """
    prints = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), fingerprint_udf(words)(F.col(text_col)).alias("fp")
        ),
        "fingerprints",
    )
    unique = stored(
        prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "unique-prints"
    )
    found = components(near_links(unique, budget))
    classes = stored(
        unique.join(found, unique["rep"] == found["member"], "left")
        .select(F.col("fp").alias("class_fp"), F.coalesce("component", "rep").alias("component_id")),
        "print-classes",
    )
    return prints.join(classes, prints["fp"] == classes["class_fp"], "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE_WORDS, budget: int = MAX_BITS,
) -> DataFrame:
    """Documents, all columns, without near copies: the smallest id of each
    group stays. Of rows that repeat an id all stay or go together; rows of null
    id stay."""
    (member,) = fresh(docs, "member_id")
    gone = (
        near_duplicates(docs, id_col, text_col, words, budget)
        .where("component_id <> doc_id")
        .select(F.col("doc_id").alias(member))
        .distinct()
    )
    return docs.join(gone, docs[id_col] == gone[member], "left_anti")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op8_simhash_dedup": op8_simhash_dedup}
ORACLE: dict[str, str] = {}
