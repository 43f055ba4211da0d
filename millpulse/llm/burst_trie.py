"""Prefix trie of conversations, built as burst tries.

A turn becomes an id of ``ID_BYTES`` bytes: 16 of the digest of its role and text
and 4 with the number of its words. A conversation is the string of its turns'
ids, so a prefix of turns is a prefix of bytes and names its node exactly.

1. Equal conversations collapse to one sequence with the number, the smallest and
   the hash of its conversations. The hash runs over their ids in order, written
   in runs of ``RUN_IDS`` and read as a stream.
2. All sequences start in one suffix container under the root. A container of
   over ``CONTAINER_SEQUENCES`` bursts: what all its sequences begin with becomes a
   chain of heads of the trie, and the sequences move on to one container for each
   next turn id. Containers are counted on the map side first, and only sequences
   of bursting containers take part in the next round. Equal sequences being one,
   every burst makes smaller containers.
3. The containers are dealt to shards. A shard sorts its sequences and sweeps them,
   container by container, into nodes.
4. The heads get their figures from the tops of containers and heads below them,
   round by round from the last.

What a task holds at once is the nodes of a container, or one conversation's ids
(20 bytes a turn). There are as many rounds as branching heads lie on one path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import WORD, stored, table

ID_BYTES = 20
CONTAINER_SEQUENCES = 1 << 8
RUN_IDS = 1 << 10
SALTS = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = (
    "container binary, round int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_ids(log: DataFrame) -> DataFrame:
    """(conv_id, turn, id in hex) of each turn; null role and text are empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 8, "0")
    content = F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text))
    return log.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.concat(F.upper(content), words).alias("id"),
    )


def whole_sequences(log: DataFrame) -> DataFrame:
    """(conv_id, ids): the ids of each conversation's turns in order, as an array.
    Turns are ordered by number, null first, then by id."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"), F.col("id"))
    turns = turn_ids(log).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return turns.select("conv_id", F.col("turns.id").alias("ids"))


def sharing_heads(sequences: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Sequences rebuilt so that they share beginnings: the first h turns of
    conversation c - c % family, then the own turns after the first h, where h is
    crc32 of the decimal c, modulo ``most``."""
    own = sequences.select(
        "conv_id", "ids", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"),
    )
    base = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, most).alias("lead")
    )
    lead = F.coalesce(F.slice("lead", 1, F.col("h")), F.array().cast("array<string>"))
    rest = F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", F.concat(lead, rest).alias("ids"))


def _hashed_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs sorted by (sequence, run) into one row for each sequence."""
    current, digest, n, least = None, None, 0, None
    done: list[tuple] = []
    for batch in batches:
        for seq, size, first, ids in zip(batch["seq"], batch["size"], batch["first"], batch["ids"]):
            seq = bytes(seq)
            if seq != current:
                if current is not None:
                    done.append((current, n, least, digest.hexdigest()))
                current, digest, n, least = seq, hashlib.sha256(), 0, first
            elif n:
                digest.update(b",")
            digest.update(ids.encode())
            n += size
        yield pd.DataFrame(done, columns=["seq", "n_convs", "conv_id", "ends_sha256"])
        done = []
    if current is not None:
        done.append((current, n, least, digest.hexdigest()))
    yield pd.DataFrame(done, columns=["seq", "n_convs", "conv_id", "ends_sha256"])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """(seq, n_convs, conv_id, ends_sha256): equal conversations as one."""
    runs = (
        sequences.select(
            F.unhex(F.array_join("ids", "")).alias("seq"), "conv_id", F.floor(F.col("conv_id") / RUN_IDS).alias("run")
        )
        .groupBy("seq", "run").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select(
            "seq", "run", F.size("ids").cast("long").alias("size"), F.element_at("ids", 1).alias("first"),
            F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"),
        )
    )
    return runs.repartition("seq").sortWithinPartitions("seq", "run").mapInPandas(
        _hashed_runs, "seq binary, n_convs long, conv_id long, ends_sha256 string"
    )


def common_turns(a: bytes, b: bytes) -> int:
    """Turns with which both begin."""
    low, high = 0, min(len(a), len(b)) // ID_BYTES
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * ID_BYTES : middle * ID_BYTES] == b[low * ID_BYTES : middle * ID_BYTES]:
            low = middle
        else:
            high = middle - 1
    return low


def _common(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole turns with which the least and the greatest sequence begin."""
    for batch in batches:
        targets = []
        for low, high in zip(batch["low"], batch["high"]):
            low = bytes(low)
            targets.append(low[: common_turns(low, bytes(high)) * ID_BYTES])
        yield pd.DataFrame({"container": batch["container"], "target": targets})


def burst(sequences: DataFrame, limit: int = CONTAINER_SEQUENCES) -> tuple[DataFrame, list[DataFrame]]:
    """Sequences with the prefix and the round of the container that holds them, and
    for each round the bursting containers' sequences with (container, target):
    the head that they burst at."""
    rounds: list[DataFrame] = []
    closed, active = None, sequences.withColumn("depth", F.lit(0))
    while True:
        active = active.withColumn("container", F.expr(f"substring(seq, 1, depth * {ID_BYTES})"))
        sizes = active.groupBy("container").agg(
            F.count("*").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high")
        )
        full = stored(
            sizes.where(F.col("n") > limit).mapInPandas(_common, "container binary, target binary"), "full-containers"
        )
        some = not full.isEmpty()
        rest = active.join(full, "container", "left_anti") if some else active
        rest = rest.select(
            *sequences.columns, "container", F.lit(len(rounds)).alias("round")
        )
        closed = rest if closed is None else closed.unionByName(rest)
        if not some:
            return closed, rounds
        rounds.append(stored(active.join(full, "container"), "bursting"))
        active = rounds[-1].where("seq <> target").select(
            *sequences.columns, (F.length("target") / ID_BYTES + 1).cast("int").alias("depth")
        )


class Sweep:
    """Nodes of one container, from its sequences in order. A node is [conv_id,
    depth, parent's conv_id, n_convs, n_children, n_leaves, saved_tokens, ends]."""

    def __init__(self, container: bytes):
        self.container, self.last = container, container
        self.depth = len(container) // ID_BYTES
        self.nodes = [[None, self.depth, None, 0, 0, 0, 0, NO_ENDS]]
        self.parents, self.words, self.path = [-1], [words_in(container, self.depth)], [0]

    def add(self, seq: bytes, n_convs: int, conv_id: int, ends: str) -> None:
        n, common = len(seq) // ID_BYTES, common_turns(seq, self.last)
        del self.path[common - self.depth + 1 :]
        for k in range(common + 1, n + 1):
            self.parents.append(self.path[-1])
            self.path.append(len(self.nodes))
            self.nodes.append([None, k, None, 0, 0, 0, 0, NO_ENDS])
            self.words.append(words_in(seq, k))
        end = self.nodes[self.path[-1]]
        end[0], end[3], end[7] = conv_id, n_convs, ends
        self.last = seq

    def close(self) -> list[list]:
        """All nodes, the container's own first."""
        nodes = self.nodes
        for i in range(len(nodes) - 1, -1, -1):  # every node stands after its parent
            node = nodes[i]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * self.words[i]
            if i:
                parent = nodes[self.parents[i]]
                parent[0] = node[0] if parent[0] is None else min(parent[0], node[0])
                parent[3] += node[3]
                parent[4] += 1
                parent[5] += node[5]
                parent[6] += node[6]
        for i in range(1, len(nodes)):
            nodes[i][2] = nodes[self.parents[i]][0]
        return nodes


def words_in(seq: bytes, depth: int) -> int:
    """Words of the last of the first ``depth`` turns."""
    return int.from_bytes(seq[depth * ID_BYTES - 4 : depth * ID_BYTES]) if depth else 0


def _frame(rows: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=[c.split()[0] for c in _NODE.split(", ")])
    return made.astype({"round": "Int32", "parent_conv_id": "Int64"})


def _swept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sequences sorted by container and sequence into nodes; a top node keeps the
    name and the round of its container."""
    current, number, out = None, None, []

    def close():
        nodes = current.close()
        out.append((current.container, number, *nodes[0]))
        out.extend((None, None, *node) for node in nodes[1:])

    for batch in batches:
        for container, at, *row in zip(
            batch["container"], batch["round"], batch["seq"], batch["n_convs"], batch["conv_id"], batch["ends_sha256"]
        ):
            container = bytes(container)
            if current is None or container != current.container:
                if current is not None:
                    close()
                current, number = Sweep(container), at
                if len(out) >= 100_000:
                    yield _frame(out)
                    out = []
            current.add(bytes(row[0]), *row[1:])
    if current is not None:
        close()
        yield _frame(out)


def _chains(number: int):
    """Heads at which containers burst into all nodes from the container on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                container, target, saved = bytes(row.container), bytes(row.target), row.below
                top, end = len(container) // ID_BYTES, len(target) // ID_BYTES
                for depth in range(end, top - 1, -1):
                    saved += (row.n_convs - 1) * words_in(target, depth)
                    children, ends = (row.n_children, row.ends_sha256) if depth == end else (1, NO_ENDS)
                    name = (container, number, row.conv_id, depth, None) if depth == top else (
                        None, None, row.conv_id, depth, row.conv_id
                    )
                    out.append((*name, row.n_convs, children, row.n_leaves, saved, ends))
            yield _frame(out)

    return run


def _parent():
    """Prefix of a container's parent; null for the root."""
    return F.expr(f"CASE WHEN length(container) > 0 THEN substring(container, 1, length(container) - {ID_BYTES}) END")


def _heads(bursting: DataFrame, below: DataFrame, number: int) -> DataFrame:
    """Nodes of the heads of one round, from the sequences that end at them and the
    tops of the next round."""
    none = F.lit(0).cast("long")
    ends = bursting.where("seq = target").select(
        "target", "conv_id", "n_convs", none.alias("children"), none.alias("n_leaves"), none.alias("saved_tokens"),
        "ends_sha256",
    )
    children = below.where(F.col("round") == number + 1).select(
        _parent().alias("target"), "conv_id", "n_convs", F.lit(1).cast("long").alias("children"), "n_leaves",
        "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"),
    )
    figures = ends.unionByName(children).groupBy("target").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"),
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    names = bursting.select("container", "target").distinct()
    return names.join(figures, "target").mapInPandas(_chains(number), _NODE)


def _with_parents(tops: DataFrame, heads: list[DataFrame]) -> DataFrame:
    """Tops with the smallest conversation of their parent. The root may be the
    parent of nearly all, so heads are repeated for each salt."""
    above = None
    for own in heads:
        above = own if above is None else above.unionByName(own)
    above = above.select(
        F.col("target").alias("above"), F.col("conv_id").alias("least"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    salt = F.pmod(F.xxhash64("container"), F.lit(SALTS)).cast("int")
    joined = tops.withColumns({"above": _parent(), "salt": salt}).join(above, ["above", "salt"], "left")
    return joined.withColumn("parent_conv_id", F.col("least")).select(*tops.columns)


def prefix_trie(sequences: DataFrame, limit: int = CONTAINER_SEQUENCES) -> DataFrame:
    """One row for each distinct beginning of a conversation (conv_id, ids), the
    empty one included: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. No conversations: no rows."""
    unique = stored(distinct_sequences(sequences), "trie-sequences")
    placed, rounds = burst(unique, limit)
    nodes = stored(
        placed.repartition("container").sortWithinPartitions("container", "seq").mapInPandas(_swept, _NODE),
        "trie-nodes",
    )
    targets = []
    for number in range(len(rounds) - 1, -1, -1):
        bursting = rounds[number]
        heads = stored(_heads(bursting, nodes.where("round IS NOT NULL"), number), "trie-heads")
        targets.append(bursting.groupBy("target").agg(F.min("conv_id").alias("conv_id")))
        nodes = nodes.unionByName(heads)
    if targets:
        inner, tops = nodes.where("container IS NULL"), nodes.where("container IS NOT NULL")
        nodes = inner.unionByName(_with_parents(tops, targets))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of null conv_id belong to no conversation and are left out; turns that
    repeat a number are ordered by their id, repeated rows are turns of their own."""
    return prefix_trie(sharing_heads(stored(whole_sequences(table(spark, sf_dir, "conversations")), "turn-ids")))


QUERIES = {"op11_burst_trie": op11_burst_trie}

ORACLE = {
    "op11_burst_trie": r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), leads AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM ids, crc_table
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), parts AS (
  SELECT l.conv_id, 0 AS part, t.place, role, text FROM leads l JOIN turns t ON t.conv_id = l.base AND t.place <= h
  UNION ALL
  SELECT l.conv_id, 1, t.place, role, text FROM leads l JOIN turns t ON t.conv_id = l.conv_id AND t.place > h
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, role, text FROM parts
), path AS (
  SELECT conv_id, depth, text, md5(string_agg(md5(length(role) || ':' || role || ':' || text), '')
           OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 'root' FROM ids
), ends AS (
  SELECT conv_id, arg_max(node, depth) AS node FROM path GROUP BY conv_id
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * len(regexp_extract_all(min(text), '[^\x20\x09-\x0D]+')) AS saved
  FROM path GROUP BY node, depth
), links AS (
  SELECT n.node, n.depth, n.conv_id, n.n_convs, n.saved, p.node AS parent, q.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN path p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN nodes q ON q.node = p.node
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM links WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT p.node, count(*) FILTER (l.node NOT IN (SELECT node FROM children)) AS n_leaves, sum(l.saved)::BIGINT AS saved_tokens
  FROM links l JOIN path p ON p.conv_id = l.conv_id AND p.depth <= l.depth GROUP BY p.node
), hashes AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM ends GROUP BY node
)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens,
       coalesce(h.ends_sha256, sha256('')) AS ends_sha256
FROM links l JOIN below b USING (node) LEFT JOIN children c USING (node) LEFT JOIN hashes h USING (node)
"""
}
