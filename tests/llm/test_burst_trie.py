"""Nodes of the conversation trie against a direct version."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from millpulse.llm import burst_trie as bt

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            turns[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + seq[h:])
    return out


def direct(sequences):
    members = defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted(
        (
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if sequences[c] == node).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def check(spark, rows, limit=bt.CONTAINER_SEQUENCES, share=True):
    log = spark.createDataFrame(
        [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string"
    ).repartition(3)
    sequences = bt.whole_sequences(log)
    nodes = bt.prefix_trie(bt.sharing_heads(sequences) if share else sequences, limit)
    got = sorted(tuple(r) for r in nodes.collect())
    want = rebuilt(rows)
    if not share:
        want = {c: rebuilt([(0, *r[1:]) for r in rows if r[0] == c])[0] for c in want}
    assert got == direct(want)
    return got


@pytest.mark.parametrize("limit", [256, 20, 1])
def test_random_logs(spark, limit):
    rng = np.random.default_rng(limit)
    rows = [
        (int(c), k, "user" if k % 2 else "assistant", f"t{rng.integers(0, 3)} and words")
        for c in rng.permutation(150) for k in range(int(rng.integers(1, 6)))
    ]
    assert len(check(spark, rows, limit)) > 50
    assert len(check(spark, rows, limit, share=False)) > 20


def test_edges(spark):
    rows = [
        (0, 0, "user", "a b"), (0, 1, None, None), (1, None, "user", "a"), (1, 5, None, ""), (2, 3, "", None),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "b", "z"), (4, 0, "a", "y"), (None, 0, "user", "x"),
        (20, 0, "user", "long " * 50_000), (25, -3, "us", "er"), (26, 0, "use", "rer"), (41, 0, "user", "no base"), (-7, 0, "u", "t"),
        (-20, 0, "u", "minus"), (42, 0, "user", "\x0b \t"), (42, 1, "user", None),
    ]
    for limit in (1000, 1):
        check(spark, rows, limit)


def test_turnless_conversation_ends_at_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    (root,) = check(spark, [(c, 0, "user", "gone")], 1)
    assert root[:6] == (c, 0, None, 1, 0, 1) and root[7] == hashlib.sha256(str(c).encode()).hexdigest()


def test_many_copies_and_one_long_conversation(spark):
    rows = [(20 * c, 0, "user", "hello there") for c in range(2500)]
    rows += [(7, k, "user", "hello there") for k in range(3000)] + [(27, k, "user", "hello there") for k in range(2000)]
    check(spark, rows, 1, share=False)


def test_empty_and_sql(spark):
    from tests.oracle_check import compare

    assert check(spark, []) == []
    for name, query in bt.QUERIES.items():
        assert compare(spark, query, bt.ORACLE[name], "/root/testdata/sf0.001") is None
