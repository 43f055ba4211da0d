"""Maximal conversations against a direct version."""

from collections import defaultdict

import numpy as np
import pytest

from millpulse.llm import chat_collapse as cc


def direct(rows):
    """rows: (conv_id, turn, role, text)."""

    def first(v):
        return (v is not None, v if v is not None else "")

    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn, role, text))
    for own in turns.values():
        own.sort(key=lambda t: ((t[0] is not None, t[0] or 0), first(t[1]), first(t[2])))
    plain = {c: tuple((r, t) for _, r, t in own) for c, own in turns.items()}
    proper = {p[:k] for p in plain.values() for k in range(1, len(p))}
    kept = {}
    for c in sorted(plain):
        if plain[c] not in proper:
            kept.setdefault(plain[c], c)
    return sorted(
        (c, k, len(p), f"<|im_start|>{'user' if r is None else r}\n{t or ''}<|im_end|>\n")
        for p, c in kept.items() for k, (r, t) in enumerate(p, 1)
    )


def check(spark, rows):
    frame = spark.createDataFrame(
        [(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, block int"
    ).repartition(3)
    got = sorted((r.conv_id, r.position, r.n_turns, r.rendered) for r in cc.collapse(frame).collect())
    assert got == direct(rows)
    return got


@pytest.mark.parametrize("block", [256, 2])
def test_random_logs(spark, monkeypatch, block):
    monkeypatch.setattr(cc, "BLOCK_TURNS", block)
    rng = np.random.default_rng(0)
    rows = []
    for c in range(120):
        if c and rng.random() < 0.6:  # a snapshot, shorter or longer, of an earlier one
            source = int(rng.integers(0, c))
            own = [(r[2], r[3]) for r in rows if r[0] == source]
            own = own[: int(rng.integers(1, len(own) + 1))]
            own += [("user", f"t{rng.integers(0, 3)}") for _ in range(int(rng.integers(0, 3)))]
        else:
            own = [("user", f"t{rng.integers(0, 3)}") for _ in range(int(rng.integers(1, 7)))]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(own)]
    assert len({r[0] for r in check(spark, rows)}) < 120


def test_edges(spark):
    rows = [
        (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, None), (3, 0, "user", "a"), (3, 1, "user", ""),
        (4, None, "user", "a"), (4, 5, None, None), (None, 0, "user", "x"), (5, 0, None, "user"), (6, 0, "user", None),
        (7, 0, "user", "b"), (7, 0, "user", "b"), (8, 0, "user", "b"), (9, 3, "b", "z"), (9, 3, "a", "y"),
        (10, -300, "user", "long " * 50_000), (10, 900, "user", "end"), (11, 2, "user", "long " * 50_000),
    ]
    kept = {r[0] for r in check(spark, rows)}
    assert kept == {2, 3, 5, 6, 7, 9, 10}


def test_many_copies_and_one_long_conversation(spark):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(999, k, "user", "hello") for k in range(700)]
    assert {r[0] for r in check(spark, rows)} == {999}


def test_empty_and_sql(spark):
    from tests.oracle_check import compare

    assert check(spark, []) == []
    for name, query in cc.QUERIES.items():
        assert compare(spark, query, cc.ORACLE[name], "/root/testdata/sf0.001") is None
