"""Repeated runs of words against a direct version."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from millpulse.llm import block_anchors as ba

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    part = [k for k, (i, _) in enumerate(rows) if i is not None]
    seen = Counter(tuple(words[k][s : s + window]) for k in part for s in range(len(words[k]) - window + 1))
    out = []
    for k, (doc_id, _) in enumerate(rows):
        gone = set()
        if doc_id is not None:
            for s in range(len(words[k]) - window + 1):
                if seen[tuple(words[k][s : s + window])] > 1:
                    gone.update(range(s, s + window))
        kept = " ".join(w for p, w in enumerate(words[k]) if p not in gone)
        out.append((doc_id, len(words[k]), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, window, bits=1 << 22):
    frame = spark.createDataFrame(
        [(i, t, "x", 7) for i, t in rows], "doc_id long, text string, substring_dedup string, single long"
    ).repartition(3)
    out, name = ba.drop_repeats(frame, window=window, index_bits=bits)
    assert out.columns[:4] == frame.columns and name not in frame.columns
    got = out.select("doc_id", f"{name}.n_words", f"{name}.n_removed", f"{name}.kept_sha256").collect()
    got = sorted((tuple(r) for r in got), key=repr)
    assert got == direct(rows, window)
    return got


@pytest.mark.parametrize(("window", "bits"), [(35, 1 << 22), (7, 1 << 22), (6, 1 << 22), (5, 1 << 10)])
def test_random_copies_at_random_places(spark, window, bits):
    """Passages of about a window's length stand at any offset; a tiny index lets
    nearly all windows through and changes nothing."""
    rng = np.random.default_rng(window)
    passages = [" ".join(f"p{rng.integers(40)}" for _ in range(window + d)) for d in (-1, 0, 1, 5, window)]
    rows = []
    for k in range(60):
        own = []
        for _ in range(int(rng.integers(0, 4))):
            own += [f"w{rng.integers(30)}" for _ in range(int(rng.integers(0, 2 * window)))]
            own.append(passages[rng.integers(len(passages))])
        rows.append((k, " ".join(own)))
    rows += [(100 + k, " ".join(f"own{k}w{j}" for j in range(3 * window))) for k in range(5)]
    got = check(spark, rows, window, bits)
    assert any(r[2] for r in got) and any(r[1] and not r[2] for r in got)


def test_two_equal_runs_hold_a_block_at_every_offset(spark):
    run = " ".join(f"r{k}" for k in range(35))
    rows = []
    for a in range(18):
        rows.append((a, " ".join([f"a{a}x{k}" for k in range(a)] + [run.replace("r", f"s{a}r")])))
        rows.append((100 + a, " ".join([f"b{a}x{k}" for k in range(2 * a + 1)] + [run.replace("r", f"s{a}r")])))
    assert all(r[2] == 35 for r in check(spark, rows, 35))


def test_edges(spark):
    long = " ".join(f"l{k % 977}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\f\r"), (None, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"),
        (5, "x a b c d e f"), (6, "a b\tc\nd  e f g"), (7, "repeat me now please again"),
        (7, "repeat me now please again"), (8, "same id other words here"), (8, "and yet another text here"),
        (9, "n n n n n n"), (10, long), (11, "q " + long), (12, "four words are short"), (13, "four words are short"),
    ]
    got = {r[0]: r for r in check(spark, rows, 5)}
    assert got[4][2] == 0 and got[7][2] == 5 and got[9][2] == 6 and got[10][2] == 30_000 and got[12][2] == 0


def test_hot_passage_and_empty(spark):
    passage = " ".join(f"h{k}" for k in range(40))
    rows = [(k, f"own{k} one{k} {passage} two{k}") for k in range(400)]
    assert {r[2] for r in check(spark, rows, 35)} == {40}
    assert check(spark, [], 35) == []


def test_sql(spark):
    from tests.oracle_check import compare

    for name, query in ba.QUERIES.items():
        assert compare(spark, query, ba.ORACLE[name], "/root/testdata/sf0.001") is None
