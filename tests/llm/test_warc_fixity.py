"""Audits against a comparison of all records."""

from collections import Counter

import numpy as np
import pytest

from millpulse.llm import warc_fixity as wf

SCHEMA = "file string, offset long, length long, digest string, node int"


def direct(left, right):
    out = []
    a, b = Counter(left), Counter(right)
    for file, offset in {r[:2] for r in left} | {r[:2] for r in right}:
        x, y = (
            sorted((r[2], r[3], n) for r, n in side.items() if r[:2] == (file, offset)) for side in (a, b)
        )
        if x != y:
            damage = "changed" if x and y else "missing" if x else "extra"
            out.append((
                file, offset, damage, ",".join(r[1] for r in x) if x else None, ",".join(r[1] for r in y) if y else None
            ))
    return sorted(out, key=repr)


def audited(spark, left, right):
    sides = (spark.createDataFrame([(*r, 1) for r in side], SCHEMA) for side in (left, right))
    rows = wf.audit(*sides).collect()
    return sorted(((r.file, r.offset, r.damage, r.left_digest, r.right_digest) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_locates_all_damage(spark, seed):
    rng = np.random.default_rng(seed)
    left = []
    for f in range(5):
        at = 0
        for k in range(60):
            size = int(10 ** rng.uniform(2, 7.5))
            left.append((f"file-{f}", at, size, f"d{f}-{k}"))
            at += size
    right = []
    for r in left:
        chance = rng.random()
        if r[0] == "file-0" or chance > 0.06:
            right.append(r)
        elif chance > 0.04:
            right.append((*r[:3], r[3] + "x"))
        elif chance > 0.02:
            right.append((r[0], r[1], r[2] + 1, r[3]))
    right += [("file-9", 5, 6, "new"), ("file-1", 7, 8, "added"), left[3]]
    want = direct(left, right)
    assert want and audited(spark, left, right) == want


def test_edges(spark):
    same = [("a", 0, 5, "x"), ("a", 1 << 45, 5, "y"), ("b", 3, 1, "z"), ("b", 3, 1, "z")]
    assert audited(spark, same, same[::-1]) == []
    assert audited(spark, [], []) == []
    assert audited(spark, same, []) == direct(same, [])
    assert audited(spark, same, same[:3]) == [("b", 3, "changed", "z", "z")]
    got = audited(spark, [(None, None, None, None)], [("", -1, -1, "")])
    assert got == []


def test_offsets_of_pages_follow_each_other(spark):
    rows = [(3, "http://x/é", "<p>ü</p>"), (1, None, None), (2, "u", ""), (2, "u", ""), (None, "v", "w"), (1001, "q", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = wf.page_records(pages, pages["html"]).collect()
    by_file = {}
    for r in sorted(records, key=lambda r: r.offset):
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + r.length
    assert len(records) == 6 and {"warc-0", "warc-1"} < set(by_file)


def test_query_equals_sql(spark):
    from tests.oracle_check import compare

    for name, query in wf.QUERIES.items():
        assert compare(spark, query, wf.ORACLE[name], "/root/testdata/sf0.01") is None
