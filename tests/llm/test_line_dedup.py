"""Line deduplication against a direct version."""

import hashlib
from collections import defaultdict

import pytest

from millpulse.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"


def direct(docs, least=10):
    """docs: (doc_id, text). Rows of null id stay as they are."""

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc_id is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc_id
        ]
        rest = "\n".join(kept)
        out.append((doc_id, len(lines), len(lines) - len(kept), rest, hashlib.sha256(rest.encode()).hexdigest()))
    return out


CASES = [
    (1, "A repeated line here\nonly here in one\nshort\nA repeated line here"),
    (2, "  a REPEATED line here\t\nshort\nother words in two"),
    (3, "été à la plage\n\n"),
    (4, "ÉTÉ à la plage\x0b\nété à la plage  "),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, "ééééééééé\nnine chars"),
    (9, "ééééééééé\nNINE CHARS"),
    (None, "A repeated line here\nnine chars"),
    (10, "x" * 300_000 + "\n" + "y y\n" * 5000),
    (11, "X" * 300_000 + "\nA repeated line here"),
    (12, "only here in one\nonly here in one"),
    (12, "only here in one\nonly here in one"),
]


@pytest.mark.parametrize("bits", [1 << 20, 1 << 24])
def test_equals_direct_version(spark, bits):
    docs = spark.createDataFrame(CASES, "doc_id long, text string").repartition(3)
    out, name = line_dedup.dedup_lines(docs, filter_bits=bits)
    rows = out.select("doc_id", f"{name}.*").select("doc_id", "n_lines", "n_dropped", "text", "kept_sha256").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(direct(CASES), key=repr)


def test_full_filter_loses_nothing(spark):
    """So many lines on so few bits that all are suspects: same result."""
    cases = [(i, "\n".join(f"line number {i + j} of text" for j in range(0, 40, 1 + i % 3))) for i in range(50)]
    docs = spark.createDataFrame(cases, "doc_id long, text string").repartition(4)
    out, name = line_dedup.dedup_lines(docs, filter_bits=64)
    rows = out.select("doc_id", f"{name}.*").select("doc_id", "n_lines", "n_dropped", "text", "kept_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(direct(cases))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(empty)[0].count() == 0
    docs = spark.createDataFrame(
        [(1, "the very same line", 7, "a"), (2, "the very same line", 8, None)],
        "doc_id long, text string, lost long, Line_Dedup string",
    )
    out, name = line_dedup.dedup_lines(docs)
    assert name == "_line_dedup"
    rows = out.select("doc_id", "lost", "Line_Dedup", f"{name}.n_dropped").collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, 7, "a", 0), (2, 8, None, 1)]


def test_query_equals_sql(spark):
    from tests.oracle_check import compare

    for name, query in line_dedup.QUERIES.items():
        assert compare(spark, query, line_dedup.ORACLE[name], "/root/testdata/sf0.001") is None
