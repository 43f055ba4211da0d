"""Chunks, gradients and held-out accuracy."""

import zlib

import numpy as np
import pytest

from millpulse.llm import byte_cnn as bc


@pytest.mark.parametrize("n", [0, 1, 5, 6, 7, 8, 100, 1023, 1024, 1025, 1026, 5000])
def test_chunks_cover_every_position_once(n):
    data = bytes(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8))
    chunks = bc.chunks_of(data)
    padded = data + b" " * max(0, bc.WIDTH - n)
    padded += b" " * ((len(padded) - bc.WIDTH) % bc.STRIDE)
    net = bc.ByteNet.start()
    tables = net.tables()
    whole = net.activations(np.frombuffer(padded, dtype=np.uint8), tables)
    parts = np.concatenate([net.activations(c, tables) for c in chunks])
    assert np.allclose(whole, parts)
    assert all(len(c) <= bc.CHUNK for c in chunks)


def test_tables_are_the_convolution():
    net = bc.ByteNet.start(3)
    x = np.frombuffer(b"some bytes of a text", dtype=np.uint8)
    act = net.activations(x, net.tables())
    for p in range(len(act)):
        window = net.embedding[x[p * bc.STRIDE : p * bc.STRIDE + bc.WIDTH]]
        assert np.allclose(act[p], np.einsum("we,wef->f", window, net.filters), atol=1e-5)


def test_training_learns():
    rng = np.random.default_rng(0)
    docs = []
    for k in range(120):
        words = ["".join(rng.choice(list("abcdefg"), 5)) for _ in range(80)]
        docs.append((" ".join(w + ("###" if k % 2 and i % 3 == 0 else "") for i, w in enumerate(words)), 1 - k % 2))
    net = bc.train(docs[:80])
    tables = net.tables()
    assert np.mean([(net.score(t, tables) >= 0.5) == bool(y) for t, y in docs[80:]]) > 0.95


def test_whole_text_counts():
    """A mark at the far end of a long text changes its score."""
    rng = np.random.default_rng(0)
    net = bc.ByteNet.start(1)
    net.output[:] = rng.normal(size=2 * bc.FILTERS)
    tables = net.tables()
    text = "abc " * 30_000
    assert net.score(text, tables) != net.score(text + "\x7f\x7f#$%&*\x7f", tables)


def test_held_out_accuracy_and_edges(spark):
    folder = "/root/testdata/sf0.01"
    out = bc.op9_byte_cnn(spark, folder)
    rows = {r.doc_id: r for r in out.collect()}
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.9


def test_learns_nothing_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    for text, _ in bc.training_rows(docs, labels):
        assert zlib.crc32(text.split()[1].encode()) % 5


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x", "c"), (2, "", "b")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = bc.score_quality(docs, none).collect()
    assert len(rows) == 4 and all(r.score == pytest.approx(0.5) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert bc.score_quality(docs.limit(0), none).count() == 0
