"""Tokens, the index and the packing as a whole."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millpulse.llm import lexical_packing as lp


def whole_ids(text):
    tokenizer = Tokenizer.from_file(lp.tokenizer_path())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [lp.END_ID]


TEXTS = [
    None, "", " \n", "Hello, World's end", "don't  can't\x1c\x85a b ́x", "É é Σας ΣΑΣ İ 12a3",
    "<|endoftext|> a<|startoftext|>b", "a\x00b ﻿c", "token = \"ab12\" +1 (499) 555",
]


def test_words_encode_like_whole_texts():
    encoder = lp.WordEncoder(lp.tokenizer_path(), cached=5)
    for text, ids in zip(TEXTS, encoder.encode(TEXTS)):
        assert ids.tolist() == whole_ids(text), text


def test_real_texts_encode_like_whole_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    encoder = lp.WordEncoder(lp.tokenizer_path())
    texts = [r.text for r in rows]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == whole_ids(text)


def check(docs, rows, window=lp.WINDOW):
    """Every id once, sequences gapless, at most a window long and unpadded."""
    want = sorted((d, tuple(whole_ids(t))) for d, t in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert len(ids) == r.length > 0
        by_doc[(r.doc_id, r.doc_tokens)].append((r.start, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    got = []
    for (doc_id, n), pieces in by_doc.items():
        at, ids = 0, []
        for start, part in sorted(pieces, key=lambda p: p[0]):
            assert start == at
            at += len(part)
            ids.extend(part.tolist())
        assert at == n
        got.append((doc_id, tuple(ids)))
    assert sorted(got) == want
    return by_sequence


def test_packing_is_a_partition(spark):
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, int(rng.integers(0, 900))) % 5000)) for i in range(120)]
    docs += [(1000, None), (1001, ""), (1002, "long text " * 20_000), (1003, docs[3][1]), (1004, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = lp.pack(frame, shard_docs=32).collect()
    sequences = check(docs, rows)
    full = sum(sum(n for _, n in s) == lp.WINDOW for s in sequences.values())
    assert full / len(sequences) > 0.5
    digests = lp.digest_columns(lp.pack(frame, shard_docs=32)).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in digests) == sorted(
        (r.doc_id, r.start, zlib.crc32(bytes(r.ids))) for r in rows
    )


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "no id")], "doc_id long, text string")
    rows = lp.pack(docs).collect()
    assert sum(r.length for r in rows) == 2 * len(whole_ids("same text here")) + len(whole_ids("no id"))
    assert lp.pack(docs.limit(0)).count() == 0


def test_index_scores_are_bm25():
    rng = np.random.default_rng(3)
    tails = [rng.integers(0, 60, int(rng.integers(3, 40))) for _ in range(50)]
    df = np.bincount(np.concatenate([np.unique(t) for t in tails]), minlength=60)
    idf = np.log1p((50 - df + 0.5) / (df + 0.5))
    mean = float(np.mean([len(t) for t in tails]))
    shard = lp.Shard(tails, idf, mean)
    for seed in range(5):
        terms = np.unique(tails[seed])
        weight = {
            t: idf[t] * (tf := int((tails[seed] == t).sum())) * (lp.K1 + 1)
            / (tf + lp.K1 * (1 - lp.B + lp.B * len(tails[seed]) / mean)) for t in terms
        }
        terms = sorted(weight, key=lambda t: -weight[t])[: lp.QUERY_TERMS]
        score = np.array(
            [
                sum(
                    idf[t] * tf * (lp.K1 + 1) / (tf + lp.K1 * (1 - lp.B + lp.B * len(d) / mean))
                    for t in terms if (tf := int((d == t).sum()))
                )
                for d in tails
            ]
        )
        unused = np.ones(50, dtype=bool)
        unused[seed] = False
        got = shard.neighbours(seed, unused)
        assert len(got) == 49
        assert np.all(np.diff(score[got]) <= 1e-9)
        assert shard.neighbours(seed, unused, 7).tolist() == got[:7].tolist()


def test_neighbours_share_words(spark):
    """Documents of two vocabularies fill windows of their own."""
    rng = np.random.default_rng(5)
    docs = [
        (i, " ".join(f"{'alpha' if i % 2 else 'omega'}{x}" for x in rng.integers(0, 50, 60))) for i in range(80)
    ]
    rows = lp.pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    kinds = defaultdict(set)
    for r in rows:
        kinds[r.sequence_id].add(r.doc_id % 2)
    assert np.mean([len(k) == 1 for k in kinds.values()]) >= 0.6


@pytest.mark.parametrize("sizes", [[5], [2047, 1], [2048], [3000, 10], [700] * 9])
def test_last_rest_needs_no_padding(sizes):
    tails = [(i, 0, n, np.full(n, i + 2)) for i, n in enumerate(sizes) if n < 2048]
    if tails:
        full, rest = lp.pack_shard(tails, np.ones(100), 100.0, 2048, True)
        assert not rest and sum(len(p[3]) for s in full for p in s) == sum(len(t[3]) for t in tails)
        assert all((n := sum(len(p[3]) for p in s)) & (n - 1) == 0 for s in full)


def test_term_counts():
    rng = np.random.default_rng(2)
    for kind in ("<u2", "<u4"):
        for n in (1, 2, 7, 2047):
            ids = rng.integers(0, 50, n).astype(kind)
            terms, counts = lp.term_counts(ids)
            want, times = np.unique(ids, return_counts=True)
            assert terms.tolist() == want.tolist() and counts.tolist() == times.tolist()


def test_pipeline_keeps_fewer_words_in_a_process(spark, monkeypatch):
    import corpus_pipeline

    asked, whole = [], lp.pack
    monkeypatch.setattr(lp, "pack", lambda docs, **more: asked.append(more) or whole(docs, **more))
    docs = [(k, f"some words {k}, again") for k in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert corpus_pipeline.pack_windows(spark, frame, "").count() >= 20
    assert asked == [{"cached": corpus_pipeline.CACHED_WORDS}] and corpus_pipeline.CACHED_WORDS < lp.CACHED_WORDS
    check(docs, whole(frame, cached=4).collect())
    small = lp.shared_encoder(lp.tokenizer_path(), 4)
    assert small is lp.shared_encoder(lp.tokenizer_path(), 4) and small is not lp.shared_encoder(lp.tokenizer_path())
    list(small.encode([t for _, t in docs]))
    assert len(small.known) + len(small.known.old) <= 4
