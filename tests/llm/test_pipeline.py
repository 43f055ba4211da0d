"""The pipeline against direct versions of its stages, on whole small tables."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millpulse.llm import lexical_packing, quality_rules
from tests.llm import test_jaccard_dedup, test_line_dedup, test_quality_rules

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, FOLDER)
        docs = corpus_pipeline.stored(frame, f"test-{name}")
        out.append(docs.collect())
        if name != "packing":
            assert docs.columns == COLUMNS
    return out


def test_quality(spark, stages):
    before, after = stages[0], stages[1]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality_rules.fit_field(quality_rules.training_texts(docs, labels))
    want = set()
    for r in before:
        rows, sizes = quality_rules.line_features(r.text)
        path = model.decode(np.array(rows) @ model.weights) if rows else []
        *base, failed = test_quality_rules.direct(r.text)
        share = sum(s for s, label in zip(sizes, path) if label) / max(1, base[0])
        if not failed and share >= quality_rules.CONTENT_SHARE:
            want.add(r.doc_id)
    assert {r.doc_id for r in after} == want and 0 < len(want) < len(before)


def test_lines(stages):
    before, after = stages[1], stages[2]
    want = {d: text for d, _, _, text, _ in test_line_dedup.direct([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)
    assert want != {r.doc_id: r.text for r in before}


def test_near_copies(stages):
    before, after = stages[2], stages[3]
    assert {r.doc_id for r in after} == test_jaccard_dedup.slow_kept([(r.doc_id, r.text) for r in before])


def test_mix_keeps_good_documents(spark, stages):
    before, after = stages[3], stages[4]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    good = [r.doc_id for r in before if r.doc_id in labels and labels[r.doc_id].quality and not labels[r.doc_id].toxic]
    toxic = [r.doc_id for r in before if r.doc_id in labels and labels[r.doc_id].toxic]
    assert np.mean([d in kept for d in good]) > 0.95
    assert not toxic or np.mean([d in kept for d in toxic]) < 0.5


def test_packing(spark, stages):
    before, after = stages[4], stages[5]
    ids = {r.doc_id: ids for r, ids in zip(
        before, lexical_packing.WordEncoder(lexical_packing.tokenizer_path()).encode([r.text for r in before])
    )}
    seen = {}
    for r in after:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {d: len(i) for d, i in ids.items()}


def test_run_and_registration(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[-1]))
    assert len(corpus_pipeline.STAGES) == 5
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
