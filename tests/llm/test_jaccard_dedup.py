"""Near copies against brute-force Jaccard similarity."""

import itertools

import numpy as np

import corpus_pipeline
from millpulse.llm import jaccard_dedup, line_dedup


def brute(text):
    words = (text or "").lower().split()
    if len(words) <= 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def slow_kept(rows):
    """Smallest ids of the components of all pairs of Jaccard 0.8 or more."""
    sets = [(d, brute(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (d, a), (e, b) in itertools.combinations(sets, 2):
        if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
            x, y = sorted((find(d), find(e)))
            root[y] = x
    return {d for d in root if find(d) == d}


def edited(rng, words, n):
    out = list(words)
    for k in rng.choice(len(out), n, replace=False):
        out[k] = f"new{rng.integers(1 << 30)}"
    return out


def corpus():
    rng = np.random.default_rng(3)
    texts = ["", None, " ", "one two", "One  two", "one two three"]
    for _ in range(12):
        words = [f"w{k}" for k in rng.integers(0, 5000, 200)]
        texts.append(" ".join(words))
        texts += [" ".join(edited(rng, words, n)) for n in (1, 2, 3, 4, 5, 6, 8)]
    chain = [f"c{k}" for k in range(300)]
    for _ in range(6):  # each like the last, the ends unlike
        chain = edited(rng, chain, 5)
        texts.append(" ".join(chain))
    return [(int(k), t) for k, t in zip(rng.permutation(len(texts)), texts)] + [(None, texts[7]), (0, texts[8])]


def test_stage_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert {r.doc_id for r in got} - {None} == slow_kept(rows)
    assert sum(r.doc_id is None for r in got) == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_stage_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out, result = line_dedup.dedup_lines(docs)
    before = corpus_pipeline.stored(out.select("doc_id", f"{result}.text"), "test-lines")
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, before, "").collect()}
    assert got == slow_kept([tuple(r) for r in before.collect()])


def test_group_of_copies_is_not_paired(spark):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(edited(rng, words, 2))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in jaccard_dedup.one_of_each(docs).collect()] == [0]


def test_prefix_pairs_hold_every_similar_pair(spark):
    """Against brute force, with common passages, several components and few pairs."""
    rng = np.random.default_rng(8)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for k in range(60):
        own = [f"o{k}w{j}" for j in range(120)]
        texts.append(passage + own)
        if k % 3 == 0:
            texts.append(edited(rng, passage + own, int(rng.integers(1, 6))))
    texts += [edited(rng, passage, 1) for _ in range(20)]
    sets = [jaccard_dedup.shingles(" ".join(t)) for t in texts]
    rows = [(bytes([k]), k % 7, bytes(own.tobytes())) for k, own in enumerate(sets)]
    frame = spark.createDataFrame(rows, "digest binary, component long, own binary").repartition(3)
    got = {(r.a[0], r.b[0]) for r in jaccard_dedup.prefix_pairs(frame, 80).collect()}
    want = {
        (i, j) for i, j in itertools.combinations(range(len(sets)), 2)
        if i % 7 != j % 7 and jaccard_dedup.similar(sets[i], sets[j])
    }
    assert want and want <= got and len(got) < 400


def test_common_passage_forms_no_pairs(spark, monkeypatch):
    """Texts that share a third and little else, with no hub rounds before."""
    compared = []
    whole = jaccard_dedup.prefix_pairs
    monkeypatch.setattr(jaccard_dedup, "HUB_ROUNDS", 0)
    monkeypatch.setattr(jaccard_dedup, "prefix_pairs", lambda *a: compared.append(whole(*a)) or compared[-1])
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"o{k}w{j}" for j in range(100))) for k in range(300)]
    rows.append((300, rows[7][1] + " more"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in jaccard_dedup.one_of_each(docs).collect()} == set(range(300))
    assert compared[0].count() == 1


def test_crowd_below_the_similarity_forms_few_pairs(spark, monkeypatch):
    """Copies of one text with so many edits that only a few are similar: pairs grow
    with the members, not with their square, and none that counts is lost."""
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(200)]
    compared = []
    whole = jaccard_dedup.prefix_pairs
    monkeypatch.setattr(jaccard_dedup, "prefix_pairs", lambda *a: compared.append(whole(*a)) or compared[-1])
    texts = [" ".join(edited(rng, words, int(n))) for n in rng.integers(3, 40, 600)]
    for n in (200, 600):
        docs = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id long, text string")
        got = {r.doc_id for r in jaccard_dedup.one_of_each(docs).collect()}
        assert got == slow_kept(list(enumerate(texts[:n])))
        assert compared[-1].count() <= n


def test_fingerprints_alone_propose_near_copies(spark):
    """Without MinHash keys: nearly all that brute force finds, nothing else."""
    rng = np.random.default_rng(11)
    texts = []
    for _ in range(40):
        words = [f"w{k}" for k in rng.integers(0, 5000, 200)]
        texts += [" ".join(words)] + [" ".join(edited(rng, words, n)) for n in (1, 2, 3, 4)]
    sets = [jaccard_dedup.shingles(t) for t in texts]
    rows = [
        (bytes(jaccard_dedup.set_digest(s)), k, jaccard_dedup.fingerprints(s, jaccard_dedup.PRINTS), [])
        for k, s in enumerate(sets)
    ]
    unique = spark.createDataFrame(rows, "digest binary, rep long, prints array<long>, bands array<long>")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links = {(r.child, r.parent) for r in jaccard_dedup.near_links(docs, unique, 5, 80).collect()}
    assert all(jaccard_dedup.similar(sets[a], sets[b]) for a, b in links)
    root = list(range(len(texts)))
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    kept, want = set(root), slow_kept(list(enumerate(texts)))
    assert want <= kept and len(kept - want) <= 0.02 * (len(texts) - len(want))


def test_processes_get_few_sets_at_once(spark, monkeypatch):
    """While the stage runs, and as before afterwards."""
    key, seen, whole = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard_dedup.stored
    monkeypatch.setattr(jaccard_dedup, "stored", lambda *a: seen.append(spark.conf.get(key)) or whole(*a))
    before = spark.conf.get(key)
    jaccard_dedup.one_of_each(spark.createDataFrame(corpus()[:12], "doc_id long, text string")).count()
    assert set(seen) == {str(jaccard_dedup.ARROW_ROWS)} and spark.conf.get(key) == before
