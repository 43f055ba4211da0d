"""Base counts, decoding and training of the line field."""

import itertools
import re

import numpy as np
import pytest

from millpulse.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = {}
    for i in range(n - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), symbols, dup, len(covered), failed


TEXTS = [
    None, "", " \n\n ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 30, "é#ü *** a\x1cb\x0bc\n" * 3,
    "a b c d e f g h i j k l m n o p q r s t u v w x y z a b c d e f g h i j",
    " ".join(map(str, range(300))) + "\n\n \n" + "1 2 3 4 5 6 7 8 9", "line\nline\n\n\nline ", "w" * 200_000,
    " ".join(f"{i % 700}" for i in range(30_000)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert qr.base_counts(text) == direct(text)


def test_base_counts_of_random_texts():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(0, 120))
        text = "".join(
            str(w) + rng.choice([" ", "\n", "  ", "\t"]) for w in rng.integers(0, rng.integers(2, 60), n)
        )
        assert qr.base_counts(text) == direct(text)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(100):
        model = qr.LineField(np.zeros(qr.N_FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))
        scores = rng.normal(size=int(rng.integers(1, 8)))

        def value(path):
            total = model.start[path[0]] + path[0] * scores[0]
            for k in range(1, len(path)):
                total += model.moves[path[k - 1], path[k]] + path[k] * scores[k]
            return total

        best = max(itertools.product((0, 1), repeat=len(scores)), key=value)
        assert value(model.decode(scores)) == pytest.approx(value(best))


def test_training_separates_classes():
    good = "The rivers were quiet that night and nobody spoke.\nThen the morning came with rain over the hills."
    bad = "BUY!! NOW!! CHEAP!! ***\n$$$ ### CLICK!! HERE!! |||\nNOW!! NOW!! NOW!!"
    model = qr.fit_field([(f"{good} {i}", 1) for i in range(20)] + [(f"{bad} {i}", 0) for i in range(20)])
    for text, label in ((good, 1), (bad, 0)):
        scores = np.array(qr.line_features(text)[0]) @ model.weights
        assert set(model.decode(scores)) == {label}


def test_mixed_documents_get_both_labels(spark):
    """Fitted on one half of the labelled documents, decoded on splices of the other."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    texts = qr.training_texts(docs, labels)
    model = qr.fit_field(texts[::2])
    right = lines = both = 0
    mixed = qr.spliced(texts[1::2])
    for text, want in mixed:
        got = model.decode(np.array(qr.line_features(text)[0]) @ model.weights)
        right += sum(a == b for a, b in zip(got, want, strict=True))
        lines += len(want)
        both += set(got) == {0, 1}
    print(right / lines, both / len(mixed), model.moves)
    assert len(mixed) > 50 and right / lines > 0.8 and both / len(mixed) > 0.7


def test_judge_keeps_columns_and_handles_edges(spark):
    clean = " ".join(f"word{i}" for i in range(40)) + "."
    rows = [(1, clean, "a"), (2, None, None), (3, "", "c"), (1, clean, "a"), (None, clean, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_verdict string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out, name = qr.judge(docs, none)
    assert name == "_quality_verdict" and out.columns[:3] == docs.columns
    got = sorted(((r.doc_id, r[name].kept, r.quality_verdict) for r in out.collect()), key=repr)
    assert got == sorted([(1, True, "a"), (1, True, "a"), (None, True, "x"), (2, False, None), (3, False, "c")], key=repr)
    assert qr.judge(docs.limit(0), none)[0].count() == 0


def test_query_on_labelled_documents(spark):
    """Of labelled documents that pass the base rules, those of good quality stay."""
    folder = "/root/testdata/sf0.01"
    out = qr.op3_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = out.where("NOT base_failed").select("kept", "quality").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.99
