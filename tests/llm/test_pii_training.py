"""The span classifier is fitted on all kinds, however often a span is repeated."""

import numpy as np

from millpulse.llm import pii_labels as pii


def test_equal_spans_do_not_fill_the_sample(spark):
    copies = 21_000
    texts = [f"mail{'x' * k}@host.com " * copies for k in range(4)]
    texts += [f"call +1 (499) 555-{k:04d} now" for k in range(40)]
    texts += [f'token = "{k:02d}b9c654e721b4f812088970e66a6345cee33d{k:02d}"' for k in range(40)]
    numbers = [f"order {10 ** 12 + 7919 * k} sent" for k in range(300)]
    rows = list(enumerate(texts + numbers))
    out = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[k].count("email") == copies for k in range(4))
    assert all(out[k].startswith("secret") for k in range(44, 84))
    assert not any(out[k] for k in range(84, 384))


def test_fit_uses_all_vectors_with_their_counts(spark):
    rng = np.random.default_rng(5)
    kinds = [("email", (1, 1, 0, 0, 1, 1), 0.98), ("secret", (0, 1, 0, 1, 1, 1), 0.7), ("phone", (0, 0, 0, -1, 1, -1), 0.02)]
    rows = [
        (list(vote), pii.features("1" * int(rng.integers(1, 30)) + "a" * int(rng.integers(1, 60)), kind, vote), int(n), y)
        for kind, vote, y in kinds for n in (*rng.integers(1, 50, 30), 10 ** 6)
    ]
    vectors = spark.createDataFrame([r[:3] for r in rows], "votes array<int>, features array<double>, n long")
    at, size = pii._measured(vectors, {vote: y for _, vote, y in kinds})
    w = pii.fit_classifier(at, size)
    x, n, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (n * (y - p)) - w).max() < 1e-6 * n.sum()  # the gradient over all spans
    assert np.abs(p - y).max() < 0.05
