"""Base spans against plain regular expressions, EM and the whole query."""

import hashlib
import re

import numpy as np
import pytest

from millpulse.llm import pii_labels as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def direct(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


TEXTS = [
    None, "", "a@b.c_d@e.f", "x@y a@b-.c.d, @q.r é.a@b.com.", "a@@b.c", "a@b.c@d.e", "1.2.3.4.5.6.7.8 01.002.3.0004 999.1.1.1",
    "0000000000255.1.1.1 256.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 41111111111111111111",
    "+1 (499) 555-6503 +1+22 33 44 55 66 +12", "+1 2", "call +4 9 (0) 30.123-456-7 now", "token = \"1eb9c654e721b4f812088970e66a6345cee33dd6\"",
    "é" * 50 + " mail a.b@c.de " + "ü" * 10, "1" * 4000 + ".1.1.1", "a" * 3000 + "@" + "b" * 3000, "..@x.y", "%+-@1.2",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.scan(text)[0] == direct(text)


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(0)
    alphabet = list("aB1234567890.@+-() %_é,")
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 60))))
        assert pii.scan(text)[0] == direct(text)


def test_candidates_touch_no_base_span():
    rng = np.random.default_rng(1)
    for _ in range(500):
        spans = [("x", int(s), int(s + n)) for s, n in zip(rng.integers(0, 100, 12), rng.integers(1, 15, 12))]
        base, rest = spans[:6], spans[6:]
        free = pii._free(base, rest)
        assert all(e <= s2 or e2 <= s for _, s, e in free for _, s2, e2 in base)
        assert all(a[2] <= b[1] for a, b in zip(free, free[1:]))


def test_em_finds_reliable_labelers():
    rng = np.random.default_rng(2)
    truth = rng.random(5000) < 0.3
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.55])
    votes = np.where(rng.random((5000, 6)) < right, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[rng.random((5000, 6)) < 0.2] = 0
    counts = {}
    for v in map(tuple, votes.tolist()):
        counts[v] = counts.get(v, 0) + 1
    belief = pii.estimate(counts)
    guess = np.array([belief[tuple(v)] > 0.5 for v in votes.tolist()])
    assert (guess == truth).mean() > 0.95
    assert pii.estimate({}) == {}


def test_query_rows(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "c"), (None, "x@y.zz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.find_personal_data(docs).collect()
    want = []
    for doc_id, text, _ in rows:
        base = direct(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        want.append((doc_id, *(sum(b[0] == k for b in base) for k in PLAIN), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(
        ((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=repr
    ) == sorted(want, key=repr)
    for r in got:
        assert set(filter(None, r.base_text.split(","))) <= set(r.spans.split(","))
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_adds_secrets_and_little_else(spark):
    out = pii.op7_pii_labels(spark, "/root/testdata/sf0.01").collect()
    added = [s for r in out for s in r.spans.split(",") if s.startswith("secret")]
    base = sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in out)
    spans = sum(len(r.spans.split(",")) for r in out if r.spans)
    assert added and spans == base + len(added)
