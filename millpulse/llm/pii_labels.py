"""Personal data by weak supervision.

Base patterns find emails, addresses, cards and phones. Beside them, wider
patterns propose candidates (secrets, disguised emails, long numbers), on which
labelers vote for, against or not at all: patterns, checksums, gazetteers,
contexts, boundaries and shapes. Expectation-maximisation over the counts of all
vote patterns of the corpus estimates how reliable each labeler is; its
posteriors train a logistic span classifier on all candidates: each Newton step
is summed over the distinct feature vectors, weighted by their counts. Candidates
that it accepts are added; base spans always stay.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

ACCEPT = 0.5
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELERS = ("pattern", "checksum", "gazetteer", "context", "boundary", "shape")

# Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov io de fr es uk it nl eu info biz".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 91".split())
SECRET_NAMES = frozenset(
    "token key secret password passwd pwd apikey api_key access_key auth bearer credential private_key".split()
)
NUMBER_NAMES = frozenset("card visa account iban tel phone mobile call fax ip host".split())
NOT_PERSONAL = frozenset("isbn order invoice page version build item sku eq nr no".split())

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+")
_DISGUISED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63}){1,8}"
)
_NAME = re.compile(r"([A-Za-z_]{2,20})[\x20\"':=]{0,6}\Z")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ has at most one match around it: local characters before it, as
    far back as the last match, and a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def scan(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """(base spans, other numbers that look alike), as (kind, start, end)."""
    text = text or ""
    base, rest = [], []
    if "@" in text:
        base.extend(("email", s, e) for s, e in _emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split(".")):
                base.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                base.append(("card", *m.span()))
            elif 9 <= len(digits) <= 19:
                rest.append(("card" if len(digits) >= 13 else "phone", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    base.append(("phone", *m.span()))
        for m in _TOKEN.finditer(text):
            if any(c.isalpha() for c in m[0]) and any(c.isdigit() for c in m[0]):
                rest.append(("secret", *m.span()))
    if "(at)" in text or "[at]" in text:
        rest.extend(("email", *m.span()) for m in _DISGUISED.finditer(text))
    base.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return base, rest


def _free(base: list[tuple], rest: list[tuple]) -> list[tuple]:
    """Candidates that touch no base span and no earlier candidate."""
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    reach = list(itertools.accumulate((e for _, e in taken), max))  # furthest end so far
    out, last = [], 0
    for kind, s, e in sorted(rest, key=lambda c: (c[1], -c[2])):
        k = bisect.bisect_left(starts, e)
        if s >= last and (k == 0 or reach[k - 1] <= s):
            out.append((kind, s, e))
            last = e
    return out


def entropy(text: str) -> float:
    counts = np.unique(list(text), return_counts=True)[1] / max(1, len(text))
    return float(-(counts * np.log2(counts)).sum())


def votes(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler: 1 personal, -1 not, 0 no opinion."""
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    m = _NAME.search(text[max(0, start - 30) : start])
    name = m[1].lower() if m else ""
    named = name.split("_")[-1]
    pattern = 1 if base or (kind == "secret" and re.fullmatch(r"[0-9a-f]{32,}", span)) else 0
    checksum = gazetteer = shape = 0
    if kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[0] in "3456" else 0
        shape = 1 if len(digits) in (15, 16, 19) else -1
    elif kind == "ip":
        checksum = 1
        shape = -1 if len(set(span.split("."))) == 1 else 1
    elif kind == "phone":
        checksum = 1 if 8 <= len(digits) <= 15 and span[0] == "+" else 0
        gazetteer = 1 if span[0] == "+" and {digits[:1], digits[:2]} & CALLING_CODES else 0
        shape = 1 if any(c in span for c in " ()-.") else -1
    elif kind == "email":
        checksum = 1 if re.search(r"[A-Za-z]{2,}\Z", span) else -1
        gazetteer = 1 if re.split(r"[^A-Za-z]+", span)[-1].lower() in TOP_DOMAINS else 0
        shape = 1 if len(span) <= 80 else -1
    else:
        checksum = 1 if entropy(span) >= 3.0 else -1
        gazetteer = 1 if named in SECRET_NAMES or name in SECRET_NAMES else 0
        shape = 1 if sum(c.isdigit() for c in span) >= len(span) / 5 and len(span) <= 128 else -1
    if name in NOT_PERSONAL:
        context = -1
    elif named in SECRET_NAMES | NUMBER_NAMES or (kind == "secret" and re.search(r"[=:]\s*[\"']?\Z", text[max(0, start - 4) : start])):
        context = 1
    else:
        context = 0
    around = text[start - 1 : start] + text[end : end + 1]
    boundary = -1 if any(c.isalnum() for c in around) else 1
    return pattern, checksum, gazetteer, context, boundary, shape


def features(span: str, kind: str, vote: tuple[int, ...]) -> list[float]:
    n = max(1, len(span))
    return [
        1.0,
        *(1.0 if kind == k else 0.0 for k in KINDS),
        *map(float, vote),
        sum(c.isdigit() for c in span) / n,
        min(1.0, n / 64),
        len(set(span)) / n,
    ]


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """EM for two classes and labelers that vote independently given the class:
    the probability that a candidate of each vote pattern is personal."""
    patterns = sorted(counts)
    if not patterns:
        return {}
    v = np.array(patterns) + 1
    n = np.array([counts[p] for p in patterns], dtype=float)
    belief = 1 / (1 + np.exp(-2.0 * (v - 1).sum(axis=1) + 1.0))
    for _ in range(rounds):
        logs = []
        for own in (1 - belief, belief):
            weight = own * n
            log = np.full(len(patterns), math.log((weight.sum() + 1) / (n.sum() + 2)))
            for j in range(v.shape[1]):
                share = np.bincount(v[:, j], weight, 3) + 0.5
                log += np.log(share / share.sum())[v[:, j]]
            logs.append(log)
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - belief).max() < 1e-6:
            break
        belief = new
    return dict(zip(patterns, new.tolist()))


def measures(x: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logistic loss, gradient and curvature of weighted rows with soft labels, as one array."""
    z = x @ w
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    curve = (x.T * (n * np.maximum(p * (1 - p), 1e-6))) @ x
    return np.concatenate([[n @ (np.logaddexp(0, z) - y * z)], x.T @ (n * (y - p)), curve.ravel()])


def _measured(vectors: DataFrame, belief: dict[tuple[int, ...], float]):
    """The measures of all vectors at given weights; each task returns one row."""
    size = len(features("", KINDS[0], (0,) * len(LABELERS)))

    def at(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + size + size * size)
            for batch in batches:
                if len(batch):
                    y = np.array([belief[tuple(v)] for v in batch["votes"]])
                    total += measures(np.stack(batch["features"]), y, batch["n"].to_numpy(dtype=float), w)
            yield pd.DataFrame({"sums": [total.tolist()]})

        found = vectors.select("votes", "features", "n").mapInPandas(run, "sums array<double>").collect()
        return np.sum([r.sums for r in found], axis=0) if found else np.zeros(1 + size + size * size)

    return at, size


def fit_classifier(at, size: int, steps: int = 100) -> np.ndarray:
    """Logistic regression with a small L2 penalty by Newton steps; a step that
    does not gain is halved. ``at`` gives the measures at weights."""
    w = np.zeros(size)
    now = at(w)
    for _ in range(steps):
        curve = now[1 + size :].reshape(size, size) + np.eye(size)
        change = np.linalg.solve(curve, now[1 : 1 + size] - w)
        loss = now[0] + w @ w / 2
        while np.abs(change).max() >= 1e-6:
            new = at(w + change)
            if new[0] + (w + change) @ (w + change) / 2 <= loss:
                break
            change /= 2
        else:
            break
        w, now = w + change, new
    return w


_SPAN = "struct<kind:string,start:long,end:long,base:boolean,votes:array<int>,features:array<double>>"
_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_text string, spans array<" + _SPAN + ">"


def _found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        out = []
        for text in batch:
            base, rest = scan(text)
            spans = []
            for group, is_base in ((base, True), (_free(base, rest), False)):
                for kind, s, e in group:
                    vote = votes(text, kind, s, e, is_base)
                    spans.append(
                        {"kind": kind, "start": s, "end": e, "base": is_base, "votes": list(vote),
                         "features": features(text[s:e], kind, vote)}
                    )
            out.append(
                (*(sum(b[0] == k for b in base) for k in BASE_KINDS), _joined(base), spans)
            )
        yield pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base_text", "spans"])


def _joined(spans: list[tuple]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def _accepted(weights: np.ndarray):
    def run(found: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in found:
            out = []
            for spans in batch:
                own = [] if spans is None else list(spans)
                keep = [
                    (s["kind"], s["start"], s["end"]) for s in own
                    if s["base"] or (len(weights) and np.array(s["features"]) @ weights >= math.log(ACCEPT / (1 - ACCEPT)))
                ]
                out.append(_joined(keep))
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"found": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_text, base_sha256, spans), a
    row for each document. Spans are kind:start:end, code points, end exclusive.

    Null and empty texts have no spans. Repeated rows and null ids are kept, each
    a row of its own. Without candidates nothing is added to the base spans.
    """
    _found.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    find = F.pandas_udf(_found, _FOUND).asNondeterministic()  # not to be run twice
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col)).alias("found")).select("doc_id", "found.*"),
        "pii-candidates",
    )
    spans = rows.select(F.explode("spans").alias("s")).select("s.*")
    vectors = stored(
        spans.groupBy("votes", "features").agg(F.count("*").alias("n")), "pii-vectors"
    )
    # 3 ** len(LABELERS) rows at most
    counts = {tuple(r.votes): r.n for r in vectors.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    belief = estimate(counts)
    weights = fit_classifier(*_measured(vectors, belief)) if belief else np.zeros(0)
    return rows.select(
        "doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_text",
        F.sha2("base_text", 256).alias("base_sha256"),
        _accepted(weights)(F.col("spans")).alias("spans"),
    )


def op7_pii_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs).drop("base_text")


QUERIES = {"op7_pii_labels": op7_pii_labels}
ORACLE: dict[str, str] = {}
