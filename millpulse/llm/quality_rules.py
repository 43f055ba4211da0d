"""Quality rules: base counts and a linear-chain CRF over the lines of a text.

Each line with a word is content or boilerplate. Viterbi decoding finds the best
sequence of labels; a document whose content lines hold enough of its words is
kept. The field is trained by gradient ascent on a bounded sample of labelled
documents (``TRAIN_DOCS`` of each class, of at most ``TRAIN_CHARS``), where a
line has the label of its document. Decoding covers all lines of all texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import BLANKS, fresh, table

TRAIN_DOCS = 800
TRAIN_CHARS = 20_000
EPOCHS = 150
CONTENT_SHARE = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

SYMBOLS = b"#*$%&|<>"
_ALL = bytes(range(256))
_NOT_SYMBOL = bytes(set(_ALL) - set(SYMBOLS))
_NOT_UPPER = bytes(set(_ALL) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_NOT_DIGIT = bytes(set(_ALL) - set(b"0123456789"))
_NOT_LEAD = bytes(range(0x80, 0xC0))  # continuation bytes
_ENDS = (b".", b"!", b"?", b":", b";", b'"', b")")
N_FEATURES = 10


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice
    or more. Windows are compared exactly: ranks of pairs, of fours, of eights."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    width = 1
    while width < window:
        pairs = rank[:-width] * np.int64(n + 1) + rank[width:]
        _, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if counts.max() == 1:
            return 0
        width *= 2
    starts = np.flatnonzero(counts[rank] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    whole = text.encode("utf-8", "surrogatepass")
    words = whole.split()
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = len(whole.translate(None, _NOT_SYMBOL))
    lines, dup = set(), 0
    for line in whole.split(b"\n"):
        if line in lines:
            dup += bool(line.strip())
        else:
            lines.add(line)
    repeat = repeated_words(words)
    n = len(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    return n, chars, symbols, dup, repeat, failed


def line_features(text: str | None) -> tuple[list[tuple], list[int]]:
    """Features and word count of every line that has a word."""
    out, sizes = [], []
    seen = set()
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        size = len(line)
        out.append(
            (
                1.0,
                min(2.0, len(line.translate(None, _NOT_SYMBOL)) / n),
                min(2.0, line.count(b"!") / n),
                len(line.translate(None, _NOT_UPPER)) / size,
                len(set(words)) / n,
                math.log1p(n) / 5,
                len(line.translate(None, _NOT_DIGIT)) / size,
                1.0 if line in seen else 0.0,
                1.0 if words[-1].endswith(_ENDS) else 0.0,
                min(3.0, size / n / 10),
            )
        )
        sizes.append(n)
        seen.add(line)
    return out, sizes


@dataclass
class LineField:
    """Linear-chain CRF with labels 0 boilerplate and 1 content."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, scores: np.ndarray) -> list[int]:
        """Best labels, given each line's score of content; ties go to content."""
        if not len(scores):
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        rows = scores.tolist()
        v0, v1 = float(self.start[0]), float(self.start[1]) + rows[0]
        back = []
        for s in rows[1:]:
            a0, b0 = v0 + m00, v1 + m10
            a1, b1 = v0 + m01, v1 + m11
            back.append((b0 >= a0, b1 >= a1))
            v0, v1 = (b0 if b0 >= a0 else a0), (b1 if b1 >= a1 else a1) + s
        label = 1 if v1 >= v0 else 0
        labels = [label]
        for from0, from1 in reversed(back):
            label = int(from1 if label else from0)
            labels.append(label)
        return labels[::-1]


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def spliced(docs: list[tuple[str, int]]) -> list[tuple[str, list[int]]]:
    """Documents put together from a good and a bad one, with the label of each line
    that has words: the labels of a real document change, those of the labelled
    table do not. Every document takes part once at most; the shapes take turns:
    good bad, bad good, good bad good, bad good bad."""
    kinds = [[t for t, y in docs if y == label and line_features(t)[0]] for label in (0, 1)]
    out = []
    for k, (bad, good) in enumerate(zip(*kinds)):
        first, second = ((good, 1), (bad, 0)) if k % 2 == 0 else ((bad, 0), (good, 1))
        pieces = [first, second]
        lines = first[0].split("\n")
        if k % 4 > 1 and len(lines) > 1:
            half = len(lines) // 2
            pieces = [("\n".join(lines[:half]), first[1]), second, ("\n".join(lines[half:]), first[1])]
        labels = [y for text, y in pieces for _ in line_features(text)[0]]
        out.append(("\n".join(text for text, _ in pieces), labels))
    return out


def fit_field(docs: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = 0.1) -> LineField:
    """Maximum likelihood with a small L2 penalty, by Adam, on the documents and on
    spliced ones. All are handled at once, one position after the other."""
    whole = [(np.array(f), [y] * len(f), y) for f, y in ((line_features(t)[0], y) for t, y in docs) if f]
    model = LineField()
    if len({y for _, _, y in whole}) < 2:
        return model
    share = np.bincount([y for _, _, y in whole], minlength=2) / len(whole)
    # both classes weigh the same; a spliced document has something of each
    rows = [(f, own, 1 / (2 * share[y])) for f, own, y in whole]
    rows += [(np.array(line_features(t)[0]), own, 1.0) for t, own in spliced(docs)]
    rows.sort(key=lambda r: -len(r[0]))
    t = len(rows[0][0])
    sizes = np.array([len(f) for f, _, _ in rows])
    live = [int((sizes > k).sum()) for k in range(t)]  # documents are sorted by length
    x = [np.stack([f[k] for f, _, _ in rows[: live[k]]]) for k in range(t)]
    y = [np.array([own[k] for _, own, _ in rows[: live[k]]]) for k in range(t)]
    value = np.array([v for _, _, v in rows])
    theta = np.zeros(N_FEATURES + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    total = float((value * sizes).sum())
    for step in range(1, epochs + 1):
        w, start, moves = theta[:N_FEATURES], theta[N_FEATURES : N_FEATURES + 2], theta[-4:].reshape(2, 2)
        score = [np.stack([np.zeros(live[k]), x[k] @ w], axis=1) for k in range(t)]
        alpha = [start + score[0]]
        for k in range(1, t):
            at = alpha[-1][: live[k]]
            alpha.append(
                score[k] + _log_add(at[:, :1] + moves[:1], at[:, 1:] + moves[1:])
            )
        beta = [None] * t
        beta[t - 1] = np.zeros((live[t - 1], 2))
        for k in range(t - 2, -1, -1):
            beta[k] = np.zeros((live[k], 2))
            m = live[k + 1]
            after = score[k + 1] + beta[k + 1]
            beta[k][:m] = np.stack(
                [_log_add(moves[i, 0] + after[:, 0], moves[i, 1] + after[:, 1]) for i in (0, 1)], axis=1
            )
        whole = alpha[0] + beta[0]
        z = _log_add(whole[:, 0], whole[:, 1])
        grad = np.zeros_like(theta)
        for k in range(t):
            m = live[k]
            p1 = np.exp(alpha[k][:, 1] + beta[k][:, 1] - z[:m])
            gap = value[:m] * (y[k] - p1)
            grad[:N_FEATURES] += gap @ x[k]
            if k == 0:
                grad[N_FEATURES : N_FEATURES + 2] += [-gap.sum(), gap.sum()]
            else:
                before = alpha[k - 1][:m]
                after = score[k] + beta[k]
                for i in (0, 1):
                    for j in (0, 1):
                        pair = np.exp(before[:, i] + moves[i, j] + after[:, j] - z[:m])
                        seen = (y[k - 1][:m] == i) & (y[k] == j)
                        grad[-4 + 2 * i + j] += (value[:m] * (seen - pair)).sum()
        grad = grad / total - 1e-4 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineField(theta[:N_FEATURES], theta[N_FEATURES : N_FEATURES + 2], theta[-4:].reshape(2, 2))


def training_texts(
    docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS, chars: int = TRAIN_CHARS
) -> list[tuple[str, int]]:
    """Texts and quality of at most ``per_class`` documents of each class."""
    chosen = None
    for quality in (0, 1):
        part = (
            labels.where(F.col("quality") == quality).where("doc_id IS NOT NULL")
            .select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(per_class)
        )
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * per_class rows of two numbers
    rows = (
        docs.select("doc_id", "text").where(F.length("text") <= chars)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    )
    return [(r.text, int(r.label)) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))]


_VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def judge_udf(model: LineField, share: float = CONTENT_SHARE):
    names = [c.split()[0] for c in _VERDICT.split(", ")]

    def verdicts(texts: Iterable[str | None]) -> list[tuple]:
        rows, all_features, all_sizes = [], [], []
        for text in texts:
            features, sizes = line_features(text)
            all_features.extend(features)
            all_sizes.append(sizes)
            rows.append(base_counts(text))
        scores = np.array(all_features) @ model.weights if all_features else np.zeros(0)
        at, out = 0, []
        for row, sizes in zip(rows, all_sizes):
            own = model.decode(scores[at : at + len(sizes)])
            at += len(sizes)
            words = row[0]
            content = sum(s for s, label in zip(sizes, own) if label) / words if words else 0.0
            out.append((*row, content, not row[5] and content >= share))
        return out

    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for k in range(0, len(batch), 256):
                out.extend(verdicts(batch.iloc[k : k + 256]))
            yield pd.DataFrame(out, columns=names)

    judged.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(judged, _VERDICT).asNondeterministic()  # not to be run twice


def judge(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", share: float = CONTENT_SHARE
) -> tuple[DataFrame, str]:
    """Documents, all columns, and a struct column (its name is returned) with the
    base counts, content_share and kept.

    Null and empty texts have no words and fail the base rules. Without labels
    of both classes every line counts as content. Repeated rows are judged alike.
    """
    model = fit_field(training_texts(docs.select("doc_id", F.col(text_col).alias("text")), labels))
    (verdict,) = fresh(docs, "quality_verdict")
    return docs.withColumn(verdict, judge_udf(model, share)(F.col(text_col))), verdict


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, verdict = judge(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", f"{verdict}.*")


QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE: dict[str, str] = {}
