"""Soft-membership mixing: document rates whose expected domain tokens meet targets.

A naive Bayes classifier, counted on the labelled table, gives every document a
posterior over domains (high and low quality, toxic). Rates r >= 0 minimise

    (E - T)' inverse(G) (E - T),   E_d = sum of r * tokens * p_d,   G = sum of tokens * p p'

by projected gradient steps of length one. G is the metric of the steps, taken over
the documents whose rate is not zero; if such a step does not help, it is made
with the G of all documents, with which it always does. A step needs the residuals of the domains only, so
the rate of a document is a fold over the list of past residuals and its own
posterior: nothing is stored per document, and a lost task is simply run again.
Every iteration is one aggregate. Documents of equal posteriors move together
and are summed before the first step.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

import functools
import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import BLANKS, fresh, stored, table

DOMAINS = ("high", "low", "toxic")
TARGETS = {"high": 0.92, "low": 0.06, "toxic": 0.02}
#: Labelled documents the classifier is counted on, at most.
TRAIN_DOCS = 20_000
#: Words that tell toxic texts, at most.
LEXICON = 128
LEVELS = 4
MAX_STEPS = 60
TOLERANCE = 1e-5


def _level(value: Column, *cuts: float) -> Column:
    """0 below the first cut, up to LEVELS - 1."""
    return functools.reduce(lambda a, c: a + (value >= c).cast("int"), cuts, F.lit(0))


def words_of(text: Column) -> Column:
    """Words as an array, A-Z in lower case among others; none for null or blank."""
    plain = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(
        F.split(F.lower(plain), r"[\x20\x09-\x0D]+")
    )


def with_cells(docs: DataFrame, text_col: str, lexicon: list[str]) -> tuple[DataFrame, str, str]:
    """Adds two columns and returns their names: tokens (words, 1 at least) and
    cell, one of LEVELS ** 4 combinations of the levels of four text measures."""
    names = ("mix_words", "mix_n", "mix_signs", "mix_upper", "mix_distinct", "mix_toxic", "mix_tokens", "mix_cell")
    words, count, *measures, tokens, cell = fresh(docs, *names)
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.greatest(F.size(words), F.lit(1))
    values = [
        F.regexp_count(text, F.lit(r"[#*$%&|<>!]")) / n,
        F.regexp_count(text, F.lit(r"[A-Z]")) / F.greatest(F.length(text), F.lit(1)),
        F.size(F.array_distinct(F.col(words))) / n,
        (F.size(F.array_intersect(F.col(words), F.array(*map(F.lit, lexicon)))) if lexicon else F.lit(0)).cast("double"),
    ]
    cuts = ((0.02, 0.2, 0.8), (0.15, 0.3, 0.5), (0.1, 0.25, 0.45), (1, 2, 4))
    # Expanded from arrays of one element, words and measures are computed once a
    # row; a filter on the rate would otherwise compute them for every level.
    out = docs.select("*", F.inline(F.array(F.struct(words_of(F.col(text_col)).alias(words)))))
    out = out.select("*", F.inline(F.array(F.struct(
        n.cast("long").alias(count), *(v.alias(name) for v, name in zip(values, measures))
    )))).drop(words)
    levels = [_level(F.col(name), *c) for name, c in zip(measures, cuts)]
    number = functools.reduce(lambda a, b: a * LEVELS + b, levels)
    return out.withColumns({tokens: F.col(count), cell: number}).drop(count, *measures), tokens, cell


@dataclass
class Classifier:
    """Domain posteriors of every cell, and the words that the cells count."""

    lexicon: list[str]
    posteriors: list[list[float]]

    def columns(self, cell: str) -> list[Column]:
        return [
            F.element_at(F.array(*(F.lit(p[d]) for p in self.posteriors)), F.col(cell) + 1)
            for d in range(len(DOMAINS))
        ]


def fit_classifier(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS
) -> Classifier:
    """Naive Bayes over the four levels, add-one smoothing, on at most
    ``train_docs`` labelled documents. Labels with a null are left out."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .select(F.col("doc_id").alias("label_id"), domain.alias("domain"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(train_docs)
    )
    # train_docs rows of two numbers at most
    sample = stored(
        docs.select("doc_id", F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "domain", "text"),
        "mix-sample",
    )
    sizes = dict(sample.groupBy("domain").count().collect())
    toxic, rest = sizes.get(2, 0), sum(sizes.values()) - sizes.get(2, 0)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("o") + 0.5) / (rest + 1.0))
    seen = (
        sample.select("domain", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
        .groupBy("word")
        .agg(F.count_if(F.col("domain") == 2).alias("t"), F.count_if(F.col("domain") != 2).alias("o"))
        .where(F.col("t") >= max(5, 0.01 * toxic)).where(odds > math.log(20))
    )
    lexicon = [r.word for r in seen.orderBy(odds.desc(), F.col("t").desc(), "word").limit(LEXICON).collect()]
    cells, _, cell = with_cells(sample, "text", lexicon)
    measures = 4
    counts = [[[1.0] * LEVELS for _ in range(measures)] for _ in DOMAINS]
    prior = [1.0] * len(DOMAINS)
    for d, c, n in cells.groupBy("domain", cell).count().collect():  # 3 * LEVELS ** 4 rows at most
        prior[d] += n
        for k in range(measures):
            counts[d][k][c // LEVELS ** (measures - 1 - k) % LEVELS] += n
    posteriors = []
    for c in range(LEVELS**measures):
        logs = [
            math.log(prior[d])
            + sum(
                math.log(counts[d][k][c // LEVELS ** (measures - 1 - k) % LEVELS] / sum(counts[d][k]))
                for k in range(measures)
            )
            for d in range(len(DOMAINS))
        ]
        top = max(logs)
        weights = [math.exp(x - top) for x in logs]
        posteriors.append([w / sum(weights) for w in weights])
    return Classifier(lexicon, posteriors)


@dataclass
class Step:
    """A move against the pull of each domain, then on by a part of what moved."""

    pull: list[float]
    momentum: float = 0.0


def _folded(posteriors: list[Column], steps: list[Step]) -> Column:
    """(rate, ahead) after the steps: rate is projected, ahead is where the next
    step starts."""
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    if not steps:
        return start
    # As one text, which the optimizer turns into a constant.
    text = json.dumps([[*map(float, s.pull), s.momentum] for s in steps])
    past = F.from_json(F.lit(text), "array<array<double>>")

    def step(state: Column, move: Column) -> Column:
        moved = state["ahead"]
        for d, p in enumerate(posteriors):
            moved = moved - p * move[d]
        rate = F.greatest(F.lit(0.0), moved)
        return F.struct(
            rate.alias("rate"), (rate + move[len(posteriors)] * (rate - state["rate"])).alias("ahead")
        )

    return F.aggregate(past, start, step)


def rate_column(posteriors: list[Column], steps: list[Step]) -> Column:
    """The rate of a document after the given steps."""
    return _folded(posteriors, steps)["rate"]


def fit_rates(
    members: DataFrame, tokens: str, posteriors: list[str], targets: list[float],
    total: float | None = None, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE,
    whole: int | None = None,
) -> tuple[list[Step], list[float], list[float]]:
    """(steps, expected tokens, wanted tokens).

    ``targets`` are shares; they are of ``total`` tokens, by default all that
    there are, or, with ``whole`` the number of a domain, of so many that this
    domain needs 2 % more than it has: none of its documents is thinned out. A
    domain without tokens can't be filled; its target is left unmet.
    """
    domains = range(len(posteriors))
    classes = stored(
        members.groupBy(*posteriors).agg(F.sum(tokens).alias("mix_sum"))
        .toDF(*(f"p{d}" for d in domains), "t"),
        "mix-classes",
    )
    p = [F.col(f"p{d}") for d in domains]
    size = len(posteriors)

    def measure(steps: list[Step]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected tokens, those where the next step starts, and the Gram matrix
        of what has a rate above zero."""
        state = classes.select("t", *p, _folded(p, steps).alias("s")).select("t", *p, "s.*")
        live = F.when(F.col("rate") > 0, F.col("t"))
        row = state.agg(
            *(F.coalesce(F.sum(F.col(of) * F.col("t") * p[a]), F.lit(0.0)) for of in ("rate", "ahead") for a in domains),
            *(F.coalesce(F.sum(live * p[a] * p[b]), F.lit(0.0)) for a in domains for b in domains),
        ).first()
        return np.array(row[:size]), np.array(row[size : 2 * size]), np.array(row[2 * size :]).reshape(size, size)

    def inverse(gram: np.ndarray) -> np.ndarray:
        return np.linalg.pinv(gram, rcond=1e-9, hermitian=True)  # domains x domains

    steps: list[Step] = []
    expected, ahead, gram = measure(steps)
    share = np.array(targets) / sum(targets)
    if whole is not None and share[whole] > 0:
        total = 1.02 * expected[whole] / share[whole]
    total = expected.sum() if total is None else total
    wanted = share * total
    near = tolerance * max(1.0, total)
    metric = fixed = inverse(gram)

    def loss(tokens: np.ndarray) -> float:
        return float((tokens - wanted) @ fixed @ (tokens - wanted))

    # Long steps, in the metric of the documents with a rate, while they help much.
    while len(steps) < max_steps and np.abs(expected - wanted).max() > near:
        tried = [*steps, Step((metric @ (expected - wanted)).tolist())]
        found = measure(tried)
        if loss(found[0]) > loss(expected) / 4:
            break
        steps, (expected, ahead, gram) = tried, found
        metric = inverse(gram)
    # Steps that are safe in any case, with momentum; it restarts when they lead astray.
    speed, losses = 1.0, [loss(expected)]
    while len(steps) < max_steps and np.abs(expected - wanted).max() > near:
        faster = (1 + math.sqrt(1 + 4 * speed**2)) / 2
        tried = [*steps, Step((fixed @ (ahead - wanted)).tolist(), (speed - 1) / faster)]
        found = measure(tried)
        if loss(found[0]) > losses[-1]:
            if speed == 1.0:
                break  # not even a step without momentum helps: this is the least
            steps[-1].momentum, speed = 0.0, 1.0
            ahead = expected
            continue
        steps, (expected, ahead, gram), speed = tried, found, faster
        losses.append(loss(expected))
        if len(losses) > 20 and losses[-1] > losses[-20] * (1 - tolerance):
            break
    return steps, expected.tolist(), wanted.tolist()


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
    text_col: str = "text", train: DataFrame | None = None, whole: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Documents, all columns, with tokens, a posterior for each domain and rate;
    returns the names of these columns by role.

    Null and blank texts count one token. Rows of null or repeated ids have rates
    of their own. Without labels all domains are alike likely. ``train`` holds
    the labelled texts if ``docs`` lacks some of them.
    """
    targets = targets or TARGETS
    model = fit_classifier(docs if train is None else train, labels, text_col)
    out, tokens, cell = with_cells(docs, text_col, model.lexicon)
    names = fresh(out, *(f"p_{d}" for d in DOMAINS), "rate")
    posteriors, rate = names[:-1], names[-1]
    members = stored(
        out.groupBy(cell).agg(F.sum(tokens).alias("tokens")).select(
            "tokens", *(c.alias(f"p{d}") for d, c in enumerate(model.columns(cell)))
        ),
        "mix-cells",
    )
    steps, _, _ = fit_rates(
        members, "tokens", [f"p{d}" for d in range(len(DOMAINS))], [targets[d] for d in DOMAINS],
        whole=None if whole is None else DOMAINS.index(whole),
    )
    # the rates of the cells, from the same fold over the residuals
    rates = {
        r[0]: r[1:] for r in docs.sparkSession.range(len(model.posteriors)).select(
            F.col("id").cast("int").alias("id")
        ).select("id", *model.columns("id")).toDF("id", *(f"p{d}" for d in range(len(DOMAINS))))
        .select("id", rate_column([F.col(f"p{d}") for d in range(len(DOMAINS))], steps)).collect()
    }
    by_cell = F.array(*(F.lit(float(rates[c][0])) for c in range(len(model.posteriors))))
    out = out.withColumns(
        dict(zip(posteriors, model.columns(cell))) | {rate: F.element_at(by_cell, F.col(cell) + 1)}
    ).drop(cell)
    return out, {"tokens": tokens, "rate": rate} | dict(zip(DOMAINS, posteriors))


def draw(rate: Column, key: Column) -> Column:
    """Copies of a document: the rate rounded up or down by a hash of its key, so
    that copies are as many as the rates in expectation and the same every time."""
    chance = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + chance).cast("long")


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, names = mix(docs, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id",
        F.col(names["tokens"]).alias("tokens"),
        *(F.col(names[d]).alias(f"p_{d}") for d in DOMAINS),
        F.col(names["rate"]).alias("rate"),
        draw(F.col(names["rate"]), F.col("doc_id")).alias("copies"),
    )


QUERIES = {"op5_soft_mixing": op5_soft_mixing}
ORACLE: dict[str, str] = {}
