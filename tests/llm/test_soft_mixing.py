"""Classifier, rates and the mix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millpulse.llm import soft_mixing as sm

PYTHON = ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "MapInArrow", "FlatMapGroups", "ExistingRDD")


def direct_rates(tokens, p, steps):
    rate = ahead = np.ones(len(tokens))
    for step in steps:
        before, rate = rate, np.maximum(0, ahead - p @ np.array(step.pull))
        ahead = rate + step.momentum * (rate - before)
    return rate


def fit(spark, tokens, p, targets, **more):
    rows = [(float(t), *map(float, x)) for t, x in zip(tokens, p)]
    frame = spark.createDataFrame(rows, "t double, a double, b double, c double")
    return sm.fit_rates(frame, "t", ["a", "b", "c"], targets, **more)


@pytest.mark.parametrize("alpha,targets", [(0.5, [0.2, 0.3, 0.5]), (2.0, [0.4, 0.3, 0.3]), (0.2, [0.9, 0.05, 0.05])])
def test_expected_tokens_meet_targets(spark, alpha, targets):
    rng = np.random.default_rng(0)
    tokens, p = rng.integers(1, 1000, 300), rng.dirichlet([alpha] * 3, 300)
    pulls, expected, wanted = fit(spark, tokens, p, targets)
    rate = direct_rates(tokens, p, pulls)
    assert (rate >= 0).all()
    assert (rate * tokens) @ p == pytest.approx(wanted, rel=1e-3)
    assert expected == pytest.approx((rate * tokens) @ p)


def test_out_of_reach_is_least_squares(spark):
    """One domain alone is wanted although every document has some of the others:
    the rates come near the least distance, in the metric of the fit."""
    rng = np.random.default_rng(1)
    tokens, p = rng.integers(1, 100, 200).astype(float), rng.dirichlet([0.5] * 3, 200)
    pulls, expected, wanted = fit(spark, tokens, p, [0.0, 0.0, 1.0], max_steps=60, tolerance=1e-9)
    gram = (p * tokens[:, None]).T @ p
    metric = np.linalg.inv(gram)

    def loss(e):
        return (e - wanted) @ metric @ (e - wanted)

    rate = np.ones(len(tokens))
    for _ in range(20_000):
        rate = np.maximum(0, rate - 0.9 * p @ metric @ ((rate * tokens) @ p - wanted))
    least, first = loss((rate * tokens) @ p), loss(tokens @ p)
    assert loss(np.array(expected)) - least <= 0.05 * (first - least)


def test_hopeless_and_empty(spark):
    _, expected, wanted = fit(spark, [10, 10], [[1, 0, 0], [0.5, 0.5, 0]], [0.4, 0.1, 0.5])
    assert expected[2] == 0 and expected[:2] == pytest.approx(wanted[:2], rel=1e-3)
    assert fit(spark, [], [], [0.2, 0.3, 0.5])[0] == []


def test_whole_domain_is_not_thinned(spark):
    tokens, p = [100, 50, 30], [[0.99, 0.01, 0], [0.01, 0.99, 0], [0, 0.02, 0.98]]
    pulls, _, _ = fit(spark, tokens, np.array(p), [0.97, 0.03, 0.0], whole=0)
    rate = direct_rates(np.array(tokens), np.array(p), pulls)
    assert rate[0] >= 1 and rate[1] < 0.2 and rate[2] < 0.05


def test_mix_on_documents(spark):
    """Targets within reach: the few labels of this table leave four in a hundred
    tokens of good documents in doubt, so that less than that can't be asked."""
    folder, targets = "/root/testdata/sf0.01", {"high": 0.9, "low": 0.05, "toxic": 0.05}
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    mixed, names = sm.mix(docs.select("doc_id", "text"), labels, targets)
    out = mixed.select(
        "doc_id", names["tokens"], names["rate"], *(F.col(names[d]).alias(f"p_{d}") for d in sm.DOMAINS)
    ).toDF("doc_id", "tokens", "rate", *(f"p_{d}" for d in sm.DOMAINS)).cache()
    total = out.agg(F.sum("tokens").alias("t"), *(
        F.sum(F.col("rate") * F.col("tokens") * F.col(f"p_{d}")).alias(d) for d in sm.DOMAINS
    )).first()
    for d in sm.DOMAINS:
        assert total[d] / total.t == pytest.approx(targets[d], abs=1e-3)
    guess = F.when(F.col("p_toxic") > 0.5, 2).when(F.col("p_low") > 0.5, 1).otherwise(0)
    truth = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    right = out.join(labels, "doc_id").agg(F.avg((guess == truth).cast("int"))).first()[0]
    assert right > 0.9
    plan = sm.op5_soft_mixing(spark, folder)._jdf.queryExecution().toString()
    assert not any(node in plan for node in PYTHON)


def test_edges(spark):
    rows = [(1, "some words of a text", 5), (2, None, 6), (3, " \n", 7), (None, "other words", 8), (1, "some words of a text", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Mix_Cell int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out, names = sm.mix(docs, none, {"high": 1.0, "low": 1.0, "toxic": 1.0})
    got = out.select("doc_id", "Mix_Cell", names["tokens"], *(names[d] for d in sm.DOMAINS), names["rate"]).collect()
    assert sorted((r[0] or 0, r[1], r[2]) for r in got) == [(0, 8, 2), (1, 5, 5), (1, 5, 5), (2, 6, 1), (3, 7, 1)]
    for r in got:
        assert list(r[3:6]) == pytest.approx([1 / 3] * 3) and r[6] == pytest.approx(1)
    assert sm.mix(docs.limit(0), none)[0].count() == 0


def test_draw_rounds_by_key(spark):
    ids = spark.range(20_000).select(sm.draw(F.lit(1.3), F.col("id")).alias("n"))
    counts = dict(ids.groupBy("n").count().collect())
    assert set(counts) == {1, 2} and counts[2] == pytest.approx(6000, abs=300)
