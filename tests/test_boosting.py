import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelens.operators import boosting as B
from quotelens.operators import target_stats as TS
from quotelens.operators.metrics import regression_metrics
from quotelens.operators.models import fit_price_model, load_model, predict, save_model


def panel(spark, n=3000, seed=1):
    """A gamma target with a step, an interaction and a level effect; some missing values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.uniform(0, 10), rng.uniform(-1, 1), rng.choice("uvwxyz")
        mu = 100 * (1 + (a > 6) * 2) * math.exp(0.8 * (b > 0) * (c in "uv")) * (1.5 if c == "z" else 1)
        rows.append((i, None if rng.random() < .05 else a, b, c, rng.gammavariate(20, mu / 20), i % 5 == 0, rng.uniform(.5, 2)))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y double, held boolean, w double")


def plain_boost(rows, rounds, depth, rate, l2, min_rows, power, bins):
    """Level by level over whole arrays, bins by numpy quantiles; the margins."""
    X, y, w = rows
    edges = [np.unique(np.quantile(x[~np.isnan(x)], [i / bins for i in range(1, bins)])) for x in X]
    B_ = np.array([np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, "left")) for x, e in zip(X, edges)])
    m = np.full(len(y), math.log((w * y).sum() / w.sum()))
    for _ in range(rounds):
        g = w * (np.exp((2 - power) * m) - y * np.exp((1 - power) * m))
        h = w * ((2 - power) * np.exp((2 - power) * m) - (1 - power) * y * np.exp((1 - power) * m))
        nodes = [np.arange(len(y))]
        step = np.zeros(len(y))
        for _ in range(depth):
            following = []
            for at in nodes:
                best = None
                for missing_left in (True, False):
                    for f in range(len(X)):
                        for t in range(1, bins + 1):
                            left = (B_[f][at] <= t) & ((B_[f][at] > 0) | missing_left)
                            if left.sum() < min_rows or (~left).sum() < min_rows:
                                continue
                            s = lambda k: g[at][k].sum() ** 2 / (h[at][k].sum() + l2)
                            gain = s(left) + s(~left) - s(np.ones(len(at), bool))
                            if gain > 0 and (best is None or gain > best[0] * (1 + 1e-9)):
                                best = (gain, left)
                if best is None:
                    continue
                for side in (at[best[1]], at[~best[1]]):
                    step[side] = -rate * g[side].sum() / (h[side].sum() + l2)
                    following.append(side)
            nodes = following
        m = m + step
    return m


@pytest.mark.parametrize("power", [2.0, 1.5])
def test_trees_equal_a_plain_computation(spark, power):
    df = panel(spark, 400)
    params = B.BoostParams(power=power, rounds=3, depth=2, rate=.3, bins=8, min_rows=15)
    got = B.margins(B.fit_boosted(df, ["a", "b"], "y", "w", params=params), df, "m").orderBy("id").toPandas()
    p = df.orderBy("id").toPandas()
    want = plain_boost(([p.a.to_numpy(float), p.b.to_numpy(float)], p.y.to_numpy(), p.w.to_numpy()), 3, 2, .3, 1.0, 15, power, 8)
    assert np.allclose(got.m, want, atol=1e-9)


def test_boosting_stops_and_keeps_the_best_round(spark):
    df = panel(spark, 1200)
    params = B.BoostParams(rounds=60, depth=3, rate=.6, bins=16, patience=3)
    model = B.fit_boosted(df, ["a", "b"], "y", held_out="held", params=params)
    assert len(model.trees) < 40 and len(model.validation) <= len(model.trees) + 4
    assert min(model.validation) == model.validation[len(model.trees)]
    held = B.margins(model, df.where("held"), "m").toPandas()
    mu = np.exp(held.m)
    assert np.isclose((2 * (held.y / mu - 1 - np.log(held.y / mu))).mean(), min(model.validation))


def test_held_out_rows_change_nothing_else(spark):
    df = panel(spark, 600)
    params = B.BoostParams(rounds=4, depth=2, bins=8, patience=9)
    with_ = B.fit_boosted(df, ["a", "b"], "y", "w", "held", params)
    without = B.fit_boosted(df.where("not held"), ["a", "b"], "y", "w", params=params)
    without.trees = without.trees[:len(with_.trees)]
    a, b = (B.margins(m, df, "m").orderBy("id").toPandas().m for m in (with_, without))
    assert with_.trees and np.allclose(a, b, atol=1e-9)


def test_gamma_boost_is_better_than_the_glm_where_it_is_not_linear(spark, tmp_path):
    df = panel(spark)
    d2 = {}
    for kind in ("glm_gamma", "gamma_boost"):
        m = fit_price_model(df.where("not held") if kind == "glm_gamma" else df, "y", ["a", "b", "c"], ["c"], ["a", "b"], kind, "w", validation_indicator="held")
        scored = predict(m, df.where("held"))
        d2[kind] = regression_metrics(scored, "y", "prediction", tiebreak="id").first().d2
    assert d2["gamma_boost"] > d2["glm_gamma"] + .1 and d2["gamma_boost"] > .8
    save_model(m, str(tmp_path / "m"))
    back = predict(load_model(spark, str(tmp_path / "m")), df)
    assert back.exceptAll(predict(m, df)).count() == 0
    unseen = predict(m, spark.createDataFrame([(None, 0.5, "never")], "a double, b double, c string")).first().prediction
    assert 50 < unseen < 500


def test_tweedie_takes_zero_targets(spark):
    df = panel(spark, 600).withColumn("y", F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("y")))
    m = fit_price_model(df, "y", ["a", "c"], ["c"], ["a"], "tweedie_boost", params={"rounds": 5})
    r = predict(m, df).agg(F.avg("y").alias("y"), F.avg("prediction").alias("p")).first()
    assert m.training_rows is None and abs(r.p / r.y - 1) < .05
    with pytest.raises(ValueError):
        B.fit_boosted(df, ["a"], "y", params=B.BoostParams(power=3.0))


def ordered_by_rule(spark, rows, seed, prior_weight=1.0):
    """rows: (id, level, y, w)."""
    o = {r.id: r.o for r in spark.createDataFrame([(r[0],) for r in rows], "id long").select("id", TS.hashed_order(F.col("id"), seed).alias("o")).collect()}
    prior = sum(w * y for *_, y, w in rows) / sum(w for *_, w in rows)
    sums, out = {}, {}
    for i, level, y, w in sorted(rows, key=lambda r: (o[r[0]], r[0])):
        a, b = sums.get(level, (0.0, 0.0))
        out[i] = (a + prior_weight * prior) / (b + prior_weight)
        sums[level] = (a + w * y, b + w)
    return out


def test_ordered_statistics_with_hot_levels_in_ranges(spark):
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 else rng.choice(["x", None, "y"]), rng.uniform(1, 9), rng.uniform(0, 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, c string, y double, w double")
    want = ordered_by_rule(spark, rows, 7)
    for rows_per_range in (50, 10_000):
        got = {r.id: r[TS.prefix("c")] for r in TS.ordered_statistics(df, "id", ["c"], "y", "w", rows_per_range=rows_per_range).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_a_column_of_many_levels(spark):
    """100,000 levels stay a table: nothing of their size is sent to the driver or into a plan."""
    df = spark.range(200_000).select("id", (F.col("id") % 100_000).cast("string").alias("c"), (F.lit(100.0) + (F.col("id") % 7)).alias("y"), F.rand(3).alias("a"))
    m = fit_price_model(df, "y", ["c", "a"], ["c"], ["a"], "gamma_boost", params={"rounds": 2, "depth": 2, "bins": 32})
    assert m.levels.count() == 100_001 and len(str(m.meta())) < 20_000
    assert predict(m, df).where("prediction is null").count() == 0


def test_held_out_rows_stay_out_of_the_histograms(spark, monkeypatch):
    held, plain = [], B._histogram
    monkeypatch.setattr(B, "_histogram", lambda rows, *a: held.append(rows.where("held_out").count()) or plain(rows, *a))
    params = B.BoostParams(rounds=10, depth=1, bins=8, patience=20)
    model = B.fit_boosted(panel(spark, 300), ["a", "b"], "y", held_out="held", params=params)
    assert held and not any(held)
    assert len(model.validation) == 11  # rounds 0 to 10, over two cuts of the margins
    rest = panel(spark, 300).where("held")
    for r in (0, 7, 8, 9, 10):
        trees = B.fit_boosted(panel(spark, 300).where("not held"), ["a", "b"], "y", params=B.BoostParams(rounds=r, depth=1, bins=8))
        got = B.margins(trees, rest, "m").toPandas()
        assert np.isclose(B.deviance(2.0, got.y.to_numpy(), got.m.to_numpy()).mean(), model.validation[r])
