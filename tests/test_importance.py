import random

import numpy as np
from pyspark.sql import functions as F

from quotelens.operators import importance as I
from quotelens.operators import models as ML


def panel(spark, n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        a, c, e = rng.uniform(0, 10), rng.choice(["x", "y", None]), rng.choice("pq")
        rows.append((i, None if i % 17 == 0 else a, c, e, (100 + 20 * (a > 5) + (40 if c == "x" else 0)) * rng.uniform(.9, 1.1)))
    return spark.createDataFrame(rows, "id long, a double, c string, e string, y double")


def test_cells_equal_predictions_of_permuted_rows(spark, monkeypatch):
    df = panel(spark)
    model = ML.fit_price_model(df, "y", ["c", "e", "a"], ["c", "e"], ["a"], "segment_mean", cells=["c", "e"])
    for block in (50_000, 90):
        monkeypatch.setattr(I, "BLOCK", block)
        got = {r.feature: (r.importance_mean, r.importance_std) for r in ML.permutation_importance(model, df, "id", 3).collect()}
        rows = df.withColumn("b", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(max(1, -(-400 // block))))).toPandas()
        scored = lambda p: ML.predict(model, spark.createDataFrame(p[["id", "c", "e", "a", "y"]].astype(object).where(p.notna(), None).values.tolist(), "id long, c string, e string, a double, y double")).toPandas()
        def r2(p):
            s = scored(p)
            return 1 - ((s.y - s.prediction) ** 2).sum() / ((s.y - s.y.mean()) ** 2).sum()
        base = r2(rows)
        for f in ("c", "e"):
            drops = []
            for r in range(3):
                changed = rows.copy()
                for _, part in rows.groupby("b"):
                    cases = {(x, k): s for x, k, s in I.permutations([str(i) for i in part.id], list(part.id), [f], 3)}
                    changed.loc[part.index, f] = part[f].to_numpy()[cases[f, r]]
                drops.append(base - r2(changed))
            assert np.allclose(got[f], (np.mean(drops), np.std(drops)), atol=1e-9)
        assert got["a"] == (0.0, 0.0) and got["c"][0] > .2 > abs(got["e"][0])


def test_boosted_trees_rank_what_they_use(spark):
    df = panel(spark)
    model = ML.fit_price_model(df, "y", ["a", "c", "e"], ["c", "e"], ["a"], "gamma_boost", params={"rounds": 12})
    got = {r.feature: r.importance_mean for r in ML.permutation_importance(model, df, "id", 3).collect()}
    assert got["c"] > got["a"] > .05 > abs(got["e"])
    # one case by hand: the whole table is one block
    p = df.toPandas()
    _, _, source = next(x for x in I.permutations([str(i) for i in p.id], list(p.id), ["a"], 1))
    changed = spark.createDataFrame([(int(i), None if a != a else float(a), c, e, float(y)) for i, a, c, e, y in zip(p.id, p.a.to_numpy()[source], p.c, p.e, p.y)], df.schema)
    s, t = (ML.predict(model, x).toPandas() for x in (df, changed))
    r2 = lambda s: 1 - ((s.y - s.prediction) ** 2).sum() / ((s.y - s.y.mean()) ** 2).sum()
    one = {r.feature: r.importance_mean for r in ML.permutation_importance(model, df, "id", 1).collect()}
    assert np.isclose(one["a"], r2(s) - r2(t))


def test_validation_rows_cross_one_exchange(spark):
    df = panel(spark)
    plan = I.squared_errors(df, "id", "y", {"a": "a"}, lambda v: v["a"], 5, 400)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_spark_ml_rows_cross_one_exchange_with_the_values_of_all_cases(spark, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 90)
    df = panel(spark).withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    got = I.with_permuted(df, "id", ["c", "a"], 3, 400)
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan
    p = df.withColumn("b", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(5))).toPandas()
    found = {r.id: r for r in got.collect()}
    assert len(found) == 400 and None in found
    for _, part in p.groupby("b"):
        part = part[["id", "c", "a"]].astype(object).where(part.notna(), None).sort_values("id", na_position="first", key=lambda s: s.astype(float))
        if part.id.isna().any():
            continue  # a missing key has its own order
        ids = [int(i) for i in part.id]
        for f, r, source in I.permutations([str(i) for i in ids], ids, ["c", "a"], 3):
            for i, s in zip(ids, source):
                assert found[i][f"__v{['c', 'a'].index(f)}"][r] == part[f].iloc[s]


def test_spark_ml_importance_equals_predictions_of_permuted_rows(spark):
    df = panel(spark)
    model = ML.fit_price_model(df, "y", ["c", "a"], ["c"], ["a"], "glm_gamma")
    got = {r.feature: r.importance_mean for r in ML.permutation_importance(model, df, "id", 2).collect()}
    p = df.toPandas()
    r2 = lambda rows: (lambda s: 1 - ((s.y - s.prediction) ** 2).sum() / ((s.y - s.y.mean()) ** 2).sum())(ML.predict(model, rows).toPandas())
    base, drops = r2(df), {}
    for f, _, source in I.permutations([str(i) for i in p.id], list(p.id), ["c", "a"], 2):
        q = p[["id", "a", "c", "e", "y"]].copy()
        q[f] = p[f].to_numpy()[source]
        drops.setdefault(f, []).append(base - r2(spark.createDataFrame([(int(i), None if a != a else float(a), c if isinstance(c, str) else None, e, float(y)) for i, a, c, e, y in q.itertuples(index=False)], df.schema)))
    assert all(np.isclose(got[f], np.mean(d)) for f, d in drops.items()) and set(got) == set(drops)
