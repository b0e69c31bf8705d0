import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from quotelens.operators import anchors as A
from quotelens.operators import batched_glm as G
from quotelens.operators import models as ML
from quotelens.operators.splits import time_split
from quotelens.spec import PanelSpec

SPEC = PanelSpec(date_column="d", id_columns=("id",), competitor_columns=("p", "q", "r"), categorical_columns=("c",), numeric_columns=("a", "b"),
                 min_train_rows=20, lookback_months=3).with_()


def panel(spark, n=900, seed=4, target="avg_top_3_competitor_premium"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(50, 20), rng.uniform(-1, 1), rng.choice("xyz")
        mu = math.exp(5 + .01 * a - .3 * b + {"x": 0, "y": .2, "z": -.1}[c])
        y = rng.gammavariate(30, mu / 30)
        prices = [None if rng.random() < .15 else y * k for k in (.9, 1.1, 1.3)]
        rows.append((i, dt.datetime(2020, 1, 1) + dt.timedelta(days=i * 300 / n, hours=i % 24), a, None if i % 11 == 0 else b, c, y, *prices))
    return spark.createDataFrame(rows, f"id long, d timestamp_ntz, a double, b double, c string, {target} double, p double, q double, r double")


def spark_ml(train, score, target, weight, power=2.0):
    """The same model by Spark ML on a design of full rank."""
    cols = {"a0": F.col("a"), "b0": F.coalesce("b", F.lit(0.0)), "b1": F.col("b").isNull().cast("double"), "y0": (F.col("c") == "y").cast("double"), "z0": (F.col("c") == "z").cast("double")}
    assembler = VectorAssembler(inputCols=list(cols), outputCol="x")
    family = {"family": "gamma", "link": "log"} if power == 2.0 else {"family": "tweedie", "variancePower": power, "linkPower": 0.0}
    glm = GeneralizedLinearRegression(featuresCol="x", labelCol=target, weightCol=weight, maxIter=60, tol=1e-12, **family)
    fit = glm.fit(assembler.transform(train.withColumns(cols)))
    return {r.id: r.prediction for r in fit.transform(assembler.transform(score.withColumns(cols))).select("id", "prediction").collect()}


def test_months_equal_fits_month_by_month(spark):
    df = panel(spark)
    got = A.rolling_glm_anchor(df, SPEC, ["c"], ["a", "b"]).select("id", "d", "market_anchor", "anchor_training_rows", "anchor_training_start", "anchor_training_cutoff").collect()
    t = SPEC.target_column
    rows = df.toPandas()
    for month in (3, 6, 10):
        p = dt.datetime(2020, month, 1)
        lo = dt.datetime(2020, max(1, month - 3), 1) if month > 3 else dt.datetime(2019, 12, 1)
        age = F.floor(F.datediff(F.lit(p), F.to_date("d")).cast("double") - F.hour("d") / 24.0)
        train = df.where((F.col("d") >= F.lit(lo)) & (F.col("d") < F.lit(p))).withColumn("w", F.pow(F.lit(.5), F.greatest(age, F.lit(0.0)) / 60.0))
        of_month = df.where((F.col("d") >= F.lit(p)) & (F.month("d") == month))
        want = spark_ml(train, of_month, t, "w")
        mine = {r.id: r for r in got if r.d >= p and r.d.month == month}
        assert mine.keys() == want.keys() and want
        assert max(abs(mine[i].market_anchor / want[i] - 1) for i in want) < 1e-6
        window = rows[(rows.d >= lo) & (rows.d < p)]
        r = next(iter(mine.values()))
        assert (r.anchor_training_rows, r.anchor_training_start, r.anchor_training_cutoff) == (len(window), window.d.min(), window.d.max())
    assert all(r.market_anchor is None for r in got if r.d.month == 1)


def test_jobs_do_not_grow_with_the_months(spark):
    def jobs(df):
        group = f"count-{random.random()}"
        spark.sparkContext.setJobGroup(group, group)
        A.rolling_glm_anchor(df, SPEC, ["c"], ["a"]).count()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    few, many = panel(spark, 300).where("d < '2020-04-01'"), panel(spark, 300)
    assert jobs(many) <= jobs(few) + 8  # iterations differ, months don't count


@pytest.mark.parametrize("power", [2.0, 1.5])
def test_groups_at_once_equal_groups_alone(spark, power, monkeypatch):
    df = panel(spark)
    t = F.col(SPEC.target_column)
    design = G.learn_design(df, ["c"], ["a", "b"])
    members = lambda ks: F.array(*[G.member(F.lit(k), t * (k + 1), F.when(F.col("id") % (k + 2) == 0, 1.0).otherwise(0.3)) for k in ks])
    together = G.fit_groups(df, design, members(range(4)), [0, 1, 2, 3], power)
    monkeypatch.setattr(G, "SENT_BYTES", 8 * len(design.owners))  # one group at a time
    apart = G.fit_groups(df, design, members(range(4)), [0, 1, 2, 3], power)
    for k in range(4):
        assert np.allclose(together[k], apart[k], atol=1e-8)
        want = spark_ml(df.withColumn("y", t * (k + 1)).withColumn("w", F.when(F.col("id") % (k + 2) == 0, 1.0).otherwise(0.3)), df, "y", "w", power)
        got = {r.id: r.m for r in G.predict_groups(df, F.lit(k), design, together, "m").select("id", "m").collect()}
        assert max(abs(got[i] / want[i] - 1) for i in want) < 1e-6


def test_collinear_constant_and_unseen_columns(spark):
    df = panel(spark, 200).withColumn("a2", F.col("a") * 2 + 1).withColumn("one", F.lit(3.0)).withColumn("empty", F.lit(None).cast("double"))
    design = G.learn_design(df, ["c"], ["a", "a2", "one", "empty"])
    t = F.col(SPEC.target_column)
    full = G.fit_groups(df, design, F.array(G.member(F.lit(0), t, F.lit(1.0))), [0, 5])
    assert list(full) == [0]
    lean = G.learn_design(df, ["c"], ["a"])
    plain = G.fit_groups(df, lean, F.array(G.member(F.lit(0), t, F.lit(1.0))), [0])
    x, y = (G.predict_groups(df, F.lit(0), d, b, "m").orderBy("id").toPandas().m for d, b in ((design, full), (lean, plain)))
    assert np.allclose(x, y, rtol=1e-6)
    new = G.predict_groups(df.limit(1).withColumn("c", F.lit("never")), F.lit(0), lean, plain, "m").first().m
    assert min(x) * .5 < new < max(x) * 2
    with pytest.raises(ValueError):
        G.learn_design(spark.range(5000).select(F.col("id").cast("string").alias("c")), ["c"], [])


def test_competitors_in_one_fit(spark, tmp_path):
    df = panel(spark)
    split = time_split(df, SPEC)
    models = ML.fit_competitors(split, ["p", "q", "r"], ["c"], ["a", "b"], SPEC)
    for c in ("p", "q"):
        train = split.where((F.col("_split") == "train") & F.col(c).isNotNull())
        cut = train.agg(F.max("d")).first()[0]
        age = F.floor((F.unix_timestamp(F.lit(cut).cast("timestamp")) - F.unix_timestamp(F.col("d").cast("timestamp"))) / 86400.0)
        want = spark_ml(train.withColumn("w", F.pow(F.lit(.5), age / 60.0)), df, c, "w")
        got = {r.id: r.m for r in ML.predict(models[c], df, "m").select("id", "m").collect()}
        assert max(abs(got[i] / want[i] - 1) for i in want) < 1e-6
        assert models[c].training_rows == train.count()
    met = ML.competitor_models(split, ["p", "q", "r"], ["c", "a", "b"], ["c"], ["a", "b"], SPEC, save_to=str(tmp_path))
    assert {(r.competitor, r._split) for r in met.collect()} == {(c, s) for c in "pqr" for s in ("train", "validation", "test")}
    assert min(r.d2 for r in met.collect()) > .3
    back = ML.load_model(spark, f"{tmp_path}/q/model")
    a, b = (ML.predict(m, df, "m").orderBy("id").toPandas().m for m in (back, models["q"]))
    assert (a == b).all()
