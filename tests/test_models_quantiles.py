import math
import random

import pytest
from pyspark.sql import functions as F

from quotelens.functions.quantiles import order_statistics, quantiles
from quotelens.operators.metrics import regression_metrics
from quotelens.operators.models import fit_price_model, predict


def test_order_statistics_exact_with_ties(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([1.0, 2.0, 2.0, 5.5]) if i % 3 else rnd.random() * 1000 for i in range(30000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    ranks = [1, 17, 9999, 15000, 29999, 30000]
    got, n = order_statistics(df, "x", ranks)
    assert n == len(vals)
    assert all(got[r] == s[r - 1] for r in ranks)


def test_quantiles_match_linear_interpolation(spark):
    vals = [float(v) for v in range(1, 102)] + [7.5, 7.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    for p, q in zip([0.1, 0.25, 0.5, 0.9], quantiles(df, "x", [0.1, 0.25, 0.5, 0.9])):
        pos = p * (len(s) - 1)
        lo = math.floor(pos)
        exp = s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (pos - lo)
        assert abs(q - exp) < 1e-9


def _clean(spark, n=180):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        age = 18 + rnd.random() * 60
        region = "abc"[i % 3]
        y = math.exp(5 + 0.01 * age + {"a": 0.0, "b": 0.2, "c": -0.1}[region]) * (1 + rnd.gauss(0, 0.02))
        rows.append((i, age, region, y, ["train", "validation", "test"][i % 3]))
    return spark.createDataFrame(rows, "id long, driver_age double, region string, y double, _split string")


def test_gamma_glm_fits_clean_data(spark):
    df = _clean(spark)
    m = fit_price_model(df.where(F.col("_split") == "train"), "y", ["region", "driver_age"], ["region"],
                        ["driver_age"], kind="glm_gamma")
    r = regression_metrics(predict(m, df.where(F.col("_split") == "test")), "y", "prediction").first()
    assert r.d2 > 0.5


def test_missing_features_raise(spark):
    df = _clean(spark)
    m = fit_price_model(df, "y", ["region", "driver_age"], ["region"], ["driver_age"], kind="segment_mean",
                        cells=["region"])
    with pytest.raises(ValueError):
        predict(m, df.select("id", "driver_age"))


def test_order_statistics_exact_over_many_passes(spark, monkeypatch):
    import quotelens.functions.quantiles as Qm
    monkeypatch.setattr(Qm, "SORTED_ROWS", 50)
    monkeypatch.setattr(Qm, "DEFAULT_BUCKETS", 8)
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 400)) / 7 for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    ranks = [1, 250, 2500, 2501, 4999, 5000]
    got, _ = Qm.order_statistics(df, "x", ranks, buckets=8)
    assert all(got[r] == s[r - 1] for r in ranks)
