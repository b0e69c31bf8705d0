import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import elapsed_days
from quotelens.functions.quantiles import grouped_quantiles, kth_smallest, quantiles
from quotelens.operators import demand as Q
from quotelens.operators import models as ML
from quotelens.operators import views as V
from quotelens.sources import manifest as G
from quotelens.spec import PanelSpec

SPEC = PanelSpec(date_column="day", id_columns=("ref",), demand_test_fraction=0.2)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_days_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-31 00:00:00", "2024-04-01 00:00:00"), ("2024-11-03 00:30:00", "2024-11-04 00:29:59.999999")], "a string, b string")
        got = df.select(elapsed_days(F.col("b").cast("timestamp_ntz"), F.col("a").cast("timestamp_ntz")).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.n for r in got] == [1, 0]


@pytest.mark.parametrize("ident", [lambda i: f"Q42-{i:06d}", lambda i: 2 ** 53 + i])
def test_chronological_cut_ranks_ids_in_their_own_type(spark, ident):
    rows = [(ident(i), dt.datetime(2030, 1, 1 + i // 200)) for i in range(600)]
    cut = Q.chronological_cut(spark.createDataFrame(rows, f"ref {'string' if isinstance(rows[0][0], str) else 'long'}, day timestamp_ntz").repartition(3), SPEC)
    got = {r.ref for r in cut.where(F.col(Q.PART) == "train").collect()}
    assert got == {r for r, _ in rows[:480]}


def test_kth_smallest(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"]], "x string")
    assert [kth_smallest(df, "x", k) for k in (1, 2, 3, 4, 5)] == ["a", "a", "b", "c", None]


def test_quantiles_of_awkward_values(spark):
    values = [5e-324, 1e-323, 0.0, -0.0, 1e308, -1e308, 3.0, 3.0, 3.0] * 9 + [float(i) for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0, 0.1, 0.5, 0.77, 1]
    assert quantiles(df, "x", probs) == pytest.approx(np.quantile(values, probs).tolist())


def test_large_ranges_are_narrowed_on_the_cluster(spark, monkeypatch):
    import quotelens.functions.quantiles as M
    monkeypatch.setattr(M, "SORTED_ROWS", 40)
    rng = np.random.default_rng(4)
    data = {"a": rng.normal(size=3000), "b": np.concatenate([np.full(2000, 7.0), rng.pareto(1.0, 1000)]), "c": np.array([1.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "k string, v double")
    probs = [i / 10 for i in range(11)]
    got = grouped_quantiles(df, "k", "v", probs)
    for k, vs in data.items():
        assert got[k] == pytest.approx(np.quantile(vs, probs).tolist())
    only = df.where("k = 'b'")
    assert quantiles(only, "v", probs) == pytest.approx(np.quantile(data["b"], probs).tolist())


def test_segments_keep_text_of_any_cardinality(spark):
    df = spark.createDataFrame([(f"p{i % 40}", i % 3, i, "one") for i in range(200)], "postcode string, level int, number int, flat string")
    got = {r["column"]: r.n_distinct for r in V.segment_columns(df, set()).collect()}
    assert got == {"postcode": 40, "level": 3, "flat": 1}


def test_few_values_and_no_values_keep_the_schema(spark):
    df = spark.createDataFrame([(float(i % 3), 1.0) for i in range(30)], "x double, y double")
    extra = {"n": F.count("*"), "m": F.avg("y")}
    bands = V.quantile_bands(df, "x", 10, extra)
    assert {r.band for r in bands.collect()} <= {0, 1, 2} and bands.agg(F.sum("n")).first()[0] == 30
    none = V.quantile_bands(df.where("false"), "x", 10, extra, min_rows=20)
    assert none.columns == bands.columns and none.count() == 0
    assert V.equal_width_bins(df.where("false"), "x", 4, extra).columns == V.equal_width_bins(df, "x", 4, extra).columns
    metrics, improvement = Q.demand_diagnostic(spark.createDataFrame([], "ref string, day timestamp_ntz, own double, conv int, market_anchor double"),
                                               SPEC.with_(own_premium_column="own", conversion_column="conv"))
    assert metrics.count() == 0 and "brier" in metrics.columns and improvement.first().status == "insufficient_data"


def test_fill_values(spark):
    df = spark.createDataFrame([("O'Brien", 1.0), ("O'Brien", 3.0), ("a", 10.0), (None, None), ("a", 100.0), ("b\\", None)], "c string, v double")
    assert ML.category_levels(df, ["c"])["c"] == ("O'Brien", 3)
    statement = ML.fill_statement(df, ["c"], ["v"], {"c": "O'Brien"}, "f_", "f_").replace("__THIS__", "fill_in")
    df.createOrReplaceTempView("fill_in")
    assert [(r.f_c, r.f_v) for r in spark.sql(statement).where("c is null").collect()] == [("O'Brien", 6.5)]
    assert ML.category_levels(df.select(F.lit(None).cast("string").alias("c")), ["c"]) == {"c": (None, 0)}


def frame_of(spark, n, levels):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        load, k = float(rng.uniform(1, 9)), i % levels
        rows.append((i, f"k{k}", load, float(100 + 20 * load + 3 * (k % 5) + rng.normal()), i % 5 == 0))
    return spark.createDataFrame(rows, "ref long, kind string, load double, y double, held boolean")


@pytest.mark.parametrize("kind", ["glm_gamma", "gbt_log", "gbt_log1p", "rf"])
def test_every_estimator_fits_saves_and_loads(spark, tmp_path, kind):
    """A hundred levels of one category, and predictions that survive a round trip."""
    df = frame_of(spark, 600, 100)
    small = {"glm_gamma": {}, "rf": {"numTrees": 5}}.get(kind, {"maxIter": 8})
    indicator = "held" if kind.startswith("gbt") else None
    model = ML.fit_price_model(df, "y", ["kind", "load"], ["kind"], ["load"], kind=kind, params=small, validation_indicator=indicator)
    scored = ML.predict(model, df)
    worst = scored.agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)).alias("e"), F.var_pop("y").alias("v")).first()
    assert 1 - worst.e / worst.v > 0.5
    ML.save_model(model, str(tmp_path / "m"))
    again = ML.predict(ML.load_model(spark, str(tmp_path / "m")), df)
    pairs = scored.select("ref", "prediction").join(again.select("ref", F.col("prediction").alias("p")), "ref")
    assert pairs.where("abs(prediction - p) > 1e-9").count() == 0


def test_importance_uses_all_rows_and_constant_features_count_nothing(spark):
    df = frame_of(spark, 500, 4).withColumn("flat", F.lit(1.0))
    model = ML.fit_price_model(df, "y", ["kind", "load", "flat"], ["kind"], ["load", "flat"], kind="rf", params={"numTrees": 5})
    got = {r.feature: r for r in ML.permutation_importance(model, df, "ref", repeats=2).collect()}
    assert got["load"].importance_mean > 0.5 and abs(got["flat"].importance_mean) < 1e-9


def test_lost_and_swapped_artifacts_show(spark, tmp_path):
    root = tmp_path / "art"
    root.mkdir()
    for name, text in (("a.txt", "one"), ("b.txt", "two")):
        (root / name).write_text(text)
    listed = spark.createDataFrame(G.artifact_manifest(spark, {"art": str(root)}).collect())
    status = lambda: G.verify_manifest(spark, listed, {"art": str(root)}).first().status
    assert status() == "verified"
    (root / "a.txt").write_text("two")
    (root / "b.txt").write_text("one")
    assert status() == "mismatch"
    moved = {"art": str(tmp_path / "elsewhere")}
    assert G.verify_manifest(spark, listed, moved).first().status == "missing"
    with pytest.raises(ValueError):
        G.require_verified(spark, listed, "art", moved["art"])
    assert os.path.exists(root)
