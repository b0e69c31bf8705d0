import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelens.operators import basket as B
from quotelens.operators.anchors import historical_features, historical_summary, score_anchor
from quotelens.operators.models import PriceModel
from quotelens.spec import PanelSpec, TargetSpec


def test_basket_holds_every_profile(spark):
    rows = [(f"t{i % 7}", f"u{i % 90:02d}", float(i)) for i in range(900)] + [(None, "u00", None)]
    df = spark.createDataFrame(rows, "tariff string, town string, load double")
    got = B.reference_basket(df, ["tariff", "town"], ["load"]).collect()
    assert len(got) == 7 * 90 * 3 and len({(r.tariff, r.town, r["load"]) for r in got}) == len(got)
    assert sorted(r.basket_id for r in got) == list(range(len(got)))
    first = min(got, key=lambda r: r.basket_id)
    assert (first.tariff, first.town, first["load"]) == ("t0", "u00", 224.8)  # 899 / 4, half-even


def test_basket_without_known_columns(spark):
    assert B.reference_basket(spark.range(4), ["tariff"], ["load"]).count() == 0


def test_index_has_a_row_for_each_month(spark):
    basket = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "load double")
    cells = spark.createDataFrame([(1.0, 50.0), (2.0, 70.0), (9.0, -4.0)], "load double, __cell_mean double")
    model = PriceModel(kind="segment_mean", features=["load"], categorical=[], numeric=["load"], target="y",
                       params={"cells": ["load"]}, cells=cells, global_mean=None)
    dated = spark.createDataFrame([(dt.datetime(2030, 11, 30),), (dt.datetime(2031, 2, 1),)], "day timestamp_ntz")
    idx = B.basket_index(basket, model, dated, "day").orderBy("quote_month").collect()
    assert [str(r.quote_month) for r in idx] == ["2030-11-01", "2030-12-01", "2031-01-01", "2031-02-01"]
    assert all((r.mean_prediction, r.n_profiles) == (40.0, 4) for r in idx)  # the negative price counts 0, a missing one stays missing


SPEC = PanelSpec(date_column="day", id_columns=("ref",), own_premium_column="offer", categorical_columns=("zone",), numeric_columns=("load",),
                 target=TargetSpec(name="y"), min_train_rows=20, lookback_months=2)


def history(spark, targets):
    """One quote every 12 hours over five months; the target is given by day number."""
    rows = [(f"r{i:03d}", dt.datetime(2031, 1, 1) + dt.timedelta(hours=12 * i), "pq"[i % 2], float(i % 9), 400.0, targets(i // 2)) for i in range(300)]
    return spark.createDataFrame(rows, "ref string, day timestamp_ntz, zone string, load double, offer double, y double")


def test_anchors_see_earlier_months_only(spark):
    hist = historical_features(history(spark, lambda day: 100.0 if day < 59 else 200.0), SPEC, cells=["zone"]).cache()
    by_month = {r.m: r for r in hist.groupBy(F.trunc("day", "month").cast("string").alias("m")).agg(
        F.min("market_anchor").alias("lo"), F.max("market_anchor").alias("hi"), F.max("anchor_training_cutoff").alias("cut")).collect()}
    assert by_month["2031-01-01"].lo is None
    assert (by_month["2031-03-01"].lo, by_month["2031-03-01"].hi) == pytest.approx((100.0, 100.0))  # March is 200, seen from April on
    assert by_month["2031-04-01"].lo > 100 and by_month["2031-05-01"].lo == pytest.approx(200)
    assert all(r.cut is None or str(r.cut)[:10] < m for m, r in by_month.items())


def test_summary_counts_months_even_with_one_training_cutoff(spark):
    """Without targets in March, March and April share their last training date."""
    hist = historical_features(history(spark, lambda day: None if 59 <= day < 90 else 100.0), SPEC, cells=["zone"])
    got = historical_summary(hist, "day").first()
    assert (got.periods_scored, got.rows_total, got.rows_scored + got.rows_warmup_unscored) == (4, 300, 300)


def test_missing_prediction_stays_missing(spark):
    model = PriceModel(kind="segment_mean", features=["zone"], categorical=["zone"], numeric=[], target="y", params={"cells": ["zone"]},
                       cells=spark.createDataFrame([("p", 80.0)], "zone string, __cell_mean double"), global_mean=None)
    got = score_anchor(history(spark, lambda day: 1.0).limit(2), SPEC, model).orderBy("ref").collect()
    assert [(r.market_anchor, r.relative_price_ratio) for r in got] == [(80.0, 5.0), (None, None)]
