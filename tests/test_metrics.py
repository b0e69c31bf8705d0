import math

from quotelens.operators.metrics import gini, lift_table, regression_metrics


def _frame(spark, actual, pred):
    return spark.createDataFrame([(i, float(a), float(p)) for i, (a, p) in enumerate(zip(actual, pred))],
                                 "id long, y double, p double")


def test_gini_is_one_for_perfect_order(spark):
    df = _frame(spark, [1, 2, 3, 4], [1, 2, 3, 4])
    assert gini(df, "y", "p", tiebreak="id").first().gini == 1.0


def test_gini_is_scale_invariant(spark):
    a = gini(_frame(spark, [1, 2, 3, 4], [1, 2, 3, 4]), "y", "p", tiebreak="id").first().gini
    b = gini(_frame(spark, [1, 2, 3, 4], [10, 20, 30, 40]), "y", "p", tiebreak="id").first().gini
    assert a == b


def test_regression_metrics_match_direct_formulas(spark):
    y = [100.0, 200.0, 150.0, 120.0, 90.0]
    p = [110.0, 190.0, 160.0, 100.0, 95.0]
    r = regression_metrics(_frame(spark, y, p), "y", "p", tiebreak="id").first()
    n = len(y)
    rmse = math.sqrt(sum((b - a) ** 2 for a, b in zip(y, p)) / n)
    mape = sum(abs((a - b) / a) for a, b in zip(y, p)) / n * 100
    m = sum(y) / n
    dev = sum(2 * (math.log(b / a) + a / b - 1) for a, b in zip(y, p))
    dev0 = sum(2 * (math.log(m / a) + a / m - 1) for a in y)
    assert abs(r.rmse - rmse) < 1e-9
    assert abs(r.mape - mape) < 1e-9
    assert abs(r.d2 - (1 - dev / dev0)) < 1e-9
    assert r.n == 5


def test_lift_table_buckets_cover_all_rows(spark):
    df = _frame(spark, list(range(1, 101)), list(range(1, 101)))
    rows = lift_table(df, "y", "p", 10).collect()
    assert sum(r.n for r in rows) == 100
    assert len(rows) == 10
