import random

from pyspark.sql import functions as F

from quotelens.operators import demand as Q
from quotelens.operators.metrics import binary_metrics
from quotelens.spec import PanelSpec

SPEC = PanelSpec(date_column="day", id_columns=("ref",), own_premium_column="own", conversion_column="conv", categorical_columns=("kind",),
                 numeric_columns=("age",), demand_minimum_rows=50, demand_test_fraction=0.25)


def history(spark, n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        own, anchor, kind = rng.uniform(50, 150), rng.uniform(50, 150), rng.choice(["p", "q", None])
        likely = 1 / (1 + 2.7 ** ((own - anchor) / 30 - (kind == "p")))
        rows.append((i, f"2024-01-{1 + i * 28 // n:02d}", own, int(rng.random() < likely), anchor, kind, rng.choice([20.0, 40.0, None])))
    rows.append(rows[7])
    df = spark.createDataFrame(rows, "ref long, day string, own double, conv int, market_anchor double, kind string, age double")
    return df.withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_both_models_share_one_preparation_and_equal_single_fits(spark, monkeypatch):
    hist, calls, plain = history(spark), [], Q.category_levels
    monkeypatch.setattr(Q, "category_levels", lambda *a: calls.append(a[0]) or plain(*a))
    metrics, improvement = Q.demand_diagnostic(hist, SPEC)
    assert len(calls) == 1
    assert set(calls[0].columns) <= {"ref", "day", "kind", "age", "__conv", "log_own_premium", "log_market_anchor", Q.PART}
    got = {r.model: r for r in metrics.collect()}
    cut = Q.chronological_cut(Q.usable_rows(hist, SPEC), SPEC)
    train, test = (cut.where(F.col(Q.PART) == part) for part in ("train", "test"))
    for name, extra in (("baseline", []), ("with_market_anchor", ["log_market_anchor"])):
        scored = Q.fit_and_score(train, test, ["age", "log_own_premium", *extra], ["kind"])
        want = binary_metrics(scored, "__conv", "p_convert").first()
        assert all(abs(got[name][c] - want[c]) < 1e-9 for c in want.asDict())
    assert improvement.first().incremental_log_loss_improvement > 0
