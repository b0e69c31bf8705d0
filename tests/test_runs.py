import datetime as dt

import numpy as np
import pytest

from quotelens.plans import runs as R
from quotelens.spec import PanelSpec, TargetSpec

SPEC = PanelSpec(date_column="day", id_columns=("ref",), own_premium_column="offer", conversion_column="sold", competitor_columns=("x1", "x2", "x3"),
                 categorical_columns=("zone",), numeric_columns=("power",), comparability_columns=("zone",), segment_columns=("zone",),
                 target=TargetSpec(name="cheapest_two", top_n=2), top_ns=(2,), min_train_rows=50, demand_minimum_rows=100, importance_repeats=1)
SCHEMA = "ref long, day timestamp_ntz, zone string, power double, offer double, sold int, x1 double, x2 double, x3 double"


def quotes(spark, n, first, shift=0.0):
    rng = np.random.default_rng(n)
    rows = []
    for i in range(n):
        zone = "nesw"[i % 4]
        base = 200 + 40 * "nesw".index(zone) + shift
        p = [float(base + rng.normal(0, 3)) for _ in range(3)]
        rows.append((i, first + dt.timedelta(hours=6 * i), zone, float(i % 11) + shift, float(base + rng.normal(0, 10)), int(rng.uniform() < 0.4), *p[:2], None if i % 7 == 3 else p[2]))
    return spark.createDataFrame(rows, SCHEMA)


def test_train_score_and_monitor(spark, tmp_path):
    run, old = str(tmp_path / "run"), quotes(spark, 900, dt.datetime(2031, 1, 1))
    checks = {r.check: r for r in R.train(spark, old, SPEC, run, kind="segment_mean", cells=["zone"]).collect()}
    assert len(checks) == 18 and all(r.value is not None for r in checks.values())
    assert all(checks[c].passed for c in ("data_contract_valid", "time_based_split", "model_export_available", "runtime_budget", "leakage_review", "validation_d2_threshold"))

    scored = R.score(spark, old.limit(8), SPEC, run)
    assert scored.count() == 8 and scored.where("market_anchor is null or anchor_model_sha256 is null").count() == 0

    same = R.monitor(spark, quotes(spark, 300, dt.datetime(2031, 8, 14)), SPEC, run, old)
    assert same["coverage_drops"].where("coverage_drop > 0.01").count() == 0
    moved = R.monitor(spark, quotes(spark, 300, dt.datetime(2032, 6, 1), shift=50.0), SPEC, run, old)
    assert {"drift", "horizon", "d2"} <= {r.trigger for r in moved["reasons"].collect()}

    (tmp_path / "run" / "production_model" / "added.txt").write_text("not of the run")
    with pytest.raises(ValueError):
        R.score(spark, old, SPEC, run)
