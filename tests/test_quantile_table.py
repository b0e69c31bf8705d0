import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelens.functions.quantiles import quantile_table
from quotelens.operators import drift as D

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def test_equals_numpy_for_groups_of_all_sizes(spark):
    rng = random.Random(3)
    rows = [("hot", 1, float(rng.choice([5, 5, 5, rng.gauss(0, 9)]))) for _ in range(4000)]
    rows += [(f"g{i}", i % 3, rng.uniform(-1, 1)) for i in range(300) for _ in range(rng.randint(1, 6))]
    rows += [(None, 0, 2.5), (None, 0, -1.0), ("nan", 0, float("nan")), ("null", 0, None), ("one", 0, 7.0)]
    df = spark.createDataFrame(rows, "a string, b int, x double").repartition(5)
    groups = {}
    for a, b, x in rows:
        if x is not None and x == x:
            groups.setdefault((a, b), []).append(x)
    got = {(r.a, r.b): r for r in quantile_table(df, ["a", "b"], "x", PROBS).collect()}
    assert got.keys() == groups.keys()
    for k, xs in groups.items():
        assert np.allclose(got[k].q, np.quantile(xs, PROBS), atol=1e-12)
        assert (got[k].n, got[k].lo, got[k].hi, got[k].distinct) == (len(xs), min(xs), max(xs), len(set(xs)))


def test_weights_are_occurrences(spark):
    rows = [("g", 1.0, 3), ("g", 4.0, 1), ("g", 9.0, 2)]
    got = quantile_table(spark.createDataFrame(rows, "g string, x double, n int"), ["g"], "x", PROBS, "n").first()
    assert got.q == pytest.approx(np.quantile([1, 1, 1, 4, 9, 9], PROBS)) and got.n == 6


def test_hundred_thousand_groups(spark):
    df = spark.range(400_000).select((F.col("id") % 100_000).alias("g"), (F.col("id") / 100_000).cast("int").cast("double").alias("x"))
    out = quantile_table(df, ["g"], "x", [0.5])
    r = out.agg(F.count("*").alias("n"), F.min(F.get("q", F.lit(0))).alias("lo"), F.max(F.get("q", F.lit(0))).alias("hi")).first()
    assert (r.n, r.lo, r.hi) == (100_000, 1.5, 1.5)


def test_empty(spark):
    assert quantile_table(spark.createDataFrame([], "g string, x double"), ["g"], "x", [0.5]).count() == 0


def frames(spark):
    rng = random.Random(5)
    old = [(rng.gauss(0, 1), float(rng.randint(0, 1)), rng.choice("ab"), None) for _ in range(800)]
    new = [(rng.gauss(.5, 1), float(rng.randint(0, 1)), rng.choice("abc"), 1.0) for _ in range(300)]
    schema = "x double, flag double, c string, empty double"
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


def test_profile_gives_the_drift_without_the_reference(spark, tmp_path):
    old, new = frames(spark)
    old.write.parquet(str(tmp_path / "old"))
    profile = D.reference_profile(spark.read.parquet(str(tmp_path / "old")), ["x", "flag", "empty"], ["c"])
    assert not any("/old/" in f for f in D.drift_from_profile(profile, new, ["x", "flag", "c"]).inputFiles())
    got = {r.feature: r for r in D.profile_drift_table(profile, new, ["x", "flag", "empty", "c", "gone"]).collect()}
    want = {r.feature: r.psi for r in D.drift_psi(old, new, ["x", "flag", "empty"], ["c"]).collect()}
    assert {f: got[f].psi for f in ("x", "flag", "c")} == pytest.approx({f: want[f] for f in ("x", "flag", "c")}) and want["empty"] == 0
    assert got["gone"].status == "missing" and got["empty"].status == "missing" and got["x"].psi > .1
    types = {(r.feature, r.type, r.edges is None) for r in profile.select("feature", "type", "edges").distinct().collect()}
    assert types == {("x", "numeric", False), ("flag", "numeric", True), ("c", "categorical", True)}


def test_profiles_of_equal_edges_merge(spark):
    old, new = frames(spark)
    profile = D.reference_profile(old, ["x"], ["c"])
    rules = D.profile_rules(profile)
    count = lambda df: D.label_counts(df, rules)
    merged = count(old).unionByName(count(new)).groupBy("feature", "label").agg(F.sum("n").alias("n"))
    whole = count(old.unionByName(new)).select("feature", "label", "n")
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
