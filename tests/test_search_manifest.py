import hashlib
import random

from pyspark.sql import functions as F

from quotelens.operators import search as S
from quotelens.operators import views as V
from quotelens.sources import manifest as G


def panel(spark, n=240):
    rng = random.Random(7)
    rows = [(i, a := rng.uniform(0, 3), 100 * 2.7 ** (.3 * a) * rng.uniform(.9, 1.1)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, y double").withColumn("d", F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, cast(id as int))"))
    return df.where("id % 4 > 0"), df.where("id % 4 = 0")


def test_draws_follow_seed_and_ranges():
    space = {"a": ("log", 1e-4, 1.0), "b": ("log_int", 2, 50), "c": ("int", 3, 5), "d": ("choice", 7, 9), "e": ("linear", -1.0, 1.0)}
    sets = S.draw(space, 200, 1)
    assert sets[:20] == S.draw(space, 20, 1) and sets != S.draw(space, 200, 2)
    assert all(1e-4 <= s["a"] <= 1 and 2 <= s["b"] <= 50 and s["c"] in (3, 4, 5) and s["d"] in (7, 9) and -1 <= s["e"] <= 1 for s in sets)
    assert sum(s["a"] < 1e-2 for s in sets) > 60 and {s["c"] for s in sets} == {3, 4, 5} and all(isinstance(s["b"], int) for s in sets)


def test_rungs_keep_the_best_on_growing_shares(spark):
    train, validation = panel(spark)
    out = S.halving_search(train, validation, "y", ["a"], [], ["a"], "gamma_boost", "d", space={"rounds": ("int", 1, 12)}, trials=4, keep=.5, rungs=2, key="id")
    rows = sorted(out.collect())
    first, second = [r for r in rows if r.rung == 0], [r for r in rows if r.rung == 1]
    assert len(first) == 4 and len(second) == 2 and {r.share for r in second} == {1.0}
    best = {r.trial for r in sorted(first, key=lambda r: (r.value, r.trial))[:2]}
    assert {r.trial for r in second} == best
    top = min(second, key=lambda r: (r.value, r.trial))
    assert S.best_params(out) == S.draw({"rounds": ("int", 1, 12)}, 4, 42)[top.trial]


def test_share_is_the_latest_rows(spark):
    train, _ = panel(spark)
    part = S.latest_share(train, "d", 1 / 3)
    ids = sorted(r.id for r in train.collect())
    assert sorted(r.id for r in part.collect()) == ids[-60:]


def test_search_stops_at_its_limit(spark):
    train, validation = panel(spark)
    ticks = iter(range(1000))
    out = S.halving_search(train, validation, "y", ["a"], [], ["a"], "gamma_boost", "d", space={"rounds": ("int", 1, 2)}, trials=6, rungs=3, key="id",
                           seconds=3, workers=1, clock=lambda: next(ticks))
    assert out.count() == 2 and S.best_params(out)
    none = S.halving_search(train, validation, "y", ["a"], [], ["a"], "gamma_boost", "d", space={"rounds": ("int", 1, 2)}, trials=2, seconds=0, clock=lambda: 0)
    assert none.count() == 0 and S.best_params(none) == {}


def plain_tree(data, record):
    parts = [hashlib.sha256(data[i:i + record]).hexdigest() for i in range(0, len(data), record)]
    return hashlib.sha256(f"{len(data)}:{':'.join(parts)}".encode()).hexdigest()


def test_tree_of_files_of_any_size(spark, tmp_path):
    rng = random.Random(1)
    sizes = [1, 99, 100, 101, 250, 1000, 4096, 12345]
    data = {f"f{n}.bin": rng.randbytes(n) for n in sizes}
    root = tmp_path / "run"
    root.mkdir()
    for name, raw in data.items():
        (root / name).write_bytes(raw)
    want = {name: (plain_tree(raw, 100), len(raw)) for name, raw in data.items()}
    for whole in (10_000_000, 100, 0):  # files above it are read by ranges
        assert {r.name.lstrip("/"): (r.sha256, r.bytes) for r in G.file_hashes(spark, str(root), 100, whole).collect()} == want
    big = data["f12345.bin"]
    for changed in (big[:5000] + bytes([big[5000] ^ 1]) + big[5001:], big[:100] + big[200:300] + big[100:200] + big[300:], big[:-1], big + b"\0"):
        (root / "f12345.bin").write_bytes(changed)
        got = {r.name.lstrip("/"): r.sha256 for r in G.file_hashes(spark, str(root), 100, 200).collect()}
        assert got["f12345.bin"] == plain_tree(changed, 100) != want["f12345.bin"][0]


def test_scatter_points_are_the_smallest_hashes(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"), F.lit(1.0).alias("x"))
    got = {(r.g, r.id) for r in V.scatter_points(df, "id", ["x"], ["g"], 50).collect()}
    want = {(g, i) for g in (0, 1) for i in sorted((i for i in range(3000) if i % 2 == g), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:50]}
    assert got == want
    plan = V.scatter_points(df, "id", ["x"], ["g"], 50)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
