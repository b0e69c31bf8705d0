"""Seeded random parameter search by successive halving on the time-ordered validation part.

Parameter sets are drawn from ranges by a seed. The first rung fits all of them on the latest share of the training
rows, and each further rung keeps the best part and fits it on a larger share, up to all rows; every fit is scored on
the whole validation part. The rows are written once and shares are cuts by date (exact order statistics), so a fit
reads what it needs; fits of a rung run as concurrent Spark jobs. A time limit lets running fits end but starts no
other one; the best set then comes from the highest rung that has a result.
"""

from __future__ import annotations

import json
import math
import random
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.functions.nullsafe import ntz_at, ntz_micros
from quotelens.functions.quantiles import order_statistics
from quotelens.operators.models import fit_price_model, predict
from quotelens.session import materialize

#: Ranges by estimator: kind of range, least, greatest value (or the choices).
SPACES = {
    "glm_gamma": {"regParam": ("log", 1e-6, 0.3)},
    "gamma_boost": {"depth": ("int", 2, 5), "rate": ("log", 0.05, 0.4), "l2": ("log", 0.01, 30.0), "min_rows": ("log_int", 5, 100), "bins": ("choice", 32, 64)},
    "tweedie_boost": {"power": ("linear", 1.1, 1.9), "depth": ("int", 2, 5), "rate": ("log", 0.05, 0.4), "l2": ("log", 0.01, 30.0)},
    "gbt_log": {"maxDepth": ("int", 2, 6), "stepSize": ("log", 0.03, 0.3), "minInstancesPerNode": ("log_int", 1, 50)},
    "rf": {"numTrees": ("log_int", 20, 120), "maxDepth": ("int", 4, 10), "minInstancesPerNode": ("log_int", 1, 50)},
}
MAXIMISED = ("d2", "gini", "r2")
COLUMNS = "trial int, rung int, share double, params string, value double, metric string, direction string"


def draw(space: dict, n: int, seed: int) -> list[dict]:
    """n parameter sets; the i-th depends on the seed and i only."""
    out = []
    for i in range(n):
        rng = random.Random(f"{seed}:{i}")
        one = {}
        for name in sorted(space):
            kind, *bounds = space[name]
            if kind == "choice":
                one[name] = rng.choice(bounds)
            elif kind == "int":
                one[name] = rng.randint(*bounds)
            elif kind == "linear":
                one[name] = rng.uniform(*bounds)
            else:
                v = math.exp(rng.uniform(math.log(bounds[0]), math.log(bounds[1])))
                one[name] = min(max(round(v), bounds[0]), bounds[1]) if kind == "log_int" else v
        out.append(one)
    return out


def latest_share(train: DataFrame, date_column: str, share: float) -> DataFrame:
    """The rows from the date on at which the latest share begins; rows of that date are all in."""
    if share >= 1:
        return train
    at = ntz_micros(F.col(date_column))
    cut, n = order_statistics(train, at, lambda n: [max(1, math.floor(n * (1 - share)) + 1)])
    return train.where(F.col(date_column).cast("timestamp_ntz") >= ntz_at(next(iter(cut.values())))) if n else train


def halving_search(train: DataFrame, validation: DataFrame, target: str, features, categorical, numeric, kind: str, date_column: str,
                   space: dict | None = None, trials: int = 9, keep: float = 1 / 3, rungs: int = 3, seed: int = 42, metric: str = "mape",
                   weight: str | None = None, key: str | None = None, seconds: float | None = None, workers: int = 3, clock=time.monotonic) -> DataFrame:
    """All results (trial, rung, share, params, value, metric, direction). Shares fall by ``keep`` from the last rung, that has all rows."""
    from quotelens.operators.metrics import regression_metrics
    spark, began, sign = train.sparkSession, clock(), -1 if metric in MAXIMISED else 1
    need = list(dict.fromkeys([*features, target, date_column, *([weight] if weight else []), *([key] if key else [])]))
    train, validation = materialize(train.select(*need), "search-train"), materialize(validation.select(*need), "search-validation")
    sets = dict(enumerate(draw(space or SPACES[kind], trials, seed)))
    results: list[tuple] = []
    for rung in range(rungs):
        share = keep ** (rungs - 1 - rung)
        rows = latest_share(train, date_column, share)

        def fit(trial: int):
            if seconds is not None and clock() - began >= seconds:
                return None
            model = fit_price_model(rows, target, features, categorical, numeric, kind=kind, weight=weight, params=sets[trial], date_column=date_column)
            value = regression_metrics(predict(model, validation, "__ps"), target, "__ps", tiebreak=key).first()[metric]
            return trial, rung, share, json.dumps(sets[trial], sort_keys=True), None if value is None else float(value), metric, "maximize" if sign < 0 else "minimize"

        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            done = [r for r in pool.map(inheritable_thread_target(spark)(fit), sorted(sets)) if r]
        results += done
        if len(done) < len(sets):
            break
        ranked = sorted(done, key=lambda r: (r[4] is None, sign * (r[4] or 0.0), r[0]))
        sets = {r[0]: sets[r[0]] for r in ranked[:max(1, math.ceil(len(ranked) * keep))]}
    return spark.createDataFrame(results, COLUMNS)


def best_params(results: DataFrame) -> dict:
    """Parameters of the best result of the highest rung (first trial among equals); empty without results."""
    rows = [r for r in results.collect() if r.value is not None]  # one row a fit
    if not rows:
        return {}
    sign = -1 if rows[0].direction == "maximize" else 1
    return json.loads(min(rows, key=lambda r: (-r.rung, sign * r.value, r.trial)).params)
