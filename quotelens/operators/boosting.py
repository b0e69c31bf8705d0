"""Second-order histogram boosting on DataFrames, with deviances that Spark ML's trees lack.

Targets are positive (gamma) or non-negative (Tweedie, 1 < power < 2) and the link is the logarithm. Features
are numbers, cut once into bins by exact quantiles of the training rows; bin 0 is a missing value. A level of a
tree is one pass over the rows: each task adds up gradients and Hessians by (node, feature, bin) in numpy and emits
its sums, which one small exchange adds. What reaches the driver is that histogram, of at most
``2 ** depth * features * (bins + 1)`` rows whatever the input. Held-out rows stay out of these passes: every ``CUT``
rounds one pass over them gives the deviance after each of these rounds. Boosting stops at the first round where it
no longer falls, and the trees end with the best round; the rounds begun after that one are dropped.

The rows are read from a written table of bins; every ``CUT`` rounds the margins are written with it, so a pass
evaluates a few trees only and a lost executor costs a reread.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.functions.quantiles import count_below, grouped_quantiles
from quotelens.session import materialize

#: Rounds whose trees are evaluated in each pass before the margins are written.
CUT = 8


@dataclass
class BoostParams:
    power: float = 2.0            # variance power of the deviance: 2 gamma, between 1 and 2 Tweedie
    rounds: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 64
    l2: float = 1.0               # added to every Hessian sum
    min_rows: int = 20            # of a leaf
    patience: int = 6             # rounds without a better validation deviance before the end


@dataclass
class Boosted:
    features: list[str]
    edges: list[list[float]]
    base: float
    power: float
    trees: list[dict] = field(default_factory=list)
    validation: list[float] = field(default_factory=list)  # mean deviance after 0, 1, ... rounds

    def meta(self) -> dict:
        return dict(self.__dict__)


def bin_edges(train: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Distinct inner quantiles of each feature (exact, linear)."""
    long = train.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "f", "x")
    found = grouped_quantiles(long, "f", "x", [i / bins for i in range(1, bins)])
    return [sorted(set(found.get(f, []))) for f in features]


def bin_of(feature: str, edges: list[float]) -> Column:
    """0 for a missing value, else 1 + the number of edges below it."""
    x = f"CAST(`{feature}` AS DOUBLE)"
    return F.expr(f"CAST(CASE WHEN {x} IS NULL OR isnan({x}) THEN 0 ELSE 1 + {count_below(x, edges)} END AS SMALLINT)")


def gradient(power: float, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of half the unit deviance by the margin (the log of the mean)."""
    a, b = y * np.exp((1 - power) * margin), np.exp((2 - power) * margin)
    return b - a, (2 - power) * b - (1 - power) * a


def deviance(power: float, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Unit deviance."""
    mu = np.exp(margin)
    if power == 2.0:
        return 2 * (y / mu - 1 - np.log(y / mu))
    return 2 * (y ** (2 - power) / ((1 - power) * (2 - power)) - y * mu ** (1 - power) / (1 - power) + mu ** (2 - power) / (2 - power))


def tree_values(tree: dict, goes_left, n: int, key: str = "leaf") -> np.ndarray:
    """A tree's value for each of n rows; ``goes_left(node, rows)`` says which of some rows a split sends left."""
    out = np.zeros(n)
    stack = [(tree, np.arange(n))]
    while stack:
        node, rows = stack.pop()
        if "feature" not in node:
            out[rows] = node[key]
        elif len(rows):
            left = goes_left(node, rows)
            stack += [(node["left"], rows[left]), (node["right"], rows[~left])]
    return out


def _by_bin(bins: list[np.ndarray]):
    def goes_left(node: dict, rows: np.ndarray) -> np.ndarray:
        b = bins[node["feature"]][rows]
        left = b <= node["bin"]
        return left if node["missing_left"] else left & (b > 0)
    return goes_left


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, params: BoostParams) -> dict | None:
    """Best split of one node from its sums by (feature, bin), and the leaf values of both sides.

    A split sends bins 1 to t left, and missing values to either side. Gains are compared to ten digits, so that the
    order of summation doesn't decide; of equal ones the first feature, the lowest bin and missing-left win."""
    G, H, N = g.sum(1)[:, None], h.sum(1)[:, None], n.sum(1)[:, None]
    score = lambda a, b: a * a / (b + params.l2)
    found = None
    inner = lambda x: np.cumsum(x[:, 1:], axis=1)
    for missing_left in (True, False):
        extra = [x[:, :1] if missing_left else 0 for x in (g, h, n)]
        gl, hl, nl = (inner(x) + e for x, e in zip((g, h, n), extra))
        gain = score(gl, hl) + score(G - gl, H - hl) - score(G, H)
        ok = (nl >= params.min_rows) & (N - nl >= params.min_rows)
        gain = np.where(ok, gain, -np.inf)
        if not ok.any():
            continue
        digits = 10 - math.ceil(math.log10(max(abs(gain[ok]).max(), 1e-300)))
        rounded = np.where(ok, np.round(gain, min(max(digits, 0), 300)), -np.inf)
        f, t = np.unravel_index(int(rounded.argmax()), rounded.shape)
        top = float(rounded[f, t])
        if top <= 0 or (found is not None and (top, -f, -t) <= (found["gain"], -found["feature"], -(found["bin"] - 1))):
            continue
        value = lambda a, b: float(-params.rate * a / (b + params.l2))
        found = {"feature": int(f), "bin": int(t) + 1, "missing_left": missing_left, "gain": top,
                 "left": {"leaf": value(gl[f, t], hl[f, t])}, "right": {"leaf": value(G[f, 0] - gl[f, t], H[f, 0] - hl[f, t])}}
    return found


def _read(batch: pa.RecordBatch, n_features: int):
    column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    return column("y"), column("w"), column("margin"), [column(f"b{i}") for i in range(n_features)]


def _partial_histograms(recent: list[dict], tree: dict, params: BoostParams, n_features: int, nodes: int):
    """One row for each (node, feature, bin) of a task."""
    def partial(batches):
        cells = params.bins + 1
        sums = np.zeros((3, nodes, n_features, cells))
        for batch in batches:
            y, w, margin, bins = _read(batch, n_features)
            goes_left = _by_bin(bins)
            for t in recent:
                margin = margin + tree_values(t, goes_left, len(y))
            node = tree_values(tree, goes_left, len(y), "node").astype(np.int64)
            use = np.flatnonzero(node >= 0)
            node, w = node[use], w[use]
            g, h = gradient(params.power, y[use], margin[use])
            for f in range(n_features):
                at = node * cells + bins[f][use]
                for i, weights in enumerate((w * g, w * h, None)):
                    sums[i, :, f] += np.bincount(at, weights, nodes * cells).reshape(nodes, cells)
        node, f, b = np.nonzero(sums[2])
        g, h, n = sums[:, node, f, b]
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int32()), pa.array(f, pa.int32()), pa.array(b, pa.int32()), pa.array(g), pa.array(h), pa.array(n.astype(np.int64))],
            names=["node", "f", "b", "g", "h", "n"])
    return partial


def _histogram(rows: DataFrame, recent: list[dict], tree: dict, params: BoostParams, n_features: int, nodes: int) -> dict:
    """node -> (G, H, n) by (feature, bin)."""
    parts = rows.mapInArrow(_partial_histograms(recent, tree, params, n_features, nodes), "node int, f int, b int, g double, h double, n long")
    sums = parts.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
    node, f, b, g, h, n = (sums.column(c).to_numpy() for c in ("node", "f", "b", "g", "h", "n"))
    out: dict = {}
    for k in np.unique(node).tolist():
        own = node == k
        out[k] = tuple(np.zeros((n_features, params.bins + 1)) for _ in range(3))
        for array, values in zip(out[k], (g, h, n)):
            array[f[own], b[own]] = values[own]
    return out


def _grown(recent: list[dict], n_features: int):
    """Adds the recent trees to the margins."""
    def grow(batches):
        for batch in batches:
            *_, margin, bins = _read(batch, n_features)
            for t in recent:
                margin = margin + tree_values(t, _by_bin(bins), len(margin))
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))
    return grow


def _partial_deviances(recent: list[dict], power: float, n_features: int):
    """A task's summed deviance and weight before the recent trees and after each of them."""
    def partial(batches):
        sums = np.zeros((len(recent) + 1, 2))
        for batch in batches:
            y, w, margin, bins = _read(batch, n_features)
            for i, t in enumerate([None, *recent]):
                if t is not None:
                    margin = margin + tree_values(t, _by_bin(bins), len(y))
                sums[i] += (w * deviance(power, y, margin)).sum(), w.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["i", "d", "w"])
    return partial


def _watch(model: Boosted, held: DataFrame, recent: list[dict], params: BoostParams) -> int | None:
    """Adds the mean deviance after each round that has none yet; the best round, if one of them ends the boosting."""
    parts = held.mapInArrow(_partial_deviances(recent, params.power, len(model.features)), "i int, d double, w double")
    found = {r.i: r.d / r.w for r in parts.groupBy("i").agg(F.sum("d").alias("d"), F.sum("w").alias("w")).collect()}
    first = len(model.trees) - len(recent)
    for r in range(len(model.validation), len(model.trees) + 1):
        model.validation.append(found[r - first])
        best = model.validation.index(min(model.validation))
        if r == params.rounds or r - best >= params.patience:
            return best
    return None


def _leaves(tree: dict) -> list[dict]:
    return [tree] if "feature" not in tree else _leaves(tree["left"]) + _leaves(tree["right"])


def fit_boosted(train: DataFrame, features: list[str], target: str, weight: str | None = None, held_out: str | None = None,
                params: BoostParams | None = None) -> Boosted:
    """Boosts on the rows whose ``held_out`` column is false (all without one); the others only decide when it ends."""
    params = params or BoostParams()
    if not (params.power == 2.0 or 1.0 < params.power < 2.0):
        raise ValueError("The variance power is 2 (gamma) or between 1 and 2 (Tweedie)")
    y = F.col(target).cast("double")
    rows = train.where(y > 0 if params.power == 2.0 else y >= 0)
    out = F.coalesce(F.col(held_out), F.lit(False)) if held_out else F.lit(False)
    rows = rows.withColumn("held_out", out) if held_out != "held_out" else rows
    # written with the columns that follow, since bins are counted and then set from them
    x = [f"x{i}" for i in range(len(features))]
    rows = materialize(rows.select(y.alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), "held_out",
                                   *[F.col(f).cast("double").alias(c) for f, c in zip(features, x)]), "boost-rows")
    edges = bin_edges(rows.where(~F.col("held_out")), x, params.bins)
    binned = rows.select("y", "w", "held_out", *[bin_of(c, e).alias(f"b{i}") for i, (c, e) in enumerate(zip(x, edges))])
    state = materialize(binned, "bins")
    first = state.groupBy("held_out").agg(F.sum(F.col("w") * F.col("y")).alias("wy"), F.sum("w").alias("w")).collect()
    sums = {r.held_out: r for r in first}
    if False not in sums or not sums[False].wy or sums[False].wy <= 0:
        raise ValueError("Boosting needs training rows of positive weight and target")
    base = math.log(sums[False].wy / sums[False].w)
    model = Boosted(list(features), edges, base, params.power)
    watched = True in sums
    state, recent, best = state.withColumn("margin", F.lit(base)), [], None
    for _ in range(params.rounds):
        tree, own = {"leaf": 0.0}, state.where(~F.col("held_out"))
        for _ in range(params.depth):
            open_leaves = [leaf for leaf in _leaves(tree) if not leaf.get("done")]
            for leaf in _leaves(tree):
                leaf["node"] = -1
            for i, leaf in enumerate(open_leaves):
                leaf["node"] = i
            if not open_leaves:
                break
            sums = _histogram(own, recent, tree, params, len(features), len(open_leaves))
            for i, leaf in enumerate(open_leaves):
                found = best_split(*sums[i], params) if i in sums else None
                if found:
                    del leaf["leaf"], leaf["node"]
                    leaf.update(found)
                else:
                    leaf["done"] = True
        if "feature" not in tree:  # nothing left to split
            break
        for leaf in _leaves(tree):
            for mark in ("node", "done"):
                leaf.pop(mark, None)
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == CUT:
            best = _watch(model, state.where("held_out"), recent, params) if watched else None
            if best is not None:
                break
            kinds = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in state.schema)
            state, recent = materialize(state.mapInArrow(_grown(recent, len(features)), kinds), "margins"), []
    if watched:
        if best is None and len(model.validation) <= len(model.trees):
            best = _watch(model, state.where("held_out"), recent, params)
        model.trees = model.trees[:model.validation.index(min(model.validation))]
    return model


def scorer(model: Boosted):
    """A function that gives the margins of rows from a dict of their features' values (NaN: missing)."""
    trees, edges, base, features = model.trees, model.edges, model.base, model.features

    def score(values: dict[str, np.ndarray]) -> np.ndarray:
        def goes_left(node: dict, rows: np.ndarray) -> np.ndarray:
            x, own = values[features[node["feature"]]][rows], edges[node["feature"]]
            below = x <= own[node["bin"] - 1] if node["bin"] <= len(own) else np.ones(len(x), bool)
            return np.where(np.isnan(x), node["missing_left"], below)
        n = len(next(iter(values.values())))
        total = np.full(n, base)
        for t in trees:
            total = total + tree_values(t, goes_left, n)
        return total
    return score


def margins(model: Boosted, df: DataFrame, out: str) -> DataFrame:
    """Adds the log of the predicted mean, from the features' own values; only these go through Python, in Arrow batches."""
    used = used_features(model)
    if not used:
        return df.withColumn(out, F.lit(model.base))
    score_rows = scorer(model)

    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(score_rows({f: c.to_numpy(np.float64) for f, c in zip(used, columns)}))

    udf = F.pandas_udf(score, "double")
    return df.withColumn(out, udf(*[F.col(f).cast("double") for f in used]))


def used_features(model: Boosted) -> list[str]:
    return [model.features[i] for i in sorted({n["feature"] for t in model.trees for n in _splits(t)})]


def _splits(tree: dict) -> list[dict]:
    return [] if "feature" not in tree else [tree, *_splits(tree["left"]), *_splits(tree["right"])]
