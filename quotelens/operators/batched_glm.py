"""Many generalized linear models at once: log link, variance power 2 (gamma) or between 1 and 2 (Tweedie).

Models are numbered groups - the months of rolling anchors, the competitors of a panel. A row belongs to any number
of groups, each with a target and a weight of its own, so nothing is copied. An iteration of reweighted least
squares is one pass for all groups: tasks add up the Gram matrix, the right side and the deviance of each group
over Arrow batches, the sums of a group meet in one row and are solved on the cluster. What comes back
is one coefficient vector a group; those are sent to the tasks again, so many groups at a time that they
take at most ``SENT_BYTES``.

The design: an intercept, numbers (0 and an indicator column where missing) and a column for each level of a
category. Columns are standardised by the group's own sums, those that don't vary in a group get coefficient 0,
and the least-norm solution is taken where columns are collinear, so an unknown level is as good as an average one.
Features of more than ``MAX_LEVELS`` levels are refused: encode those by target statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.operators.joins import maybe_broadcast
from quotelens.session import materialize

MAX_LEVELS = 1_000
SENT_BYTES = 32 * 1024 * 1024
TOLERANCE, ITERATIONS = 1e-10, 30
#: Directions of the standardised Gram matrix below this share of the largest one count as collinear.
COLLINEAR = 1e-9


@dataclass
class Design:
    """Columns of the design by feature, with constants that only keep the numbers small."""
    numeric: list[str]
    categorical: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def owners(self) -> list[str | None]:
        """The feature of each column; None for the intercept."""
        out: list[str | None] = [None]
        for c in self.numeric:
            out += [c, c]
        for c in self.categorical:
            out += [c] * len(self.levels[c])
        return out

    def column(self) -> Column:
        out = [F.lit(1.0)]
        for c in self.numeric:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            mean, sd = self.scale[c]
            out += [F.coalesce((x - F.lit(mean)) / F.lit(sd), F.lit(0.0)), x.isNull().cast("double")]
        for c in self.categorical:
            v = F.col(c).cast("string")
            out += [F.coalesce((v == F.lit(level)).cast("double"), F.lit(0.0)) for level in self.levels[c]]
        return F.array(*out)


def learn_design(df: DataFrame, categorical: list[str], numeric: list[str]) -> Design:
    """Levels and number scales of all rows: two aggregates."""
    design = Design(list(numeric), list(categorical))
    if numeric:
        x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in numeric}
        row = df.agg(*[F.avg(v).alias(f"m_{c}") for c, v in x.items()], *[F.stddev_pop(v).alias(f"s_{c}") for c, v in x.items()]).first()
        design.scale = {c: (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"] or 0.0) or 1.0) for c in numeric}
    if categorical:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([], list(categorical), "c", "v").where(F.col("v").isNotNull())
        counted = long.groupBy("c", "v").count().groupBy("c").agg(F.count("*").alias("n")).collect()
        wide = [r.c for r in counted if r.n > MAX_LEVELS]
        if wide:
            raise ValueError(f"Too many levels for a design matrix: {sorted(wide)}")
        found = {r.c: sorted(r.v) for r in long.groupBy("c").agg(F.collect_set("v").alias("v")).collect()}
        design.levels = {c: found.get(c, []) for c in categorical}
    return design


def member(group: Column, y: Column, weight: Column) -> Column:
    """One membership of a row."""
    return F.struct(group.cast("int").alias("g"), y.cast("double").alias("y"), weight.cast("double").alias("w"))


def _members(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    """(design rows, row of each membership, group, y, w)"""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    lists = batch.column("members")
    flat = lists.flatten()
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    return x, row, *(flat.field(c).to_numpy(zero_copy_only=False) for c in ("g", "y", "w"))


def _unit_deviance(power: float, y: np.ndarray, mu: np.ndarray) -> np.ndarray:
    if power == 2.0:
        return 2 * (y / mu - 1 - np.log(y / mu))
    return 2 * (y ** (2 - power) / ((1 - power) * (2 - power)) - y * mu ** (1 - power) / (1 - power) + mu ** (2 - power) / (2 - power))


def _partial_sums(width: int, power: float, betas: dict[int, np.ndarray] | None, groups: set[int]):
    """One row a group and task: Gram matrix, right side, deviance, weight, end to end."""
    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, row, g, y, w = _members(batch, width)
            for k in np.unique(g).tolist():
                if k not in groups:
                    continue
                own = np.flatnonzero((g == k) & (w > 0))
                X, t, v = x[row[own]], y[own], w[own]
                if betas is not None:
                    mu = np.exp(X @ betas[k])
                else:  # the first round starts from the targets, away from 0
                    mu = t if power == 2.0 else np.maximum((t + np.average(t, weights=v)) / 2, 1e-6)
                work = v * mu ** (2 - power)
                z = np.log(mu) + (t - mu) / mu
                WX = X * work[:, None]
                part = np.concatenate([(X.T @ WX).ravel(), WX.T @ z, [(v * _unit_deviance(power, t, mu)).sum(), v.sum()]])
                sums[k] = sums[k] + part if k in sums else part
        for k, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.list_(pa.float64()))], names=["g", "sums"])
    return partial


def solve(gram: np.ndarray, right: np.ndarray, ridge: float) -> np.ndarray:
    """Weighted least squares on standardised columns; the first column is the intercept."""
    total = gram[0, 0]
    mean = gram[0] / total
    variance = np.diag(gram) / total - mean ** 2
    sd = np.sqrt(np.maximum(variance, 0))
    used = np.flatnonzero(sd > 1e-9 * np.maximum(np.sqrt(np.diag(gram) / total), 1e-300))
    used = used[used > 0]
    beta = np.zeros(len(right))
    centre = (gram - total * np.outer(mean, mean))[np.ix_(used, used)] / total / np.outer(sd[used], sd[used])
    side = (right - mean * right[0])[used] / total / sd[used]
    values, vectors = np.linalg.eigh(centre) if len(used) else (np.zeros(0), np.zeros((0, 0)))
    keep = values > COLLINEAR * max(values.max(initial=0), 1e-300)
    beta[used] = vectors[:, keep] @ (vectors[:, keep].T @ side / (values[keep] + ridge)) / sd[used]
    beta[0] = right[0] / total - mean[1:] @ beta[1:]
    return beta


def _solve_group(width: int, ridge: float):
    def solved(table: pa.Table) -> pa.Table:
        parts = np.array(table["sums"].to_pylist())
        s = parts[np.lexsort(parts.T[::-1])].sum(axis=0)  # in an order of their own, so that reruns agree
        gram, right = s[:width * width].reshape(width, width), s[width * width:width * (width + 1)]
        beta = solve(gram, right, ridge)
        return pa.table({"g": table["g"][:1], "beta": pa.array([beta], pa.list_(pa.float64())), "deviance": [s[-2]], "weight": [s[-1]]})
    return solved


def fit_groups(rows: DataFrame, design: Design, members: Column, groups: list[int], power: float = 2.0, ridge: float = 0.0) -> dict[int, np.ndarray]:
    """Coefficients of each group. ``members``: array of ``member`` of a row, in any groups; others than those asked for are passed over.

    Targets are positive for power 2. The design and the memberships are written once; an iteration is one job."""
    width = len(design.owners)
    table = materialize(rows.select(design.column().alias("x"), members.alias("members")).where(F.size("members") > 0), "design")
    at_once = max(1, SENT_BYTES // (8 * width))
    out: dict[int, np.ndarray] = {}
    for start in range(0, len(groups), at_once):
        todo, betas, last = set(groups[start:start + at_once]), None, {}
        for _ in range(ITERATIONS):
            sums = table.mapInArrow(_partial_sums(width, power, betas, todo), "g int, sums array<double>")
            found = sums.groupBy("g").applyInArrow(_solve_group(width, ridge), "g int, beta array<double>, deviance double, weight double").collect()
            if not found:
                break
            settled = betas is not None and all(abs(r.deviance - last.get(r.g, math.inf)) <= TOLERANCE * (abs(r.deviance) + 1e-12 * r.weight) for r in found)
            betas, last = {r.g: np.array(r.beta) for r in found}, {r.g: r.deviance for r in found}
            if settled:
                break
        out |= betas or {}
    return out


def coefficients(spark, betas: dict[int, np.ndarray]) -> DataFrame:
    """(g, beta): one row a group."""
    return spark.createDataFrame([(int(g), [float(x) for x in b]) for g, b in betas.items()], "g int, beta array<double>")


def linear(design: Design, beta: Column) -> Column:
    """The linear predictor of a row, in generated code: numbers by their coefficients, categories by looking up their level's."""
    out, at = F.get(beta, F.lit(0)), 1
    for c in design.numeric:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        mean, sd = design.scale[c]
        out = out + F.when(x.isNull(), F.get(beta, F.lit(at + 1))).otherwise((x - F.lit(mean)) / F.lit(sd) * F.get(beta, F.lit(at)))
        at += 2
    for c in design.categorical:
        levels = design.levels[c]
        if levels:
            place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.coalesce(F.col(c).cast("string"), F.lit(""))).cast("int")
            out = out + F.when(place > 0, F.get(beta, place + (at - 1))).otherwise(F.lit(0.0))
        at += len(levels)
    return out


def predict_groups(rows: DataFrame, group: Column, design: Design, betas: dict[int, np.ndarray], out: str) -> DataFrame:
    """Adds each row's mean by the model of its group; null for a group without one. The table of coefficients is broadcast if small."""
    table = coefficients(rows.sparkSession, betas).select(F.col("g").alias("__g"), F.col("beta").alias("__beta"))
    joined = rows.withColumn("__group", group.cast("int")).join(maybe_broadcast(table), F.col("__group") == F.col("__g"), "left")
    return joined.withColumn(out, F.when(F.col("__beta").isNotNull(), F.exp(linear(design, F.col("__beta"))))).drop("__g", "__beta", "__group")
