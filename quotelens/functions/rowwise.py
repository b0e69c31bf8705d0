"""Row-wise market components over the competitor premium columns.

Every expression is unrolled over the (few) competitor columns with
``least``/``greatest``/``sort_array``/``get`` so it stays inside whole-stage
codegen; no higher-order lambdas, no UDF, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def masked(c: str) -> Column:
    """Premium with values <= 0 (and NULL/NaN) masked to NULL."""
    x = F.col(c)
    return F.when((x > 0) & ~F.isnan(x), x)


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def present_count(comps: list[str]) -> Column:
    return _sum([F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in comps])


def sorted_prices(comps: list[str]) -> Column:
    """Ascending array of the present prices."""
    return F.sort_array(F.array_compact(F.array(*[F.col(c) for c in comps])))


def top_n_mean(comps: list[str], n: int) -> Column:
    """Mean of the n cheapest present prices; NULL when fewer than n quote."""
    s = sorted_prices(comps)
    total = _sum([F.get(s, i) for i in range(n)])
    return F.when(present_count(comps) >= n, total / F.lit(float(n)))


def row_min(comps: list[str]) -> Column:
    return F.least(*[F.col(c) for c in comps]) if len(comps) > 1 else F.col(comps[0])


def row_max(comps: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in comps]) if len(comps) > 1 else F.col(comps[0])


def row_median(comps: list[str]) -> Column:
    """Median of present prices (mean of the two middle values)."""
    s = sorted_prices(comps)
    n = present_count(comps)
    lo = F.get(s, F.floor((n - 1) / 2).cast("int"))
    hi = F.get(s, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (lo + hi) / 2.0)


def row_softmin(comps: list[str], temperature: float) -> Column:
    """m - T*ln(max(mean(exp(-(p-m)/T)), 1e-12)), m = row minimum; NULL if none quote."""
    m = row_min(comps)
    t = F.lit(float(temperature))
    terms = [F.coalesce(F.exp(-(F.col(c) - m) / t), F.lit(0.0)) for c in comps]
    n = present_count(comps)
    mean_shift = _sum(terms) / n
    return F.when(n > 0, m - t * F.log(F.greatest(mean_shift, F.lit(1e-12))))


def row_std(comps: list[str]) -> Column:
    """Sample standard deviation (ddof 1) of present prices; NULL below 2 prices."""
    n = present_count(comps)
    mean = _sum([F.coalesce(F.col(c), F.lit(0.0)) for c in comps]) / n
    ss = _sum([F.coalesce(F.pow(F.col(c) - mean, 2), F.lit(0.0)) for c in comps])
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def panel_signature(comps: list[str]) -> Column:
    """Names of quoting competitors in column order joined by '|', '' if none."""
    return F.concat_ws("|", *[F.when(F.col(c).isNotNull(), F.lit(c)) for c in comps])


def top_n_signature(comps: list[str], n: int) -> Column:
    """Names of the n cheapest (ties by column order), sorted by name; NULL if < n quote."""
    items = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(),
               F.struct(F.col(c).alias("p"), F.lit(i).alias("pos"), F.lit(c).alias("name")))
        for i, c in enumerate(comps)
    ]))
    cheapest = F.slice(F.sort_array(items), 1, n)
    names = F.sort_array(cheapest.getField("name"))
    return F.when(present_count(comps) >= n, F.array_join(names, "|"))


def own_rank(own: Column, comps: list[str]) -> Column:
    """1 + number of competitor prices strictly below own (rank method 'min')."""
    below = _sum([F.when(F.col(c) < own, 1).otherwise(0) for c in comps])
    return F.when(own.isNotNull(), (below + 1).cast("double"))


def complete_panel(comps: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in comps])
