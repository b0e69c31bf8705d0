"""Exact global order statistics and linear quantiles without a global sort.

``order_statistics`` finds the k-th smallest values of a column by histogram
narrowing: each pass buckets the rows that fall inside the current candidate
range into at most ``buckets`` equal-width bins (one ``groupBy`` with map-side
partial aggregation), finds the bin of each wanted rank by running sums over
the bucket table on the cluster, and shrinks the range to that bin's actual
min/max. It stops when a bin holds one distinct value, or few enough rows to
be sorted in one task. Only the chosen bins (one row for each rank) reach the
driver, a value shared by a third of all rows ends the search at once, and no
task ever holds a whole group.

Quantiles use linear interpolation between order statistics (position
``p * (n - 1)``), the numpy/DuckDB ``quantile_cont`` convention.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096
SORTED_ROWS = 20_000  # a range of so few rows is sorted in one task


def _narrow(values: DataFrame, ranks: list[int], n: int, lo: float, hi: float,
            buckets: int) -> dict[int, float]:
    """values: one non-null double column ``x``; ranks are 1-based."""
    found = _narrow_keyed(values.withColumn("k", F.lit("0")), {"0": ranks}, {"0": (n, lo, hi)}, buckets)
    return {r: v for (_, r), v in found.items()}


def _in_ranges(values: DataFrame, items: list[tuple]) -> DataFrame:
    """Values with their open range (j, a, b, w). The ranges of a key do not overlap.

    Ranges of a single key are found by comparing with their sorted lower edges; for many keys the
    ranges (keys x ranks rows, a known number) are joined on the key."""
    x = F.col("x")
    if len({k for _, (k, *_), _ in items}) == 1:
        ordered = sorted((a, b, w, j) for j, (_, a, b, _, _), w in items)
        place = sum((F.when(x >= F.lit(o[0]), 1).otherwise(0) for o in ordered), F.lit(0))
        pick = lambda i, kind: F.get(F.array(*[F.lit(o[i]).cast(kind) for o in ordered]), F.col("place") - 1)
        found = values.where(F.col("k") == str(items[0][1][0])).withColumn("place", place).withColumns({"a": pick(0, "double"), "b": pick(1, "double"), "w": pick(2, "double"), "j": pick(3, "int")})
        return found.where(F.col("b").isNotNull() & (x <= F.col("b"))).select("j", "x", "a", "w")
    table = values.sparkSession.createDataFrame([(str(k), j, float(a), float(b), float(w)) for j, (k, a, b, _, _), w in items],
                                                "k string, j int, a double, b double, w double")
    side = F.broadcast(table) if len(items) <= 100_000 else table
    return values.join(side, "k").where((x >= F.col("a")) & (x <= F.col("b"))).select("j", "x", "a", "w")


def _narrow_keyed(values: DataFrame, wanted: dict, init: dict, buckets: int) -> dict:
    """Histogram narrowing for many groups at once.

    ``values``: columns ``k`` (group key, text) and non-null double ``x``;
    ``wanted``: key -> 1-based ranks; ``init``: key -> (n, min, max). A pass counts the rows of each
    open range by bucket and picks, from running sums over the bucket table, the bucket of each
    wanted rank; ranges of at most SORTED_ROWS rows are sorted on the cluster instead. One row for
    each wanted rank comes back. The least and the greatest value of a range fall into different
    buckets, so every pass narrows it and the search ends.
    """
    spark = values.sparkSession
    state = {(k, r): (init[k][1], init[k][2], 0, init[k][0]) for k, rs in wanted.items() for r in rs}
    result: dict = {}
    while True:
        for kr, (a, b, _, _) in state.items():
            if a == b:
                result.setdefault(kr, a)
        active = {kr: st for kr, st in state.items() if kr not in result}
        if not active:
            return result
        ranges = sorted({(kr[0], *st) for kr, st in active.items()}, key=lambda t: (str(t[0]), t[1:]))
        number = {rg: j for j, rg in enumerate(ranges)}
        items = [(j, rg, rg[2] / buckets - rg[1] / buckets) for rg, j in number.items()]
        small = [i for i in items if i[1][4] <= SORTED_ROWS or i[2] == 0]
        large = [i for i in items if not (i[1][4] <= SORTED_ROWS or i[2] == 0)]
        asked = spark.createDataFrame([(number[(k, *st)], r, r - st[2]) for (k, r), st in active.items()], "j int, r long, place long")
        by_number = {(number[(k, *st)], r): (k, r) for (k, r), st in active.items()}
        if small:
            place = F.row_number().over(Window.partitionBy("j").orderBy("x"))
            placed = _in_ranges(values, small).withColumn("place", place.cast("long"))
            for row in placed.join(F.broadcast(asked), ["j", "place"]).select("j", "r", "x").collect():
                result[by_number[row.j, row.r]] = row.x
        if large:
            inside = _in_ranges(values, large)
            bucket = F.least(F.floor((F.col("x") - F.col("a")) / F.col("w")).cast("double"), F.lit(float(buckets - 1))).cast("int")
            hist = inside.groupBy("j", bucket.alias("bucket")).agg(F.count("*").alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
            upto = F.sum("c").over(Window.partitionBy("j").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
            found = (hist.withColumn("upto", upto).join(F.broadcast(asked), "j")
                     .where((F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("c"))))
            for row in found.select("j", "r", "mn", "mx", "upto", "c").collect():
                kr = by_number[row.j, row.r]
                state[kr] = (row.mn, row.mx, state[kr][2] + row.upto - row.c, row.c)


def kth_smallest(df: DataFrame, column: str, k: int):
    """The k-th smallest (1-based) value of a column in its own type, by range partitions: only the
    partition that holds it is ranked."""
    from quotelens.session import materialize
    values = df.select(F.col(column).alias("x")).where(F.col("x").isNotNull())
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = materialize(values.repartitionByRange(n, "x").withColumn("part", F.spark_partition_id()), "ranked")
    before = 0
    for row in parts.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        if before + row.n >= k:
            place = F.row_number().over(Window.orderBy("x"))
            return parts.where(F.col("part") == row.part).select("x", place.alias("place")).where(F.col("place") == k - before).first().x
        before += row.n
    return None


def grouped_quantiles(long: DataFrame, key: str, value: str, probs: list[float]) -> dict:
    """Exact linear quantiles of ``value`` per ``key`` (few keys, e.g. features), all keys
    served by the same passes; memory bounded per task whatever the distinct values."""
    from pyspark import StorageLevel
    values = (long.select(F.col(key).cast("string").alias("k"), F.col(value).cast("double").alias("x"))
              .where(F.col("x").isNotNull() & ~F.isnan("x")).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        init = {r.k: (int(r.n), float(r.lo), float(r.hi)) for r in values.groupBy("k").agg(
            F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
        wanted = {k: sorted({q for lo, hi, _ in _positions(probs, n) for q in (lo, hi)}) for k, (n, _, _) in init.items()}
        found = _narrow_keyed(values, wanted, init, DEFAULT_BUCKETS)
    finally:
        values.unpersist()
    out = {}
    for k, (n, _, _) in init.items():
        qs = []
        for lo, hi, frac in _positions(probs, n):
            a, b = found[(k, lo)], found[(k, hi)]
            qs.append(a + (b - a) * frac if frac else a)
        out[k] = qs
    return out


def order_statistics(df: DataFrame, expr: Column | str, ranks, buckets: int = DEFAULT_BUCKETS
                     ) -> tuple[dict[int, float], int]:
    """k-th smallest non-null values of ``expr`` (1-based ranks) and the count n.

    ``ranks`` is a list, or a function of n returning one (so callers that need
    n to choose ranks pay for one first aggregate only).
    """
    x = F.col(expr) if isinstance(expr, str) else expr
    values = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        agg = values.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        n = int(agg.n)
        if n == 0:
            return {}, 0
        wanted_in = ranks(n) if callable(ranks) else ranks
        wanted = sorted({min(max(int(r), 1), n) for r in wanted_in})
        found = _narrow(values, wanted, n, float(agg.lo), float(agg.hi), buckets)
        return {r: found[min(max(int(r), 1), n)] for r in wanted_in}, n
    finally:
        values.unpersist()


def _positions(probs: list[float], n: int) -> list[tuple[int, int, float]]:
    out = []
    for p in probs:
        pos = p * (n - 1)
        lo = math.floor(pos)
        frac = pos - lo
        out.append((lo + 1, min(lo + 2, n), frac))
    return out


def quantiles(df: DataFrame, expr: Column | str, probs: list[float],
              mode: str = "exact", accuracy: int = 100_000) -> list[float | None]:
    """Linear-interpolated quantiles of a column (NULLs ignored)."""
    x = F.col(expr) if isinstance(expr, str) else expr
    if mode == "approx":
        row = df.select(F.percentile_approx(x.cast("double"), list(probs), accuracy).alias("q")).first()
        return list(row.q) if row.q is not None else [None] * len(probs)
    stats, n = order_statistics(
        df, x, lambda n: sorted({r for lo, hi, _ in _positions(probs, n) for r in (lo, hi)}))
    if n == 0:
        return [None] * len(probs)
    out = []
    for lo, hi, frac in _positions(probs, n):
        a, b = stats[lo], stats[hi]
        out.append(a + (b - a) * frac if frac else a)
    return out


def median(df: DataFrame, expr: Column | str, mode: str = "exact") -> float | None:
    return quantiles(df, expr, [0.5], mode)[0]


def group_quantile(expr: Column, p, mode: str = "exact", accuracy: int = 100_000) -> Column:
    """Per-group quantile aggregate: exact ``percentile`` (a value->count map per
    group, bounded by distinct values) or fixed-memory ``percentile_approx``."""
    if mode == "approx":
        return F.percentile_approx(expr, p, accuracy)
    return F.percentile(expr, p)


def sql_double(v: float) -> str:
    return f"{float(v)!r}D"


def count_below(x: str, edges: list[float]) -> str:
    """SQL text: how many of the sorted edges lie below x, by bisection, as one expression of generated code. (Text, since
    an expression of many parts costs a driver call for each.)"""
    def between(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {x} > {sql_double(edges[mid])} THEN {between(mid + 1, hi)} ELSE {between(lo, mid)} END"
    return between(0, len(edges))


def quantile_table(long: DataFrame, keys: list[str], value: str, probs: list[float], weight: str | None = None,
                   counted: bool = False) -> DataFrame:
    """keys, n, lo, hi, distinct, q (exact linear quantiles, one for each prob) of every group, for any number of groups.

    Equal values of a group are counted first, with map-side sums, so a value that a third of the rows share
    is one row. The counted values are dealt to partitions by ranges of (group, value); a group's ranks start, in
    each partition, from the sums of the partitions before it - one row for each partition and group. So a large
    group is spread over partitions, small ones share one, and nothing comes to the driver. Groups without a value have no
    row; ``weight`` is a whole number of occurrences. ``counted``: each (group, value) is one row already."""
    from quotelens.session import materialize
    x, k = F.col(value).cast("double"), F.struct(*[F.col(c) for c in keys]).alias("k")
    rows = (long.select(k, x.alias("x"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("c"))
            .where(F.col("x").isNotNull() & ~F.isnan("x")))
    rows = rows if counted else rows.groupBy("k", "x").agg(F.sum("c").alias("c"))
    ranked = materialize(rows.repartitionByRange("k", "x").withColumn("part", F.spark_partition_id()), "ranked")
    sums = ranked.groupBy("part", "k").agg(F.sum("c").alias("s"), F.count("*").alias("d"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    group, earlier = Window.partitionBy("k"), Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", "k", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"), F.sum("s").over(group).alias("n"),
                         F.sum("d").over(group).alias("distinct"), F.min("lo").over(group).alias("lo"), F.max("hi").over(group).alias("hi"))
    upto = F.sum("c").over(Window.partitionBy("part", "k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    placed = ranked.withColumn("upto", upto).join(starts, ["part", "k"]).withColumn("upto", F.col("upto") + F.col("before"))
    below = [f"CAST(floor({sql_double(p)} * (n - 1)) AS BIGINT)" for p in probs]
    ranks = ", ".join(f"struct({i} AS i, least({at} + {1 + side}, n) AS rank, {side} AS side)" for i, at in enumerate(below) for side in (0, 1))
    hits = placed.select("k", "x", "n", "distinct", "lo", "hi", F.expr(f"explode(filter(array({ranks}), r -> r.rank <= upto AND r.rank > upto - c)) AS r"))
    wide = hits.groupBy("k").agg(*[F.max(c).alias(c) for c in ("n", "distinct", "lo", "hi")],
                                 *[F.expr(f"max(CASE WHEN r.i = {i} AND r.side = {side} THEN x END) AS v{i}_{side}") for i in range(len(probs)) for side in (0, 1)])
    frac = [f"({sql_double(p)} * (n - 1) - {at})" for p, at in zip(probs, below)]
    between = F.expr("array(" + ", ".join(f"CASE WHEN {f} > 0 THEN v{i}_0 + (v{i}_1 - v{i}_0) * {f} ELSE v{i}_0 END" for i, f in enumerate(frac)) + ")")
    return wide.select(*[F.col(f"k.{c}").alias(c) for c in keys], "n", "lo", "hi", "distinct", between.alias("q"))
