"""Ordered prefix sums at scale.

``ordered_cross_sum`` computes, per group, S = sum_i a_i * (B_before_i + c * b_i)
where rows are ordered by ``order`` and B_before_i is the sum of b over the
rows before i. Gini areas and rank-sum AUC are both of this form.

Plan: ``repartitionByRange(groups + order)`` (sampled bounds, so a hot group
is split over many tasks) -> ``sortWithinPartitions`` -> one ``mapInPandas``
pass that streams the partition's Arrow batches and emits one partial record
per (partition, group segment): local S, sum a, sum b. The partials (at most
partitions + groups rows) are combined in partition order with running
offsets: S_total = sum_k S_k + A_k * B_before_k. No global sort, no window
over all rows, nothing row-level leaves the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _partials(group_names: list[str], c: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        cur_key = None
        state = None  # [pid, seq, S, A, B, AB, first_a, first_b, n]
        seq = 0
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["__pid"].iat[0])
            if group_names:
                change = np.zeros(len(pdf), dtype=bool)
                change[0] = True
                for g in group_names:
                    codes = pd.factorize(pdf[g], use_na_sentinel=False)[0]
                    change[1:] |= codes[1:] != codes[:-1]
                starts = np.flatnonzero(change)
            else:
                starts = np.array([0])
            ends = list(starts[1:]) + [len(pdf)]
            a_all = pdf["__a"].to_numpy(dtype=float)
            b_all = pdf["__b"].to_numpy(dtype=float)
            for s, e in zip(starts, ends):
                key = tuple(None if pd.isna(v) else v for v in pdf[group_names].iloc[s]) if group_names else ()
                if state is None or key != cur_key:
                    if state is not None:
                        out.append((*cur_key, *state))
                    cur_key = key
                    state = [pid, seq, 0.0, 0.0, 0.0, 0.0, float(a_all[s]), float(b_all[s]), 0]
                    seq += 1
                a = a_all[s:e]
                b = b_all[s:e]
                before = state[4] + np.cumsum(b) - b
                state[2] += float(np.sum(a * (before + c * b)))
                state[3] += float(np.sum(a))
                state[4] += float(np.sum(b))
                state[5] += float(np.sum(a * b))
                state[8] += int(e - s)
        if state is not None:
            out.append((*cur_key, *state))
        cols = [*group_names, "pid", "seq", "S", "A", "B", "AB", "first_a", "first_b", "n"]
        yield pd.DataFrame(out, columns=cols)
    return run


def ordered_cross_sum(df: DataFrame, groups: list[str], order: list[Column], a: Column, b: Column,
                      c: float = 1.0, partitions: int | None = None) -> dict[tuple, dict]:
    """Per group: S (see module doc), A = sum a, B = sum b, AB = sum a*b, the first row's
    (a, b) in the order, and the row count n."""
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    order_names = [f"__o{i}" for i in range(len(order))]
    sel = df.select(*[F.col(g) for g in groups], *[o.alias(n) for o, n in zip(order, order_names)],
                    a.cast("double").alias("__a"), b.cast("double").alias("__b"))
    ranged = (sel.repartitionByRange(partitions, *groups, *order_names)
              .sortWithinPartitions(*groups, *order_names)
              .withColumn("__pid", F.spark_partition_id()))
    group_fields = [f for f in sel.schema.fields if f.name in groups]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in group_fields]
                       + ["pid int", "seq int", "S double", "A double", "B double", "AB double",
                          "first_a double", "first_b double", "n long"])
    parts = ranged.select(*groups, "__a", "__b", "__pid").mapInPandas(_partials(groups, c), schema)
    rows = sorted(parts.collect(), key=lambda r: (r.pid, r.seq))
    result: dict[tuple, dict] = {}
    for r in rows:
        key = tuple(r[g] for g in groups)
        acc = result.setdefault(key, {"S": 0.0, "A": 0.0, "B": 0.0, "AB": 0.0, "n": 0,
                                      "first_a": r.first_a, "first_b": r.first_b})
        acc["S"] += r.S + r.A * acc["B"]
        acc["A"] += r.A
        acc["B"] += r.B
        acc["AB"] += r.AB
        acc["n"] += r.n
    return result
