"""Permutation importance in one pass over the validation rows (M6).

Rows fall into blocks of about ``BLOCK`` by a hash of the key, so a block is a random part of the table; one exchange
brings a block together, and its task answers all (feature, repeat) cases without copying a row. Within a block a row
takes the feature value of the row that has its place in another order: rows are ordered by md5(repeat|key), values
by md5(repeat|feature|key).

* Models that a task can evaluate (boosted trees, batched GLMs) give the squared error of each case.
* The segment mean depends on the risk cell only, and cells may be many: a block gives, for each case and new cell, the
  number of its rows and the sums of target and squared target. These meet the table of cell means by a
  join on the cell, after a second, small exchange.

* Spark ML's models are evaluated by Spark: a block gives each of its rows once, with the values that the row takes in
  all repeats as one array a feature, and the cases are unfolded on the way to the model, after the exchange.

A feature that the model doesn't use has importance 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.operators.joins import attach_group_values

BLOCK = 50_000
#: The case without a permutation.
BASE = ""


def in_blocks(rows: DataFrame, key: str, n: int):
    text = F.col(key).cast("string")
    return rows.withColumn("__block", F.pmod(F.xxhash64(text), F.lit(max(1, -(-n // BLOCK))))).withColumn("__text", text).groupBy("__block")


def permutations(texts: list[str], keys: list, features: list[str], repeats: int):
    """(feature, repeat, row whose value each row takes) of every case of a block."""
    def order(prefix: str) -> np.ndarray:
        marks = [hashlib.md5(f"{prefix}{t}".encode()).digest() for t in texts]
        return np.array(sorted(range(len(texts)), key=lambda i: (marks[i], keys[i])), np.int64)
    for r in range(repeats):
        places = order(f"{r}|")
        for f in features:
            source = np.empty(len(texts), np.int64)
            source[places] = order(f"{r}|{f}|")
            yield f, r, source


def squared_errors(rows: DataFrame, key: str, target: str, inputs: dict[str, str], score: Callable, repeats: int, n: int) -> DataFrame:
    """(feature, repeat, sse); ``inputs``: the column of each feature, ``score``: means from a dict of arrays."""
    names = list(inputs)

    def block(table: pa.Table) -> pa.Table:
        values = {f: table[c].to_numpy().astype(np.float64) for f, c in inputs.items()}
        y, texts, keys = table[target].to_numpy().astype(np.float64), table["__text"].to_pylist(), table[key].to_pylist()
        out = [(BASE, 0, float(((y - score(values)) ** 2).sum()))]
        for f, r, source in permutations(texts, keys, names, repeats):
            out.append((f, r, float(((y - score(values | {f: values[f][source]})) ** 2).sum())))
        return pa.table({c: list(v) for c, v in zip(("feature", "repeat", "sse"), zip(*out))}, schema=pa.schema([("feature", pa.string()), ("repeat", pa.int32()), ("sse", pa.float64())]))
    need = rows.select(F.col(key), F.col(target).cast("double").alias(target), *dict.fromkeys(inputs.values()))
    return in_blocks(need, key, n).applyInArrow(block, "feature string, repeat int, sse double").groupBy("feature", "repeat").agg(F.sum("sse").alias("sse"))


def with_permuted(rows: DataFrame, key: str, features: list[str], repeats: int, n: int) -> DataFrame:
    """Rows with an array ``__v<i>`` for the i-th feature: the value that the row takes in each repeat."""
    def block(table: pa.Table) -> pa.Table:
        ends, size = [b"" if t is None else b"|" + t.encode() for t in table["__text"].to_pylist()], table.num_rows

        def order(*prefix) -> np.ndarray:
            begin = "|".join(prefix).encode()
            marks = np.frombuffer(b"".join(hashlib.md5(begin + e).digest() for e in ends), ">u8").reshape(-1, 2)
            return np.lexsort((marks[:, 1], marks[:, 0]))
        places = [order(str(r)) for r in range(repeats)]
        offsets = pa.array(np.arange(0, size * repeats + 1, repeats, dtype=np.int32))
        out = table.drop_columns(["__block", "__text"])
        for i, f in enumerate(features):
            source = np.empty((size, repeats), np.int64)
            for r in range(repeats):
                source[places[r], r] = order(str(r), f)
            out = out.append_column(f"__v{i}", pa.ListArray.from_arrays(offsets, table[f].combine_chunks().take(pa.array(source.ravel()))))
        return out
    kinds = {f: rows.schema[f].dataType.simpleString() for f in features}
    schema = ", ".join([*(f"`{c.name}` {c.dataType.simpleString()}" for c in rows.schema), *(f"`__v{i}` array<{kinds[f]}>" for i, f in enumerate(features))])
    return in_blocks(rows, key, n).applyInArrow(block, schema)


def cell_errors(rows: DataFrame, key: str, target: str, cells: list[str], means: DataFrame, overall: float, repeats: int, n: int) -> DataFrame:
    """(feature, repeat, sse) of a model that gives each cell its mean, and ``overall`` to a cell without one."""
    schema = pa.schema([("feature", pa.string()), ("repeat", pa.int32()), *((f"c{i}", pa.string()) for i in range(len(cells))),
                        ("n", pa.int64()), ("sy", pa.float64()), ("syy", pa.float64())])

    def block(table: pa.Table) -> pa.Table:
        y, texts, keys = table[target].to_numpy().astype(np.float64), table["__text"].to_pylist(), table[key].to_pylist()
        coded = [table[f"c{i}"].combine_chunks().dictionary_encode(null_encoding="encode") for i in range(len(cells))]
        codes, levels = [c.indices.to_numpy() for c in coded], [c.dictionary for c in coded]
        parts = []

        def emit(feature: str, repeat: int, own: list[np.ndarray]) -> None:
            found, where = np.unique(np.stack(own), axis=1, return_inverse=True)
            where = where.ravel()
            parts.append(pa.table([pa.array([feature] * found.shape[1]), pa.array([repeat] * found.shape[1], pa.int32()), *(lv.take(pa.array(c)) for lv, c in zip(levels, found)),
                                   pa.array(np.bincount(where)), pa.array(np.bincount(where, y)), pa.array(np.bincount(where, y * y))], schema=schema))
        emit(BASE, 0, codes)
        for f, r, source in permutations(texts, keys, cells, repeats):
            i = cells.index(f)
            emit(f, r, [c[source] if j == i else c for j, c in enumerate(codes)])
        return pa.concat_tables(parts)
    need = rows.select(F.col(key), F.col(target).cast("double").alias(target), *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cells)])
    columns = [f"c{i}" for i in range(len(cells))]
    spark_schema = "feature string, repeat int, " + ", ".join(f"{c} string" for c in columns) + ", n long, sy double, syy double"
    sums = in_blocks(need, key, n).applyInArrow(block, spark_schema).groupBy("feature", "repeat", *columns).agg(*[F.sum(c).alias(c) for c in ("n", "sy", "syy")])
    mean_of_cell = means.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cells)], "__cell_mean")
    p = F.coalesce(F.col("__cell_mean"), F.lit(float(overall)))
    return attach_group_values(sums, mean_of_cell, columns).groupBy("feature", "repeat").agg(F.sum(F.col("syy") - 2 * p * F.col("sy") + F.col("n") * p * p).alias("sse"))


def importances(errors: DataFrame, rows: DataFrame, target: str, features: list[str]) -> DataFrame:
    """feature, importance_mean, importance_std: the drop in R2 over the repeats, from the squared errors of all cases."""
    y = F.col(target).cast("double")
    total = rows.agg((F.sum(y * y) - F.pow(F.sum(y), 2) / F.count(y)).alias("sst")).first().sst or 0.0
    found = {}
    for r in errors.collect():  # a row for each feature and repeat
        found.setdefault(r.feature, []).append(r.sse)
    r2 = lambda sse: 1 - sse / total if total > 0 else 0.0
    base = r2(found.get(BASE, [0.0])[0])
    out = []
    for f in features:
        drops = [base - r2(sse) for sse in found.get(f, [])] or [0.0]
        out.append((f, float(np.mean(drops)), float(np.std(drops))))
    return rows.sparkSession.createDataFrame(sorted(out, key=lambda r: (-r[1], r[0])), "feature string, importance_mean double, importance_std double")
