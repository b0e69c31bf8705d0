"""Nearest neighbours by query-aware collision counting (QALSH).

Vectors are dealt to blocks of about ``BLOCK`` rows. A block's index is ``PROJECTIONS`` sorted arrays,
one for each random projection. Around a query's own projection every array opens a window of half
width ``WIDTH / 2`` times the search radius; enlarging the radius (virtual rehashing) only adds the two
new ends of each window. A vector that lies in at least ``THRESHOLD`` of the windows is verified
by its exact distance. The search in a block ends when the k best distances found are within the
radius: a vector at that distance lies in a window with probability 0.83, so it is missed with
probability of about 0.3 %. No cap on candidates.

Queries are dealt to blocks of ``QUERY_BLOCK`` and meet every block of vectors; a block's best are
merged by one ranking. Equal vectors are searched once: of each group of equal vectors only its
k + 1 smallest ids can be in a result, and equal queries share one search, so a vector that a third
of all rows hold costs no more than another.

Defined results: vectors that are null, empty or zero or hold null or non-finite components take
no part; vectors of other lengths than the query's are no candidates; ties go to the smaller id.
Ids are unique and not null (rows with a null id take no part). Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.session import materialize

PROJECTIONS = 48
WIDTH = 2.719
THRESHOLD = 32
GROWTH = 1.3
BLOCK = 8192
QUERY_BLOCK = 1024
SEED = 7


class Index:
    """Sorted arrays of one block."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.direction = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        where = (vectors @ self.direction).T
        self.order = np.argsort(where, axis=1, kind="stable")
        self.sorted = np.take_along_axis(where, self.order, axis=1)
        self.unit = max(float(where.std(axis=1).mean()) * 2 ** 0.5, 1e-12)

    def windows(self, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of the windows of all queries in each array."""
        half = WIDTH * radius / 2
        lo = np.stack([np.searchsorted(s, a - half, "left") for s, a in zip(self.sorted, at.T)], axis=1)
        hi = np.stack([np.searchsorted(s, a + half, "right") for s, a in zip(self.sorted, at.T)], axis=1)
        return lo, hi

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, distances) verified for each query, at least its k nearest."""
        n, at = len(self.vectors), queries @ self.direction
        count = np.zeros((len(queries), n), np.uint8)
        distance = [np.full(n, np.inf) for _ in queries]
        start = np.stack([np.searchsorted(s, a, "left") for s, a in zip(self.sorted, at.T)], axis=1)
        lo, hi, radius, todo = start, start.copy(), 0.2 * self.unit, np.arange(len(queries))
        while len(todo):
            new_lo, new_hi = self.windows(at[todo], radius)
            open_ = []
            for i, q in enumerate(todo):
                ids = np.concatenate([self.order[j, a:b] for j, (a, b) in enumerate(zip(new_lo[i], lo[i]))]
                                     + [self.order[j, a:b] for j, (a, b) in enumerate(zip(hi[i], new_hi[i]))])
                count[q] += np.bincount(ids, minlength=n).astype(np.uint8)
                fresh = np.flatnonzero((count[q] >= THRESHOLD) & np.isinf(distance[q]))
                distance[q][fresh] = np.sqrt(((self.vectors[fresh] - queries[q]) ** 2).sum(axis=1))
                known = np.isfinite(distance[q])
                enough = known.sum() >= k and np.partition(distance[q][known], k - 1)[k - 1] <= radius
                if not (enough or known.all()):
                    open_.append(i)
            lo, hi, todo = new_lo[open_], new_hi[open_], todo[open_]
            radius *= GROWTH
        return [(np.flatnonzero(np.isfinite(d)), d[np.isfinite(d)]) for d in distance]


def to_matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search_function(k: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        group, found, score = [], [], []
        if vectors.num_rows and queries.num_rows:
            ids = vectors.column("id").to_numpy()
            results = Index(to_matrix(vectors.column("v"))).search(to_matrix(queries.column("v")), k)
            for g, (rows, distance) in zip(queries.column("q").to_pylist(), results):
                best = np.lexsort((ids[rows], distance))[:k]
                group += [g] * len(best)
                found += ids[rows][best].tolist()
                score += distance[best].tolist()
        return pa.table({"q": pa.array(group, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})
    return search


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row of ``vectors`` that ``queries`` holds for."""
    good = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    base = good.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.size(vector_col).alias("dims"),
                       F.xxhash64(vector_col).alias("a"), F.xxhash64(F.reverse(vector_col)).alias("b"), F.coalesce(queries, F.lit(False)).alias("asks"))
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("id"))
    candidates = materialize(base.withColumn("place", place).where(f"place <= {k + 1}").select("id", "v", "dims"), "vectors")
    asking = materialize(base.where("asks").select("id", "v", "dims", "a", "b"), "queries")
    first = asking.groupBy("a", "b").agg(F.min("id").alias("q"))
    distinct = materialize(asking.join(first.select("q"), F.col("id") == F.col("q")).select("q", "v", "dims"), "searches")
    blocks, query_blocks = candidates.count() // BLOCK + 1, distinct.count() // QUERY_BLOCK + 1
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = candidates.select("id", "v", "dims", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), spread(query_blocks).alias("query_block"))
    asked = distinct.select("q", "v", "dims", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).cast("int").alias("query_block"), spread(blocks).alias("block"))
    by = ["block", "query_block", "dims"]
    found = dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(search_function(k + 1), "q long, vec_id long, score double")
    order = lambda key: F.row_number().over(Window.partitionBy(key).orderBy("score", "vec_id"))
    best = found.withColumn("place", order("q")).where(f"place <= {k + 1}").drop("place")
    members = asking.join(first, ["a", "b"]).select(F.col("id").alias("query_id"), "q")
    own = members.join(best, "q").where("vec_id <> query_id")
    return own.withColumn("rank", order("query_id")).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
