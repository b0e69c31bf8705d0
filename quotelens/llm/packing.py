"""Best-fit-decreasing packing of tokenized documents into sequences of fixed capacity.

Best fit looks at lengths only, and lengths run from 1 to the capacity. So the tasks tokenize and
cut documents and rank each piece among the equally long ones; the histogram of lengths (at most
``capacity`` numbers, whatever the input) is packed on the driver by best-fit decreasing, with a
segment tree over remaining capacities that finds the tightest open bin in logarithmic time; and
the placement rules are applied to the ranks in the tasks. Bins that are alike are one entry with
a count, so the driver's work doesn't grow with the documents, and the result is that of best-fit
decreasing over all pieces at once.

Defined results: null and empty texts are the end token alone; every row is packed, repeated rows
separately; an empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.llm.hyperminhash import slices
from quotelens.llm.tokens import encode
from quotelens.session import materialize

END_ID = 0


class OpenBins:
    """Open bins by remaining capacity: runs of bin numbers at the leaves of a segment tree."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = np.zeros(2 * self.size, bool)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _set(self, leaf: int, value: bool) -> None:
        node = self.size + leaf
        self.any[node] = value
        while node > 1:
            node >>= 1
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def add(self, remaining: int, first: int, n: int) -> None:
        if remaining and n:
            self.runs[remaining].append((first, n))
            self._set(remaining, True)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].pop()
        if not self.runs[remaining]:
            self._set(remaining, False)
        return run

    def tightest(self, need: int) -> int:
        """Least remaining capacity of at least ``need`` among open bins, or 0."""
        node = self.size + need
        if self.any[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return 0


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Placement rules (length, first rank, pieces, first bin, pieces per bin, first offset), one row each.

    Of the pieces of a length, those with ranks from the first rank on go to the bins from the
    first bin on, so many to each bin, end to end from the first offset."""
    bins, rules, next_bin = OpenBins(capacity), [], 0

    def place(length, rank, left, first, n_bins, remaining):
        """Fills bins in turn; returns how many pieces they took."""
        each = remaining // length
        n = min(left, n_bins * each)
        full, part = divmod(n, each)
        rules.append((length, rank, n, first, each, capacity - remaining))
        bins.add(remaining - each * length, first, full)
        if part:
            bins.add(remaining - part * length, first + full, 1)
        used = full + (part > 0)
        if used < n_bins:
            bins.add(remaining, first + used, n_bins - used)
        return n

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if remaining := bins.tightest(length):
                n = place(length, rank, left, *bins.take(remaining), remaining)
            else:
                opened = -(-left // (capacity // length))
                n = place(length, rank, left, next_bin, opened, capacity)
                next_bin += opened
            rank, left = rank + n, left - n
    return np.array(rules, np.int64).reshape(-1, 6)


def piece_function(path: str, capacity: int):
    def pieces(batches):
        task, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, off = encode(batch.column("text"), path)
                raw, end = ids.astype("<u4").tobytes(), np.uint32(END_ID).tobytes()
                row, piece, start, length, crc = [], [], [], [], []
                for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    n = b - a + 1
                    own = raw[4 * a:4 * b] + end
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for p, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                        row.append(i)
                        piece.append(p)
                        start.append(x)
                        length.append(y - x)
                        crc.append(zlib.crc32(own[4 * x:4 * y]))
                size = np.array(length, np.int64)
                order = np.argsort(size, kind="stable")
                values, first, n = np.unique(size[order], return_index=True, return_counts=True)
                rank = np.empty(len(size), np.int64)
                rank[order] = np.arange(len(size)) - np.repeat(first, n) + np.repeat(ranks[values], n)
                ranks[values] += n
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(size), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int64()), pa.array(rank)],
                    names=["id", "piece", "start", "length", "ids_crc32", "task", "rank"])
    return pieces


def place_function(shared):
    def place(batches):
        rules = shared.value
        order = np.lexsort((rules[:, 1], rules[:, 0]))
        length, first_rank, _, first_bin, each, offset = rules[order].T
        wide = int(first_rank.max(initial=0)) + 1
        for batch in batches:
            if not batch.num_rows:
                continue
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            lo = np.searchsorted(length, size, "left")
            at = np.searchsorted(length * wide + first_rank, size * wide + np.minimum(rank, wide - 1), "right") - 1
            assert (at >= lo).all()
            inside = rank - first_rank[at]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                pa.array(first_bin[at] + inside // each[at]), pa.array(offset[at] + inside % each[at] * size)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    A document's tokens and the end token are cut only if they exceed the capacity; the first
    piece then holds what is left over."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    columns = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    cut = materialize(base.mapInArrow(piece_function(path, capacity), f"{columns}, task long, rank long"), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}
    rules = docs.sparkSession.sparkContext.broadcast(best_fit_decreasing(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (cut.join(before, ["length", "task"])
              .select("id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")))
    return ranked.mapInArrow(place_function(rules), f"{columns}, sequence_id long, offset long").withColumnRenamed("id", id_col)
