"""Substring dedup: remove word windows that occur more than once in the corpus.

Two passes over the same chunks of documents, one text shuffle:

1. *Count-min prefilter.* Each chunk of documents (about ``CHUNK_CHARS`` characters) hashes its
   windows into ``DEPTH`` rows of a sketch that is as wide as the corpus asks for
   (``CELLS_PER_WINDOW`` cells a window). A partition's sketch is sparse: sorted cells with a
   "here more than once" bit, cut into shards of the cell space. The shards are merged by adding
   counts, each in its own task, and every chunk gets back those of its cells whose merged count
   is two or more. No sketch is broadcast and none passes through the driver, so the width grows
   with the input while each task holds one shard.
2. *Exact pass.* A window whose estimate (least count over the rows) is at least two is a
   candidate; counts are never underestimated, so no repeated window is lost. Candidates are
   grouped by a 96-bit key of their word sequence, once for each chunk, so a window in a third of
   all documents costs one entry a chunk. The keys found only once (overestimates) go back to
   their chunks, which then drop the words covered by the others.

Defined results: null or empty texts have no words; texts shorter than a window lose nothing;
repeated rows (same id and text) count as separate occurrences, so each of them loses all its
windows; an empty table gives an empty result; columns other than id and text are ignored.
Documents are dealt to chunks by a hash of id and text; a chunk's memory is bounded by
``CHUNK_CHARS`` or its longest document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.words import BASES, Words, mix, rolling

CHUNK_CHARS = 8_000_000
SHARD_WINDOWS = 2_000_000
CELLS_PER_WINDOW = 8
DEPTH = 2
#: One row of each exact key list starts with h1 (8 bytes) and the low half of h2 (4 bytes).
LIST_SCHEMA = "chunk long, kind int, shard long, body binary"
OUT_SCHEMA = "id {id}, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"


def pack(sorted_values: np.ndarray) -> bytes:
    """Sorted unsigned values below 2**32 as differences, byte planes compressed."""
    d = np.diff(sorted_values.astype(np.int64), prepend=0).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(d.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def lists(rows: list[tuple]) -> pa.Table:
    chunk, kind, shard, body = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "kind": pa.array(kind, pa.int32()),
                     "shard": pa.array(shard, pa.int64()), "body": pa.array(body, pa.binary())})


def windows_of(words: Words, size: int):
    """(first word, row, hash 1, hash 2) of every window."""
    starts, row = words.window_starts(size)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return starts, row, none, none
    a, b = words.hashes()
    return starts, row, rolling(a, starts, size, BASES[0]), rolling(b, starts, size, BASES[1])


def cells_of(h1: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Sketch cell of each window in one row of the sketch."""
    return (mix(h1 + np.uint64(depth * 0x632BE59BD9B4E019)) >> np.uint64(64 - bits)).astype(np.int64)


def cut(order_key: np.ndarray, shift: int):
    """(shard, from, to) of the runs of equal high bits in sorted values."""
    shard = order_key >> shift
    at = np.flatnonzero(np.diff(shard)) + 1
    lo = np.concatenate([[0], at])
    hi = np.concatenate([at, [len(shard)]])
    return [(int(shard[i]), i, j) for i, j in zip(lo, hi)] if len(shard) else []


def sketch_function(size: int, bits: int, shard_bits: int):
    def sketch(table: pa.Table) -> pa.Table:
        """A chunk's sparse sketch: (cell in shard) * 2 + (here more than once)."""
        chunk, rows = table.column("chunk")[0].as_py(), []
        _, _, h1, _ = windows_of(Words(table.column("text")), size)
        low = bits - shard_bits
        for d in range(DEPTH):
            cell = np.sort(cells_of(h1, d, bits))
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]
            more = np.diff(np.flatnonzero(np.append(first, True))) > 1
            cell = cell[first]
            for shard, i, j in cut(cell, low):
                inside = cell[i:j] & ((1 << low) - 1)
                rows.append((chunk, d, shard, pack(inside * 2 + more[i:j])))
        return lists(rows)
    return sketch


def merge_function(low: int):
    def merge(table: pa.Table) -> pa.Table:
        """Adds the partition sketches of one shard; each chunk gets its cells that count two or more."""
        chunks, bodies = table.column("chunk").to_pylist(), table.column("body").to_pylist()
        d, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
        count = np.zeros(1 << low, np.uint8)
        for body in bodies:
            v = unpack(body)
            cell = v >> 1
            count[cell] = np.minimum(count[cell] + 1 + (v & 1).astype(np.uint8), 2)
        rows = []
        for chunk, body in zip(chunks, bodies):
            cell = unpack(body) >> 1
            cell = cell[count[cell] >= 2]
            if len(cell):
                rows.append((chunk, d, shard, pack(cell)))
        return lists(rows)
    return merge


class Estimate:
    """The cells of a chunk that count two or more, as one bit table for each row of the sketch.

    Tables are addressed by the low bits of the cell: cells that share them only add estimates."""

    def __init__(self, hot: pa.Table, bits: int, low: int):
        self.bits = bits
        self.mask = (1 << min(bits, 24)) - 1
        self.rows = np.zeros((DEPTH, self.mask + 1), bool)
        for d, shard, body in zip(hot.column("kind").to_pylist(), hot.column("shard").to_pylist(), hot.column("body").to_pylist()):
            if d < DEPTH:
                self.rows[d, ((shard << low) + unpack(body)) & self.mask] = True

    def repeated(self, h1: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for d in range(DEPTH):
            out &= self.rows[d, cells_of(h1, d, self.bits) & self.mask]
        return out


def keys(h1: np.ndarray, h2: np.ndarray):
    """Distinct 96-bit keys in order and how often each occurs."""
    h2 = h2.astype(np.uint32)
    order = np.lexsort((h2, h1))
    h1, h2 = h1[order], h2[order]
    first = np.ones(len(h1), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    n = np.diff(np.flatnonzero(np.append(first, True)))
    return h1[first], h2[first], n


def candidate_function(size: int, bits: int, shard_bits: int):
    def candidates(docs: pa.Table, hot: pa.Table) -> pa.Table:
        """Keys of a chunk's windows whose estimate is two or more, once each, with a "more than once here" byte."""
        if not docs.num_rows or not hot.num_rows:
            return lists([])
        chunk = docs.column("chunk")[0].as_py()
        _, _, h1, h2 = windows_of(Words(docs.column("text")), size)
        est = Estimate(hot, bits, bits - shard_bits).repeated(h1)
        h1, h2, n = keys(h1[est], h2[est])
        rows = []
        for shard, i, j in cut((h1 >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(h1), np.int64), 0):
            rows.append((chunk, DEPTH, shard, h1[i:j].tobytes() + h2[i:j].tobytes() + (n[i:j] > 1).tobytes()))
        return lists(rows)
    return candidates


def open_keys(body: bytes, flags: bool = True):
    n = len(body) // (13 if flags else 12)
    return (np.frombuffer(body, np.uint64, n), np.frombuffer(body, np.uint32, n, 8 * n),
            np.frombuffer(body, bool, n, 12 * n) if flags else None)


def exact(table: pa.Table) -> pa.Table:
    """Groups the keys of one shard; each chunk gets back its keys that occur once in the whole corpus."""
    shard = table.column("shard")[0].as_py()
    chunks = table.column("chunk").to_pylist()
    parts = [open_keys(b) for b in table.column("body").to_pylist()]
    h1, h2, more = (np.concatenate([p[i] for p in parts]) for i in range(3))
    owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    alone = ~more[order]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    rows, own = [], owner[order][alone]
    a, b = a[alone], b[alone]
    by_chunk = np.argsort(own, kind="stable")
    for i, lo, hi in cut(own[by_chunk], 0):
        pick = by_chunk[lo:hi]
        rows.append((chunks[i], DEPTH, shard, a[pick].tobytes() + b[pick].tobytes()))
    return lists(rows)


def spans(covered: np.ndarray, first: np.ndarray) -> list[list[dict]]:
    """Runs of covered words of each row, as word positions within the row, end exclusive."""
    out = []
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for lo, hi in zip(first[:-1], first[1:]):
        i, j = np.searchsorted(end, lo, "right"), np.searchsorted(begin, hi, "left")
        out.append([{"start": int(max(b, lo) - lo), "end": int(min(e, hi) - lo)} for b, e in zip(begin[i:j], end[i:j])])
    return out


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each row joined by one space."""
    lengths = words.lengths[keep]
    flat = words.flat[np.repeat(keep, words.lengths)]
    out = np.full(len(flat) + len(lengths), 32, np.uint8)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)] = flat
    kept_before = np.concatenate([[0], np.cumsum(keep)])[words.first]
    ends = np.concatenate([[0], np.cumsum(lengths + 1)])[kept_before]
    raw = out.tobytes()
    return pa.array([raw[a:max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())


def removal_function(size: int, bits: int, shard_bits: int):
    def remove(docs: pa.Table, back: pa.Table) -> pa.Table:
        words = Words(docs.column("text"))
        covered = np.zeros(len(words.codes), bool)
        if docs.num_rows and back.num_rows:
            starts, _, h1, h2 = windows_of(words, size)
            est = Estimate(back, bits, bits - shard_bits).repeated(h1)
            starts, h1, h2 = starts[est], h1[est], h2[est].astype(np.uint32)
            single = {}
            for kind, body in zip(back.column("kind").to_pylist(), back.column("body").to_pylist()):
                if kind == DEPTH:
                    a, b, _ = open_keys(body, flags=False)
                    single.update(((x, y), True) for x, y in zip(a.tolist(), b.tolist()))
            if single:
                maybe = np.isin(h1, np.array([x for x, _ in single], np.uint64))
                drop = [i for i in np.flatnonzero(maybe).tolist() if (int(h1[i]), int(h2[i])) in single]
                starts = np.delete(starts, drop)
            step = np.zeros(len(covered) + 1, np.int32)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + size, -1)
            covered = np.cumsum(step[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(covered)])[words.first]
        return pa.table({
            "id": docs.column("id"), "n_words": pa.array(words.counts, pa.int64()),
            "n_removed": pa.array(np.diff(removed), pa.int64()), "kept_text": joined(words, ~covered),
            "removed": pa.array(spans(covered, words.first), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        })
    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """id, n_words, n_removed, kept_text, removed (word spans) for every row of ``docs``."""
    chars = docs.select(F.sum(F.length(F.col(text_col)))).first()[0] or 0
    chunks = chars // CHUNK_CHARS + 1
    estimate = chars // 5 + 1  # words, and so windows, of a usual text; only sizes depend on it
    shard_bits = max(0, (estimate // SHARD_WINDOWS).bit_length())
    bits = max(16, (estimate * CELLS_PER_WINDOW).bit_length(), shard_bits + 10)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)).alias("chunk"))
    by_chunk = base.groupBy("chunk")
    sketch = by_chunk.applyInArrow(sketch_function(window, bits, shard_bits), LIST_SCHEMA)
    hot = sketch.groupBy("kind", "shard").applyInArrow(merge_function(bits - shard_bits), LIST_SCHEMA)
    found = by_chunk.cogroup(hot.groupBy("chunk")).applyInArrow(candidate_function(window, bits, shard_bits), LIST_SCHEMA)
    single = found.groupBy("shard").applyInArrow(exact, LIST_SCHEMA)
    back = hot.unionByName(single)
    kind = base.schema["id"].dataType.simpleString()
    out = by_chunk.cogroup(back.groupBy("chunk")).applyInArrow(removal_function(window, bits, shard_bits), OUT_SCHEMA.format(id=kind))
    return out.withColumnRenamed("id", id_col)
