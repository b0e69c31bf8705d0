"""Words and word windows of whole Arrow string arrays, vectorised with numpy.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. Texts are read as UTF-8 bytes; all separators
are single bytes below 0x80, so no character is ever split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multipliers of the two rolling hashes (fixed, so that reruns agree).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def byte_table(values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


def utf8_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string array; nulls are empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def units(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of the byte runs that lie end to end in ``flat``."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths),
                                           [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(flat))])
    enc = arr.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False), enc.dictionary


class Words:
    """Words of the rows of a string array.

    ``codes``: a dictionary code for each word, all rows end to end; ``first``: index of each
    row's first word (one more entry at the end); ``flat`` and ``lengths``: the words' bytes.
    """

    def __init__(self, arr, lower: bool = False):
        sep_table = byte_table([0x20, *range(0x09, 0x0E)])
        data, off = utf8_buffer(arr)
        sep = sep_table[data]
        begin = ~sep
        begin[1:] &= sep[:-1]
        rows = off[:-1][off[:-1] < len(data)]
        begin[rows] = ~sep[rows]
        end = ~sep
        end[:-1] &= sep[1:]
        last = off[1:][off[1:] > 0] - 1
        end[last] = ~sep[last]
        self.starts = np.flatnonzero(begin)
        self.lengths = np.flatnonzero(end) + 1 - self.starts
        self.first = np.searchsorted(self.starts, off)
        self.flat = data[~sep]
        if lower:
            table = np.arange(256, dtype=np.uint8)
            table[65:91] += 32
            self.flat = table[self.flat]
        self.codes, self.dictionary = units(self.flat, self.lengths)
        self.n_rows = len(off) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each word."""
        digest = b"".join(map(xxhash.xxh3_128_digest, self.dictionary.to_pylist()))
        both = np.frombuffer(digest, np.uint64).reshape(-1, 2)
        return both[self.codes, 0], both[self.codes, 1]

    def window_starts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, row) of each window of k words within one row."""
        n = np.maximum(self.counts - k + 1, 0)
        row = np.repeat(np.arange(self.n_rows), n)
        skipped = np.cumsum(n) - n
        return np.arange(len(row)) + np.repeat(self.first[:-1] - skipped, n), row


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(values: np.ndarray, starts: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of the k values from each start, from one prefix sum."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n = len(values)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power)])
    back = pow(base, -1, 1 << 64)
    inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, back, np.uint64)]))
    return mix((prefix[starts + k] - prefix[starts]) * inverse[starts])


def unused(df, *names: str) -> list[str]:
    """Names for helper columns that the frame doesn't have (Spark compares names without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def per_process(key, make):
    """What ``make`` returns, once for each Python worker (task functions are unpickled for each task)."""
    import sys
    import types
    home = sys.modules.setdefault("_pipeline_worker_values", types.ModuleType("_pipeline_worker_values")).__dict__
    if key not in home:
        home[key] = make()
    return home[key]
