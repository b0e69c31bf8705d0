"""Token-id files in Simple-8b: word-aligned, with escapes and the offsets of independent blocks.

A token file is a Parquet file whose rows are runs of whole documents in ascending id order: the documents'
ids and token counts, the number of token ids before the run in its file, and the token ids as 64-bit words.
A word's four high bits select how many values of which width share the other 60 bits. Blocks of ``BLOCK``
values are coded independently and each block's first word is listed, so a reader can decode any block alone
and all blocks of a run at once. Values of more than 60 bits are escaped: a word of selector 15 carries the
high bits of the value that follows it.

Documents are dealt to files by ranges of (id, hash of the text, row), so a repeated id is no hot key. Files
are written and read by Spark, in the shared folder; a file is one task's, and a lost task writes it again.

Defined results: null and empty texts are the end id alone; null ids come last; rows of equal id follow one
another in an order that depends on their texts only; an empty table gives files without rows. Other columns
are ignored. A task holds one run of documents, of ``RUN`` values or of one longer document.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.llm.hyperminhash import slices
from quotelens.llm.words import byte_table, per_process, units, utf8_buffer
from quotelens.session import stage_path

END_ID = 1
#: Values of a block, and of a run of documents.
BLOCK, RUN = 1024, 1 << 18
#: Fixed values of the coding: values in a word and their width in bits, by selector from 1 to 14.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
#: Units remembered by a Python worker; beyond it the memory turns: what is met again before the next turn stays.
REMEMBERED = 300_000


def bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 at least (beyond 53 bits one more where the value is next to a power of two)."""
    return np.maximum(np.frexp(values.astype(np.float64))[1], 1)


def widest(need: np.ndarray) -> dict[int, np.ndarray]:
    """For each selector but the last, the bits of the widest of the values that a word would hold, from each place of each block on.

    ``need``: a row for each block, with room for a whole word after its end."""
    spans = {1: need}

    def span(n: int) -> np.ndarray:
        if n not in spans:
            half = next(c for c in sorted({*COUNTS.tolist(), 1}, reverse=True) if n / 2 <= c < n)
            known = span(half)
            spans[n] = known.copy()
            np.maximum(known[:, :half - n], known[:, n - half:], out=spans[n][:, :half - n])
        return spans[n]
    return {s: span(int(COUNTS[s])) for s in range(13, 0, -1)}


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned 64-bit values; all blocks are packed side by side."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    room = int(COUNTS.max())
    padded = np.zeros(blocks * BLOCK + room, np.uint64)  # a block's last word may reach beyond its end
    padded[:n] = values
    need = bits(padded[:blocks * BLOCK]).astype(np.uint8)
    escaped = need > 60
    need[escaped], need[n:] = 60, 0
    grid = np.zeros((blocks, BLOCK + room), np.uint8)
    grid[:, :BLOCK] = need.reshape(blocks, BLOCK)
    choice = np.full((blocks, BLOCK), 14, np.int8)
    for s, top in widest(grid).items():  # the selector of most values whose values all fit
        choice[top[:, :BLOCK] <= WIDTHS[s]] = s
    choice = choice.ravel()
    step = COUNTS.astype(np.int8)[choice]
    pos, end = np.arange(blocks) * BLOCK, np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    starts, live, stop = [], pos, end
    while len(live):
        starts.append(live)
        live = live + step[live]
        on = live < stop
        live, stop = live[on], stop[on]
    starts = np.sort(np.concatenate(starts))
    owner = starts // BLOCK
    selector = choice[starts].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        place = np.arange(COUNTS[s])
        grid = starts[rows, None] + place
        held = padded[grid] & np.uint64((1 << 60) - 1)
        held[grid >= end[owner[rows], None]] = 0  # beyond the block's end
        words[rows] |= np.bitwise_or.reduce(held << (WIDTHS[s] * place).astype(np.uint64), axis=1)
    first = np.searchsorted(owner, np.arange(blocks))
    if escaped.any():  # one value a word there: the escape goes before it
        high = np.flatnonzero(escaped[starts])
        words = np.insert(words, high, (np.uint64(ESCAPE) << np.uint64(60)) | (padded[starts[high]] >> np.uint64(60)))
        first += np.searchsorted(high, first)
    return words, first.astype(np.int32)


def unpack(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The n values of the words of whole blocks."""
    words = np.ascontiguousarray(words, np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    total = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], count)
    width = WIDTHS[selector]
    values = (np.repeat(words & np.uint64((1 << 60) - 1), count) >> (place * np.repeat(width, count)).astype(np.uint64)) \
        & ((np.uint64(1) << np.repeat(width, count).astype(np.uint64)) - np.uint64(1))
    marks = np.flatnonzero(selector == ESCAPE)
    if len(marks):
        values[total[marks]] |= (words[marks] & np.uint64(15)) << np.uint64(60)
    block_start = total[np.asarray(first, np.int64)]
    sizes = np.minimum(BLOCK, n - BLOCK * np.arange(len(first)))
    inside = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return values[np.repeat(block_start, sizes) + inside]


def unpack_range(words: np.ndarray, first: np.ndarray, n: int, begin: int, end: int) -> np.ndarray:
    """Values ``begin`` up to ``end`` of a run; only the blocks that hold them are decoded."""
    if begin >= end:
        return np.zeros(0, np.uint64)
    a, b = begin // BLOCK, -(-end // BLOCK)
    to = first[b] if b < len(first) else len(words)
    part = unpack(words[first[a]:to], first[a:b] - first[a], min(n, b * BLOCK) - a * BLOCK)
    return part[begin - a * BLOCK:end - a * BLOCK]


class Encoder:
    """Ids of whole texts by a lower-casing BPE file whose pre-tokenizer drops white space.

    No pre-token goes across ASCII white space, or from an ASCII letter to an ASCII punctuation mark, and the
    normalizer composes nothing there. So texts are cut at both and each distinct unit, in lower case, is
    encoded once. A unit of lower-case Latin-1 letters is one pre-token, which the library's model takes
    directly. Texts that hold the string of an added token are encoded whole."""

    WHITE, LETTER, MARK = 1, 2, 3
    KIND = np.zeros(256, np.uint8)
    KIND[[0x20, *range(0x09, 0x0E)]] = WHITE
    KIND[33:127] = MARK
    KIND[48:58] = 0
    KIND[[*range(65, 91), *range(97, 123)]] = LETTER
    LOWER = np.arange(256, dtype=np.uint8) + 32 * byte_table(range(65, 91)).astype(np.uint8)
    SIMPLE = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        rest = [b for b in range(256) if b not in plain]
        self.shown = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def places(self, data: bytes) -> list[int]:
        """Where the strings of added tokens begin."""
        out = []
        for content in self.added:
            at = data.find(content)
            while at >= 0:
                out.append(at)
                at = data.find(content, at + 1)
        return out

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, np.uint32)

    def of_units(self, distinct: list[bytes]) -> list[bytes]:
        """Ids of each unit, as 32-bit numbers end to end. Units met since the memory last turned stay known."""
        known, old, tokenize, simple, shown = self.known, self.old, self.model.tokenize, self.SIMPLE.fullmatch, self.shown
        rest = []
        for u in distinct:
            if u in known:
                continue
            before = old.get(u)
            if before is not None:
                known[u] = before
            elif u.isalpha():  # lower-case ASCII letters
                known[u] = array("I", [t.id for t in tokenize(u.decode("ascii"))]).tobytes()
            elif simple(u):
                known[u] = array("I", [t.id for t in tokenize(u.decode("latin-1").translate(shown))]).tobytes()
            else:
                rest.append(u)
        found = self.tokenizer.encode_batch_fast([u.decode("utf-8") for u in rest], add_special_tokens=False)
        known.update((u, array("I", e.ids).tobytes()) for u, e in zip(rest, found))
        if len(known) > REMEMBERED:
            self.known, self.old = {}, known
        return [known[u] for u in distinct]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows end to end, row offsets) of a string array; nulls are empty."""
        raw, off = utf8_buffer(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        kind = self.KIND[raw]
        plain = kind != self.WHITE
        begin = plain.copy()
        begin[1:] &= (kind[:-1] == self.WHITE) | ((kind[1:] == self.MARK) & (kind[:-1] == self.LETTER))
        rows = off[:-1][off[:-1] < len(raw)]
        begin[rows] = plain[rows]
        last = plain.copy()
        last[:-1] &= ~plain[1:] | begin[1:]
        at = np.flatnonzero(begin)
        codes, distinct = units(self.LOWER[raw[plain]], np.flatnonzero(last) + 1 - at)
        found = self.of_units(distinct.to_pylist())
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        n = size[codes]
        ends = np.cumsum(n, dtype=np.int32)  # a slice of some MB
        ids = flat[np.repeat((np.cumsum(size, dtype=np.int32) - size)[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        rows = np.concatenate([[0], ends])[np.searchsorted(at, off)]
        odd = np.unique(np.searchsorted(off, self.places(raw.tobytes()), "right") - 1)
        if not len(odd):
            return ids, rows
        parts = [ids[a:b] for a, b in zip(rows[:-1], rows[1:])]
        for i in odd.tolist():
            parts[i] = self.whole(raw[off[i]:off[i + 1]].tobytes())
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def write_function(path: str, kind: pa.DataType, end_id: int):
    def write(batches):
        encoder, file, before = per_process(("idfiles", path), lambda: Encoder(path)), TaskContext.get().partitionId(), 0
        ids, counts, parts = [], [], []

        def run():
            nonlocal before, ids, counts, parts
            values = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            words, first = pack(values)
            out = pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([before], pa.int64()), pa.array([len(values)], pa.int64()),
                one_list(pa.concat_arrays(ids).cast(kind)), one_list(pa.array(np.concatenate(counts))),
                pa.array([words.astype("<u8").tobytes()], pa.binary()), pa.array([first.astype("<i4").tobytes()], pa.binary())],
                names=["file", "before", "n_ids", "id", "n_tokens", "words", "blocks"])
            before, ids, counts, parts = before + len(values), [], [], []
            return out

        held = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                found, off = encoder.encode(batch.column("text"))
                found = np.insert(found, off[1:], end_id)
                sizes = np.diff(off) + 1
                stops = np.cumsum(sizes)
                a = 0
                while a < batch.num_rows:  # whole documents up to RUN values, one at least
                    done = int(stops[a - 1]) if a else 0
                    b = int(np.searchsorted(stops, done + max(0, RUN - held), "right"))
                    if b == a and held:
                        yield run()
                        held = 0
                        continue
                    b = max(b, a + 1)
                    ids.append(batch.column("id").slice(a, b - a))
                    counts.append(sizes[a:b])
                    parts.append(found[done:int(stops[b - 1])])
                    held += int(stops[b - 1]) - done
                    a = b
        if held:
            yield run()
    return write


def write_token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes every text and writes the token files, in ascending id order from file to file; returns their path."""
    spark = docs.sparkSession
    if path is None:
        import uuid
        path = stage_path(spark, f"token-ids-{uuid.uuid4().hex[:12]}")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType
    keyed = base.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_last(), F.col("tie"), F.col("row")]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    from pyspark.sql.pandas.types import to_arrow_type
    columns = f"file int, before long, n_ids long, id array<{kind.simpleString()}>, n_tokens array<long>, words binary, blocks binary"
    runs = dealt.select("id", "text").mapInArrow(write_function(tokenizer, to_arrow_type(kind), end_id), columns)
    runs.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def read_function(kind: pa.DataType, with_ids: bool):
    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("file", "before", "n_ids", "id", "n_tokens")}
                words = np.frombuffer(batch.column("words")[i].as_buffer(), "<u8")
                first = np.frombuffer(batch.column("blocks")[i].as_buffer(), "<i4")
                values = unpack(words, first, row["n_ids"].as_py()).astype("<u4")
                sizes = row["n_tokens"].values.to_numpy()
                ends = np.cumsum(sizes)
                raw = memoryview(values).cast("B") if len(values) else memoryview(b"")
                crc = [zlib.crc32(raw[4 * (e - s):4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                arrays = [row["id"].values.cast(kind), pa.array([row["file"].as_py()] * len(sizes), pa.int32()), pa.array(ends - sizes + row["before"].as_py()),
                          pa.array(sizes), pa.array(crc, pa.int64())]
                names = ["id", "file", "before", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return read


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids (array<long>) of every document."""
    from pyspark.sql.pandas.types import to_arrow_type
    runs = spark.read.parquet(path)
    kind = runs.schema["id"].dataType.elementType
    columns = f"id {kind.simpleString()}, file int, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = runs.mapInArrow(read_function(to_arrow_type(kind), with_ids), columns)
    sums = runs.groupBy("file").agg(F.sum("n_ids").alias("total"))  # one row a file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("file_start"))
    return (found.join(starts, "file")
            .select(F.col("id").alias(id_col), (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))
