"""Fill-in-the-middle transformation over a seekable store of compressed text frames.

A text is stored as independent zstandard frames of at most ``UNITS`` code points with their cumulative
unit counts. A transformation cuts the text at two unit offsets: only the frames that hold a cut are
decompressed, every other frame goes to its new place as it is, and markers and cut frames' parts become
small frames of their own. So an output is a list of frames too; digests stream these in order.

Defined results: null and empty texts, and texts that hold a marker, stay plain; a null id counts as the
empty string in the hash that draws form and cuts. Every row is transformed by itself, so repeated rows give
repeated outputs, and an empty table gives an empty one. Other columns are ignored. A task holds one batch
of rows and one document's frames; a document's text is held whole only where it is rebuilt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.llm.hyperminhash import slices
from quotelens.llm.words import per_process
from quotelens.session import materialize

#: Code points of a frame.
UNITS = 16_384
LEVEL = 3
#: Markers of the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are transformed, and of 100 of these so many have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20


def _tools():
    import zstandard
    return per_process("zstd", lambda: (zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()))


def compress(text: str) -> bytes:
    return _tools()[0].compress(text.encode("utf-8"))


def decompress(frame: bytes) -> bytes:
    return _tools()[1].decompress(frame)


def frames_of(text: str, units: int) -> tuple[list[int], list[bytes]]:
    """(cumulative unit counts, frames) of a text."""
    ends = [*range(units, len(text), units), *([len(text)] if text else [])]
    return ends, [compress(text[max(0, e - 1) // units * units:e]) for e in ends]


class Seekable:
    """Unit ranges of one stored text."""

    def __init__(self, ends: list[int], frames: list[bytes]):
        self.ends, self.frames = np.asarray(ends, np.int64), frames
        self.open: dict[int, str] = {}

    def _text(self, i: int) -> str:
        if i not in self.open:
            self.open[i] = decompress(self.frames[i]).decode("utf-8")
        return self.open[i]

    def pieces(self, begin: int, end: int) -> Iterator[bytes | str]:
        """The units from ``begin`` up to ``end``: whole frames as they are stored, parts of frames as text."""
        while begin < end:
            i = int(np.searchsorted(self.ends, begin, "right"))
            first, last = int(self.ends[i - 1]) if i else 0, int(self.ends[i])
            if begin == first and end >= last:
                yield self.frames[i]
            else:
                yield self._text(i)[begin - first:end - first]
            begin = min(end, last)


def joined(pieces: Iterable[bytes | str]) -> list[bytes]:
    """Frames of the pieces; neighbouring texts share one."""
    out: list[bytes] = []
    texts: list[str] = []
    for p in [*pieces, b""]:
        if isinstance(p, str):
            texts.append(p)
            continue
        if any(texts):
            out.append(compress("".join(texts)))
        texts = []
        if p:
            out.append(p)
    return out


def store_function(units: int):
    def store(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                made = [frames_of(t, units) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts], pa.bool_()),
                    pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.list_(pa.binary()))],
                    names=["id", "n", "marked", "ends", "frames"])
    return store


def write_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = UNITS) -> DataFrame:
    """Writes the store and reads it back: id, n (code points), marked (a marker occurs), ends, frames."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    stored = base.mapInArrow(store_function(units), f"id {kind}, n long, marked boolean, ends array<long>, frames array<binary>")
    return materialize(stored.withColumnRenamed("id", id_col), "frames")


def drawn(id_col: str, number: int) -> Column:
    """The number-th (from 1) group of 8 hexadecimal digits of the hash of an id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def transform_function():
    def transform(batches):
        for batch in batches:
            out = []
            for n, form, a, b, ends, frames in zip(*(batch.column(c).to_pylist() for c in ("n", "form", "first", "second", "ends", "frames"))):
                text = Seekable(ends, frames)
                if form == "plain":
                    out.append(frames)
                    continue
                prefix, middle, suffix = (list(text.pieces(*span)) for span in ((0, a), (a, b), (b, n)))
                order = (PREFIX, *prefix, SUFFIX, *suffix, MIDDLE, *middle) if form == "psm" else (SUFFIX, *suffix, PREFIX, *prefix, MIDDLE, *middle)
                out.append(joined(order))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "form", "first", "second")), pa.array(out, pa.list_(pa.binary()))],
                                             names=["id", "n", "form", "first", "second", "output"])
    return transform


def fill_in_middle(store: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, output (frames) of every stored text.

    Form and cuts are drawn from a hash of the id; cut sizes are null for plain texts."""
    n = F.col("n")
    cuts = [F.pmod(drawn(id_col, i), n + 1) for i in (1, 2)]
    plain = (n == 0) | F.col("marked") | (drawn(id_col, 3) % 100 >= TRANSFORMED)
    form = F.when(plain, "plain").when(drawn(id_col, 4) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    asked = store.select(F.col(id_col).alias("id"), n, form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"), "ends", "frames")
    kind = asked.schema["id"].dataType.simpleString()
    made = asked.mapInArrow(transform_function(), f"id {kind}, n long, form string, first long, second long, output array<binary>")
    cut = F.col("form") != "plain"
    return made.select(F.col("id").alias(id_col), "n", "form", F.when(cut, F.col("first")).alias("prefix_chars"),
                       F.when(cut, F.col("second") - F.col("first")).alias("middle_chars"), "output")


def original(output: bytes, form: str) -> list[memoryview]:
    """The parts of the text, in order, from an output and its form alone.

    Marked texts are plain, and no marker begins with the end of another, so each marker's first
    occurrence is the one that was put there."""
    whole = memoryview(output)
    if form == "plain":
        return [whole]
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    inner, last = (s, p) if form == "psm" else (p, s)
    a = output.index(inner if form == "psm" else p)
    b = output.index(m)
    first, second, third = whole[len(last):a], whole[a + len(inner):b], whole[b + len(m):]
    return [first, third, second] if form == "psm" else [second, third, first]


def digest_function():
    def digests(batches):
        for batch in batches:
            made, restored = [], []
            for form, frames in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist()):
                digest, parts = hashlib.sha256(), []
                for frame in frames:
                    parts.append(decompress(frame))
                    digest.update(parts[-1])
                made.append(digest.hexdigest())
                back = hashlib.sha256()
                for part in original(b"".join(parts), form):
                    back.update(part)
                restored.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "output"), pa.array(made), pa.array(restored)],
                                             names=[*(c for c in batch.schema.names if c != "output"), "output_sha256", "restored_sha256"])
    return digests


def digests(outputs: DataFrame) -> DataFrame:
    """The outputs' columns without the frames, output_sha256, restored_sha256 (rebuilt from output and form)."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema if f.name != "output")
    return outputs.mapInArrow(digest_function(), f"{kept}, output_sha256 string, restored_sha256 string")


def texts(outputs: DataFrame) -> DataFrame:
    """The outputs' columns with the output as one string."""
    def join(batches):
        for batch in batches:
            out = [b"".join(map(decompress, frames)).decode("utf-8") for frames in batch.column("output").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("output"), "output", pa.array(out, pa.string()))
    kept = ", ".join(f"`{f.name}` {'string' if f.name == 'output' else f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(join, kept)
