"""Language identification by prediction by partial matching (PPM).

Every language has a context tree of byte orders 0 to ``ORDER``. In a context that was seen n times
with t distinct next bytes, a seen byte of count c has probability c / (n + t) and the escape
t / (n + t) (method C); an escape goes on to the next shorter context with the bytes already
excluded, down to the uniform distribution over 256 bytes. A text's code length under each frozen
tree is the exact sum of its bytes' -log2 probabilities; the shortest code wins, and the score is
the posterior of that language under equal priors.

Every (language, context, next byte) count is kept, at any input size. One pass counts the grams of
all texts in the tasks (those of rows that are not learned only as grams to be judged). The counts
are dealt by the last two context bytes to shards, which grow in number with the gram table; a
shard holds all counts of its contexts of orders 2 and 3 and gives the code length of each of its
grams in each language. Orders 0 and 1 (256 and 65,536 grams a language at most) go to every shard.
Texts are dealt to chunks; a chunk asks for its distinct grams' code lengths and sums them. No table
of higher order reaches the driver or is broadcast.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text
when nothing could be learned; ties go to the alphabetically first language. Other columns are
ignored, repeated rows are treated alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.llm.hyperminhash import slices
from quotelens.llm.words import byte_table, utf8_buffer
from quotelens.session import materialize

ORDER = 3
#: Orders whose counts every shard gets; the context bytes of the next order deal the others.
LOW_ORDERS = 2
SHARD_GRAMS = 100_000
LEAST_SHARDS = 64
CHUNK_BYTES = 8_000_000
UNDECIDED = "und"


def padded(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end, ORDER zero bytes before each; and where each text's own bytes begin and end."""
    data, off = utf8_buffer(texts)
    n = len(off) - 1
    out = np.zeros(len(data) + ORDER * n, np.uint8)
    out[np.arange(len(data)) + np.repeat(ORDER * np.arange(1, n + 1), np.diff(off))] = data
    return out, off + ORDER * np.arange(n + 1)


def text_grams(texts) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte (ORDER context bytes and the byte), texts end to end, and each text's byte count."""
    data, off = padded(texts)
    own = np.ones(len(data), bool)
    own[(off[:-1, None] + np.arange(ORDER)).ravel()] = False
    at = np.flatnonzero(own)
    gram = np.zeros(len(at), np.uint32)
    for back in range(ORDER, -1, -1):
        gram = (gram << np.uint32(8)) | data[at - back]
    return gram, np.diff(off) - ORDER


def count_grams(batches):
    """(lang, gram, n) of one task; the language is null for texts that are not learned."""
    total: dict[str | None, list] = {}

    def merged(parts):
        gram, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return gram, np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(gram)).astype(np.int64)

    for whole in batches:
        for batch in slices(whole, "text"):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                gram, _ = text_grams(batch.column("text").filter(pa.array([x == lang for x in langs.tolist()], pa.bool_())))
                parts = total.setdefault(lang, [])
                parts.append(np.unique(gram, return_counts=True))
                if len(parts) >= 16:
                    total[lang] = [merged(parts)]
    for lang, parts in total.items():
        gram, n = merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


def compile_trees(langs: list[str], kept: list[pa.Table]) -> dict:
    """Frozen trees, sparse: for each order its sorted grams with the bits of seen bytes (infinite where a
    language has not seen one), and its sorted contexts with the bits of an escape."""
    at = {lang: i for i, lang in enumerate(langs)}
    trees = {"langs": langs, "grams": [], "bits": [], "contexts": [], "escape": []}
    shorter = None
    for order, table in enumerate(kept):
        gram, where = np.unique(table.column("gram").to_numpy(), return_inverse=True)
        count = np.zeros((len(langs), len(gram)))
        np.add.at(count, ([at[x] for x in table.column("lang").to_pylist()], where), table.column("n").to_numpy())
        context, first = np.unique(gram >> 8, return_index=True)
        of = np.searchsorted(context, gram >> 8)
        total = lambda x: np.add.reduceat(x, first, axis=1) if len(gram) else np.zeros((len(langs), 0))
        n, t = total(count), total((count > 0).astype(float))
        # a byte seen here was seen after the shorter context too
        below = np.full(count.shape, 1 / 256) if shorter is None else shorter[1][:, np.searchsorted(shorter[0], gram & ((1 << (8 * order)) - 1))]
        rest = np.where(t < 256, np.maximum(1 - total(np.where(count > 0, below, 0)), 1e-15), 0)  # what exclusion leaves to the others
        escape = np.where(rest > 0, t / np.maximum(n + t, 1), 0)
        seen = count / np.maximum(n, 1)[:, of] * (1 - escape[:, of])
        with np.errstate(divide="ignore"):
            trees["bits"].append(-np.log2(seen))
            trees["escape"].append(np.where((n > 0) & (rest > 0), -np.log2(np.where(escape > 0, escape, 1) / np.where(rest > 0, rest, 1)), 0))
        trees["grams"].append(gram)
        trees["contexts"].append(context)
        shorter = gram, seen
    return trees


def gram_bits(grams: np.ndarray, trees: dict) -> np.ndarray:
    """Code length of each gram's last byte after the bytes before it (languages x grams)."""
    def found(keys, values, wanted, otherwise):
        if not len(keys):
            return np.full((len(trees["langs"]), len(wanted)), otherwise)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, values[:, place], otherwise)

    grams = grams.astype(np.int64)
    out = np.full((len(trees["langs"]), len(grams)), 8.0)
    for order in range(ORDER + 1):
        own = grams & ((1 << (8 * (order + 1))) - 1)
        seen = found(trees["grams"][order], trees["bits"][order], own, np.inf)
        out = np.where(np.isfinite(seen), seen, out + found(trees["contexts"][order], trees["escape"][order], own >> 8, 0.0))
    return out


def summed(texts, known: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bits of each text under each language, by the bits (languages x grams) of the sorted grams ``known``."""
    gram, lengths = text_grams(texts)
    out = np.zeros((len(lengths), len(bits)))
    if not len(gram):
        return out
    cell = np.searchsorted(known, gram)
    some = lengths > 0
    begin = (np.cumsum(lengths) - lengths)[some]
    for i in range(out.shape[1]):
        out[some, i] = np.add.reduceat(bits[i].take(cell), begin, dtype=np.float64)
    return out


def code_lengths(texts, trees: dict) -> np.ndarray:
    """Bits of each text under each language."""
    known = np.unique(text_grams(texts)[0])
    return summed(texts, known, gram_bits(known, trees))


def shard_function(shared):
    def judge(table: pa.Table) -> pa.Table:
        """Bits in each language of every gram of a shard."""
        langs, low = shared.value
        learned = table.filter(pc.is_valid(table.column("lang"))).select(["lang", "gram", "n"])
        gram = learned.column("gram").to_numpy()
        high = [learned.set_column(1, "gram", pa.array(gram & ((1 << (8 * (order + 1))) - 1), pa.int64())) for order in range(LOW_ORDERS, ORDER + 1)]
        known = np.unique(table.column("gram").to_numpy())
        bits = gram_bits(known, compile_trees(langs, [*low, *high])).astype(np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(known) + 1) * len(langs), pa.int32()), pa.array(bits.T.ravel(), pa.float32()))
        return pa.table({"gram": pa.array(known, pa.int64()), "bits": lists})
    return judge


def asked(table: pa.Table) -> pa.Table:
    """(chunk, gram) of the distinct grams of a chunk."""
    found = [np.unique(text_grams(part.column("_text"))[0]) for batch in table.combine_chunks().to_batches() for part in slices(batch, "_text")]
    gram = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)
    return pa.table({"chunk": pa.array(np.full(len(gram), table.column("chunk")[0].as_py() if len(gram) else 0), pa.int64()), "gram": pa.array(gram, pa.int64())})


def has_letter(texts) -> np.ndarray:
    data, off = utf8_buffer(texts)
    letter = byte_table([*range(65, 91), *range(97, 123)])[data]
    found = np.concatenate([[0], np.cumsum(letter)])
    out = found[off[1:]] > found[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[i] = any(map(str.isalpha, texts[i].as_py()))
    return out


def verdict_function(langs: list[str], names: list[str]):
    def verdicts(table: pa.Table, answers: pa.Table) -> pa.Table:
        known = answers.column("gram").to_numpy()
        order = np.argsort(known)
        bits = pc.list_flatten(answers.column("bits")).to_numpy().reshape(-1, len(langs))[order].T
        known, bits, out = known[order].astype(np.uint32), np.ascontiguousarray(bits), []
        for whole in table.combine_chunks().to_batches():
            for batch in slices(whole, "_text"):
                texts, n = batch.column("_text"), batch.num_rows
                cost, good = summed(texts, known, bits), has_letter(texts)
                best = cost.argmin(1)
                least = cost[np.arange(n), best]
                posterior = 1 / np.exp2(np.clip(least[:, None] - cost, -1000, 0)).sum(1)
                size = np.diff(utf8_buffer(texts)[1])
                lang = np.where(good, np.array(langs, object)[best], UNDECIDED)
                score, per_byte = np.where(good, posterior, 0.0), np.where(good, least / np.maximum(size, 1), 0.0)
                out.append(pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(per_byte)],
                                                      names=[*names, "lang_pred", "score", "bits_per_byte"]))
        if out:
            return pa.Table.from_batches(out)
        return table.select(names).append_column("lang_pred", pa.array([], pa.string())).append_column("score", pa.array([], pa.float64())).append_column("bits_per_byte", pa.array([], pa.float64()))
    return verdicts


def predict(rows: DataFrame, learned: Column, keep: dict[str, Column], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The columns of ``keep`` with lang_pred, score and bits_per_byte for every row, learned from the
    rows where ``learned`` holds that have a text and a language. The text is kept only if ``keep``
    has it, under the name ``_text``."""
    own = rows.where(F.col(text_col).isNotNull()).select(F.when(learned, F.col(lang_col)).alias("lang"), F.col(text_col).alias("text"))
    grams = materialize(own.mapInArrow(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs, size, n = grams.agg(F.sort_array(F.collect_set("lang")), F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = rows.select(*(c.alias(name) for name, c in ({"_text": F.col(text_col)} | keep).items()))
    if not langs:
        return base.select(*keep, F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte"))
    low = []
    for order in range(LOW_ORDERS):
        gram = F.col("gram").bitwiseAND((1 << (8 * (order + 1))) - 1)
        low.append(grams.where("lang is not null").groupBy("lang", gram.alias("gram")).agg(F.sum("n").alias("n")).toArrow())
    shared = rows.sparkSession.sparkContext.broadcast((langs, low))
    shard = F.pmod(F.xxhash64(F.shiftright("gram", 8).bitwiseAND(0xFFFF)), F.lit(LEAST_SHARDS + n // SHARD_GRAMS))
    bits = materialize(grams.withColumn("shard", shard).groupBy("shard").applyInArrow(shard_function(shared), "gram long, bits array<float>"), "bits")
    dealt = base.withColumn("chunk", F.pmod(F.xxhash64(*base.columns), F.lit(size // CHUNK_BYTES + 1)))
    by_chunk = dealt.groupBy("chunk")
    # a merge join at every size: the bits grow with the grams
    answers = by_chunk.applyInArrow(asked, "chunk long, gram long").join(bits.hint("merge"), "gram").select("chunk", "gram", "bits")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*keep).schema)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(verdict_function(langs, list(keep)), f"{fields}, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text has a language at all and whose posterior reaches ``min_score``; all columns stay."""
    names = {"_text" if c == text_col else f"c{i}": c for i, c in enumerate(docs.columns)}
    judged = predict(docs, ~held_out(id_col), {name: F.col(f"`{c}`") for name, c in names.items()}, text_col, lang_col)
    good = judged.where((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= min_score))
    return good.select(*(F.col(name).alias(c) for name, c in names.items()))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo 3, is 1 (null: as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score, bits_per_byte of every row; learned from the rows not held out."""
    return predict(docs, ~held_out(id_col), {id_col: F.col(id_col), "held_out": held_out(id_col)}, text_col, lang_col)
