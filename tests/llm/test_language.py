import math
import zlib

import pyarrow as pa
import pytest

from quotelens.llm import langid as L
from tests.llm.cases import documents, frame


def test_held_out_rows_are_identified(spark):
    rows = documents()
    got = L.identify(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    lang = {d: x for d, t, x, _ in rows if t and len(t) > 40 and x and d is not None and not 200 <= d < 209}
    judged = [r for r in got if r.held_out and r.doc_id in lang]
    assert len(judged) > 15 and sum(r.lang_pred == lang[r.doc_id] for r in judged) / len(judged) > 0.95
    undecided = {r.doc_id for r in got if r.lang_pred == "und"}
    assert undecided == {200, 201, 202, 203}


def test_code_lengths_equal_a_plain_ppm():
    """Byte by byte with escapes and exclusion, against the compiled table."""
    texts = {"a": ["abracadabra", "abc"], "b": ["banana band", "bab"]}
    grams = {}
    for lang, ts in texts.items():
        for t in ts:
            data = b"\0" * L.ORDER + t.encode()
            for i in range(L.ORDER, len(data)):
                g = int.from_bytes(data[i - L.ORDER:i + 1], "big")
                grams[lang, g] = grams.get((lang, g), 0) + 1

    def table(order):
        counts = {}
        for (lang, g), n in grams.items():
            k = (lang, g & ((1 << (8 * (order + 1))) - 1))
            counts[k] = counts.get(k, 0) + n
        rows = sorted(counts.items())
        return pa.table({"lang": [k[0] for k, _ in rows], "gram": pa.array([k[1] for k, _ in rows], pa.int64()), "n": pa.array([n for _, n in rows], pa.int64())})

    trees = L.compile_trees(["a", "b"], [table(o) for o in range(L.ORDER + 1)])

    def probability(lang, context, byte, order):
        """P(byte) at an order, all symbols allowed."""
        if order < 0:
            return 1 / 256
        lower = lambda x: probability(lang, context, x, order - 1)
        mask = (1 << (8 * order)) - 1
        seen = {}
        for (x, g), n in grams.items():
            if x == lang and ((g >> 8) & mask) == (int.from_bytes(context, "big") & mask):
                seen[g & 255] = seen.get(g & 255, 0) + n
        if not seen:
            return lower(byte)
        n, t = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (n + t)
        return t / (n + t) * lower(byte) / (1 - sum(lower(x) for x in seen))

    for text in ("abba", "zebra band", "abé"):
        data = b"\0" * L.ORDER + text.encode()
        want = [-sum(math.log2(probability(lang, data[i - L.ORDER:i], data[i], L.ORDER)) for i in range(L.ORDER, len(data))) for lang in ("a", "b")]
        assert L.code_lengths(pa.array([text]), trees)[0].tolist() == pytest.approx(want, rel=1e-5)


def test_nothing_learned_and_empty_table(spark):
    got = L.identify(frame(spark, [(1, "the text", None, "s"), (2, None, "en", "s")])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert L.identify(frame(spark, [])).count() == 0


def test_stage_keeps_columns_and_clean_rows(spark):
    docs = frame(spark)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert {200, 201, 202, 203} <= gone and len(gone) <= 6


def test_no_count_is_dropped(spark):
    """More order-3 contexts than any fixed table of eight languages held: bits per byte equal those of whole trees."""
    import random
    rng = random.Random(12)
    rows = [(8 * i + k, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz "[k % 2:], k=4000)), f"l{k}", "s") for i in range(15) for k in range(8)]
    learned = [(t, x) for d, t, x, _ in rows if zlib.crc32(str(d).encode()) % 3 != 1]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in learned]), pa.array([x for _, x in learned])], names=["text", "lang"])
    grams = pa.Table.from_batches(list(L.count_grams([batch])))
    mask = lambda o: pa.array(grams.column("gram").to_numpy() & ((1 << (8 * (o + 1))) - 1), pa.int64())
    trees = L.compile_trees([f"l{k}" for k in range(8)], [grams.set_column(1, "gram", mask(o)) for o in range(L.ORDER + 1)])
    bits = L.code_lengths(pa.array([t for _, t, _, _ in rows]), trees).min(1) / 4000
    got = {r.doc_id: r.bits_per_byte for r in L.identify(frame(spark, rows)).collect()}
    assert [got[d] for d, *_ in rows] == pytest.approx(bits.tolist(), rel=1e-4)
