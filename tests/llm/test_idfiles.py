import random
import struct
import zlib

import numpy as np
import pyarrow as pa

from quotelens.llm import idfiles as I
from quotelens.llm.queries import tokenizer_file
from tests.llm.cases import documents, frame

BPE = tokenizer_file("word_bpe_49k.json")


def plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def test_words_give_the_values_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 59, 60, 61, 1023, 1024, 1025, 5000):
        for top in (1, 2, 9, 16, 31, 59, 60, 61, 64):
            values = rng.integers(0, (1 << top) - 1, n, np.uint64, endpoint=True) >> rng.integers(0, top, n).astype(np.uint64)
            words, first = I.pack(values)
            assert (I.unpack(words, first, n) == values).all()
            assert len(first) == -(-n // I.BLOCK) and (words >> np.uint64(60) > 0).all()
            for _ in range(5):
                a, b = sorted(rng.integers(0, n + 1, 2).tolist())
                assert (I.unpack_range(words, first, n, a, b) == values[a:b]).all()


def test_words_hold_as_many_values_as_fit():
    words, _ = I.pack(np.array([0] * 60 + [3] * 30 + [7] * 20 + [32767] * 4 + [49407] * 3 + [1 << 60], np.uint64))
    assert [int(w) >> 60 for w in words] == [1, 2, 3, 11, 12, 15, 14]


def test_units_give_the_librarys_ids():
    rng = random.Random(5)
    alphabet = ["a", "B", "Word", "the", "'s", "'LL", "don't", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "1", "23", "!", "?!", ".", "é", "É", "é", "İ", "≮", "≠", "ß", "×",
                "日本", " ", "　", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|endof", "😀", "½", "ſ", "ﬁ"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)] + [None, ""]
    ids, off = I.Encoder(BPE).encode(pa.array(texts))
    library = plain()
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_files_hold_all_documents_in_order(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(I, "RUN", 500)
    rows = documents()
    path = I.write_token_files(frame(spark, rows), BPE, str(tmp_path / "ids"))
    got = I.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([d for d, *_ in rows if d is not None]) + [None]
    library, at = plain(), 0
    ids_of = {d: library.encode(t or "", add_special_tokens=False).ids + [1] for d, t, *_ in rows}
    for r in got:
        ids = ids_of[r.doc_id]
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)
    files = spark.read.parquet(path)
    assert files.count() > 3 and files.agg({"n_ids": "sum"}).first()[0] == at


def test_one_repeated_id_is_dealt_to_several_files(spark):
    rows = [(5, f"text {i % 3}", "en", "s") for i in range(600)] + [(4, "first", "en", "s"), (6, "last", "en", "s")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = I.write_token_files(frame(spark, rows).repartition(8), BPE)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path)
    assert files.where("exists(id, x -> x = 5)").select("file").distinct().count() > 1
    got = I.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [4, *[5] * 600, 6]
    assert len({tuple(r.ids) for r in got}) == 5
    same = [tuple(r.ids) for r in got[1:-1]]
    assert len([1 for x, y in zip(same, same[1:]) if x != y]) == 2  # equal texts follow one another


def test_empty_table(spark):
    assert I.read_token_files(spark, I.write_token_files(frame(spark, []), BPE)).count() == 0
