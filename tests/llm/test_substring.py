import re
from collections import Counter

from pyspark.sql import functions as F

from quotelens.llm import substring_dedup as S
from tests.llm.cases import documents, frame, words


def expected(rows, size):
    count = Counter(tuple(w[i:i + size]) for _, t, *_ in rows for w in [words(t)] for i in range(len(w) - size + 1))
    out = []
    for d, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, row[3])


def test_matches_brute_force_with_edge_rows(spark):
    rows = documents()
    got = S.remove_repeats(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=key) == sorted(expected(rows, 35), key=key)
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_many_chunks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_CHARS", 3000)
    monkeypatch.setattr(S, "SHARD_WINDOWS", 500)
    rows = documents()
    got = S.remove_repeats(frame(spark, rows), window=7).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=key) == sorted(expected(rows, 7), key=key)


def test_empty_table(spark):
    assert S.remove_repeats(frame(spark, [])).count() == 0


def test_words_are_cut_at_ascii_white_space_only(spark):
    assert re.findall(r"[^\x20\x09-\x0D]+", "a b c") == ["a b", "c"]
    got = S.remove_repeats(frame(spark, [(1, "a b c\x0bd\x1ce", "en", "s")])).select("n_words", F.col("kept_text")).first()
    assert tuple(got) == (3, "a b c d\x1ce")
