from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotelens.llm import mixing as M
from tests.llm.cases import documents, frame, words


def targets(sizes, weights=(1, 2, 3), most=3):
    """Water-filling, literally."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, sum(sizes.values())
    free = set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return target | share
        target |= {s: most * sizes[s] for s in above}
        free -= above
    return target


def check(rows, got):
    sizes, taken = Counter(), Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = targets(dict(sizes))
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, *_ in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r["size"]
        assert r.taken == r.epochs * r["size"] + r.extra
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= 1


def test_budgets_are_met_and_reruns_agree(spark):
    rows = documents()
    docs = frame(spark, rows)
    first = M.mix_sources(docs).collect()
    check(rows, first)
    again = M.mix_sources(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_caps_are_reshared_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 5)
    rows = [(i, "w " * (1 + i % 7), "en", s) for i, s in enumerate("a" * 200 + "b" * 3 + "c" * 2 + "é" * 4 + "Z" * 9)] + [(900, "w w", "en", None), (901, None, "en", "empty")]
    check(rows, M.mix_sources(frame(spark, rows)).collect())


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "word " * 20, "en", "a") for i in range(400)] + [(1000 + i, "word " * 20, "en", "b") for i in range(50)] + [(2000 + i, "word " * 20, "en", "c") for i in range(50)]
    docs = frame(spark, rows)
    quality = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1)
    got = [r for r in M.mix_sources(docs, quality=quality).collect() if r.source == "a" and r.taken]
    even = sum(r.doc_id % 2 == 0 for r in got)
    assert even > 3 * (len(got) - even)


def test_empty_table_and_draw(spark):
    assert M.mix_sources(frame(spark, [])).count() == 0
    rows = documents()
    docs = frame(spark, rows)
    mix = M.mix_sources(docs)
    drawn = M.draw(docs, mix)
    assert drawn.columns == docs.columns
    copies = {(r.doc_id, r["size"]): r.epochs + (r.extra > 0) for r in mix.collect()}
    got = Counter((r.doc_id, len(words(r.text))) for r in drawn.collect())
    for k, n in copies.items():
        if k[0] != 212:  # repeated rows share their copies
            assert got[k] == n
