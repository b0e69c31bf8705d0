import random

import numpy as np

from quotelens.llm import hyperminhash as H
from quotelens.llm.components import components
from tests.llm.cases import documents, frame, words


def sets_of(rows):
    out = {}
    for d, t, *_ in rows:
        if d is not None:
            w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
            out[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_force(rows):
    sets = sets_of(rows)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def chain(n):
    """Texts of which only neighbours are near: the class is as long as the chain."""
    all_words = [f"w{i}" for i in range(100 + 8 * n)]
    return [(500 + i, " ".join(all_words[8 * i:8 * i + 100]), "en", "s") for i in range(n)]


def test_matches_brute_force_with_edge_rows(spark):
    rows = documents() + chain(12)
    got = H.link_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_force(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    assert len({c for _, c in want.values()}) < len(want) - 20


def test_large_bands_and_families_are_compared_in_blocks(spark, monkeypatch):
    """Texts that share a long passage meet in bands without being near their smallest member."""
    monkeypatch.setattr(H, "BLOCK", 4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"q{i // 2}x{j}" for j in range(50)) + f" e{i}", "en", "s") for i in range(16)]
    got = {r.doc_id: r.component_id for r in H.link_documents(frame(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in brute_force(rows).items()} and len(set(got.values())) == 8


def test_empty_table_and_stage(spark):
    assert H.link_documents(frame(spark, [])).count() == 0
    rows = documents()
    docs = frame(spark, rows)
    kept = H.keep_representatives(docs)
    assert kept.columns == docs.columns
    want = brute_force(rows)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()})


def test_registers_hold_leading_zeros_and_mantissa():
    h = np.array([(5 << 57) | (0b101 << 40)], np.uint64)  # bucket 5; of the 57 bits below, bit 42 is the first set
    reg = H.registers(np.array([0]), h, 1)[0]
    zeros, mantissa = 57 - 43, 0b01 << 8
    assert reg[5] == (zeros << H.MANTISSA) + mantissa and (np.delete(reg, 5) == H.EMPTY).all()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "x long, y long")
    got = {r.node: r.component for r in components(links, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(links.limit(0), "x", "y").count() == 0


def test_tiny_sets_lose_no_link(spark):
    """Sets of one to a few shingles around one text: every pair at the threshold is found (all pairs by brute force)."""
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(5, 12))]
        rows.append((2 * i, " ".join(words)))
        rows.append((2 * i + 1, " ".join([*words, "more"]) if rng.random() < .5 else " ".join([*words[:-1], "other"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in H.link_documents(docs).collect()}
    assert got == brute_force(rows)


def test_prefixes_of_near_sets_meet():
    """Over the same order, sets of similarity 0.75 share one of their prefixes."""
    rng = random.Random(12)
    for _ in range(4000):
        union = rng.sample(range(1000), rng.randint(1, 21))
        a, b = ({x for x in union if rng.random() < .92} for _ in range(2))
        if a and b and min(len(a), len(b)) < H.SMALL and 100 * len(a & b) >= 75 * len(a | b):
            first = lambda s: set(sorted(s)[:H.prefixes(len(s), 75)])
            assert first(a) & first(b)


def test_helper_names_may_be_taken(spark):
    rows = [(1, "a b c d e f", 7, 7, 7), (1, "a b c d e f", 7, 7, 7), (2, "a b c d e f", 7, 7, 7), (3, "other words here", 7, 7, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _HASH int, _n int")
    got = H.keep_representatives(docs)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
