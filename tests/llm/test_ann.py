import numpy as np
from pyspark.sql import functions as F

from quotelens.llm import ann as A


def exact(vectors, query_ids, k):
    good = {i: np.array(v, float) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in query_ids:
        if q in good:
            near = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            out[q] = near
    return out


def run(spark, vectors, divisor, k):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, id int, score int").repartition(3)
    got = {}
    for r in A.nearest(df, F.col("vec_id") % divisor == 0, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(s, i) for _, i, s in sorted(x)] for q, x in got.items()}


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 300)
    monkeypatch.setattr(A, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((12, 24))
    vectors = [(i, (centres[i % 12] + 0.3 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(1500)]
    got, want = run(spark, vectors, 50, 10), exact(vectors, range(0, 1500, 50), 10)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) / (10 * len(want)) >= 0.97
    at = dict(vectors)
    for q, x in got.items():
        assert x == sorted(x)
        for s, i in x:
            assert abs(s - np.linalg.norm(np.array(at[q], float) - np.array(at[i], float))) < 1e-12


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [1.0, 2.0, 3.0]) for i in range(0, 40)] + [(100 + i, rng.standard_normal(3).tolist()) for i in range(30)]
    vectors += [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (205, []), (None, [1.0, 2.0, 3.0]), (210, [1.0, 2.0])]
    vectors = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got, want = run(spark, vectors, 10, 10), exact(vectors, [i for i, _ in vectors if i is not None and i % 10 == 0], 10)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items() if x}


def test_fewer_candidates_than_asked_and_empty(spark):
    vectors = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert [i for _, i in run(spark, vectors, 100, 10)[0]] == [1, 2] or [i for _, i in run(spark, vectors, 100, 10)[0]] == [2, 1]
    assert run(spark, [], 100, 10) == {}
