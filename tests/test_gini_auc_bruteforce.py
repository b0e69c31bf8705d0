import random

import numpy as np

from quotelens.operators.metrics import auc, gini


def _concentration(y, w, score):
    order = np.lexsort((np.arange(len(score)), score))
    sw, sl = w[order], y[order] * w[order]
    cw, cl = np.cumsum(sw) / sw.sum(), np.cumsum(sl) / sl.sum()
    area = float(np.sum((cw[1:] - cw[:-1]) * (cl[1:] + cl[:-1]) / 2))
    return 1 - 2 * area


def test_weighted_gini_with_ties_matches_bruteforce(spark):
    rnd = random.Random(11)
    n = 400
    y = np.array([rnd.choice([100.0, 150.0, 150.0, 220.0]) + rnd.random() for _ in range(n)])
    p = np.array([float(rnd.randint(1, 12)) for _ in range(n)])  # many ties in the score
    w = np.array([rnd.choice([0.5, 1.0, 2.0]) for _ in range(n)])
    df = spark.createDataFrame([(i, float(y[i]), float(p[i]), float(w[i])) for i in range(n)],
                               "id long, y double, p double, w double")
    exp = round(_concentration(y, w, p) / _concentration(y, w, y), 6)
    got = gini(df, "y", "p", weight="w", tiebreak="id").first().gini
    assert abs(got - exp) < 1e-6


def test_auc_with_ties_matches_pairwise_count(spark):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 9)) / 10) for _ in range(300)]
    df = spark.createDataFrame(rows, "y double, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    exp = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(auc(df, "y", "s").first().auc - exp) < 1e-12
