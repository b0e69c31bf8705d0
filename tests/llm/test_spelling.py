import random
import re
import zlib
from collections import Counter

from quotelens.llm import spelling as S
from tests.llm.cases import documents, frame

UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def vocabulary(rows):
    n = Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            n[run] += len(run) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def by_rule(rows):
    words = vocabulary(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def collected(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def families(seed=6):
    """Words around a few stems, of very unequal counts, chains of forms among them."""
    rng = random.Random(seed)
    letters = "abcdeéß÷ÿ"
    words = Counter()
    for stem in ("variant", "spelling", "aaaaaaaa", "abababab", "straßenbahn"):
        words[stem] += 700
        for _ in range(60):
            w = list(stem)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(w) + 1)
                kind = rng.randrange(3)
                w[i:i + (kind > 0)] = [] if kind == 1 else [rng.choice(letters)]
            words["".join(w)] += rng.choice([1, 2, 2, 3, 30, 69])
    rows, i = [], 1000
    for w, n in words.items():
        for part in range(0, n, 40):
            rows.append((i, " ".join([w if rng.random() < .8 else w.upper() if w.isascii() else w] * min(40, n - part)) + "; short 12", "en", "s"))
            i += 1
    return rows


def test_variants_equal_the_rule(spark):
    rows = documents() + families() + [(None, "nullidword nullidword", None, None)]
    want = by_rule(rows)
    assert collected(S.spelling_variants(frame(spark, rows))) == want
    assert any(f is not None and r != f for _, f, r, *_ in want) and any(len(w) > 1000 for w, *_ in want) is False


def test_long_lists_are_split_and_no_pair_is_lost(spark):
    rows = families(9)
    assert collected(S.spelling_variants(frame(spark, rows), longest=2)) == by_rule(rows)


def test_pairs_of_random_words(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(7, 9))) for _ in range(400)} | {"x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499, "y" + "x" * 2999})
    frame_ = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = sorted((a, b, words.index(b)) for a in words for b in words if one_edit(a, b))
    for longest in (2, 20, 10_000):
        got = sorted(tuple(r) for r in S.near_pairs(frame_, longest).collect())
        assert got == want


def test_words_of_one_list_stay_bounded(spark):
    """A prefix that all words share is no hot key: its list is split, and rows stay a few for each word."""
    rng = random.Random(3)
    words = {"prefixes" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)}
    frame_ = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    parts = S.lists(frame_, 50)
    sizes = [r[0] for p in parts for r in p.groupBy("key").count().select("count").collect()]
    assert max(sizes) <= 72 and sum(sizes) <= 24 * len(words)


def test_empty_table(spark):
    assert S.spelling_variants(frame(spark, [])).count() == 0
    assert S.spelling_variants(frame(spark, [(1, None, None, None), (2, "", None, None), (3, "short words only", None, None)])).count() == 0
