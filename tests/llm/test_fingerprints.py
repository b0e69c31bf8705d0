import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quotelens.llm import orderminhash as O
from tests.llm.cases import documents, frame, sentence


def edited_of(rows):
    """Edited texts by the rule, over distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (d, t, *_) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        out[d] = t[:len(t) - n] + after[:n]
    return out


def test_edited_texts_and_equal_texts(spark):
    rows = [r for r in documents() if r[0] != 212] + [(212, "single once", None, "s2")]
    got = O.edited_pairs(frame(spark, rows)).collect()
    want = edited_of(rows)
    assert {r.doc_id: r.edited for r in got} == want and len(got) == len(rows)
    prints = {}
    for r in got:
        prints.setdefault(r.text, set()).add(tuple(r.prints))
    assert all(len(x) == 1 for x in prints.values())


def test_repeated_rows_follow_one_another(spark):
    rows = [(3, "aaaaaa", "en", "s"), (2, "bbbbbb", "en", "s"), (2, "bbbbbb", "en", "s"), (1, "cccccc", "en", "s"), (None, None, "en", "s")]
    got = sorted((r.doc_id or 0, r.edited) for r in O.edited_pairs(frame(spark, rows)).collect())
    assert got == [(0, ""), (1, "cccc"), (2, "bbbbbb"), (2, "bbbbcc"), (3, "aaaabb")]


def test_likeness_follows_edits_and_order(spark):
    import random
    rng = random.Random(8)
    text = sentence(rng, 300)
    w = text.split(" ")
    versions = {"same": text, "one word": " ".join([*w[:100], "new", *w[101:]]), "third": " ".join([*w[:200], *sentence(rng, 100).split(" ")]),
                "other": sentence(rng, 300, "de"), "blocks turned": " ".join(w[150:] + w[:150])}
    df = spark.createDataFrame(pd.DataFrame({"name": list(versions), "text": list(versions.values())})).withColumn("a", O.fingerprint(F.lit(text)))
    got = {r.name: r.x for r in df.select("name", O.likeness(F.col("a"), O.fingerprint(F.col("text"))).alias("x")).collect()}
    assert got["same"] == 1 and got["one word"] > 0.8 and 0.1 < got["third"] < 0.6 and got["other"] < 0.1
    assert got["blocks turned"] < got["one word"]  # same words, other order


def plain_fingerprint(spark, text):
    """Order MinHash by the definition, on hashes that Spark computes."""
    words = text.split(" ")
    grams = [(words[i], words[i + 1] if i + 1 < len(words) else None) for i in range(len(words))]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(grams)], "i long, a string, b string").select("i", F.shiftright(F.shiftleft(F.xxhash64("a", "b"), 24), 24).alias("h")).orderBy("i").collect()
    seen, numbered = {}, []
    for r in rows:
        numbered.append((r.i, r.h, seen.get(r.h, 0)))
        seen[r.h] = seen.get(r.h, 0) + 1
    hashed = spark.createDataFrame(numbered, "i long, h long, o int").select("i", F.shiftright(F.shiftleft(F.xxhash64("h", "o"), 24), 24).alias("x")).collect()
    out = []
    for bucket in range(32):
        mine = sorted((np.int64(r.x) << np.int64(24) | r.i, r.i, r.x) for r in hashed if (int(r.x) >> 35) & 31 == bucket)[:2]
        if mine:
            tuple_ = [x for _, _, x in sorted(mine, key=lambda m: m[1])]
            value = spark.range(1).select(F.xxhash64(*map(F.lit, tuple_)).alias("v")).first().v
            out.append((bucket << 27) | ((int(value) & (2 ** 64 - 1)) >> 37))
    return sorted(out)


def test_fingerprint_equals_its_definition(spark):
    text = "a b a b a b c d e f g a b the of the of the of x y z z z z z z"
    got = spark.range(1).select(O.fingerprint(F.lit(text)).alias("p")).first().p
    assert sorted(got) == plain_fingerprint(spark, text)


def test_empty_table_and_texts(spark):
    assert O.edited_pairs(frame(spark, [])).count() == 0
    df = frame(spark, [(1, None, "en", "s"), (2, "", "en", "s"), (3, "word", "en", "s")])
    got = {r.doc_id: r for r in df.select("doc_id", O.fingerprint(F.col("text")).alias("p")).collect()}
    assert got[1].p == got[2].p == [] and len(got[3].p) == 1


def test_texts_without_spaces_follow_edits(spark):
    import random
    rng = random.Random(21)
    draw = lambda letters, n: "".join(rng.choices(letters, k=n))
    texts = {"lines": "\n".join(draw("abcdefgh", 9) for _ in range(200)), "tabs": "\t".join(draw("abcdefgh", 9) for _ in range(200)),
             "prose": draw([chr(c) for c in range(0x4E00, 0x4F00)], 800), "base64": draw("ABCDEFGHabcdefgh0123+/", 1500), "pairs": draw("\U0001F600\U0001F601\U0001F602", 900)}
    rows = [(name, t, t[:300] + "#" + t[301:], t[len(t) // 2:] + t[:len(t) // 2], "".join(reversed(t))) for name, t in texts.items()]
    a = O.fingerprint(F.col("t"))
    df = spark.createDataFrame(rows, "name string, t string, edited string, turned string, other string")
    for r in df.select("name", *(O.likeness(a, O.fingerprint(F.col(c))).alias(c) for c in ("t", "edited", "turned", "other"))).collect():
        assert r.t == 1 and r.edited > 0.7 and r.turned < r.edited and r.other < 0.3, r
