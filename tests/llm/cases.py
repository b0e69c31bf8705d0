"""Small documents for all operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, chunk long, band long, rank int, "
          "part long, text_hash long, score double, size long, copies int")
EXTRA = (7, 7, 7, 7, 7, 7, 0.5, 7, 7)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, lang="en"):
    parts = {"en": ["the", "ing", "er", "on", "an", "th", "ti", "re"], "de": ["sch", "ung", "ein", "über", "keit", "pf", "tz", "ge"],
             "es": ["ción", "que", "ado", "os", "ñar", "el", "ie", "ga"]}[lang]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def documents():
    """(doc_id, text, lang, source) rows."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lang = ("en", "de", "es")[i % 3]
        rows.append((i, sentence(rng, rng.randint(1, 160), lang), lang, f"s{i % 4}"))
    base = rows[4][1] + " " + sentence(rng, 120)
    shared = sentence(rng, 70)
    for i in range(8):  # near copies of one text, and a passage that unrelated texts share
        words = base.split()
        words[10 * i + 3] = f"changed{i}"
        rows.append((100 + i, " ".join(words), "en", "s0"))
        rows.append((120 + i, sentence(rng, 60) + "\n" + shared + "\t" + sentence(rng, 60), "en", None if i % 2 else "s1"))
    rows += [(140 + i, base, "en", "s0") for i in range(5)]  # exact copies
    rows += [(200, None, "en", "s0"), (201, "", None, "s1"), (202, " \n\t ", "en", "s2"), (203, "12 34 !?", None, None), (None, sentence(rng, 50), "en", "s3"),
             (204, "one", "en", "s2"), (205, "One two  three", "en", "s2"), (206, "one TWO three", "en", "s2"), (207, "ünïcode space　here 日本語のテキスト", None, "s1"),
             (208, sentence(rng, 6000), "en", "s3"), (209, "x" * 5000, None, "s1"), (210, "\n".join([shared] * 3), "en", "s3"),
             (211, "<|endoftext|> a  b\n\n c \r\n\t d'll  ", None, "s1"), (212, shared, None, "s2"), (212, shared, None, "s2"), (213, "a" + "\U0001F600" * 7, None, "s2")]
    return rows


def frame(spark, rows=None):
    """The rows with clashing extra columns, over several partitions."""
    rows = documents() if rows is None else rows
    full = [(d, t, lang, s, None if t is None else len(t), *EXTRA) for d, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def words(text):
    return WORD.findall(text or "")
