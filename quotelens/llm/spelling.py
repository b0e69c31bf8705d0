"""Spelling variants: near words of a counted vocabulary by dynamic programming over sorted lists.

Two words are near if one insertion, deletion or replacement of a code point turns one into the other.
With L the length of the shorter, such a pair shares its first L // 2 code points or its last L - L // 2, so
each word is listed under both keys, for L equal to its length and to one less. A key's words share what the key
holds, and only the segments between are compared: sorted, with the lengths of the prefixes that neighbours
have in common. Each word walks down such a list with the band of three cells of its edit matrix; words with
a common prefix share the rows of that prefix, and a range of the list whose prefix already costs more than one edit
is skipped. All words of a task walk side by side, a code point at a time.

A list longer than ``LONGEST`` is split by the same rule: its pairs share the first or the last half of the segments
too. Splitting ends at segments of one code point, where a list can't be longer than the square of the alphabet. So
no key is hot, rows are a few for each word, and no pair is lost: a pair belongs to the first half it shares, by the
place of its first difference.

Defined results: null and empty texts have no words; a null id counts as the empty string in the hash; repeated
rows count again; an empty table gives no words. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelens.session import materialize

#: Code points of a word, upper-case letters that are lowered, one of so many runs loses a code point.
LETTERS, UPPER, EDITED = "A-Za-z\u00C0-\u00FF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 31
#: Words have this many code points and occurrences at least; a form is this many times as frequent.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: Words of a list that is walked as it is, rows of a task, and states of a walk that are held at once.
LONGEST, ROWS, STATES = 2_000, 20_000, 1_000_000
#: A distance beyond those that count.
FAR = 3


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """One row (word) for each run of letters that, in lower case and with the drawn ones one code point shorter, is long enough."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    plain = F.octet_length("run") == F.length("run")
    low = runs.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, UPPER.lower())).alias("run"))
    hashed = low.select("run", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % EDITED == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= least_length)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of every word with enough occurrences over all texts."""
    return occurrences(docs, id_col, text_col, least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the hash of their list: role (length of the shorter word), shared prefix and shared suffix."""
    head, tail = F.col("word").substr(F.lit(1), F.col("head")), F.col("word").substr(F.length("word") - F.col("tail") + 1, F.col("tail"))
    return rows.withColumn("key", F.xxhash64("shorter", "head", "tail", head, tail))


def open_length() -> Column:
    return F.col("shorter") - F.col("head") - F.col("tail")


def halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of the segment shared, and with the last half."""
    half = F.floor(open_length() / 2).cast("int")
    split = F.explode(F.array(F.struct((F.col("head") + half).alias("h"), F.col("tail").alias("t")),
                              F.struct(F.col("head").alias("h"), (F.col("tail") + open_length() - half).alias("t"))))
    return rows.withColumn("s", split).select("word", "n", "shorter", F.col("s.h").alias("head"), F.col("s.t").alias("tail"))


def lists(words: DataFrame, longest: int = LONGEST) -> list[DataFrame]:
    """Parts (word, n, shorter, head, tail, key) that together hold every list which can have a pair, none too long."""
    size = F.length("word")
    roles = words.withColumn("shorter", F.explode(F.array(size, size - 1))).where(F.col("shorter") >= LEAST_LENGTH)
    rows, out = roles.withColumn("head", F.lit(0)).withColumn("tail", F.lit(0)), []
    while True:
        rows = keyed(halved(rows))
        own = F.sum((F.length("word") == F.col("shorter")).cast("long"))
        sizes = rows.groupBy("key").agg(F.count("*").alias("rows"), own.alias("own")).where("rows > 1 and own > 0").select("key", "rows")
        sized = materialize(rows.join(sizes, "key"), "lists")
        short = (F.col("rows") <= longest) | (open_length() <= 1)
        out.append(sized.where(short))
        rows = sized.where(~short).select("word", "n", "shorter", "head", "tail")
        if rows.isEmpty():
            return out


class Lists:
    """Sorted segments of many lists, end to end."""

    def __init__(self, key: np.ndarray, segments: list[str]):
        table = pa.table({"key": key, "segment": pa.array(segments).cast(pa.binary())})
        self.order = pc.sort_indices(table, sort_keys=[("key", "ascending"), ("segment", "ascending")]).to_numpy()
        texts = [segments[i] for i in self.order.tolist()]
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        self.codes = np.concatenate([np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.zeros(3, np.uint32)])
        self.at = np.cumsum(self.length) - self.length
        key = key[self.order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        self.starts = np.flatnonzero(first)
        self.stops = np.append(self.starts[1:], len(key))
        self.common = self._common_prefixes(first)

    def _common_prefixes(self, first: np.ndarray) -> np.ndarray:
        """Code points that each segment shares with the one before it; -1 for the first of a list."""
        out = np.where(first, -1, 0)
        live, depth = np.flatnonzero(~first), 0
        while len(live):
            live = live[(self.length[live] > depth) & (self.length[live - 1] > depth)]
            live = live[self.codes[self.at[live] + depth] == self.codes[self.at[live - 1] + depth]]
            depth += 1
            out[live] = depth
        return out

    def pairs(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, common prefix) for every row of the query's list at distance 1; places in the sorted rows.

        A state is a query, a range of its list whose rows share ``depth`` code points, the cells of the edit
        matrix at that depth and one to the left and right of the diagonal, and the place of the first difference
        (-1: none yet)."""
        where = np.searchsorted(self.starts, queries, "right") - 1
        cells = [np.full(len(queries), x, np.int8) for x in (FAR, 0, 1)]
        stack = [(0, (queries, self.starts[where], self.stops[where], *cells, np.full(len(queries), -1)))]
        found = []
        while stack:
            depth, state = stack.pop()
            borders = np.append(np.flatnonzero(self.common <= depth), len(self.length))
            lo, hi = np.searchsorted(borders, state[1]), np.searchsorted(borders, state[2])
            if len(lo) > 1 and (hi - lo).sum() > STATES:
                half = len(lo) // 2
                stack += [(depth, tuple(x[half:] for x in state)), (depth, tuple(x[:half] for x in state))]
                continue
            ended, state = self._step(depth, state, borders, lo, hi - lo)
            found.append(ended)
            if len(state[0]):
                stack.append((depth + 1, state))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _step(self, depth, state, borders, lo, many):
        """Splits each range by the next code point; (pairs that end here, states one code point on)."""
        parent = np.repeat(np.arange(len(lo)), many)
        k = np.arange(len(parent)) + np.repeat(lo - (np.cumsum(many) - many), many)
        begin, end = borders[k], borders[k + 1]
        query, left, middle, right, differ = (state[i][parent] for i in (0, 3, 4, 5, 6))
        size = self.length[query]
        ends = self.length[begin] == depth
        distance = np.choose(np.clip(size - depth + 1, -1, 3) + 1, [np.full(len(size), FAR), left, middle, right, np.full(len(size), FAR)])
        near = np.flatnonzero(ends & (distance == 1))
        pairs = (query[near], begin[near], np.where(differ[near] < 0, depth, differ[near]))
        go = np.flatnonzero(~ends)
        query, begin, end, left, middle, right, differ, size = (x[go] for x in (query, begin, end, left, middle, right, differ, size))
        letter, place = self.codes[self.at[begin] + depth], self.at[query] + depth
        if depth:
            new_left = np.minimum(left + (letter != self.codes[place - 1]), middle + 1)
        else:
            new_left = middle + 1
        new_left = np.where(depth <= size, new_left, FAR)
        new_middle = np.where(depth < size, np.minimum(np.minimum(middle + (letter != self.codes[place]), right + 1), new_left + 1), FAR)
        new_right = np.where(depth + 1 < size, np.minimum(right + (letter != self.codes[place + 1]), new_middle + 1), FAR)
        cells = [np.minimum(x, FAR).astype(np.int8) for x in (new_left, new_middle, new_right)]
        differ = np.where((differ < 0) & (cells[1] > 0), depth, differ)
        on = np.flatnonzero(np.minimum(np.minimum(*cells[:2]), cells[2]) <= 1)
        return pairs, tuple(x[on] for x in (query, begin, end, *cells, differ))


def near_in_lists(table: pa.Table) -> pa.Table:
    """Both directions of every near pair of one task's lists (word, near, near_n)."""
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    shorter, head, tail = (table[c].to_numpy().astype(np.int64) for c in ("shorter", "head", "tail"))
    lists_ = Lists(table["key"].to_numpy(), [w[h:len(w) - t] for w, h, t in zip(words, head.tolist(), tail.tolist())])
    rows = lists_.order
    inner = (shorter - head - tail)[rows]
    query, row, common = lists_.pairs(np.flatnonzero(lists_.length == inner))
    longer = lists_.length[row] > lists_.length[query]
    # a pair that shares the first half as well belongs there
    mine = ~(longer & (common >= inner[query]) & (tail[rows[query]] > 0))
    a, b, longer = rows[query[mine]], rows[row[mine]], longer[mine]
    a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
    same = [words[i][:h] == words[j][:h] and words[i][len(words[i]) - t:] == words[j][len(words[j]) - t:] and s == r  # not only the hash
            for i, j, h, t, s, r in zip(a.tolist(), b.tolist(), head[a].tolist(), tail[a].tolist(), shorter[a].tolist(), shorter[b].tolist())]
    a, b = a[same], b[same]
    column = table["word"].combine_chunks()
    return pa.table({"word": column.take(pa.array(a)), "near": column.take(pa.array(b)), "near_n": pa.array(n[b])})


def near_pairs(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """word, near, near_n of all near pairs of a written vocabulary (word, n), in both directions."""
    out = None
    for part in lists(words, longest):
        tasks = max(1, part.count() // ROWS)
        dealt = part.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks))).groupBy("task")
        found = dealt.applyInArrow(near_in_lists, "word string, near string, near_n long")
        out = found if out is None else out.unionByName(found)
    return out


def rooted(links: DataFrame) -> DataFrame:
    """word, root for links (word, form, form_n) in which the form is at least ``RATIO`` times as frequent."""
    most = links.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, RATIO)))  # no chain is longer
    out = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        out = materialize(out, "roots")
        after = out.select(F.col("word").alias("root"), F.col("root").alias("further"))
        out = out.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return out


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    near = near_pairs(words, longest).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= RATIO * F.col("n")
    formed = materialize(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    roots = rooted(formed.where("form is not null").select("word", "form", "form_n"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
