"""Main text of web pages: page regions and a suffix array over each host's pages.

1. Every page is read into blocks that are marked as inside the article's container, as furniture
   (menus, footers, adverts, forms, notices, comments) or as neither.
2. The token streams of a host's pages are concatenated, and their suffixes are sorted by prefix
   doubling up to ``RUN`` tokens. Suffixes that agree on ``RUN`` tokens lie together; such a run of
   equals over ``PAGES`` distinct pages or more is a repeated substring.
3. A repeated substring is boilerplate if one of its occurrences lies outside every article
   container (furniture on one page is furniture on the others). What boilerplate covers is removed from
   the articles, and the unique runs are kept. Substrings that repeat only within articles are
   copies and quotations, not boilerplate, and stay.
4. A page without a container keeps all its blocks but furniture, without the substrings that are
   furniture by 3 or that repeat on ``PAGES`` such pages with text of their own. Pages that repeats
   cover to more than 1 - 1/``OWN`` are copies of one another: they don't count, so copies keep
   their text whatever their number.

A host of more than ``PART_CHARS`` characters is dealt to parts by a hash, so a host with a third of
all pages is many groups. Repetition is decided over the whole host, by a sketch and then exactly.
Parts send the cells of their runs' hashes, with the number of pages that hold them, to the host's
shards, and get back the cells on ``PAGES`` pages of all parts together; counts are never too small,
so no repeated run is lost. Cells with nothing but articles of pages with a container stay, as their
runs can't be boilerplate. Of the runs in the other cells parts send the full hashes with the pages,
and get back those on ``PAGES`` distinct pages. Texts are exchanged once, compressed, for all passes.

Defined results: null or empty html gives empty text; a null or unparsable url counts to the host
``''``; repeated rows are one distinct page but one result each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.html_blocks import blocks
from quotelens.llm.substring_dedup import cut, joined, pack, unpack
from quotelens.llm.words import BASES, Words, rolling, utf8_buffer
from quotelens.session import materialize

RUN = 16
PAGES = 3
PART_CHARS = 8_000_000
#: A page without a container has text of its own if no repeat covers a part of 1 / OWN of it.
OWN = 4
#: Key of a run: two rolling hashes of its tokens, 64 bits of one and 32 of the other.
KEY = np.dtype([("a", "<u8"), ("b", "<u4")])
LISTS = "host string, part long, shard long, loose boolean, runs binary, at binary, pages binary, marks binary"
#: Marks of a run: outside an article somewhere, repeated on pages with text of their own, on a page without a container in this part.
FURNITURE, APART, LOOSE = 1, 2, 4
#: A shard of a host's sketch has 2 ** CELL_BITS cells, for the runs of PART_CHARS characters of html.
CELL_BITS = 24
CELLS = "host string, part long, shard long, cells binary"
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?(?:www\.)?([^/:?#]+)"


def suffix_ranks(token: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` tokens (a power of two), by prefix doubling.

    ``left``: tokens to the end of the page's region; a shorter suffix is ranked by what it has."""
    rank, width = token.astype(np.int64), 1
    while width < depth:
        second = np.zeros(len(rank), np.int64)
        at = np.flatnonzero(left > width)
        second[at] = rank[at + width] + 1
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + second, return_inverse=True)
        width *= 2
    return rank


def cover(at: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens lie in a run that begins at one of ``at``."""
    step = np.zeros(n + RUN + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + RUN, -1)
    return np.cumsum(step[:n]) > 0


def boilerplate(s: Streams) -> np.ndarray:
    """Which tokens are covered by a boilerplate substring, by the pages at hand."""
    long = np.flatnonzero(s.left >= RUN)
    if not len(long):
        return np.zeros(len(s.left), bool)
    token = s.words.codes
    rank = suffix_ranks(token, s.left, RUN)[long]
    order = np.lexsort((s.page[long], rank))  # the suffix array, equal suffixes by page
    rank, at = rank[order], long[order]
    first = np.ones(len(rank), bool)
    first[1:] = rank[1:] != rank[:-1]
    new_page = first.copy()
    new_page[1:] |= s.page[at[1:]] != s.page[at[:-1]]
    group = np.cumsum(first) - 1
    repeated = np.bincount(group, weights=new_page) >= PAGES
    beyond = np.bincount(group, weights=s.furniture[at]) > 0
    counted = np.flatnonzero(s.apart(cover(at[repeated[group]], len(token)))[at])
    pair = np.unique(group[counted] * len(s.pages) + s.page[at[counted]])
    apart = np.bincount(pair // max(len(s.pages), 1), minlength=len(repeated)) >= PAGES
    return cover(at[repeated[group] & (beyond[group] | (s.loose[at] & apart[group]))], len(token))


class Streams:
    """Token streams of pages end to end, from each row's blocks: texts by line, and a byte of flags for each
    (1: inside the container, 2: furniture).

    For each token: ``page`` (an index into ``pages``), ``wanted`` (may be main text), ``loose`` (on a
    page without a container), ``furniture`` (outside the article of a page with one) and ``left``
    (tokens to the end of its region; no substring spans two). ``first``: each row's first token."""

    def __init__(self, lines: pa.Array, flags: list[bytes], keys):
        self.words = Words(lines)
        self.first, n = self.words.first, self.words.n_rows
        data, off = utf8_buffer(lines)
        begin = np.union1d(off[:-1][np.diff(off) > 0], np.flatnonzero(data == 10) + 1)  # first byte of each block
        sizes = np.diff(np.append(np.searchsorted(self.words.starts, begin), len(self.words.codes)))
        flag = np.frombuffer(b"".join(flags), np.uint8)
        inside, furniture = (flag & 1) > 0, (flag & 2) > 0
        row = np.repeat(np.arange(n), [len(f) for f in flags])
        contained = (np.bincount(row, weights=inside & ~furniture, minlength=n) > 0)[row]
        self.wanted = np.repeat(~furniture & (inside | ~contained), sizes)
        self.loose = np.repeat(~contained, sizes)
        self.furniture = np.repeat((furniture | ~inside) & contained, sizes)
        index: dict = {}
        own = np.array([index.setdefault(key, len(index)) for key in keys], np.int64)
        self.pages, self.page = list(index), np.repeat(own, np.diff(self.first))
        ends = np.union1d(self.first[1:], np.flatnonzero(np.diff(self.wanted)) + 1).astype(np.int64)
        at = np.arange(len(self.page))
        self.left = (ends[np.searchsorted(ends, at, "right")] if len(at) else at) - at

    def apart(self, covered: np.ndarray) -> np.ndarray:
        """Which tokens lie on a page without a container that has text of its own, beside the repeats that cover the rest."""
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        mine, n = self.loose & self.wanted, len(self.first) - 1
        size, own = np.bincount(row[mine], minlength=n), np.bincount(row[mine & ~covered], minlength=n)
        return self.loose & ((own > 0) & (own * OWN >= size))[row]

    def texts(self, covered: np.ndarray) -> pa.Array:
        return joined(self.words, self.wanted & ~covered)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First token and 96-bit key of every run."""
        at = np.flatnonzero(self.left >= RUN)
        out = np.zeros(len(at), KEY)
        if len(at):
            out["a"], out["b"] = (rolling(h, at, RUN, base) for h, base in zip(self.words.hashes(), BASES))
        return at, out


def read_pages(batches):
    """Blocks of each page: texts by line (a text holds no line break), compressed, and a byte of flags for each."""
    for batch in batches:
        found = [blocks(x) if x else [] for x in batch.column("html").to_pylist()]
        names, press = [x for x in batch.schema.names if x != "html"], zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array([press("\n".join(t for t, _, _ in f).encode()) if f else b"" for f in found], pa.binary()),
                                          pa.array([bytes(i + 2 * u for _, i, u in f) for f in found], pa.binary()),
                                          pa.array([bool(f) and not any(i and not u for _, i, u in f) for f in found], pa.bool_())], names=[*names, "lines", "flags", "loose"])


def streams(table: pa.Table, keys=None) -> Streams:
    unpress = zstandard.ZstdDecompressor().decompress
    lines = pa.array([unpress(x) if x else b"" for x in table.column("lines").to_pylist()], pa.large_binary()).cast(pa.large_string())
    return Streams(lines, table.column("flags").to_pylist(), table.column("page").to_pylist() if keys is None else keys)


def extract(table: pa.Table) -> pa.Table:
    s = streams(table, [u if u is not None else ("row", i) for i, u in enumerate(table.column("url").to_pylist())])
    return pa.table({"id": table.column("id"), "url": table.column("url"), "text": s.texts(boilerplate(s))})


def cell_lists(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.table({name: pa.array(c, k) for name, c, k in zip(("host", "part", "shard", "cells"), columns, kinds)})


def cells_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Each run's shard and, in the low bits, its cell there."""
    return ((key["a"] % np.uint64(shards)).astype(np.int64) << CELL_BITS) + (key["a"] >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def sketch(table: pa.Table) -> pa.Table:
    """A part's cells by shard, each with its number of distinct pages (at most PAGES) and whether a run in it
    is anywhere but in an article: (cell * PAGES + pages - 1) * 2 + elsewhere."""
    s = streams(table)
    at, key = s.runs()
    host, part, shards = (table.column(c)[0].as_py() for c in ("host", "part", "parts"))
    cell = cells_of(key, shards)
    elsewhere = np.unique(cell[(s.furniture | s.loose)[at]])
    cell = np.unique(cell * len(s.pages) + s.page[at]) // len(s.pages)
    cell, pages = np.unique(cell, return_counts=True)
    inside = ((cell & ((1 << CELL_BITS) - 1)) * PAGES + np.minimum(pages, PAGES) - 1) * 2 + np.isin(cell, elsewhere)
    return cell_lists([(host, part, shard, pack(inside[i:j])) for shard, i, j in cut(cell, CELL_BITS)])


def hot_cells(table: pa.Table) -> pa.Table:
    """Of one shard of a host: each part gets its cells whose pages, added over the parts, are PAGES or more, if one isn't an article."""
    host, shard = table.column("host")[0].as_py(), table.column("shard")[0].as_py()
    parts, bodies = table.column("part").to_pylist(), table.column("cells").to_pylist()
    count, elsewhere = np.zeros(1 << CELL_BITS, np.uint8), np.zeros(1 << CELL_BITS, bool)
    for body in bodies:
        v = unpack(body)
        cell = v // (2 * PAGES)
        count[cell] = np.minimum(count[cell] + (v // 2 % PAGES + 1).astype(np.uint8), PAGES)
        elsewhere[cell] |= (v & 1) > 0
    hot, rows = (count >= PAGES) & elsewhere, []
    for part, body in zip(parts, bodies):
        cell = unpack(body) // (2 * PAGES)
        cell = cell[hot[cell]]
        if len(cell):
            rows.append((host, part, shard, pack(cell)))
    return cell_lists(rows)


def lists(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 8
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 4)
    return pa.table({name: pa.array(c, k) for name, c, k in zip(("host", "part", "shard", "loose", "runs", "at", "pages", "marks"), columns, kinds)})


def entries(table: pa.Table, s: Streams, at: np.ndarray, key: np.ndarray) -> pa.Table:
    """A part's distinct (run, page) by shard, at most PAGES pages a run, and the run's marks (FURNITURE, LOOSE) over all of them."""
    if not len(at):
        return lists([])
    host, part, shards = (table.column(c)[0].as_py() for c in ("host", "part", "parts"))
    page = s.page[at]
    order = np.lexsort((page, key["b"], key["a"]))
    key, page, furniture, loose = key[order], page[order], s.furniture[at][order], s.loose[at][order]
    first = np.append(True, key[1:] != key[:-1])
    new = first | np.append(True, page[1:] != page[:-1])
    run = np.cumsum(first) - 1
    mark = (FURNITURE * (np.bincount(run, weights=furniture) > 0) + LOOSE * (np.bincount(run, weights=loose) > 0)).astype(np.uint8)[run]
    so_far = np.cumsum(new)
    keep = new & (so_far - so_far[np.flatnonzero(first)][run] < PAGES)
    key, page, mark = key[keep], page[keep], mark[keep]
    shard = (key["a"] % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ids, rows = np.array(s.pages, np.int64), []
    for chosen in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        own, where = np.unique(page[chosen], return_inverse=True)
        pressed = zstandard.ZstdCompressor(level=1).compress(where.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
        rows.append((host, part, int(shard[chosen[0]]), False, key[chosen].tobytes(), pressed, ids[own].tobytes(), mark[chosen].tobytes()))
    return lists(rows)


def send(table: pa.Table, hot: pa.Table) -> pa.Table:
    """The runs of a part that lie in hot cells of the host."""
    if not table.num_rows or not hot.num_rows:
        return lists([])
    s = streams(table)
    at, key = s.runs()
    known = np.concatenate([(shard << CELL_BITS) + unpack(x) for shard, x in zip(hot.column("shard").to_pylist(), hot.column("cells").to_pylist())])
    likely = np.isin(cells_of(key, table.column("parts")[0].as_py()), known)
    return entries(table, s, at[likely], key[likely])


def repeated_runs(table: pa.Table) -> pa.Table:
    """Of one shard of a host: each part gets its runs that are on PAGES pages of the host, with their marks: those that
    it has on pages without a container, and those of the others that are furniture."""
    host, shard = table.column("host")[0].as_py(), table.column("shard")[0].as_py()
    parts = table.column("part").to_pylist()
    keys = [np.frombuffer(x, KEY) for x in table.column("runs").to_pylist()]
    pages = []
    for at, own in zip(table.column("at").to_pylist(), table.column("pages").to_pylist()):
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(at), np.uint8).reshape(4, -1)
        pages.append(np.frombuffer(own, np.int64)[np.ascontiguousarray(planes.T).view("<u4").ravel()])
    mark = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("marks").to_pylist()])
    owner = np.repeat(np.arange(len(parts)), [len(k) for k in keys])
    key, page = np.concatenate(keys), np.concatenate(pages)
    order = np.lexsort((page, key["b"], key["a"]))
    key, page, mark, owner = key[order], page[order], mark[order], owner[order]
    first = np.append(True, key[1:] != key[:-1])
    run = np.cumsum(first) - 1
    often = np.bincount(run, weights=first | np.append(True, page[1:] != page[:-1])) >= PAGES
    furniture = np.bincount(run, weights=mark & FURNITURE) > 0
    _, at = np.unique(owner * len(often) + run, return_index=True)
    owner, run, mark = owner[at], run[at], FURNITURE * furniture[run[at]] + (mark[at] & LOOSE)
    key, rows = key[first], []
    for loose in (True, False):
        sent = np.flatnonzero(often[run] & ((mark >= LOOSE) == loose) & (mark > 0))
        for chosen in np.split(sent, np.flatnonzero(np.diff(owner[sent])) + 1) if len(sent) else ():
            rows.append((host, parts[owner[chosen[0]]], shard, loose, key[run[chosen]].tobytes(), b"", b"", mark[chosen].astype(np.uint8).tobytes()))
    return lists(rows)


def answers(back: pa.Table, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each run is in the lists, and its marks there."""
    known = np.frombuffer(b"".join(back.column("runs").to_pylist()), KEY)
    mark = np.frombuffer(b"".join(back.column("marks").to_pylist()), np.uint8)
    if not len(known) or not len(key):
        return np.zeros(len(key), bool), np.zeros(len(key), np.uint8)
    both = np.concatenate([known, key])
    order = np.lexsort((both["b"], both["a"]))
    where = np.zeros(len(both), np.int64)
    where[order] = np.append(0, np.cumsum(both[order][1:] != both[order][:-1]))
    found, marks = np.zeros(len(both), bool), np.zeros(len(both), np.uint8)
    found[where[:len(known)]], marks[where[:len(known)]] = True, mark
    return found[where[len(known):]], marks[where[len(known):]]


def send_apart(table: pa.Table, back: pa.Table) -> pa.Table:
    """The repeated runs of a part's pages without a container that have text of their own."""
    table = table.filter(table.column("loose"))
    if not table.num_rows or not back.num_rows:
        return lists([])
    s = streams(table)
    at, key = s.runs()
    repeated, _ = answers(back, key)
    chosen = repeated & s.apart(cover(at[repeated], len(s.page)))[at]
    return entries(table, s, at[chosen], key[chosen])


def mark_apart(sent: pa.Table, found: pa.Table) -> pa.Table:
    """Of one shard of a host: the parts' repeated runs that are furniture or on PAGES of the pages with text of their own, so marked."""
    apart, rows = repeated_runs(sent) if sent.num_rows else lists([]), []
    for host, part, shard, loose, runs, marks in zip(*(found.column(c).to_pylist() for c in ("host", "part", "shard", "loose", "runs", "marks"))):
        key, mark = np.frombuffer(runs, KEY), np.frombuffer(marks, np.uint8) & FURNITURE
        if loose:
            mark = (mark + APART * answers(apart, key)[0]).astype(np.uint8)
        if mark.any():
            rows.append((host, part, shard, loose, key[mark > 0].tobytes(), b"", b"", mark[mark > 0].tobytes()))
    return lists(rows)


def extract_part(table: pa.Table, back: pa.Table) -> pa.Table:
    s = streams(table)
    at, key = s.runs()
    _, marks = answers(back, key)
    gone = (marks & FURNITURE > 0) | (s.loose[at] & (marks & APART > 0))
    return pa.table({"id": table.column("id"), "url": table.column("url"), "text": s.texts(cover(at[gone], len(s.page)))})


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text of every row."""
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.coalesce(F.regexp_extract(F.lower("url"), HOST, 1), F.lit(""))
    sizes = base.groupBy(host.alias("name")).agg((F.sum(F.coalesce(F.length("html"), F.lit(0))) / PART_CHARS).cast("long").alias("parts"))
    large = materialize(sizes.where("parts > 0"), "hosts")  # written, so that the join is planned by its real size
    hosted = base.withColumn("host", host)
    kind = base.schema["id"].dataType.simpleString()
    fields = f"id {kind}, url string, text string"
    small = hosted.join(large, F.col("host") == F.col("name"), "left_anti").select("id", "url", "host", "html")
    read = "lines binary, flags binary, loose boolean"
    out = small.mapInArrow(read_pages, f"id {kind}, url string, host string, {read}").groupBy("host").applyInArrow(extract, fields)
    if not large.isEmpty():
        dealt = (hosted.join(large, F.col("host") == F.col("name")).withColumn("part", F.pmod(F.xxhash64("id", "url"), F.col("parts") + 1))
                 .withColumn("page", F.when(F.col("url").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("url")))
                 .select("id", "url", "host", "part", "parts", "page", "html"))
        # one plan, so that all passes over the parts read the same exchange
        by_part = dealt.mapInArrow(read_pages, f"id {kind}, url string, host string, part long, parts long, page long, {read}").groupBy("host", "part")
        hot = by_part.applyInArrow(sketch, CELLS).groupBy("host", "shard").applyInArrow(hot_cells, CELLS)
        found = by_part.cogroup(hot.groupBy("host", "part")).applyInArrow(send, LISTS).groupBy("host", "shard").applyInArrow(repeated_runs, LISTS)
        loose = by_part.cogroup(found.where("loose").groupBy("host", "part")).applyInArrow(send_apart, LISTS)
        back = loose.groupBy("host", "shard").cogroup(found.groupBy("host", "shard")).applyInArrow(mark_apart, LISTS)
        out = out.unionByName(by_part.cogroup(back.groupBy("host", "part")).applyInArrow(extract_part, fields))
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
