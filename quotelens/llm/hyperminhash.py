"""Near-duplicate documents by HyperMinHash sketches.

A document's set holds the 64-bit hashes of its distinct word shingles. Its sketch has 2**7
registers; a register keeps, of the least hash in its bucket, the count of leading zeros and the
``MANTISSA`` bits after them (two bytes instead of eight). The steps:

1. Documents with equal sets form one class, whose smallest id stands for it (a class may hold a
   third of all rows: it is a partial aggregate, never a pair).
2. Bands of ``BAND`` compressed registers, the last one shorter; documents that agree on a band meet there. At
   similarity 0.75 all bands of a full sketch miss with probability (1 - 0.75**3)**42 < 1e-9. Sets of fewer
   than ``SMALL`` shingles leave registers empty, so these also meet by shingles: near sets share one of the
   first n - ceil(0.75 n) + 1 by hash value, of both, for certain.
3. Sketches that meet are compared as arrays, all bands of a batch at once. Two documents may be
   near if the collision-corrected Jaccard estimate of their sketches lies no more than 5 standard
   errors below the threshold. No pair comes out of this step: each document only names the
   representative of the documents of its band that may be near, directly or through others.
   Connected components of these names are *families*; near documents share one.
4. Families get their full sets and are compared within themselves: sketches first, then exact
   intersections, in integers, of packed bits over the shingles that at least two members hold.
   Documents that are linked already are not compared again, and only the links of a spanning
   forest come out. Connected components of these links are the result.

Large bands and families are cut into blocks of ``BLOCK`` members, and every two blocks meet in a
task of their own, so no group is unbounded and none is skipped; rows and shuffles grow with
documents, not with pairs.

Ids are whole numbers. Defined results: null, empty or blank texts have the empty set and are linked with nothing; texts
of fewer words than a shingle are one shingle; a row with a null id has no component and is kept;
rows that repeat an id share its component when their texts do. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.components import components
from quotelens.llm.words import BASES, Words, mix, rolling, unused
from quotelens.session import materialize

BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
EMPTY = 0xFFFF
BAND = 3
BANDS = -(-REGISTERS // BAND)
#: Sets of fewer shingles also meet by these.
SMALL = 16
BLOCK = 1024
#: Pairs of sketches or bit rows that are compared at once.
AT_ONCE = 50_000
SLICE_BYTES = 3_000_000


def slices(batch: pa.RecordBatch, column: str):
    """Parts of a batch with about SLICE_BYTES of text each (one row at least)."""
    size = np.cumsum([0, *(len(x) if x else 0 for x in batch.column(column).cast(pa.binary()).to_pylist())])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES)))
        yield batch.slice(at, to - at)
        at = to


def shingles(texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, ordered by row and hash."""
    words = Words(texts, lower=True)
    h, _ = words.hashes() if len(words.codes) else (np.zeros(0, np.uint64), None)
    starts, row = words.window_starts(k)
    parts = [(row, rolling(h, starts, k, BASES[0]))]
    for n in range(1, k):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            parts.append((short, mix(rolling(h, words.first[short], n, BASES[0]) + np.uint64(n))))
    row, h = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[first], h[first]


def registers(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """Sketch of each row: leading zeros and mantissa of the least hash of each bucket."""
    out = np.full((n_rows, REGISTERS), EMPTY, np.uint16)
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    slot = row * REGISTERS + bucket
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]
    rest = h[first] << np.uint64(BUCKET_BITS)
    zeros = np.where(rest > 0, 64 - np.frexp(rest.astype(np.float64))[1], 64 - BUCKET_BITS)
    zeros = np.clip(zeros, 0, 64 - BUCKET_BITS).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[slot[first]] = (zeros * np.uint64(1 << MANTISSA) + mantissa).astype(np.uint16)
    return out


def prefixes(n: int, percent: int) -> int:
    """How many of a small set's least hashes stand for it: two sets at the threshold share one of both their prefixes.

    Sets that can be near a small one have them too."""
    return n + (-percent * n) // 100 + 1 if 0 < percent * n < 100 * SMALL else 0


def signature_function(k: int, percent: int):
    def signatures(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                row, h = shingles(batch.column("text"), k)
                n = np.bincount(row, minlength=batch.num_rows)
                end = np.cumsum(n)
                raw = h.tobytes()
                regs = registers(row, h, batch.num_rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), pa.array(n, pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(raw[8 * (e - c):8 * e]) if c else None for c, e in zip(n.tolist(), end.tolist())], pa.binary()),
                    pa.array([r.tobytes() if c else None for r, c in zip(regs, n.tolist())], pa.binary()),
                    pa.array([raw[8 * (e - c):8 * (e - c + prefixes(c, percent))] for c, e in zip(n.tolist(), end.tolist())], pa.binary())],
                    names=["id", "n_shingles", "set_key", "regs", "least"])
    return signatures


def sets_function(k: int):
    def sets(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                row, h = shingles(batch.column("text"), k)
                n = np.bincount(row, minlength=batch.num_rows)
                end, raw = np.cumsum(n), h.tobytes()
                members = [raw[8 * (e - c):8 * e] for c, e in zip(n.tolist(), end.tolist())]
                own = [xxhash.xxh3_128_digest(m) == key for m, key in zip(members, batch.column("set_key").to_pylist())]
                out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("family"), pa.array(members, pa.binary())], names=["id", "family", "members"])
                yield out.filter(pa.array(own))  # of rows that repeat the id, those with the class's set
    return sets


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def band_keys(batches):
    """(id, n_shingles, band): one row for each band that holds a register, and for each prefix of a small set."""
    for batch in batches:
        regs = matrix(batch.column("regs"))
        filler = np.full((len(regs), BANDS * BAND - REGISTERS), EMPTY, np.uint16)
        used = np.hstack([regs, filler]).reshape(-1, BANDS, BAND)
        packed = np.zeros(used.shape[:2], np.uint64)
        for i in range(BAND):
            packed = packed * np.uint64(1 << 16) + used[:, :, i]
        key = mix(packed + np.arange(BANDS, dtype=np.uint64) * np.uint64(1 << 48)).view(np.int64)
        which, band = np.nonzero((used != EMPTY).any(axis=2))
        own = key[which, band]
        least = batch.column("least").to_pylist()
        first = np.frombuffer(b"".join(least), np.uint64)
        which = np.concatenate([which, np.repeat(np.arange(len(least)), [len(x) // 8 for x in least])])
        keys = np.concatenate([own, mix(first + np.uint64(BANDS)).view(np.int64)])
        take = pa.array(which)
        yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("n_shingles").take(take), pa.array(keys)],
                                         names=["id", "n_shingles", "band"])


class Sketches:
    """Sketches of a batch, prepared for comparing rows by number."""

    def __init__(self, regs: np.ndarray, n: np.ndarray, percent: int):
        empty = regs == EMPTY
        self.regs, self.other = regs, np.where(empty, np.uint16(EMPTY - 1), regs)  # two empty registers never agree
        self.used = np.packbits(~empty, axis=1).view(np.uint64)
        self.n, self.percent = n.astype(np.float64), percent

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sets of rows a and b may reach the threshold, by their sizes and their sketches.

        The filled registers hold a sample, without replacement, of the union (at similarity t its
        size is (n_a + n_b) / (1 + t)), so their error is hypergeometric: nearly none for texts with
        fewer shingles than registers. A pair passes within 5 standard errors (and one register),
        and never needs to be lower than if all unsampled shingles were shared."""
        t, n_a, n_b = self.percent / 100, self.n[a], self.n[b]
        out = 100 * np.minimum(n_a, n_b) >= self.percent * np.maximum(n_a, n_b)
        for i in range(0, len(a), AT_ONCE):
            at = i + np.flatnonzero(out[i:i + AT_ONCE])
            x, y = a[at], b[at]
            equal = np.count_nonzero(self.regs[x] == self.other[y], axis=1)
            filled = np.maximum(np.bitwise_count(self.used[x] | self.used[y]).sum(axis=1), 1)
            ratio = n_a[at] / n_b[at]
            chance = 0.169919487159739 * 2.0 ** -MANTISSA * 4 * ratio / (1 + ratio) ** 2  # accidental match of a register
            estimate = (equal - filled * chance) / filled
            union = np.maximum((n_a[at] + n_b[at]) / (1 + t), filled)
            error = np.sqrt(t * (1 - t) / filled * (union - filled) / np.maximum(union - 1, 1))
            out[at] = estimate >= np.maximum(t - 5 * error - 1 / filled, (t * union - (union - filled)) / filled - 0.01)
        return out


def pairs_by_distance(group: np.ndarray, wanted):
    """(a, b) row numbers of all pairs of equal ``group`` (sorted) that ``wanted`` holds for: neighbours first,
    then next but one, and so on; all groups of the batch take part in each step."""
    left, distance = np.arange(len(group)), 1
    while len(left):
        left = left[left + distance < len(group)]
        left = left[group[left] == group[left + distance]]
        good = wanted(left, left + distance)
        if good.any():
            yield left[good], left[good] + distance
        distance += 1


class Forest:
    """Union of row numbers; a root is the least row of its tree."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def edge_batch(ids: np.ndarray, forest: Forest) -> pa.RecordBatch:
    """(a, b) of every row that is not a root: its id and its root's."""
    at = np.flatnonzero(forest.root != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(ids[forest.root[at]], pa.int64())], names=["a", "b"])


def whole_groups(batches, key):
    """Tables that hold each group of equal ``key`` (an array of a table; rows come sorted by it) whole."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        k = key(table)
        change = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if len(change):
            yield table.slice(0, change[-1]), k[:change[-1]]
            table = table.slice(change[-1])
        rest = table
    if rest is not None and rest.num_rows:
        yield rest, key(rest)


def numbers(table, *columns) -> np.ndarray:
    return np.stack([table.column(c).to_numpy().astype(np.int64) for c in columns], axis=1)


def group_numbers(key: np.ndarray) -> np.ndarray:
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]).any(axis=1)
    return np.cumsum(new)


def shared_bands(batches):
    """Rows of the bands that at least two rows share; rows come sorted by band."""
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        band = table.column("band").to_numpy()
        after = np.append(band[1:] == band[:-1], False)
        before = np.concatenate([[False], after[:-1]])
        if last is not None:
            row, joined = last
            before[0] = row.column("band")[0].as_py() == band[0]
            if joined or before[0]:
                yield from row.to_batches()
        if len(band) > 1:
            yield from table.slice(0, len(band) - 1).filter(pa.array((after | before)[:-1])).to_batches()
        last = (table.slice(len(band) - 1), bool(before[-1]))
    if last is not None and last[1]:
        yield from last[0].to_batches()


def family_function(percent: int):
    def families(batches):
        """Edges between the documents of a band, or of two of its blocks, that may be near."""
        for table, key in whole_groups(batches, lambda t: numbers(t, "band", "i", "j")):
            sketches = Sketches(matrix(table.column("regs")), table.column("n_shingles").to_numpy(), percent)
            ids, block, cross = table.column("id").to_numpy(), table.column("block").to_numpy(), key[:, 1] != key[:, 2]
            forest = Forest(len(ids))
            apart = lambda a, b: (forest.root[a] != forest.root[b]) & (~cross[a] | (block[a] != block[b]))
            for a, b in pairs_by_distance(group_numbers(key), lambda a, b: np.ones(len(a), bool)):
                some = apart(a, b)
                a, b = a[some], b[some]
                good = sketches.near(a, b)
                forest.union(a[good], b[good])
            yield edge_batch(ids, forest)
    return families


def link_function(percent: int):
    def link(table: pa.Table) -> pa.Table:
        """Links of one family, or of two of its blocks: exact on full sets."""
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        n = np.array([len(x) for x in sets], np.int64)
        row, flat = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
        sketches = Sketches(registers(row, flat, len(sets)), n, percent)
        _, word, times = np.unique(flat, return_inverse=True, return_counts=True)
        common = times > 1
        place = (np.cumsum(common) - 1)[word]
        bits = np.zeros((len(sets), -(-max(int(common.sum()), 1) // 64)), np.uint64)
        for i, (lo, hi) in enumerate(zip(np.cumsum(n) - n, np.cumsum(n))):
            own = place[lo:hi][common[word[lo:hi]]]
            np.bitwise_or.at(bits[i], own >> 6, np.uint64(1) << (own & 63).astype(np.uint64))
        forest = Forest(len(sets))
        step = max(1, 4_000_000 // bits.shape[1])
        for a, b in pairs_by_distance(np.zeros(len(sets), np.int64), lambda a, b: np.ones(len(a), bool)):
            some = (forest.root[a] != forest.root[b]) & ((block[a] != block[b]) if cross else True)
            a, b = a[some], b[some]
            good = sketches.near(a, b)
            a, b = a[good], b[good]
            for i in range(0, len(a), step):
                x, y = a[i:i + step], b[i:i + step]
                both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
                near = 100 * both >= percent * (n[x] + n[y] - both)
                forest.union(x[near], y[near])
        return pa.Table.from_batches([edge_batch(ids, forest)])
    return link


def dealt(members: DataFrame, group: str) -> DataFrame:
    """Members of groups with their block and the two blocks (i, j) of each task that they take part in."""
    sizes = members.groupBy(group).agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    large = materialize(sizes.select(F.col(group).alias("large"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "large")
    placed = (members.join(large, F.col(group) == F.col("large"), "left").drop("large")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return each.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id, kept for every row of ``docs``."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = materialize(base.mapInArrow(signature_function(shingle, percent), "id long, n_shingles long, set_key binary, regs binary, least binary"), "sketches")
    class_of = materialize(sig.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("rep")), "classes")
    reps = (sig.join(class_of, (sig.set_key == class_of.set_key) & (sig.id == class_of.rep), "left_semi")
            .select("id", "n_shingles", "regs", "least"))
    reps = materialize(reps, "representatives")
    bands = reps.mapInArrow(band_keys, "id long, n_shingles long, band long")
    shared = materialize(bands.repartition("band").sortWithinPartitions("band").mapInArrow(shared_bands, "id long, n_shingles long, band long"), "bands")
    met = dealt(shared, "band").join(reps.select(F.col("id").alias("rep"), "regs"), F.col("id") == F.col("rep")).drop("rep")
    together = met.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    families = components(together.mapInArrow(family_function(percent), "a long, b long"), "a", "b")
    families = families.join(class_of, F.col("node") == F.col("rep")).select("node", F.col("component").alias("family"), "set_key")
    families = materialize(families, "families")
    # a merge join at every size: families grow with the documents, so a plan that broadcasts them while they are few
    # would say nothing about the plan that large inputs get
    texts = base.join(families.hint("merge"), F.col("id") == F.col("node")).select("id", "text", "family", "set_key")
    members = materialize(texts.mapInArrow(sets_function(shingle), "id long, family long, members binary"), "members")
    links = dealt(members, "family").groupBy("family", "i", "j").applyInArrow(link_function(percent), "a long, b long")
    found = components(links, "a", "b")
    classes = (class_of.join(found, F.col("rep") == F.col("node"), "left")
               .select(F.col("set_key").alias("key"), F.coalesce("component", "rep").alias("component")))
    out = sig.select("id", "n_shingles", "set_key").join(classes, F.col("set_key") == F.col("key"), "left")
    component = F.expr("if(id is null, null, coalesce(component, id))")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.expr("id is null or coalesce(component, id) = id").alias("kept"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``link_documents`` keeps, all columns; of rows that repeat both id and text one stays."""
    key, digest, n = unused(docs, "_id", "_hash", "_n")
    kept = link_documents(docs, id_col, text_col, **options).where("kept").select(F.col(id_col).alias(key)).distinct()
    rows = docs.join(kept.hint("merge"), F.col(id_col).eqNullSafe(F.col(key)), "left_semi")
    same = docs.groupBy(F.col(id_col).alias(key), F.xxhash64(text_col).alias(digest)).agg(F.count("*").alias(n)).where(F.col(n) > 1)
    same = materialize(same.select(key, digest), "repeated")
    if same.isEmpty():
        return rows
    again = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(digest))
    return rows.join(same, again, "left_anti").unionByName(rows.join(same, again, "left_semi").dropDuplicates([id_col, text_col]))
