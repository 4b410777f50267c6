"""N-gram Jaccard join with count-vector R-trees (operator 1).

A document is the set of its five-word shingles, hashed to 64 bits. Documents
link when the intersection has at least 80 % of the union.

Equal sets are one class from the start. A pair of classes that links shares a
shingle among the first ``n - ceil(0.8 n) + 1`` of each, in any order common to
all; with frequent shingles last such a prefix says most, and only documents
that share one form a block. Inside a block every set is a point: its shingles
are hashed into groups and the counts per group are its coordinates. The sum of
coordinate minima bounds the intersection, and an R-tree over the points, whose
pages keep the largest coordinates and the range of sizes, finds the points
whose bound reaches the 80 %. The tree adds up ``fold`` groups to a coordinate;
what it finds is bounded again by the single groups. A count is a byte; what is
above 255 goes, summed over the groups, to one further coordinate, so that the
bound holds for sets of any size. Pairs that survive are verified on the whole sets.

What is asked for are components, so no block is expanded into all its pairs:

1. Blocks of each document's first few shared shingles give a spanning forest of
   their surviving pairs, best bounds first; these pairs are verified and the
   components of the links computed.
2. In the blocks that still hold several components, the surviving pairs between
   two components are counted. A pair is verified if the number of blocks it
   shares leaves room for a link: documents that share a passage only do not
   reach that. After that no link between components is left.

A block of more than ``block`` points is dealt over tasks by a hash. In step 1
its smallest point joins every part, which ties the parts of one group of copies
together; in step 2 each two parts meet. Hot blocks of copies end in step 1.

Frequent shingles only change the order, never the result, so a bounded number
of them is broadcast. Nothing else is, but for ids behind a check of their
number.

Defined results: texts without words have an empty set, no links, and their own
id as component; NULL ids take part, and a component of NULL ids has a NULL
component_id; repeated rows are equal sets; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import body_text, discard, stored
from txrisk.llm.components import connected


@dataclass(frozen=True)
class Join:
    """``percent`` of the union that the intersection must have. ``fold`` of the
    ``groups`` make a coordinate of the tree. ``first`` is how many shared
    shingles of a document step 1 looks at, ``frequent`` how many shingles are
    put last, ``few`` how many ids may be broadcast."""

    percent: int = 80
    shingle: int = 5
    groups: int = 256
    fold: int = 4
    first: int = 3
    block: int = 2048
    frequent: int = 100_000
    few: int = 1_000_000


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted hashes of the distinct shingles. ``known`` keeps word hashes."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    for word in set(words):
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = len(words) - width + 1
    h = np.zeros(size, np.uint64)
    for k in range(width):
        h = h * _MULTIPLIER + ids[k : k + size]
    return np.unique(_mixed(h))


def _sets(batch: pa.Array, width: int, known: dict[bytes, int]) -> Iterator[np.ndarray]:
    for text in batch:
        if len(known) > 500_000:
            known.clear()
        yield shingle_set(text.as_py(), width, known)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def set_id(hashes: np.ndarray) -> int:
    """Hash of a whole set, as a signed number."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def counts(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Shingles per group, at most 255."""
    found = np.bincount((hashes >> np.uint64(17)) % np.uint64(groups), minlength=groups)
    return np.minimum(found, 255).astype(np.uint8)


@dataclass(frozen=True)
class Points:
    """Counts per group and, in ``above``, the shingles that no count holds.
    With n shingles, ``above`` is n less the sum of the counts."""

    counts: np.ndarray
    above: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, sizes: np.ndarray) -> Points:
        return Points(counts, sizes - counts.sum(axis=1, dtype=np.int64))

    def take(self, rows: np.ndarray | slice) -> Points:
        return Points(self.counts[rows], self.above[rows])

    def coordinates(self, fold: int) -> np.ndarray:
        """``fold`` groups added up to each coordinate, and ``above`` as the last."""
        starts = np.arange(0, self.counts.shape[1], fold)
        folded = np.add.reduceat(self.counts, starts, axis=1, dtype=np.uint32)
        return np.column_stack([folded, self.above.astype(np.uint32)])

    def bound(self, i: np.ndarray | int, j: np.ndarray | int) -> np.ndarray:
        """At least the intersections of the sets i with the sets j."""
        both = np.minimum(self.counts[i], self.counts[j]).sum(axis=-1, dtype=np.int64)
        return both + np.minimum(self.above[i], self.above[j])


def frequent_shingles(docs: DataFrame, join: Join) -> np.ndarray:
    """The shingles that most prefixes hold, at most ``join.frequent``. Each
    batch reports those it saw twice, which any frequent one is somewhere."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            first = [
                s[: prefix_size(len(s), join.percent)]
                for s in _sets(batch.column(0), join.shingle, known)
            ]
            found, times = np.unique(np.concatenate(first or [np.empty(0, np.uint64)]), return_counts=True)
            often = times > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(times[often].astype(np.int64))],
                names=["shingle", "times"],
            )

    top = (
        docs.select(body_text().alias("text"))
        .mapInArrow(report, "shingle bigint, times bigint")
        .groupBy("shingle")
        .agg(F.sum("times").alias("times"))
        .filter("times >= 16")
        .orderBy(F.desc("times"), "shingle")
        .limit(join.frequent)
        .select("shingle")
        .toArrow()
    )
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def document_sets(docs: DataFrame, join: Join) -> DataFrame:
    """Per document: doc_id, text_id, set, n, the point, the prefix and a row number."""
    frequent = frequent_shingles(docs, join)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        last = shared.value
        for batch in batches:
            sets, sizes, points, prefixes = [], [], [], []
            for hashes in _sets(batch.column(2), join.shingle, known):
                size = prefix_size(len(hashes), join.percent)
                common = np.isin(hashes, last, assume_unique=True, kind="sort")
                rare = hashes[~common]
                prefix = np.concatenate([rare[:size], hashes[common][: max(0, size - len(rare))]])
                sets.append(set_id(hashes))
                sizes.append(len(hashes))
                points.append(counts(hashes, join.groups).tobytes())
                prefixes.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sets, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(points, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_id", "set", "n", "point", "prefix"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = body_text()
    return stored(
        docs.select("doc_id", F.xxhash64(text).alias("text_id"), text.alias("text")).mapInArrow(
            describe,
            f"doc_id {kind}, text_id bigint, set bigint, n bigint, point binary, prefix array<bigint>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "shingle-sets",
    )


class RTree:
    """Packed tree over points in order of size. A page keeps the largest value
    of each coordinate and the range of sizes of what is below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int, page: int = 32) -> None:
        self.points, self.sizes, self.percent, self.page = points, sizes, percent, page
        self.levels = [(points, sizes, sizes)]
        while len(self.levels[-1][0]) > page:
            most, low, high = self.levels[-1]
            starts = np.arange(0, len(most), page)
            self.levels.append(
                (
                    np.maximum.reduceat(most, starts),
                    np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts),
                )
            )

    def survivors(self, point: np.ndarray, size: int, before: int) -> np.ndarray:
        """Rows below ``before`` whose bound admits a link with the point. With
        sizes a, b a link needs an intersection of p (a + b) / (100 + p)."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            most, low, high = self.levels[level]
            at = at[(at * self.page**level < before)]
            fits = (100 * high[at] >= self.percent * size) & (100 * size >= self.percent * low[at])
            at = at[fits]
            bound = np.minimum(most[at], point).sum(axis=1, dtype=np.int64)
            at = at[(100 + self.percent) * bound >= self.percent * (size + low[at])]
            if level:
                at = (at[:, None] * self.page + np.arange(self.page)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return at


def reaching(
    points: Points, sizes: np.ndarray, i: int, near: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``near`` that the bound by single groups leaves, and that bound."""
    bound = points.bound(near, i)
    fits = (100 + percent) * bound >= percent * (sizes[near] + sizes[i])
    return near[fits], bound[fits]


def forest_pairs(tree: RTree, fine: Points) -> list[tuple[int, int]]:
    """A spanning forest of the surviving pairs: each point with the best match
    in every component it meets."""
    label = np.arange(len(tree.sizes))
    found = []
    for i in range(1, len(label)):
        near = tree.survivors(tree.points[i], tree.sizes[i], i)
        near, overlap = reaching(fine, tree.sizes, i, near, tree.percent)
        if not len(near):
            continue
        quality = overlap / (tree.sizes[near] + tree.sizes[i] - overlap)
        order = np.argsort(-quality, kind="stable")
        roots, first = np.unique(label[near[order]], return_index=True)
        found += [(i, int(near[order[f]])) for f in first]
        label[np.isin(label, roots)] = i
        label[i] = i
    return found


def crossing_pairs(
    tree: RTree, fine: Points, component: np.ndarray, part: np.ndarray, two_parts: bool
) -> list[tuple[int, int]]:
    """Surviving pairs between components. Of two different parts, pairs inside
    one are left to the task where that part meets itself."""
    found = []
    for i in range(1, len(component)):
        near = tree.survivors(tree.points[i], tree.sizes[i], i)
        near = near[component[near] != component[i]]
        if two_parts:
            near = near[part[near] != part[i]]
        near, _ = reaching(fine, tree.sizes, i, near, tree.percent)
        found += [(i, int(j)) for j in near]
    return found


def page_pairs(first: np.ndarray, at_once: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same page, some at a time. Pages are runs of rows, and
    ``first`` is the first row of each row's page."""
    ends = np.cumsum(np.arange(len(first)) - first)
    start = 0
    while start < len(first):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + at_once, "right")))
        rows = np.arange(start, stop)
        i = np.repeat(rows, rows - first[rows])
        j = first[i] + np.arange(len(i)) - (ends[i] - (i - first[i]) - done)
        yield i, j
        start = stop


def spanning(i: np.ndarray, j: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """Which of the pairs, best first, connect what was not connected."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    chosen = []
    for k in np.argsort(-quality, kind="stable").tolist():
        left, right = root(int(i[k])), root(int(j[k]))
        if left != right:
            parent[left] = right
            chosen.append(k)
    return np.array(chosen, int)


# Pairs a task adds up at a time.
HELD_PAIRS = 1_000_000


def pair_counts(pairs: np.ndarray) -> pa.RecordBatch:
    """Distinct columns (a, b, n_a, n_b) and how often each occurs."""
    pairs = pairs[:, np.lexsort(pairs[:2])]
    opens = np.r_[True, (pairs[:2, 1:] != pairs[:2, :-1]).any(axis=0)]
    starts = np.flatnonzero(opens)
    times = np.diff(np.r_[starts, pairs.shape[1]])
    columns = [*pairs[:, starts], times]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns],
        names=["a", "b", "n_a", "n_b", "times"],
    )


def _block_pairs(rows: DataFrame, join: Join, forest: bool) -> DataFrame:
    """Pairs ``a`` < ``b`` of sets with their sizes and ``times``, in how many
    blocks they survive; a pair may come in several rows. ``rows`` has ``block``
    keys x, y, z and set, n, point, component and part, and ``near``. With
    ``forest`` a block gives a spanning forest of its pairs, otherwise all
    between components. Blocks that fit on one page of the tree are many, so a
    task compares the points of many such pages at once.

    Sets that share a text's passage share many blocks, whose smallest member
    ``near`` is often the same. Blocks (or parts of them) go to tasks by it, and
    a task adds up the pairs it has found before it hands them on."""
    keys, page = ["x", "y", "z"], 32
    columns = [*keys, "set", "n", "component", "part", "point"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Whole blocks, several at once; a block that batches cut is put together."""
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            now = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(columns)}
            if rest is not None:
                now = {c: np.concatenate([rest[c], v]) for c, v in now.items()}
            last = np.ones(batch.num_rows if rest is None else len(now["x"]), bool)
            for c in keys:
                last &= now[c] == now[c][-1:]
            cut = len(last) - int(last.sum())
            if cut:
                yield {c: v[:cut] for c, v in now.items()}
            rest = {c: v[cut:] for c, v in now.items()}
        if rest is not None:
            yield rest

    def small(block: dict[str, np.ndarray], fine: Points, first: np.ndarray) -> list:
        n, found, points = block["n"], [], fine.coordinates(join.fold)
        for i, j in page_pairs(first):
            fits = 100 * np.minimum(n[i], n[j]) >= join.percent * np.maximum(n[i], n[j])
            if not forest:
                fits &= block["component"][i] != block["component"][j]
                fits &= (block["y"][i] == block["z"][i]) | (block["part"][i] != block["part"][j])
            i, j = i[fits], j[fits]
            bound = np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64)
            fits = (100 + join.percent) * bound >= join.percent * (n[i] + n[j])
            i, j = i[fits], j[fits]
            bound = fine.bound(i, j)
            fits = (100 + join.percent) * bound >= join.percent * (n[i] + n[j])
            i, j, bound = i[fits], j[fits], bound[fits]
            if forest:
                chosen = spanning(i, j, bound / (n[i] + n[j] - bound))
                i, j = i[chosen], j[chosen]
            found.append((i, j))
        return found

    def large(block: dict[str, np.ndarray], fine: Points) -> list:
        tree = RTree(fine.coordinates(join.fold), block["n"], join.percent, page)
        if forest:
            return forest_pairs(tree, fine)
        two_parts = bool(block["y"][0] != block["z"][0])
        return crossing_pairs(tree, fine, block["component"], block["part"], two_parts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            order = np.lexsort([block["set"], block["n"], *(block[c] for c in reversed(keys))])
            block = {c: v[order] for c, v in block.items()}
            opens = np.ones(len(order), bool)
            opens[1:] = np.any([block[c][1:] != block[c][:-1] for c in keys], axis=0)
            once = opens.copy()
            once[1:] |= block["set"][1:] != block["set"][:-1]
            block, opens = {c: v[once] for c, v in block.items()}, opens[once]
            starts = np.flatnonzero(opens)
            members = np.diff([*starts, len(opens)])
            fine = np.repeat(members <= page, members)
            groups = np.frombuffer(b"".join(block["point"]), np.uint8).reshape(len(opens), -1)
            points = Points.of(groups, block["n"])
            short = members[members <= page]
            first = np.repeat(np.cumsum(short) - short, short)
            at = np.flatnonzero(fine)
            found = [
                (at[i], at[j])
                for i, j in small({c: v[fine] for c, v in block.items()}, points.take(fine), first)
            ]
            for start, count in zip(starts[members > page], members[members > page]):
                part = slice(start, start + count)
                pairs = large({c: v[part] for c, v in block.items()}, points.take(part))
                if pairs:
                    found.append(tuple(start + np.array(pairs).T))
            for i, j in found:
                if not len(i):
                    continue
                flip = block["set"][i] > block["set"][j]
                a, b = np.where(flip, j, i), np.where(flip, i, j)
                yield np.stack([block["set"][a], block["set"][b], block["n"][a], block["n"][b]])

    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for pairs in scan(batches):
            held.append(pairs)
            rows += pairs.shape[1]
            if rows > HELD_PAIRS:
                yield pair_counts(np.concatenate(held, axis=1))
                held, rows = [], 0
        if held:
            yield pair_counts(np.concatenate(held, axis=1))

    return (
        rows.select("near", *columns)
        .repartition("near", "y", "z")
        .sortWithinPartitions("near", *keys)
        .select(*columns)
        .mapInArrow(added_up, "a bigint, b bigint, n_a bigint, n_b bigint, times bigint")
    )


def _sharing_enough(found: DataFrame, join: Join) -> DataFrame:
    """Pairs that occur in as many blocks as a link needs.

    A pair is found once per shared shingle of the prefixes. Up to the earlier of
    both prefix ends these are all that the sets share, and after it one of the
    sets has ``ceil(0.8 n) - 1`` shingles left; together they bound the overlap.
    """
    counted = found.groupBy("a", "b").agg(
        F.sum("times").alias("_n"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b")
    )
    after = F.expr(f"({join.percent} * greatest(n_a, n_b) + 99) div 100 - 1")
    enough = (100 + join.percent) * (F.col("_n") + after) >= join.percent * (F.col("n_a") + F.col("n_b"))
    return counted.filter(enough).select("a", "b")


def _parted(rows: DataFrame, sizes: DataFrame, join: Join) -> DataFrame:
    """Rows with the number of parts of their block, and their own part."""
    parts = F.ceil(F.col("members") / join.block).cast("int").alias("parts")
    return rows.join(sizes.select("shingle", parts, "least"), "shingle").withColumn(
        "part", F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    )


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("members"), F.min("set").alias("least"))


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, join: Join) -> DataFrame:
    """Pairs whose whole sets link, as ``u``, ``v``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    texts = (
        members.join(wanted, "set", "left_semi")
        .groupBy("set")
        .agg(F.min("text_id").alias("text_id"))
        .groupBy("text_id")
        .agg(F.lit(1))
        .select("text_id")
    )
    texts_of = stored(texts, "wanted-texts")
    small = texts_of.count() <= join.few
    texts = F.broadcast(texts_of) if small else texts_of
    text = body_text()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = list(_sets(batch.column(0), join.shingle, known))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in found], pa.int64()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                names=["set", "hashes"],
            )

    whole = (
        docs.select(F.xxhash64(text).alias("text_id"), text.alias("text"))
        .join(texts, "text_id", "left_semi")
        .select("text")
        .mapInArrow(sets, "set bigint, hashes binary")
        .dropDuplicates(["set"])
    )
    whole = stored(whole, "whole-sets")
    discard(texts_of)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(left.as_py(), np.uint64)
                right = np.frombuffer(right.as_py(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= join.percent * (len(left) + len(right) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"]
            )

    linked = stored(
        pairs.join(whole.select(F.col("set").alias("a"), F.col("hashes").alias("_left")), "a")
        .join(whole.select(F.col("set").alias("b"), F.col("hashes").alias("_right")), "b")
        .select("a", "b", "_left", "_right")
        .mapInArrow(verify, "u bigint, v bigint"),
        "verified",
    )
    discard(whole)
    return linked


def set_components(docs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """``node`` and ``component`` of the sets that have links, as in
    :func:`~txrisk.llm.components.connected`."""
    filled = sets.filter("n > 0")
    # One document stands for a set, chosen without bringing the prefixes along.
    chosen = filled.groupBy("set").agg(F.min("row").alias("row")).select("row")
    single = filled.select("row", "set", "n", "prefix").join(chosen, "row", "left_semi")
    entries = single.select("set", "n", F.posexplode("prefix").alias("place", "shingle"))
    shared = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    rows = stored(entries.join(shared.select("shingle"), "shingle"), "shared-shingles")
    points = stored(
        filled.join(rows.select("set").distinct(), "set", "left_semi")
        .select("set", "point")
        .dropDuplicates(["set"]),
        "points",
    )

    early = Window.partitionBy("set").orderBy("place", "shingle")
    first = (
        rows.withColumn("_k", F.row_number().over(early))
        .filter(F.col("_k") <= join.first)
        .select("shingle", "set", "n")
    )
    first = _parted(first, _sizes(first), join)
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    parts = F.when(F.col("set") == F.col("least"), everywhere).otherwise(F.array("part"))
    zero = F.lit(0)
    step_one = (
        first.withColumn("y", F.explode(parts))
        .join(points, "set")
        .select(
            F.col("least").alias("near"), F.col("shingle").alias("x"), "y", zero.alias("z"), "set", "n",
            F.col("set").alias("component"), "part", "point",
        )
    )
    members = sets.select("set", "text_id")
    tried = _block_pairs(step_one, join, forest=True).select("a", "b").distinct()
    tried = stored(tried, "pairs")
    links = _verified(tried, docs, members, join)
    found = connected(links)

    labelled = rows.join(found, rows["set"] == found["node"], "left").select(
        "shingle", "set", "n", F.coalesce("component", "set").alias("component")
    )
    labelled = stored(labelled, "labelled")
    mixed = labelled.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("set").alias("least"),
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
    )
    mixed = stored(mixed.filter("_low < _high"), "mixed-blocks")
    own, other = F.col("part"), F.col("_other")
    step_two = (
        _parted(labelled, mixed, join)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(points, "set")
        .select(
            F.col("least").alias("near"), F.col("shingle").alias("x"), F.least(own, other).alias("y"),
            F.greatest(own, other).alias("z"), "set", "n", "component", "part", "point",
        )
    )
    crossing = _sharing_enough(_block_pairs(step_two, join, forest=False), join)
    untried = stored(crossing.join(tried, ["a", "b"], "left_anti"), "pairs")
    discard(rows, points, labelled, mixed, tried)
    if untried.isEmpty():
        return found
    more = _verified(untried, docs, members, join)
    return connected(links.unionByName(more))


def document_components(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, text_id, n and ``_component``, the component of its set, per document."""
    sets = document_sets(docs, join)
    found = set_components(docs, sets, join)
    rows = (
        sets.select("doc_id", "text_id", "set", "n")
        .join(found, F.col("set") == F.col("node"), "left")
        .select("doc_id", "text_id", "n", F.coalesce("component", "set").alias("_component"))
    )
    return stored(rows, "set-components")


def ngram_join(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id per document, and ``text_id``."""
    rows = document_components(docs, join)
    least = (
        rows.filter("n > 0").groupBy("_component").agg(F.min("doc_id").alias("component_id"))
    )
    linked = rows.filter("n > 0").join(least, "_component")
    alone = rows.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone, allowMissingColumns=True).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "text_id"
    )


def representatives(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The documents without near duplicates: of each component of sets one row
    stays, that with the smallest id (NULL last), then text hash, then other
    columns. Documents without words stay."""
    found = document_components(docs, join).filter("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id", "copies")).alias("first")
    stays = (
        found.groupBy("_component", "doc_id", "text_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("_component")
        .agg(first)
        .select(
            F.col("first.doc_id").alias("_id"),
            F.col("first.text_id").alias("_text"),
            F.col("first.copies").alias("_copies"),
        )
    )
    stays = stored(stays, "representatives")
    has_words = F.length(F.translate(body_text(), " \t\n\x0b\f\r", "")) > 0
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(body_text()) == F.col("_text"))
    kept = docs.filter(has_words).join(stays, same)
    single = kept.filter("_copies = 1").select(*docs.columns)
    # Rows that repeat id and text are reduced before they are shuffled.
    repeated = (
        kept.filter("_copies > 1")
        .groupBy("_id", "_text")
        .agg(F.min(F.struct(*docs.columns)).alias("_row"))
        .select("_row.*")
    )
    return single.unionByName(repeated).unionByName(docs.filter(~has_words))
