"""Jaccard join of word 5-grams with count-vector R-trees (operator 11).

A document's set holds the 64-bit hashes of its distinct five-word shingles. Hashing the shingles into
groups makes a set a point of group counts; the sum of the coordinate minima of two points bounds the
overlap of their sets, and so does the sum of the minima of two bounding boxes' upper corners, which
is what a tree over the points prunes by. Points have about a quarter as many coordinates as their
set has shingles (a power of two, halved by adding neighbours where sizes differ): with fewer,
unlike sets of that size would pass, with more, nothing is gained.

A tree over all points of a corpus could not prune (unlike texts lie in the middle of every box), so
the points are first dealt to lists in which every linked pair meets:

1. Equal sets form a class; the rest works on classes, so exact copies cost nothing more.
2. Shingles are ordered by load, the number of shingles of the corpus in their cell of a fixed table
   of LOADS counts. The table (its size does not depend on the corpus) is summed on the cluster and
   goes with the tasks. Two sets that link share one of their first n - ceil(0.8 n) + 1 shingles in
   any common order; in this one a passage of many documents comes last.
3. First pass: in each list every class is offered to one centre, the class with the heaviest
   shingles. A large group of near copies joins its centre here, with as many pairs as classes.
4. Second pass: each list that still holds several components is joined with itself by R-trees over
   the points of its classes. Boxes and pairs inside one component are pruned too: a further link
   there cannot change the groups. Longer lists than LIST are cut into blocks, each pair of blocks
   a group of its own, so no list is one task and memory is bounded. No pair is left out.
5. Both passes confirm the surviving pairs exactly on the full sets
   (100 * |A and B| >= 80 * |A or B|); a centre's set is sent once per SALT_ROWS partners.
6. Links become components by repeated minimum and pointer jumping over stored tables.

Classes are told apart by a 64-bit digest of the whole set; two of N different sets share one with a
chance of N^2 / 2^65.

Edge cases: null or empty texts have an empty set and link with nothing; texts of fewer than five
words have one shingle; a null doc_id takes the smallest non-null id of its group, or null; repeated
rows are exact copies; ids shared by different texts are kept apart, as the work goes by class; very
long texts are read whole, one at a time; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import chunks, keep_ids, stored, texts_of
from dustline.llm.near_duplicates import Shingler, components, full_sets
from dustline.llm.near_duplicates import _node as digest

NUMER, DENOM = 80, 100
LOADS = 1 << 20  # cells of the load table (4 MB)
BLOCK = 1 << 12  # cells in a row while it is summed
FEWEST, MOST = 16, 4096  # coordinates of a point
FAN = 8  # children of a box
LIST = 2048  # members of a list in one block
PAIRS = 1 << 12  # pairs of boxes compared at once
SALT_ROWS = 256


def wanted_prefix(n: np.ndarray | int):
    """Shingles of a set of ``n`` among which a linked set must meet it."""
    return n - (n * NUMER + DENOM - 1) // DENOM + 1


def needed(total):
    """Least overlap of two linked sets whose sizes add up to ``total``."""
    return (total * NUMER + NUMER + DENOM - 1) // (NUMER + DENOM)


def coordinates(n: int) -> int:
    """Groups for a set of ``n`` shingles: a power of two near a quarter of it."""
    return min(MOST, max(FEWEST, 1 << max(0, (int(n) // 4).bit_length() - 1)))


def point_of(values: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by group; the group is the hash's leading bits, so adding neighbours halves the groups."""
    d = coordinates(len(values))
    counts = np.bincount((values.view(np.uint64) >> np.uint64(64 - (d.bit_length() - 1))).astype(np.int64), minlength=d)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32)


def point_from(raw: bytes, n: int) -> np.ndarray:
    d = coordinates(n)
    return np.frombuffer(raw, dtype=np.uint8 if len(raw) == d else np.uint32).astype(np.int32)


def bound(a: np.ndarray, b: np.ndarray) -> int:
    """At least the overlap of two sets, from their points."""
    while len(a) > len(b):
        a = a.reshape(-1, 2).sum(axis=1)
    while len(b) > len(a):
        b = b.reshape(-1, 2).sum(axis=1)
    return int(np.minimum(a, b).sum())


class Tree:
    """R-tree over points of one dimension, loaded in bulk: points are split at the median of the widest coordinate down to leaves,
    and FAN neighbours at a time form the boxes of each level above. Level 0 are the points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.order = np.concatenate(self._tiles(points, np.arange(len(points)))) if len(points) else np.zeros(0, dtype=np.int64)
        top, least, most, low, high = (x[self.order] for x in (points, sizes, sizes, labels, labels))
        self.levels = [(top, least, most, low, high)]
        while len(self.levels[-1][0]) > 1:
            top, least, most, low, high = self.levels[-1]
            at = np.arange(0, len(top), FAN)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
                                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))

    @staticmethod
    def _tiles(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= FAN:
            return [rows]
        part = points[rows]
        widest = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        rows = rows[np.argsort(part[:, widest], kind="stable")]
        # whole leaves to the left, so that boxes of consecutive points are the tiles
        leaves = -(-len(rows) // FAN)
        cut = (leaves + 1) // 2 * FAN
        return Tree._tiles(points, rows[:cut]) + Tree._tiles(points, rows[cut:])

    def level(self, k: int) -> tuple:
        return self.levels[min(k, len(self.levels) - 1)]


def _may_link(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs of boxes that may hold linked points of different labels."""
    top_a, least_a, most_a, low_a, high_a = a
    top_b, least_b, most_b, low_b, high_b = b
    ok = (most_a[i] * DENOM >= least_b[j] * NUMER) & (most_b[j] * DENOM >= least_a[i] * NUMER)
    ok &= ~((low_a[i] == high_a[i]) & (low_b[j] == high_b[j]) & (low_a[i] == low_b[j]))
    left = np.flatnonzero(ok)
    step = max(1, (1 << 22) // max(1, top_a.shape[1]))
    for s in range(0, len(left), step):
        at = left[s:s + step]
        overlap = np.minimum(top_a[i[at]], top_b[j[at]]).sum(axis=1, dtype=np.int64)
        ok[at] = overlap >= needed(least_a[i[at]] + least_b[j[at]])
    return ok


def tree_pairs(a: Tree, b: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of a, row of b) whose points may link; ``a`` may be ``b``, each pair then comes once."""
    same = a is b
    zero = np.zeros(1, dtype=np.int64)
    stack = [(max(len(a.levels), len(b.levels)) - 1, zero, zero)]
    while stack:
        k, i, j = stack.pop()
        if len(i) > PAIRS:
            stack += [(k, i[s:s + PAIRS], j[s:s + PAIRS]) for s in range(0, len(i), PAIRS)]
            continue
        ok = _may_link(a.level(k), b.level(k), i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if k == 0:
            yield a.order[i], b.order[j]
            continue
        n_a, n_b = len(a.level(k - 1)[0]), len(b.level(k - 1)[0])
        step = np.arange(FAN)
        # a tree that has no level this high stays at its root
        wide_a = FAN if k < len(a.levels) else 1
        wide_b = FAN if k < len(b.levels) else 1
        ci = (i[:, None] * wide_a + step[:wide_a])[:, :, None] + np.zeros((1, 1, wide_b), dtype=np.int64)
        cj = (j[:, None] * wide_b + step[:wide_b])[:, None, :] + np.zeros((1, wide_a, 1), dtype=np.int64)
        ci, cj = ci.reshape(-1), cj.reshape(-1)
        keep = (ci < n_a) & (cj < n_b)
        if same:
            keep &= (ci <= cj) if k > 1 else (ci < cj)
        stack.append((k - 1, ci[keep], cj[keep]))


def list_pairs(nodes: np.ndarray, sizes: np.ndarray, places: np.ndarray, labels: np.ndarray, sides: np.ndarray, points: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of one block of a list. ``sides`` 0 and 1 are two different blocks, all 0 is one block with itself;
    ``places`` are those of the list's shingle in each set's order, from 1: all earlier shingles are not shared, or met before."""
    width = np.array([coordinates(n) for n in sizes])
    widths = set(width.tolist())
    trees: dict[tuple, tuple] = {}
    for side in (0, 1):
        for d in set(width[sides == side].tolist()):
            rows = np.flatnonzero((sides == side) & (width == d))
            vectors = np.stack([point_from(points[r], sizes[r]) for r in rows.tolist()])
            trees[side, d] = rows, vectors
            if d // 2 in widths:  # to meet sets with half as many groups
                trees[side, d, "half"] = rows, vectors.reshape(len(rows), d // 2, 2).sum(axis=2)
    built = {k: Tree(v, sizes[rows], labels[rows]) for k, (rows, v) in trees.items()}
    two = bool((sides == 1).any())
    left, right = [], []

    def meet(x: tuple, y: tuple) -> None:
        if x in built and y in built:
            for i, j in tree_pairs(built[x], built[y]):
                left.append(trees[x][0][i])
                right.append(trees[y][0][j])

    for d in sorted(widths):
        meet((0, d), (1 if two else 0, d))
        meet((0, d), (1 if two else 0, 2 * d, "half"))
        if two:
            meet((0, 2 * d, "half"), (1, d))
    if not left:
        return nodes[:0], nodes[:0]
    i, j = np.concatenate(left), np.concatenate(right)
    least = needed(sizes[i] + sizes[j])
    ok = (labels[i] != labels[j]) & (sizes[i] - places[i] + 1 >= least) & (sizes[j] - places[j] + 1 >= least)
    i, j = i[ok], j[ok]
    return np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])


def leaf_pairs(groups: np.ndarray, cross: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, places: np.ndarray, labels: np.ndarray, sides: np.ndarray,
               points: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same for many lists of at most FAN members, each a tree of one leaf: all at once. ``groups`` numbers the lists, whose rows
    follow one another; ``cross`` marks rows of lists of two different blocks."""
    left, right = [], []
    for step in range(1, FAN):
        i = np.flatnonzero(groups[step:] == groups[:-step])
        j = i + step
        least = needed(sizes[i] + sizes[j])
        ok = (labels[i] != labels[j]) & (sizes[i] - places[i] + 1 >= least) & (sizes[j] - places[j] + 1 >= least) & (~cross[i] | (sides[i] != sides[j]))
        ok &= (sizes[i] * DENOM >= sizes[j] * NUMER) & (sizes[j] * DENOM >= sizes[i] * NUMER)
        left.append(i[ok])
        right.append(j[ok])
    i, j = np.concatenate(left), np.concatenate(right)
    ok = np.array([bound(point_from(points[x], sizes[x]), point_from(points[y], sizes[y])) >= needed(sizes[x] + sizes[y])
                   for x, y in zip(i.tolist(), j.tolist())], dtype=bool)
    i, j = i[ok], j[ok]
    return np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])


def summaries(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, n, node), and per task the loads of its shingles as (block, loads): one pass over all texts."""
    kind = "doc_id long, n long, node long, block int, loads binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, loads = Shingler(), np.zeros(LOADS, dtype=np.int64)
        names = ["doc_id", "n", "node", "block", "loads"]
        for batch in chunks(batches):
            sets = list(shingler.sets(texts_of(batch)))
            loads += np.bincount(np.concatenate(sets) & (LOADS - 1), minlength=LOADS) if sets else 0
            k = len(sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([digest(s) if len(s) else None for s in sets], pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=names)
        if loads.any():
            kept = np.min_scalar_type(int(loads.max()))
            blocks = [loads[at:at + BLOCK].astype(kept).tobytes() for at in range(0, LOADS, BLOCK)]
            k = len(blocks)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(range(k), pa.int32()),
                                              pa.array(blocks, pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def load_table(parts: DataFrame) -> np.ndarray:
    """Loads of all cells, added up on the cluster block by block; LOADS numbers reach the driver, whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, dtype=f"u{len(raw) // BLOCK}").astype(np.int64)
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "loads"])

    out = np.zeros(LOADS, dtype=np.int64)
    for r in parts.repartition("block").mapInArrow(run, "block int, loads binary").collect():
        out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["loads"], dtype=np.int64)
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


def indexed(docs: DataFrame, loads: np.ndarray) -> DataFrame:
    """(node, n, weight, point, first) of every row with a set; ``first`` are the leading shingles in order of load, ``weight`` the
    mean log load of all."""
    kind = "node long, n long, weight float, point binary, first array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in chunks(batches):
            node, n, weight, point, first = [], [], [], [], []
            for s in shingler.sets(texts_of(batch)):
                if not len(s):
                    continue
                load = loads[s & (LOADS - 1)]
                k = wanted_prefix(len(s))
                # values are sorted, so a stable order by load breaks ties by value
                lead = np.argpartition(load, k - 1)[:k] if k < len(s) else np.arange(len(s))
                lead = np.flatnonzero(load <= load[lead].max())
                lead = lead[np.argsort(load[lead], kind="stable")][:k]
                node.append(digest(s))
                n.append(len(s))
                weight.append(float(np.log(load).mean()))
                point.append(point_of(s).tobytes())
                first.append(s[lead])
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.float32()), pa.array(point, pa.binary()),
                                              pa.array(first, pa.list_(pa.int64()))], names=["node", "n", "weight", "point", "first"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, kind)


def bounded(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs (a, b) that their sizes and points allow to link."""
    of = lambda side: index.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("point").alias(f"p_{side}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y, n_x, n_y, p_x, p_y in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if bound(point_from(p_x, n_x), point_from(p_y, n_y)) >= needed(n_x + n_y):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    agree = (F.col("n_a") * DENOM >= F.col("n_b") * NUMER) & (F.col("n_b") * DENOM >= F.col("n_a") * NUMER)
    return pairs.join(of("b"), "b").join(of("a"), "a").where(agree).select("a", "b", "n_a", "n_b", "p_a", "p_b").mapInArrow(run, "a long, b long")


def across(lists: DataFrame, index: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different components, from ``lists`` (value, node, n, place, component)."""
    parts = lists.groupBy("value").agg(F.ceil(F.count(F.lit(1)) / LIST).cast("int").alias("parts"))
    rows = lists.join(parts, "value").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    rows = rows.select("value", "node", "n", "place", "component", "part", other)
    rows = rows.select("value", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "n", "place", "component",
                       (F.col("part") > F.col("other")).cast("int").alias("side"))
    rows = rows.join(index.select("node", "point"), "node").select("value", "low", "high", "node", "n", "place", "component", "side", "point")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows of the last list seen, which may go on in the next batch

        def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            keys, rest, points = [np.concatenate([w[i] for w in rows]) for i in range(3)], [np.concatenate([w[i] for w in rows]) for i in range(3, 8)], [p for w in rows for p in w[8]]
            new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(new))
            small = np.repeat(ends - starts <= FAN, ends - starts)
            pairs = []
            if small.any():
                at = np.flatnonzero(small)
                pairs.append(leaf_pairs((np.cumsum(new) - 1)[at], (keys[1] != keys[2])[at], *(r[at] for r in rest), [points[i] for i in at.tolist()]))
            pairs += [list_pairs(*(r[s:e] for r in rest), points[s:e]) for s, e in zip(starts.tolist(), ends.tolist()) if e - s > FAN]
            for a, b in pairs:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            columns[5] = columns[5].astype(np.int64)
            value, low, high = columns[:3]
            point = batch.column(8).to_pylist()
            if not len(value):
                continue
            last = int(np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))[-1])
            goes_on = waiting and (value[0], low[0], high[0]) == tuple(waiting[-1][i][-1] for i in range(3))
            if last or not goes_on:
                done = [*waiting, (*(c[:last] for c in columns), point[:last])]
                waiting = []
                if sum(len(d[0]) for d in done):
                    yield from found(done)
            waiting.append((*(c[last:] for c in columns), point[last:]))
        if waiting:
            yield from found(waiting)

    return rows.repartition("value", "low", "high").sortWithinPartitions("value", "low", "high").mapInArrow(run, "a long, b long").distinct()


def linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. The sets are those of one document of each class in ``pairs``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(classes, "node").select("first_id").distinct()
    sets = full_sets(keep_ids(docs, ids.where("first_id is not null").withColumnRenamed("first_id", "doc_id"), "doc_id"))
    sets = sets.unionByName(full_sets(docs.where("doc_id is null")))
    # repeated rows and shared ids give more sets than asked for
    sets = stored(sets.groupBy("node").agg(F.first("members").alias("members")), "join-sets")
    dealt = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("parts")), "a") \
        .select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("salt"), "b")
    partners = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "members")
    centres = dealt.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, at = None, None
        for batch in batches:
            left, right = [], []
            for a, b, members in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                values = np.frombuffer(members, dtype=np.int64)
                if b is None:
                    centre, at = values, a
                    continue
                if a != at:
                    raise ValueError("a set came without its centre")
                x, y = (values, centre) if len(values) <= len(centre) else (centre, values)
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if DENOM * common >= NUMER * (len(x) + len(y) - common):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return (partners.unionByName(centres).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a long, b long"))


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = stored(summaries(docs), "join-rows")
    rows = seen.where("block is null").select("doc_id", "n", "node")
    classes = stored(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "join-classes")
    loads = load_table(seen.where("block is not null").select("block", "loads"))
    ids = classes.where("first_id is not null").select(F.col("first_id").alias("doc_id")).distinct()
    index = stored(indexed(keep_ids(docs, ids, "doc_id").unionByName(docs.where("doc_id is null")), loads), "join-index")
    if index.count() > classes.count():  # repeated rows, or an id of several texts: one point per class
        index = stored(index.groupBy("node").agg(F.first(F.struct("n", "weight", "point", "first")).alias("x")).select("node", "x.*"), "join-index")
    posted = index.select("node", "n", "weight", F.posexplode("first").alias("place", "value"))
    heads = posted.groupBy("value").agg(F.max(F.struct("weight", "node")).alias("head"), F.count(F.lit(1)).alias("members")) \
        .where("members > 1").select("value", F.col("head.node").alias("centre"))
    lists = stored(posted.select("value", "node", F.col("n").cast("int").alias("n"), (F.col("place") + 1).alias("place")).join(heads, "value"), "join-lists")
    near = lists.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(linked(stored(bounded(near, index), "join-near"), docs, classes), "join-first")
    label = components(first)
    named = lists.select("value", "node", F.col("n").cast("long").alias("n"), "place").join(label, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("value")
    left = stored(named.join(mixed, "value"), "join-mixed")
    second = stored(linked(stored(across(left, index), "join-across"), docs, classes), "join-second")
    found = label if second.isEmpty() else components(first.unionByName(second))
    together = classes.join(found, "node", "left").where("copies > 1 or component is not null").withColumn("component", F.coalesce("component", "node"))
    smallest = together.groupBy("component").agg(F.min("first_id").alias("component_id"))
    together = together.join(smallest, "component").select("node", "component_id")
    return rows.join(together, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op11_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Set size and join component of every document."""
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
