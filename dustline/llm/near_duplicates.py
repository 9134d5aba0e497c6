"""Near-duplicate groups by bottom-k sketches (operator 10).

A document's set holds the 64-bit hashes of its distinct five-word shingles; its sketch is the K
smallest of them, so one hash function serves all. Inverted lists of the retained values give
candidates, the union of two sketches estimates similarity, and the full sets confirm a link
exactly (100 * |A and B| >= 75 * |A or B|).

Steps and what bounds them:

1. Documents with equal sets form a class (a hot class is one partially aggregated row); the rest
   works on classes, so thousands of exact copies cost nothing more.
2. Two linked sets share at least ``SHARED`` of their K retained values (all-complete sketches:
   75 % of the set), except with a chance below 1e-7 at a similarity of exactly 0.75. So among any
   K - SHARED + 1 values of each, taken rarest first in one global order, a value is common. Only
   these values are posted; a passage shared by many unlike documents is common, not rare, and
   hardly ever posted.
3. First pass over the lists: every class is compared with two centres of each list (the class
   whose values are the most widespread, and the smallest), never all pairs. A large group of
   near copies joins its centre here, with as many rows as classes.
4. Second pass: lists that still hold several components give their pairs across components.
   Pairs inside a component are not formed: a further link there cannot change the groups. So no
   link between different components is lost. These pairs come from full sets: with all shingles
   of the classes in such lists ordered rarest first, two linked sets meet among their first
   shingles, at places that still leave room for the overlap their sizes need. Members that only
   share a passage or a template first have their own shingles, so they hardly ever meet.
5. Both passes filter by set size and sketch estimate, then shuffle the sets of the survivors by
   (salted) centre and confirm them in a streamed pass that holds one set at a time.
6. Links become components by repeated minimum and pointer jumping, with every round written to
   the shared checkpoint folder.

Edge cases: null or empty texts have an empty set, link with nothing and are kept; a null doc_id
takes the smallest non-null id of its group, or null; repeated rows are exact copies; ids shared
by different texts are kept apart, as the work goes by class; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dustline.llm.common import chunks, keep_ids, mix, stored, texts_of

WIDTH = 5  # words of a shingle
K = 64  # retained values of a set
SHARED = 28  # of K values at least, for a similarity of 0.75 or more
NUMER, DENOM = 75, 100
MEMORY_WORDS = 150_000
SALT_ROWS = 256  # members compared with one copy of a centre's set
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)
_SIGN = np.uint64(1 << 63)


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers the hashes of a bounded number of words."""

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.hashes = np.zeros(1 << 16, dtype=np.uint64)
        self.known = 0

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The set of each text as sorted signed integers (unsigned order, sign bit flipped)."""
        if len(self.ids) > MEMORY_WORDS:
            self._reset()
        rows = []
        for t in texts:
            words = t.lower().split()  # bytes: A-Z only, and exactly the six ASCII blanks
            rows.append(np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words)))
        if len(self.ids) > self.known:
            new = [xxhash.xxh64_intdigest(w) for w, i in self.ids.items() if i >= self.known]
            if len(self.ids) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes[:self.known], np.zeros(2 * len(self.ids) - self.known, dtype=np.uint64)])
            self.hashes[self.known:len(self.ids)] = new
            self.known = len(self.ids)
        for row in rows:
            n = len(row)
            if not n:
                yield np.zeros(0, dtype=np.int64)
                continue
            h = self.hashes[row]
            w = min(WIDTH, n)
            total = np.full(n - w + 1, w, dtype=np.uint64)
            for j in range(w):
                total += h[j:n - w + 1 + j] * _FACTORS[j]
            yield np.unique((mix(total) ^ _SIGN).view(np.int64))


def _node(values: np.ndarray) -> int:
    return int.from_bytes(blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, sketch) of every row; node is a 64-bit digest of the whole set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in chunks(batches):
            n, node, sketch = [], [], []
            for s in shingler.sets(texts_of(batch)):
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
                sketch.append(s[:K])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                                              pa.array(sketch, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "node", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_shingles long, node long, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, members): the whole set of every row of ``docs`` as bytes of sorted 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in chunks(batches):
            got = [s for s in shingler.sets(texts_of(batch)) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in got], pa.int64()), pa.array([s.tobytes() for s in got], pa.binary())],
                                             names=["node", "members"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, members binary")


def _sizes_agree(a: Column, b: Column) -> Column:
    return (a * DENOM >= b * NUMER) & (b * DENOM >= a * NUMER)


def postings(classes: DataFrame) -> DataFrame:
    """(value, node, n, spread): the rarest retained values of each class that other classes retain too."""
    long = classes.select("node", F.col("n_shingles").alias("n"), F.explode("sketch").alias("value"))
    frequent = long.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = F.least("n", F.lit(K))
    complete = F.col("n") * DENOM <= F.lit(K * NUMER)  # then any partner's sketch is complete as well
    wanted = held - F.when(complete, F.ceil(F.col("n") * NUMER / DENOM)).otherwise(F.lit(SHARED)) + 1
    alone = held - F.size("shared")
    return (long.join(frequent, "value").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
            .select("node", "n", F.aggregate("shared", F.lit(0.0), lambda s, x: s + F.log(x["df"])).alias("spread"),
                    F.expr("shared").alias("shared"), (wanted - alone).cast("int").alias("take"))
            .where("take > 0").select("node", "n", "spread", F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("x"))
            .select(F.col("x.value").alias("value"), "node", "n", "spread"))


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches agree with a similarity of 0.75 or more."""
    of = lambda side: classes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect(union, F.col("s_a")), F.col("s_b")))
    complete = (F.col("n_a") <= K) & (F.col("n_b") <= K)
    return both.where(_sizes_agree(F.col("n_a"), F.col("n_b"))).where(
        F.when(complete, common * DENOM >= F.size(union) * NUMER).otherwise(common >= SHARED)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity. A centre's set is copied once per SALT_ROWS members."""
    pairs = stored(pairs, "candidates")  # read three times below
    dealt = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("parts")), "a") \
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    members = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", F.lit(1).alias("role"), "b", "members")
    centres = dealt.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a") \
        .select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("b"), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, at = None, None
        for batch in batches:
            left, right = [], []
            for a, role, b, members in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                values = np.frombuffer(members, dtype=np.int64)
                if role == 0:
                    centre, at = values, a
                    continue
                if a != at:
                    raise ValueError("a member came without its centre")
                # both are sorted and distinct: look the shorter one up in the longer
                x, y = (values, centre) if len(values) <= len(centre) else (centre, values)
                where = np.searchsorted(y, x)
                common = int((y[np.minimum(where, len(y) - 1)] == x).sum())
                if DENOM * common >= NUMER * (len(x) + len(y) - common):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return (members.unionByName(centres).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
            .mapInArrow(run, "a long, b long").distinct())


def first_shingles(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(value, node, n, component, place): for ``nodes`` (node, n, component) the leading shingles of their full sets, ordered by
    frequency among these sets, that another of them has too; ``place`` counts from 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(members, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node)), pa.array(values)], names=["node", "value"])

    wanted = sets.join(nodes.select("node"), "node").groupBy("node").agg(F.first("members").alias("members"))
    full = stored(wanted.mapInArrow(run, "node long, value long"), "mixed-sets")
    common = full.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = full.join(common, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    take = (F.col("n") - F.ceil(F.col("n") * NUMER / DENOM) + 1 - alone).cast("int")
    led = nodes.join(shared, "node").select("node", "n", "component", alone.alias("alone"), take.alias("take"), "shared").where("take > 0")
    return led.select("node", "n", "component", "alone", F.posexplode(F.slice("shared", F.lit(1), F.col("take"))).alias("i", "x")) \
        .select(F.col("x.value").alias("value"), "node", "n", "component", (F.col("alone") + F.col("i") + 1).alias("place"))


def _mixed(named: DataFrame) -> DataFrame:
    """The lists of ``named`` (value, node, component and more) that hold several components."""
    mixed = named.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("value")
    return named.join(mixed, "value")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b), for every node that has a link."""
    both = stored(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "links")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component"))
    labels = stored(labels, "labels")
    while True:
        of = labels.select(F.col("node").alias("other"), F.col("component").alias("near"))
        reached = both.join(of, "other").groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(reached, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = stored(step.join(jump, "component").select("node", "before", F.least("component", "further").alias("component")), "labels")
        labels = step.select("node", "component")
        if step.where(F.col("component") != F.col("before")).isEmpty():
            return labels


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    rows = stored(sketches(docs), "sketches")
    classes = stored(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "classes")
    posted = stored(postings(classes), "postings")
    found = None
    if not posted.isEmpty():
        wanted = posted.select("node").distinct().join(classes, "node").select(F.col("first_id").alias("doc_id")).where("doc_id is not null").distinct()
        sets = full_sets(keep_ids(docs.select("doc_id", "text"), wanted, "doc_id"))
        if not classes.where("first_id is null").isEmpty():
            sets = sets.unionByName(full_sets(docs.where("doc_id is null")))
        sets = stored(sets, "sets")
        centre = posted.groupBy("value").agg(F.max_by("node", F.struct("spread", "node")).alias("widest"), F.min("node").alias("least"))
        near = posted.join(centre, "value").select("node", F.explode(F.array("widest", "least")).alias("centre")).where("node <> centre").distinct()
        # a pair can come from both of its ends
        near = near.select(F.col("centre").alias("a"), F.col("node").alias("b"))
        first = stored(confirmed(_estimated(near, classes), sets), "first-links")
        label = components(first)
        named = posted.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = stored(_mixed(named), "mixed-lists")
        led = stored(_mixed(first_shingles(named.select("node", "n", "component").distinct(), sets)), "first-shingles")
        other = led.select("value", *(F.col(c).alias(f"o_{c}") for c in ("node", "n", "component", "place")))
        needed = F.ceil((F.col("n") + F.col("o_n")) * NUMER / (NUMER + DENOM))
        across = led.join(other, "value").where((F.col("node") < F.col("o_node")) & (F.col("component") != F.col("o_component"))
                                                & (F.col("n") - F.col("place") + 1 >= needed) & (F.col("o_n") - F.col("o_place") + 1 >= needed)) \
            .select(F.col("node").alias("a"), F.col("o_node").alias("b")).distinct()
        second = stored(confirmed(_estimated(across, classes), sets), "second-links")
        found = label if second.isEmpty() else components(first.unionByName(second))
    named = classes.select("node", "first_id", "copies")
    if found is not None:
        named = named.join(found, "node", "left")
    else:
        named = named.withColumn("component", F.lit(None).cast("long"))
    named = named.where((F.col("copies") > 1) | F.col("component").isNotNull()).withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id. Of rows that share an id and belong
    together as copies, one stays as well."""
    found = stored(groups(docs.select("doc_id", "text")), "groups")
    gone = found.where("not kept").select("doc_id").distinct()
    kept = keep_ids(docs, gone, "doc_id", "left_anti")
    again = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = Window.partitionBy("doc_id", "text").orderBy(F.lit(1))
    repeated = keep_ids(kept, again, "doc_id").withColumn("__row", F.row_number().over(once)).where("__row = 1").drop("__row")
    return keep_ids(kept, again, "doc_id", "left_anti").unionByName(repeated)
