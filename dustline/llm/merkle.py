"""Merkle manifest of the documents, with proofs by pointer jumping (operator 13).

H is the lowercase hex SHA-256 of its inputs, concatenated. A row's leaf is H of doc_id, source,
lang, n_chars and text, each ``-`` if null, else its UTF-8 length in bytes, ``:`` and its value. The
leaves of a source, by doc_id, are hashed in runs of 16 (the last may be shorter) until one node
is left, the source's subroot; the subroots, by source, give the root in the same way.

1. Leaves are ranked within their source by ``numbered``: range partitions and prefix counts, so a
   source that holds a third of all rows is no task of its own.
2. Levels are built bottom-up. A node is a row (tree, level, idx) that holds the digests of its
   run; each level is a sixteenth of the one below, and only leaves are many.
3. Every node knows its parent and the siblings to its left and right. Self-joins of the node
   table on the ancestor reached so far double the distance and append that ancestor's segments,
   until every node has reached the root: the logarithm of the height in rounds. Leaves join
   their parent once at the end, so the long rows are as many as the nodes (a fifteenth).
4. A proof is folded from the leaf's digest through its segments, innermost first.

Texts are read once and never shuffled; every step is a DataFrame expression.

Edge cases: null sources and ids come first in their order; repeated ids are ordered by their
leaf, so only equal rows tie; null or empty fields have distinct encodings; the root of an empty
table does not exist, so there are no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.functions.ranking import numbered
from dustline.llm.common import remainder, stored

RUN = 16  # children of a node
TOP = -1  # tree of the subroots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
KEY = ("tree", "level", "idx")
SEGMENT = "struct<left:binary,right:binary>"


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(columns: dict[str, Column]) -> Column:
    """Digest of a row, its fields in the fixed order."""
    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return hashed(F.concat(*(field(columns[name]) for name in FIELDS)))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hex(b: Column) -> Column:
    return F.lower(F.hex(b))


def _digest_of(run: Column) -> Column:
    """Parent of a run of binary digests."""
    return F.unhex(hashed(F.array_join(F.transform(run, _hex), "")))


def _height(size: Column) -> Column:
    """Levels above ``size`` leaves until one node is left."""
    h, n = F.lit(0), F.lit(1).cast("long")
    for level in range(1, 16):
        h = F.when(size > n, level).otherwise(h)
        n = n * RUN
    return h


def levels(leaves: DataFrame) -> DataFrame:
    """All nodes above ``leaves`` (tree, idx, size, digest), as (tree, level, idx, size, height, run, digest).

    ``size`` counts the leaves of the tree. A tree of one leaf has that leaf, at level 0 and without a run, as its only node.
    """
    base = leaves.withColumn("height", _height(F.col("size")))
    lone = base.where("height = 0").select("tree", F.lit(0).alias("level"), "idx", "size", "height",
                                           F.lit(None).cast("array<binary>").alias("run"), "digest")
    found = [stored(lone, "merkle-lone")]
    below, level = base, 0
    while True:
        level += 1
        run = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
        up = below.where(F.col("height") >= level).withColumn("parent", F.floor(F.col("idx") / RUN).cast("long")) \
            .groupBy("tree", F.col("parent").alias("idx"), "size", "height").agg(run.alias("run"))
        up = stored(up.select("tree", F.lit(level).alias("level"), "idx", "size", "height", "run", _digest_of(F.col("run")).alias("digest")), f"merkle-{level}")
        if up.isEmpty():
            break
        found.append(up)
        below = up
    out = found[0]
    for up in found[1:]:
        out = out.unionByName(up)
    return out


def _segment(run: Column, pos: Column) -> Column:
    """Siblings left and right of place ``pos`` (from 0) of a run."""
    joined = lambda part: F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x))
    left = F.slice(run, F.lit(1), pos)
    right = F.slice(run, pos + 2, F.greatest(F.size(run) - pos - 1, F.lit(0)))
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def jumped(nodes: DataFrame) -> tuple[DataFrame, str | None]:
    """(every node with ``segments`` up to the root and its tree's ``subroot``, root in hex).

    ``nodes`` are those of all source trees; the tree of subroots is built here.
    """
    subroots = nodes.where("level = height").select("tree", "digest")
    order = stored(numbered(subroots, [], ["tree"], row="ordinal", size="trees"), "merkle-subroots")
    top = levels(order.select(F.lit(TOP).cast("long").alias("tree"), F.col("ordinal").alias("idx"), F.col("trees").alias("size"), "digest"))
    top = top.where("level > 0")
    # the parent of a subroot is the node over its place in the tree of subroots
    place = order.select("tree", F.lit(TOP).cast("long").alias("p_tree"), F.col("ordinal").alias("place"), (F.col("trees") > 1).alias("more"))
    inner = nodes.where("level < height").unionByName(top.where("level < height")).select(
        *KEY, "run", "digest", F.col("tree").alias("p_tree"), (F.col("level") + 1).alias("p_level"), F.col("idx").alias("place"), F.lit(None).cast("binary").alias("subroot"))
    ends = nodes.where("level = height").join(place, "tree").select(
        *KEY, "run", "digest", F.when(F.col("more"), F.col("p_tree")).alias("p_tree"), F.when(F.col("more"), 1).alias("p_level"),
        F.when(F.col("more"), F.col("place")).alias("place"), F.col("digest").alias("subroot"))
    crown = top.where("level = height").select(*KEY, "run", "digest", F.lit(None).cast("long").alias("p_tree"), F.lit(None).cast("int").alias("p_level"),
                                               F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("subroot"))
    linked = inner.unionByName(ends).unionByName(crown).withColumn("p_idx", F.floor(F.col("place") / RUN).cast("long"))
    linked = stored(linked, "merkle-links")
    head = linked.where("p_tree is null").select(_hex(F.col("digest")).alias("root")).head()
    if head is None:
        return linked.withColumn("segments", F.array().cast(f"array<{SEGMENT}>")), None
    # distance 1: the segment under the parent; the parent is the first ancestor reached
    run_of = linked.select(*(F.col(k).alias(f"p_{k}") for k in KEY), F.col("run").alias("p_run"))
    first = _segment(F.col("p_run"), (F.col("place") % RUN).cast("int"))
    reach = linked.join(run_of, [f"p_{k}" for k in KEY], "left").select(
        *KEY, "run", "subroot", F.col("p_tree").alias("a_tree"), F.col("p_level").alias("a_level"), F.col("p_idx").alias("a_idx"),
        F.when(F.col("p_tree").isNotNull(), F.array(first)).otherwise(F.array().cast(f"array<{SEGMENT}>")).alias("segments"))
    reach = stored(reach, "merkle-reach")
    while not reach.where("a_tree is not null").isEmpty():
        on = reach.select(*(F.col(k).alias(f"a_{k}") for k in KEY), F.col("a_tree").alias("n_tree"), F.col("a_level").alias("n_level"),
                          F.col("a_idx").alias("n_idx"), F.col("segments").alias("onward"), F.col("subroot").alias("a_subroot"))
        reach = stored(reach.join(on, [f"a_{k}" for k in KEY], "left").select(
            *KEY, "run", F.coalesce("subroot", "a_subroot").alias("subroot"), F.col("n_tree").alias("a_tree"), F.col("n_level").alias("a_level"),
            F.col("n_idx").alias("a_idx"), F.concat("segments", F.coalesce("onward", F.array().cast(f"array<{SEGMENT}>"))).alias("segments")), "merkle-reach")
    return reach, head["root"]


def folded(digest: Column, segments: Column) -> Column:
    """Root that a proof gives for a leaf (hex), segments from the leaf upwards."""
    return F.aggregate(segments, digest, lambda acc, s: hashed(F.concat(_hex(s["left"]), acc, _hex(s["right"]))))


def manifest(rows: DataFrame) -> DataFrame:
    """Leaf, subroot, root and segments of every row of ``rows`` (doc_id, source, leaf and more, which stays)."""
    ranked = numbered(rows, ["source"], ["doc_id", "leaf"], row="place", size="size", first="tree")
    ranked = stored(ranked, "merkle-leaves")
    nodes = levels(ranked.select("tree", F.col("place").alias("idx"), "size", F.unhex("leaf").alias("digest")))
    reach, root = jumped(nodes)
    lone = F.col("size") == 1
    keyed = ranked.withColumn("k_level", F.when(lone, 0).otherwise(1)).withColumn("k_idx", F.floor(F.col("place") / RUN).cast("long"))
    up = reach.select(F.col("tree").alias("k_tree"), F.col("level").alias("k_level"), F.col("idx").alias("k_idx"), "run", "subroot", F.col("segments").alias("onward"))
    own = F.when(lone, F.array().cast(f"array<{SEGMENT}>")).otherwise(F.array(_segment(F.col("run"), (F.col("place") % RUN).cast("int"))))
    joined = keyed.withColumn("k_tree", F.col("tree")).join(up, ["k_tree", "k_level", "k_idx"])
    return joined.select(*rows.columns, _hex(F.col("subroot")).alias("subroot"), F.lit(root).cast("string").alias("root"), F.concat(own, "onward").alias("segments"))


def proofs(docs: DataFrame, tampered) -> DataFrame:
    """Manifest of ``docs`` with the check of each proof; rows where ``tampered`` (a condition on doc_id) holds are checked with
    their text in lower case."""
    fields = {name: F.col(name) for name in FIELDS}
    changed = leaf_of({**fields, "text": ascii_lower(F.col("text").cast("string"))})
    rows = docs.select("doc_id", "source", leaf_of(fields).alias("leaf"), F.when(F.coalesce(tampered, F.lit(False)), changed).alias("changed"))
    out = manifest(rows)
    siblings = F.array_join(F.transform("segments", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    out = out.select("doc_id", "leaf", "subroot", "root", hashed(siblings).alias("proof_sha256"),
                     folded(F.coalesce("changed", "leaf"), F.col("segments")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Proof of every document; those whose crc32 is divisible by 5 are checked as tampered."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    return proofs(docs, remainder("doc_id", 5) == 0)


#: Leaves, levels within each source, levels over the subroots, then a walk from every leaf to the root.
SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, source, lang, n_chars, text, (
    SELECT list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, list_reduce([xor(c, b) & 255] || CAST(list_transform(range(8), lambda z: 0) AS BIGINT[]),
        lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))) AS crc FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 5 = 0
      THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM fields)),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT tree, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n),
subroots AS (SELECT tree, level, digest FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, CAST(tree AS BIGINT) AS idx, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 16, n),
lower AS (
  SELECT tree, level, idx // 16 AS parent, list(digest ORDER BY idx) AS run FROM nodes WHERE n > 1 GROUP BY ALL),
upper AS (SELECT level, idx // 16 AS parent, list(digest ORDER BY idx) AS run FROM tops WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, leaf, tree, 0 AS level, idx, shown AS acc, '' AS proof FROM ranked
  UNION ALL
  SELECT doc_id, leaf, tree, c.level + 1, idx // 16,
    sha256(array_to_string(run[:idx % 16], '') || acc || array_to_string(run[idx % 16 + 2:], '')),
    proof || array_to_string(run[:idx % 16], '') || array_to_string(run[idx % 16 + 2:], '')
  FROM climb c JOIN lower l USING (tree, level) WHERE l.parent = c.idx // 16),
arrived AS (SELECT c.*, s.digest AS subroot FROM climb c JOIN subroots s USING (tree, level)),
crown AS (
  SELECT doc_id, leaf, subroot, 0 AS level, CAST(tree AS BIGINT) AS idx, acc, proof FROM arrived
  UNION ALL
  SELECT doc_id, leaf, subroot, c.level + 1, idx // 16,
    sha256(array_to_string(run[:idx % 16], '') || acc || array_to_string(run[idx % 16 + 2:], '')),
    proof || array_to_string(run[:idx % 16], '') || array_to_string(run[idx % 16 + 2:], '')
  FROM crown c JOIN upper u USING (level) WHERE u.parent = c.idx // 16),
root AS (SELECT level, digest AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM crown JOIN root USING (level)
"""
