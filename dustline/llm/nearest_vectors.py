"""Approximate nearest neighbours by learned partitions (operator 2).

1. A bounded sample (``FIT_ROWS`` in expectation) gives an exact neighbour graph, which is cut into
   balanced parts: regions grow from spread seeds under a size limit, then vertices move to the
   part that holds most of their neighbours while there is room.
2. A softmax classifier learns the part from the vector.
3. Every row is filed under its most probable part. A query is routed to its most probable parts
   (``PROBED`` of them, more where these hold too few rows) and compared with all their rows.

Parts are cut into blocks of about BLOCK_ROWS rows by a hash of the id, and the queries of a part
into blocks of QUERY_ROWS, so a task holds one block of each, however many rows share one vector.
Within a block a matrix product preselects; scores are then summed component by component in a
fixed order in double precision, so equal vectors get equal scores and ties go to the smaller id.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows without an id or of another length than most; rows that repeat an id count once and
are never neighbours of each other; with few rows there is one part and the search is exact; no
queries or an empty table give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dustline.llm.common import stored, table

NEIGHBOURS = 5
EVERY = 50
FIT_ROWS = 6_000
PART_ROWS, MOST_PARTS = 500, 128
PROBED = 0.7  # share of the parts that a query visits
GRAPH = 10  # neighbours in the graph
BLOCK_ROWS, QUERY_ROWS = 4_000, 1_000


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, components as doubles."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int = GRAPH) -> np.ndarray:
    """Indices of the k nearest rows (cosine) of each unit row."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1000):
        s = x[at:at + 1000] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1000] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, x: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Part of each vertex; no part exceeds ``slack`` times the mean size."""
    n, rng = len(graph), np.random.default_rng(seed)
    room = int(np.ceil(n / parts * slack))
    links = [set(row.tolist()) for row in graph]
    for i, row in enumerate(graph):
        for j in row.tolist():
            links[j].add(i)
    seeds = [int(rng.integers(n))]
    near = x @ x[seeds[0]]
    for _ in range(parts - 1):  # spread: the vertex farthest from all seeds so far
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
        near[seeds] = np.inf
    part, size, fronts = np.full(n, -1), np.zeros(parts, dtype=np.int64), [[s] for s in seeds]
    while any(fronts):
        for p in range(parts):
            grown = []
            for i in fronts[p]:
                if part[i] < 0 and size[p] < room:
                    part[i] = p
                    size[p] += 1
                    grown += [j for j in sorted(links[i]) if part[j] < 0]
            fronts[p] = grown
    for i in np.flatnonzero(part < 0):  # vertices that no region with room reached
        p = int(size.argmin())
        part[i] = p
        size[p] += 1
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[list(links[i])], minlength=parts)
            votes[(size >= room) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < n / 200:
            break
    return part


def router(x: np.ndarray, part: np.ndarray, parts: int, rounds: int = 200, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of a softmax classifier from unit vectors to parts (full-batch Adam)."""
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    m, s = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    one = np.eye(parts)[part]
    for t in range(1, rounds + 1):
        z = x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - one) / len(x)
        for k, (param, g) in enumerate(((w, x.T @ d + 1e-5 * w), (b, d.sum(axis=0)))):
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            param -= rate * 4 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-9)
    return w, b


def fit(rows: DataFrame, total: int, part_rows: int = PART_ROWS, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray] | None:
    """Classifier of parts, or None where one part is enough."""
    parts = int(min(MOST_PARTS, -(-total // part_rows)))
    if parts < 2:
        return None
    # rows with equal vectors are sampled together, so a hot vector is one vertex
    sample = rows.withColumn("key", F.xxhash64("v")).where(F.pmod("key", F.lit(1 << 20)) < int((1 << 20) * min(1.0, fit_rows / total))) \
        .groupBy("key").agg(F.first("v").alias("v")).orderBy("key").limit(4 * fit_rows).toPandas()
    x = unit(np.array(sample["v"].tolist(), dtype=np.float64)) if len(sample) else np.zeros((0, 1))
    parts = min(parts, len(x) // (2 * GRAPH))
    if parts < 2:
        return None
    return router(x, balanced_parts(neighbour_graph(x), x, parts), parts)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _filed(model) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                w, b = model
                yield batch.assign(part=(unit(_matrix(batch["v"])) @ w + b).argmax(axis=1).astype(np.int32))
    return run


def _routed(model, sizes: np.ndarray, probed: int, enough: int) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            w, b = model
            order = np.argsort(-(unit(_matrix(batch["v"])) @ w + b), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            needed = np.maximum(probed, (held < enough).sum(axis=1) + 1)
            yield batch.assign(parts=[row[:n].astype(np.int32) for row, n in zip(order, needed)])
    return run


def exact_cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, summed component by component in order."""
    dot, a, b = (np.zeros(len(q)) for _ in range(3))
    for d in range(q.shape[1]):
        dot += q[:, d] * x[:, d]
        a += q[:, d] * q[:, d]
        b += x[:, d] * x[:, d]
    return dot / (np.sqrt(a) * np.sqrt(b))


def _best(k: int) -> callable:
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(queries) or not len(rows):
            return empty
        queries, rows = queries.drop_duplicates("vec_id"), rows.drop_duplicates("vec_id")
        x, ids = _matrix(rows["v"]), rows["vec_id"].to_numpy()
        ux, out = unit(x), []
        for at in range(0, len(queries), 200):
            part = queries.iloc[at:at + 200]
            q, qids = _matrix(part["v"]), part["vec_id"].to_numpy()
            s = unit(q) @ ux.T
            s[qids[:, None] == ids[None, :]] = -np.inf
            top = min(k, s.shape[1])
            floor = np.partition(s, s.shape[1] - top, axis=1)[:, s.shape[1] - top]
            i, j = np.nonzero((s >= floor[:, None] - 1e-9) & (s > -np.inf))
            if not len(i):
                continue
            found = pd.DataFrame({"query_id": qids[i], "vec_id": ids[j], "score": exact_cosine(q[i], x[j])})
            out.append(found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k))
        return pd.concat(out) if out else empty
    return run


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS,
            probed: float = PROBED, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row of ``queries``, itself left out."""
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    asked = usable(queries, id_col, vector_col)
    total = rows.count()
    model = fit(rows, total, part_rows)
    if model is None:
        filed, routed = rows.withColumn("part", F.lit(0)), asked.select("*", F.lit(0).alias("part"))
        sizes = {0: total}
    else:
        filed = stored(rows.mapInPandas(_filed(model), "vec_id long, v array<double>, part int"), "filed")
        sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}
        have = np.array([sizes.get(p, 0) for p in range(len(model[1]))])
        routed = asked.mapInPandas(_routed(model, have, max(1, int(np.ceil(probed * len(have)))), k + 1), "vec_id long, v array<double>, parts array<int>") \
            .select("vec_id", "v", F.explode("parts").alias("part"))
    routed = stored(routed, "routed")
    visits = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    number = lambda of, most: F.coalesce(F.element_at(F.create_map(*[F.lit(int(x)) for p, n in sorted(of.items()) for x in (p, -(-n // most))]), F.col("part")), F.lit(1)) \
        if of else F.lit(1)
    blocks, askers = number(sizes, BLOCK_ROWS), number(visits, QUERY_ROWS)
    block = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    filed = filed.select("vec_id", "v", "part", block(blocks).alias("block"), F.explode(F.sequence(F.lit(0), askers - 1)).alias("asker"))
    routed = routed.select("vec_id", "v", "part", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), block(askers).alias("asker"))
    key = ("part", "block", "asker")
    best = routed.groupBy(*key).cogroup(filed.groupBy(*key)).applyInPandas(lambda q, x: _best(k)(q, x), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest_vectors(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every row whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
