"""Language-model scoring by a hashed maximum-entropy model (operator 3).

P(word | context) = P(class | context) * P(group | class, context) * P(word | group)

The word's hash gives its group (CLASSES classes of GROUPS groups each). The first two factors are
maximum-entropy models over hashed features: the previous word, the previous two, and skips over
one and two words; the second one's features are joined with the class. Their offsets come from
the counts of the whole corpus, so with no feature known the model is the unigram one. The last
factor is the smoothed relative frequency of the word within its group, one share being kept for
words never seen, so probabilities sum to one over the vocabulary.

* Counts: one pass over all texts, words counted in the tasks, then by one aggregation. The table
  grows with the corpus and stays on the cluster.
* Training: ROUNDS synchronous rounds, each over its own part of the training documents (by a hash of
  the id), so every document is learned from once. A shard is a group of input partitions; it takes
  gradient steps from the shared weights over its own texts, chunk by chunk, and gives the change of
  the rows it touched. Changes are averaged by blocks of rows on the executors, in a stream. Texts never
  move. The cost of a step depends on its batch alone, not on the table. The feature table goes with every task: it grows with the square root
  of the corpus (``feature_rows``) up to MOST_ROWS (67 MB); beyond that more contexts share a row.
* Scoring: one pass over all texts in sparse numpy batches. Counts of the most frequent words
  (at most HEAD_WORDS) go with the tasks; the other words of a document meet the count table in a
  join by word, and only their sums come back to the document.

Edge cases: null or empty texts are a single end token; ids may be null (never learned from) or
repeated, as rows are told apart by their own number; words unseen in training keep count 0;
without training documents every token scores alike; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from copy import copy
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import chunks, mix, remainder, segment_sums, stored, texts_of

CLASSES = GROUPS = 32
FEATURE_ROWS, MOST_ROWS = 1 << 14, 1 << 18  # of a table of weights: at least, at most
SHARDS, SHARD_TOKENS, ROUNDS = 12, 1 << 26, 3
BATCH, RATE, CELLS = 1_024, 0.3, 1 << 16
LOGIT = np.float32(60)
HEAD_WORDS = 100_000
FLUSH_WORDS = 200_000
MEMORY_WORDS = 150_000
SMOOTH = 0.1
END = b" "  # cannot be a word
BLOCK = 1 << 8  # rows of a block of weights


class Tokens:
    """Word ids and hashes of texts; remembers a bounded number of words."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.hashes, self.known, self.new = np.zeros(1 << 16, dtype=np.uint64), 0, []
        self.ids[END]

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all tokens in order, ends included; tokens of each text)."""
        rows, counts = [], np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            words = t.lower().split()
            words.append(END)
            counts[i] = len(words)
            rows.append(np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words)))
        self.new = []
        if len(self.ids) > self.known:
            self.new = [w for w, i in self.ids.items() if i >= self.known] if self.known else list(self.ids)
            if len(self.ids) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes[:self.known], np.zeros(2 * len(self.ids) - self.known, dtype=np.uint64)])
            # the same value as the SQL function xxhash64 of the word
            self.hashes[self.known:len(self.ids)] = [xxhash.xxh64_intdigest(w, 42) for w in self.new]
            self.known = len(self.ids)
        return (np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)), counts


def group_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(CLASSES * GROUPS)).astype(np.int64)


def features(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(tokens, 4) mixed hashes of the contexts: previous word, previous two, skip one, skip two."""
    n = len(hashes)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.arange(n) - starts
    before = []
    for back in (1, 2, 3):
        h = np.full(n, back, dtype=np.uint64)  # a mark of its own where the text begins
        h[back:] = np.where(at[back:] >= back, hashes[:-back] if n > back else hashes[:0], h[back:])
        before.append(h)
    one, two, three = before
    f = np.empty((n, 4), dtype=np.uint64)
    f[:, 0] = mix(one ^ np.uint64(0xA5A5))
    f[:, 1] = mix(mix(one) + two * np.uint64(0x9E3779B97F4A7C15))
    f[:, 2] = mix(two ^ np.uint64(0x5A5A00))
    f[:, 3] = mix(three ^ np.uint64(0x3C3C0000))
    return f


def feature_rows(tokens: float) -> int:
    """Rows of a table of weights for a corpus: the power of two at or above four times the root of its tokens, within bounds."""
    return min(MOST_ROWS, max(FEATURE_ROWS, 1 << int(np.ceil(np.log2(4 * np.sqrt(max(1.0, tokens)))))))


def _rows(f: np.ndarray, size: int, classes: np.ndarray | None = None) -> np.ndarray:
    if classes is not None:
        f = mix(f + (classes.astype(np.uint64) * np.uint64(0x165667B19E3779F9))[:, None])
    return (f & np.uint64(size - 1)).astype(np.int64)


def _weights(table: np.ndarray, rows: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logits, their exponentials) of each token: its offset and the weights of its features."""
    columns = np.ascontiguousarray(rows.T)
    z = table.take(columns[0], axis=0, mode="clip")  # rows are within the table; other modes check again
    part = np.empty_like(z)
    for column in columns[1:]:
        z += table.take(column, axis=0, mode="clip", out=part)
    z += offset
    np.minimum(z, LOGIT, out=z)  # exponentials of float32 stay finite
    return z, np.exp(z, out=part)


def _log_probability(table: np.ndarray, rows: np.ndarray, offset: np.ndarray, right: np.ndarray) -> np.ndarray:
    z, e = _weights(table, rows, offset)
    return z[np.arange(len(z)), right] - np.log(e.dot(np.ones(e.shape[1], dtype=e.dtype)))


class Model:
    """Weights (float32) of both levels and the corpus offsets."""

    def __init__(self, group_mass: np.ndarray):
        mass = group_mass.reshape(CLASSES, GROUPS)
        self.class_offset = np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32)
        self.group_offset = np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)
        self.tokens = mass.sum()
        self.size = feature_rows(self.tokens)
        self.tables = [np.zeros((self.size, n), dtype=np.float32) for n in (CLASSES, GROUPS)]

    def log10_group(self, f: np.ndarray, group: np.ndarray) -> np.ndarray:
        """log10 P(group | context) of each token."""
        out = np.empty(len(group))
        for i in range(0, len(group), BATCH):
            c, g = np.divmod(group[i:i + BATCH], GROUPS)
            part = f[i:i + BATCH]
            out[i:i + BATCH] = (_log_probability(self.tables[0], _rows(part, self.size), self.class_offset, c)
                                + _log_probability(self.tables[1], _rows(part[:, :2], self.size, c), self.group_offset[c], g))
        return out / np.log(10)

    def learn(self, f: np.ndarray, group: np.ndarray, rng: np.random.Generator) -> None:
        """One pass of gradient steps over shuffled batches."""
        order = rng.permutation(len(group))
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            c, g = np.divmod(group[pick], GROUPS)
            k, part = np.arange(len(pick)), f[pick]
            for table, rows, offset, right in ((self.tables[0], _rows(part, self.size), self.class_offset, c),
                                               (self.tables[1], _rows(part[:, :2], self.size, c), self.group_offset[c], g)):
                _, grad = _weights(table, rows, offset)
                grad /= grad.dot(np.ones(grad.shape[1], dtype=grad.dtype))[:, None]
                grad[k, right] -= 1
                _descend(table, rows, grad)


def _descend(table: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """Adds the step of each token to its feature rows. What n tokens of the batch share moves by their sum over the root of n, n being
    counted in CELLS cells, so nothing here is as long as the table."""
    cells = (rows & (CELLS - 1)).reshape(-1)
    scale = np.float32(-RATE) / np.sqrt(np.bincount(cells, minlength=CELLS)[cells]).astype(np.float32)
    change = grad[:, None, :] * scale.reshape(rows.shape)[:, :, None]
    at = rows[:, :, None] * table.shape[1] + np.arange(table.shape[1])
    np.add.at(table.reshape(-1), at.reshape(-1), change.reshape(-1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the rows of ``docs``; the end token is a word of one blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(have), pa.binary()).cast(pa.string()), pa.array(list(have.values()), pa.int64())], names=["word", "c"])
            have.clear()
            return batch

        for batch in chunks(batches):
            for t in texts_of(batch):
                have.update(t.lower().split())
                have[END] += 1
            if len(have) > FLUSH_WORDS:
                yield flush()
        yield flush()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_of(counts: DataFrame, most: int = HEAD_WORDS) -> dict[bytes, int]:
    """The most frequent words, as many whole count classes as fit into ``most``."""
    level = F.floor(F.log2("c") * 4).alias("level")
    left, least = most, None
    for r in counts.groupBy(level).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        if r["n"] > left:
            break
        left, least = left - r["n"], r["level"]
    if least is None:
        return {}
    return {r["word"].encode(): r["c"] for r in counts.where(F.floor(F.log2("c") * 4) >= least).collect()}


def _shard(model: Model, turn: int) -> callable:
    """Gradient steps of one shard from the shared weights; gives the change of every block of weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local, tokens, rng, seen = copy(model), Tokens(), np.random.default_rng(turn), False
        local.tables = [t.copy() for t in model.tables]
        for batch in chunks(batches):
            if len(tokens.ids) > MEMORY_WORDS:
                tokens.reset()
            ids, counts = tokens.read(texts_of(batch))
            h = tokens.hashes[ids]
            local.learn(features(h, counts), group_of(h), rng)
            seen = True
        for level, (new, old) in enumerate(zip(local.tables, model.tables) if seen else ()):
            touched = np.flatnonzero((new != old).any(axis=1))
            for rows in np.split(touched, np.flatnonzero(np.diff(touched // BLOCK)) + 1) if len(touched) else ():
                change = (new[rows] - old[rows]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([(level * model.size + int(rows[0])) // BLOCK], pa.int32()), pa.array([(rows % BLOCK).astype(np.uint8).tobytes()], pa.binary()),
                                                  pa.array([change.tobytes()], pa.binary())], names=["block", "rows", "change"])

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of the rows of each block over the shards that touched them; a task holds the sums of its blocks only."""
    sums: dict[int, np.ndarray] = {}
    times: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, rows, change in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block not in sums:
                sums[block], times[block] = np.zeros((BLOCK, GROUPS), dtype=np.float32), np.zeros(BLOCK, dtype=np.float32)
            at = np.frombuffer(rows, dtype=np.uint8)
            sums[block][at] += np.frombuffer(change, dtype=np.float16).reshape(len(at), -1)
            times[block][at] += 1
    means = [(sums[b] / np.maximum(times[b], 1)[:, None]).astype(np.float32).tobytes() for b in sums]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], names=["block", "change"])


def trained(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """``model`` with weights learned from every row of ``docs`` (doc_id, text), each in one of the rounds. The driver holds one table of
    weights, at most MOST_ROWS long."""
    shards = max(SHARDS, -(-int(model.tokens) // (rounds * SHARD_TOKENS)))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(rounds))
    for turn in range(rounds):
        texts = docs.where(part == turn).select(F.col("text").cast("string").alias("text")).coalesce(shards)
        got = texts.mapInArrow(_shard(model, turn), "block int, rows binary, change binary").repartition("block") \
            .mapInArrow(_mean, "block int, change binary").collect()
        tables = [t.copy() for t in model.tables]
        for r in got:
            level, at = divmod(r["block"] * BLOCK, model.size)
            tables[level][at:at + BLOCK] += np.frombuffer(r["change"], dtype=np.float32).reshape(BLOCK, -1)
        model.tables = tables
    return model


def scored(docs: DataFrame, head: dict[bytes, int], model: Model, group_mass: np.ndarray) -> DataFrame:
    """Per row of ``docs`` (row, doc_id, held_out, text): token counts, log sums of the frequent words, and its other words."""
    log_mass = np.log10(group_mass)
    kind = "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_logs double, model_logs double, tail array<struct<word:string,tf:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, names = Tokens(), []
        logs = np.zeros(0)
        for batch in chunks(batches):
            if len(tokens.ids) > MEMORY_WORDS:
                tokens.reset()
                names, logs = [], np.zeros(0)
            ids, n = tokens.read(texts_of(batch))
            names += tokens.new
            logs = np.concatenate([logs, [np.log10(head[w] + SMOOTH) if w in head else np.nan for w in tokens.new]])
            h = tokens.hashes[ids]
            group = group_of(h)
            value = logs[ids]
            tail = np.isnan(value)
            model_logs = segment_sums(model.log10_group(features(h, n), group) - log_mass[group], n)
            head_logs, head_known = segment_sums(np.where(tail, 0.0, value), n), segment_sums((~tail).astype(np.float64), n)
            doc = np.repeat(np.arange(len(n)), n)[tail]
            pairs, times = np.unique(doc * (len(names) + 1) + ids[tail], return_counts=True)
            owner, word = np.divmod(pairs, len(names) + 1)
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(n)))))
            words = pa.array([names[i] for i in word.tolist()], pa.binary()).cast(pa.string())
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([words, pa.array(times, pa.int32())], names=["word", "tf"]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(n), pa.array(head_known.astype(np.int64)), pa.array(head_logs),
                                              pa.array(model_logs), rare], names=["row", "doc_id", "held_out", "n_tokens", "head_known", "head_logs", "model_logs", "tail"])

    return docs.mapInArrow(run, kind)


def score(docs: DataFrame, learn) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, held_out) of each row; ``learn`` is the condition of training rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = rows.where(learn)
    counts = stored(word_counts(learned), "word-counts")
    by_group = counts.groupBy(F.pmod(F.xxhash64("word"), F.lit(CLASSES * GROUPS)).alias("g")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    n, v = sum(r["c"] for r in by_group), sum(r["v"] for r in by_group)
    group_mass = np.full(CLASSES * GROUPS, SMOOTH)
    for r in by_group:
        group_mass[r["g"]] += r["c"] + SMOOTH * r["v"]
    head = head_of(counts)
    model = trained(learned, Model(group_mass))
    held = ~F.coalesce(learn, F.lit(False)) & F.col("doc_id").isNotNull()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", held.alias("held_out"), "text")
    parts = stored(scored(numbered, head, model, group_mass), "scored")
    rare = parts.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.tf").alias("tf"))
    c = F.coalesce("c", F.lit(0))
    sums = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("tf") * F.log10(c + SMOOTH)).alias("logs"),
                                                                F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("known"))
    whole = parts.drop("tail").join(sums, "row", "left")
    logs = F.col("head_logs") + F.coalesce("logs", F.lit(0.0))
    return whole.select("doc_id", "held_out", F.col("n_tokens").cast("long").alias("n_tokens"), (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                        F.lit(n).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * float(np.log10(n + SMOOTH * (v + 1)))).alias("base_score"),
                        (logs + F.col("model_logs")).alias("score"))


def op3_language_model(spark, sf_dir: str) -> DataFrame:
    """Base and model scores of every document; rows whose id has remainder 0 modulo 10 are held out of all learning."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, remainder("doc_id", 10) != 0)
