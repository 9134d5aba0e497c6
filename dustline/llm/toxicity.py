"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 6).

A step of the network is a word: its input joins a word vector (words of the fitting sample seen
in several documents), the mean of its hashed character n-gram vectors, and the largest log odds
among its n-grams, so unseen forms of a stem still have an input. Two gated recurrent passes read a window of WINDOW words, attention pools the steps, a
logistic unit scores the window. Windows overlap (STRIDE) and cover the whole text; a document has
the score of its worst window.

Training is in numpy on a bounded sample of labelled rows (``FIT_TOXIC`` and ``FIT_OTHER`` rows in
expectation) with back-propagation through time. Labels are of documents, so each round scores all
windows of the sample and learns from the worst window of each document (multiple instances);
word vectors start with the shrunken log odds of the word in one component. Half of the sample
learns with n-gram odds counted on the other half, as all other texts will meet them. The model (a few MB,
bounded by MOST_WORDS) goes to the tasks; scoring is one narrow pass in which all windows of a
chunk step together and input products are taken once per distinct word.

Edge cases: null, empty and wordless texts score 0; without labelled rows of both classes all
scores are 0; repeated rows are scored independently; null ids are never held out nor learned from;
labels, language, source and id are never inputs.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import chunks, remainder, table, texts_of

FIT_TOXIC, FIT_OTHER = 900, 1800
MOST_WORDS = 30_000  # words with a vector of their own
LEAST_DOCUMENTS = 10  # of the sample, for a word vector
WINDOW, STRIDE = 32, 24
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 12, 8, 8, 8
NGRAMS = (3, 5, 6, 7, 8)  # characters, word ends included
GRAM_VECTORS, GRAM_ODDS = 1 << 12, 1 << 20
ROUNDS, BATCH, RATE = 8, 128, 0.01
DROPPED = 0.5  # share of word vectors left out of a training step, so n-grams have to do
LEAST_STEPS = 240  # a small sample is gone through several times a round
MEMORY_WORDS = 120_000
WORD = re.compile(r"[^\W_]{1,40}")  # a longer run counts as several words


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, n-gram hashes as a matrix) of words of equal length."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        codes = np.frombuffer("".join(f"<{words[j]}>" for j in at).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(at), n + 2).astype(np.uint64)
        out = []
        for size in NGRAMS:
            size = min(size, n + 2)
            h = np.full((len(at), n + 3 - size), size, dtype=np.uint64)
            for j in range(size):
                h = (h ^ codes[:, j:n + 3 - size + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            out.append(h)
        yield at, np.hstack(out)


def gram_inputs(words: list[str], vectors: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Mean n-gram vector of each word, and the largest log odds of its n-grams."""
    out = np.zeros((len(words), vectors.shape[1] + 1), dtype=np.float32)
    for at, h in grams(words):
        for i in range(0, len(at), 4096):
            part = h[i:i + 4096]
            out[at[i:i + 4096], :-1] = vectors[(part % np.uint64(GRAM_VECTORS)).astype(np.int64)].mean(axis=1)
            out[at[i:i + 4096], -1] = odds[(part % np.uint64(GRAM_ODDS)).astype(np.int64)].max(axis=1)
    return out


def log_odds(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """Shrunken log odds of features found in so many toxic and other documents, halved."""
    ratio = 5 * n_good / n_bad
    return ((np.log((bad + 5) / (n_bad + 5)) - np.log((good + ratio) / (n_good + ratio))).clip(-4, 4) / 2).astype(np.float32)


def window_starts(n: int) -> range:
    """Starts of the windows over ``n`` words; the last one may be short."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else range(0)


class Network:
    """Parameters, forward pass and gradients; all arrays float32."""

    def __init__(self, words: dict[str, int], odds: np.ndarray, gram_odds: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.words, self.gram_odds = words, gram_odds
        small = lambda *shape, s=0.1: (rng.standard_normal(shape) * s).astype(np.float32)
        x = WORD_DIM + CHAR_DIM + 1
        self.p = {"E": small(len(words) + 1, WORD_DIM), "C": small(GRAM_VECTORS, CHAR_DIM), "Wa": small(2 * HIDDEN, ATTENTION, s=0.3),
                  "va": small(ATTENTION, s=0.3), "wo": small(2 * HIDDEN, s=0.3), "bo": np.zeros(1, dtype=np.float32)}
        self.p["E"][:len(words), 0] = odds
        self.p["E"][-1] = 0  # a word without a vector
        for d in "fb":
            self.p |= {f"W{d}": small(x, 3 * HIDDEN, s=0.3), f"U{d}": small(HIDDEN, 3 * HIDDEN, s=0.3), f"b{d}": np.zeros(3 * HIDDEN, dtype=np.float32)}

    def inputs(self, words: list[str]) -> np.ndarray:
        known = np.fromiter((self.words.get(w, len(self.p["E"]) - 1) for w in words), dtype=np.int64, count=len(words))
        return np.hstack([self.p["E"][known], gram_inputs(words, self.p["C"], self.gram_odds)])

    def projected(self, words: list[str]) -> np.ndarray:
        """Input products of both directions, a row per word and one of zeros at the end for padding."""
        x = self.inputs(words)
        out = np.zeros((len(words) + 1, 6 * HIDDEN), dtype=np.float32)
        out[:-1, :3 * HIDDEN] = x @ self.p["Wf"] + self.p["bf"]
        out[:-1, 3 * HIDDEN:] = x @ self.p["Wb"] + self.p["bb"]
        return out

    def _pass(self, x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (steps, rows, HIDDEN) of one direction; x (steps, rows, 3 HIDDEN), mask (steps, rows, 1)."""
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        out = np.empty((len(x), x.shape[1], HIDDEN), dtype=np.float32)
        for t in range(len(x)):
            a = h @ u
            zr = 1 / (1 + np.exp(-(x[t, :, :2 * HIDDEN] + a[:, :2 * HIDDEN])))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN:] + r * a[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if keep is not None:
                keep.append((h, a, z, r, n))
            h = h + mask[t] * (new - h)
            out[t] = h
        return out

    def forward(self, ids: np.ndarray, rows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``ids`` (windows, WINDOW) index ``rows`` of projected(), the last one padding."""
        pad = len(rows) - 1
        steps = int((ids != pad).sum(axis=1).max(initial=1))
        at = np.ascontiguousarray(ids[:, :steps].T)
        mask = (at != pad)[:, :, None].astype(np.float32)
        x = rows[at]
        kept = ([], []) if keep is not None else (None, None)
        f = self._pass(x[:, :, :3 * HIDDEN], mask, self.p["Uf"], kept[0])
        b = self._pass(x[::-1, :, 3 * HIDDEN:], mask[::-1], self.p["Ub"], kept[1])[::-1]
        h = np.concatenate([f, b], axis=2)
        act = np.tanh(h @ self.p["Wa"])
        score = act @ self.p["va"] + (mask[:, :, 0] - 1) * 1e4
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        if keep is not None:
            keep.update(at=at, mask=mask, kept=kept, h=h, act=act, weight=weight, pooled=pooled)
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def gradients(self, ids: np.ndarray, words: list[str], rows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss."""
        k: dict = {}
        g = {}
        d = ((_sigmoid(self.forward(ids, rows, k)) - target) / len(ids)).astype(np.float32)
        g["wo"], g["bo"] = k["pooled"].T @ d, d.sum(keepdims=True)
        dpool = d[:, None] * self.p["wo"]
        dh = k["weight"][:, :, None] * dpool
        dw = (k["h"] * dpool).sum(axis=2)
        ds = k["weight"] * (dw - (k["weight"] * dw).sum(axis=0))
        g["va"] = np.einsum("tba,tb->a", k["act"], ds)
        dact = ds[:, :, None] * self.p["va"] * (1 - k["act"] ** 2)
        g["Wa"] = np.einsum("tbh,tba->ha", k["h"], dact)
        dh = dh + dact @ self.p["Wa"].T
        steps, size = k["at"].shape
        drows = np.zeros_like(rows)
        for name, part, kept, order in (("f", dh[:, :, :HIDDEN], k["kept"][0], range(steps)), ("b", dh[:, :, HIDDEN:], k["kept"][1], range(steps - 1, -1, -1))):
            u, du = self.p[f"U{name}"], np.zeros_like(self.p[f"U{name}"])
            back = np.zeros((size, HIDDEN), dtype=np.float32)
            cols = slice(0, 3 * HIDDEN) if name == "f" else slice(3 * HIDDEN, 6 * HIDDEN)
            for s in range(steps - 1, -1, -1):
                t = order[s]
                h, a, z, r, n = kept[s]
                total = part[t] + back
                dnew = total * k["mask"][t]
                dn = dnew * (1 - z) * (1 - n ** 2)
                dz = dnew * (h - n) * z * (1 - z)
                dr = dn * a[:, 2 * HIDDEN:] * r * (1 - r)
                da = np.hstack([dz, dr, dn * r])
                du += h.T @ da
                back = total * (1 - k["mask"][t]) + dnew * z + da @ u.T
                np.add.at(drows[:, cols], k["at"][t], np.hstack([dz, dr, dn]))
            g[f"U{name}"] = du
        drows = drows[:-1]
        x = self.inputs(words)
        dx = np.zeros_like(x)
        for name, cols in (("f", slice(0, 3 * HIDDEN)), ("b", slice(3 * HIDDEN, 6 * HIDDEN))):
            g[f"W{name}"], g[f"b{name}"] = x.T @ drows[:, cols], drows[:, cols].sum(axis=0)
            dx += drows[:, cols] @ self.p[f"W{name}"].T
        known = np.fromiter((self.words.get(w, len(self.p["E"]) - 1) for w in words), dtype=np.int64, count=len(words))
        g["E"], g["C"] = np.zeros_like(self.p["E"]), np.zeros_like(self.p["C"])
        np.add.at(g["E"], known, dx[:, :WORD_DIM])
        g["E"][-1] = 0
        for at, h in grams(words):
            ids_ = (h % np.uint64(GRAM_VECTORS)).astype(np.int64)
            np.add.at(g["C"], ids_.ravel(), np.repeat(dx[at, WORD_DIM:-1] / ids_.shape[1], ids_.shape[1], axis=0))
        return g


class Scorer:
    """Worst-window logits of texts; remembers the input products of a bounded number of words."""

    def __init__(self, net: Network, memory: float = MEMORY_WORDS):
        self.net, self.memory = net, memory
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = defaultdict(count().__next__)
        self.rows = np.zeros((1, 6 * HIDDEN), dtype=np.float32)

    def window_ids(self, words: list[str]) -> np.ndarray:
        """(windows, WINDOW) word ids, -1 for padding."""
        ids = np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))
        starts = np.fromiter(window_starts(len(words)), dtype=np.int64)
        at = starts[:, None] + np.arange(WINDOW)
        return np.where(at < len(ids), ids[np.minimum(at, max(len(ids) - 1, 0))], -1) if len(ids) else np.zeros((0, WINDOW), dtype=np.int64)

    def window_logits(self, ids: np.ndarray) -> np.ndarray:
        known = len(self.rows) - 1
        if len(self.ids) > known:
            new = [w for w, i in self.ids.items() if i >= known]
            self.rows = np.vstack([self.rows[:known], self.net.projected(new)])
        pad = len(self.rows) - 1
        ids = np.where(ids < 0, pad, ids)
        return np.concatenate([self.net.forward(ids[i:i + 1024], self.rows) for i in range(0, len(ids), 1024)]) if len(ids) else np.zeros(0)

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(worst logit, or nan without words; ids of that window) of each text."""
        if len(self.ids) > self.memory:
            self._reset()
        parts = [self.window_ids(WORD.findall(t.lower())) for t in texts]
        logits = self.window_logits(np.concatenate(parts)) if parts else np.zeros(0)
        worst, where, at = np.full(len(texts), np.nan), [], 0
        for i, part in enumerate(parts):
            if len(part):
                j = int(logits[at:at + len(part)].argmax())
                worst[i] = logits[at + j]
                where.append(part[j])
            else:
                where.append(None)
            at += len(part)
        return worst, where


def train(texts: list[str], toxic: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> Network | None:
    """Network learned from document labels, or None unless both classes are present."""
    toxic = np.asarray(toxic, dtype=np.float32)
    if not len(texts) or toxic.min() == toxic.max():
        return None
    bad, good = Counter(), Counter()
    words = [set(WORD.findall(t.lower())) for t in texts]
    for have, y in zip(words, toxic):
        (bad if y else good).update(have)
    n_bad, n_good = int(toxic.sum()), int(len(toxic) - toxic.sum())
    every = list(bad.keys() | good.keys())
    place = {w: i for i, w in enumerate(every)}
    hashed: list = [None] * len(every)
    for at, h in grams(every):
        for i, row in zip(at, (h % np.uint64(GRAM_ODDS)).astype(np.int32)):
            hashed[i] = row
    counted = np.zeros((2, 2, GRAM_ODDS), dtype=np.float32)  # half of the sample, toxic, n-gram
    half = np.zeros(len(texts), dtype=np.int64)
    for y in (0, 1):
        half[toxic == y] = np.arange(int((toxic == y).sum())) % 2
    for have, y, k in zip(words, toxic, half):
        if have:
            counted[k, int(y), np.unique(np.concatenate([hashed[place[w]] for w in have]))] += 1
    size = lambda k, y: max(1, int(((half == k) & (toxic == y)).sum()))
    crossed = [log_odds(counted[1 - k, 1], counted[1 - k, 0], size(1 - k, 1), size(1 - k, 0)) for k in (0, 1)]
    frequent = sorted((w for w in every if bad[w] + good[w] >= LEAST_DOCUMENTS), key=lambda w: (-bad[w] - good[w], w))[:MOST_WORDS]
    odds = log_odds(np.array([bad[w] for w in frequent], dtype=np.float64), np.array([good[w] for w in frequent], dtype=np.float64), n_bad, n_good)
    net = Network({w: i for i, w in enumerate(frequent)}, odds, log_odds(counted[:, 1].sum(axis=0), counted[:, 0].sum(axis=0), n_bad, n_good), seed)
    final_odds, all_words = net.gram_odds, net.words
    rng, moment, square, step = np.random.default_rng(seed), {}, {}, 0
    for _ in range(rounds):
        work = []
        for k in (0, 1):
            net.gram_odds = crossed[k]
            scorer, mine = Scorer(net, np.inf), np.flatnonzero(half == k)  # the sample is bounded
            got = [w for i in range(0, len(mine), 200) for w in scorer.documents([texts[j] for j in mine[i:i + 200]])[1]]
            names, full = list(scorer.ids), [i for i, w in enumerate(got) if w is not None]
            order = rng.permutation(full)
            work += [(k, names, [got[j] for j in order[i:i + BATCH]], toxic[mine[order[i:i + BATCH]]]) for i in range(0, len(order), BATCH)]
        work = [work[i] for i in rng.permutation(len(work))]
        for k, names, windows, target in work * max(1, -(-LEAST_STEPS // max(1, rounds * len(work)))):
            net.gram_odds = crossed[k]
            left = rng.random(len(all_words)) >= DROPPED
            net.words = {w: i for w, i in all_words.items() if left[i]}
            ids = np.stack(windows)
            used, local = np.unique(ids, return_inverse=True)
            local = local.reshape(ids.shape)
            if used[0] == -1:  # padding comes last
                used, local = used[1:], np.where(local == 0, len(used) - 1, local - 1)
            words = [names[j] for j in used]
            grads = net.gradients(local, words, net.projected(words), target)
            step += 1
            for key, g in grads.items():
                moment[key] = 0.9 * moment.get(key, 0) + 0.1 * g
                square[key] = 0.999 * square.get(key, 0) + 0.001 * g * g
                net.p[key] = (net.p[key] - RATE * (moment[key] / (1 - 0.9 ** step)) / (np.sqrt(square[key] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        net.words = all_words
    net.gram_odds = final_odds
    return net


def fit(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_other: int = FIT_OTHER) -> Network | None:
    """Network from a bounded sample of the labelled rows that the caller allows; the sample alone reaches the driver."""
    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and labelled_id is not null")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, fit_toxic / sizes[1])).otherwise(min(1.0, fit_other / sizes[0]))
    sample = known.where(F.pmod(F.xxhash64("labelled_id", F.lit("toxicity")), F.lit(1 << 20)) < share * (1 << 20))
    rows = docs.select(F.col("doc_id").alias("labelled_id"), "text").join(F.broadcast(sample), "labelled_id").where("text is not null") \
        .select("labelled_id", "text", "toxic").toPandas().sort_values(["labelled_id", "text"])
    return train(rows["text"].tolist(), rows["toxic"].to_numpy())


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with score (double, 0 to 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for batch in chunks(batches):
            out = np.zeros(batch.num_rows)
            if scorer:
                worst, _ = scorer.documents([t.decode("utf-8", "replace") for t in texts_of(batch)])
                full = ~np.isnan(worst)
                out[full] = _sigmoid(worst[full].astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "score"])

    if "score" in docs.columns:
        raise ValueError("column score exists already; select or rename first")
    return docs.mapInArrow(run, type(docs.schema)(list(docs.schema.fields)).add("score", "double"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose id has remainder 0 modulo 5 are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    rows = scored(docs.select("doc_id", held.alias("held_out"), "text"), net).drop("text")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
