"""Language identification by segmentation-marginalised unigrams (operator 8).

A fixed public vocabulary gives the pieces. Each language has a probability for every piece, and
the probability of a word is the sum over all its segmentations, found by a forward pass. A
document's likelihood is the product over its words (runs of letters, lower-cased); the highest
posterior under a uniform prior wins.

Piece probabilities are fitted by expectation maximisation on a bounded sample of labelled rows
(``FIT_ROWS`` per language in expectation). Expected counts are found by tasks on the executors;
only a table of vocabulary size times languages reaches the driver. Scoring is one narrow pass
over whole texts. Words seen by a task are remembered up to ``MEMORY_WORDS`` entries.

Edge cases: a null, empty or letterless text is ``und`` with score 0; without any labelled row
every text is ``und``; ties go to the language that sorts first; very long words are handled in
scaled arithmetic; repeated rows are scored independently; other columns are carried through, and
the added ones must not exist already in ``identify`` (the query selects only what it needs).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import chunks, remainder, segment_sums, stored, texts_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FIT_ROWS = 600  # labelled rows per language, in expectation
ROUNDS = 3
LONGEST = 8  # characters of a piece, its word mark included
MEMORY_WORDS = 120_000
UNKNOWN = 1e-8  # probability of a character outside the vocabulary
SMOOTHING = 0.05
WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BITS = 20


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Lower-case letter pieces of a sentencepiece model, shortest first, up to ``LONGEST`` characters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower()
        body = piece.removeprefix(MARK)
        if len(piece) <= LONGEST and (body.isalpha() or piece == MARK):
            found.add(piece)
    return sorted(found, key=lambda p: (len(p), p))


class Pieces:
    """Vectorised lookup of substrings in the vocabulary by a 64-bit rolling hash."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.keys = np.zeros(self.size + 1, dtype=np.uint64)
        for i, p in enumerate(pieces):
            h = np.zeros(1, dtype=np.uint64)
            for c in p:
                h = self.extend(h, np.array([ord(c)], dtype=np.uint64))
            self.keys[i] = h[0]
        self.tables = []
        left = np.arange(self.size)
        for m in _MULTIPLIERS:
            slots = np.full(1 << _BITS, self.size, dtype=np.int32)
            at = self.slot(self.keys[left], m)
            _, first = np.unique(at, return_index=True)
            slots[at[first]] = left[first]
            left = np.delete(left, first)
            self.tables.append((m, slots))
        self.rest = {int(self.keys[i]): int(i) for i in left}

    @staticmethod
    def extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (h ^ (c + np.uint64(0x51))) * np.uint64(0x100000001B3) + (h >> np.uint64(29))

    @staticmethod
    def slot(h: np.ndarray, m: int) -> np.ndarray:
        return ((h * np.uint64(m)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece index of each hash, ``size`` where there is none."""
        out = np.full(h.shape, self.size, dtype=np.int32)
        for m, slots in self.tables:
            got = slots[self.slot(h, m)]
            out = np.where((self.keys[got] == h) & (got < self.size), got, out)
        for key, i in self.rest.items():
            out[h == np.uint64(key)] = i
        return out

    def spans(self, codes: np.ndarray) -> list[list[np.ndarray]]:
        """For words of equal length: ``[end][length - 1]`` gives the piece index of the span of each word."""
        n = codes.shape[1]
        found: list[list[np.ndarray]] = [[None] * min(e, LONGEST) for e in range(n + 1)]
        for start in range(n):
            h = np.zeros(len(codes), dtype=np.uint64)
            for length in range(1, min(LONGEST, n - start) + 1):
                h = self.extend(h, codes[:, start + length - 1])
                found[start + length][length - 1] = self.find(h)
        return found


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points) of words of equal length, with the word mark in front."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        step = max(1, 2_000_000 // int(n) // LONGEST)
        for i in range(0, len(at), step):
            part = at[i:i + step]
            joined = MARK + MARK.join(words[j] for j in part)
            yield part, np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).reshape(len(part), n + 1).astype(np.uint64)


def forward(spans: list[list[np.ndarray]], probs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Forward values at every end (each divided by its own scale) and the logarithm of the words' probabilities.

    The last LONGEST ends share one running scale, so words of any length stay in range.
    """
    n, m, langs = len(spans) - 1, len(spans[-1][0]), probs.shape[1]
    alpha = [np.ones((m, langs))]
    scale = np.zeros((m, langs))
    for end in range(1, n + 1):
        total = np.zeros((m, langs))
        for length, ids in enumerate(spans[end], 1):
            p = probs[ids]
            if length == 1:
                p = np.where((ids == len(probs) - 1)[:, None], UNKNOWN, p)
            total += alpha[end - length] * p
        alpha.append(total)
        if n > 40 and end % LONGEST == 0:
            top = np.maximum(total, 1e-300)
            for back in range(max(0, end - LONGEST), end + 1):
                alpha[back] = alpha[back] / top
            scale += np.log(top)
    return alpha, scale + np.log(np.maximum(alpha[n], 1e-300))


class Scorer:
    """Log probability of words under every language; remembers a bounded number of words."""

    def __init__(self, pieces: Pieces, probs: np.ndarray):
        self.pieces, self.probs = pieces, np.vstack([probs, np.zeros((1, probs.shape[1]))])
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = defaultdict(count().__next__)
        self.scores = np.zeros((1024, self.probs.shape[1]))
        self.known = 0

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(summed log probabilities, number of words) of each text."""
        if len(self.ids) > MEMORY_WORDS:
            self._reset()
        rows, counts = [], np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            words = WORD.findall(t.lower())
            counts[i] = len(words)
            rows.append(np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words)))
        if len(self.ids) > self.known:
            new = list(self.ids)[self.known:] if self.known == 0 else [w for w, i in self.ids.items() if i >= self.known]
            got = np.zeros((len(new), self.probs.shape[1]))
            for at, codes in _by_length(new):
                got[at] = forward(self.pieces.spans(codes), self.probs)[1]
            if len(self.ids) > len(self.scores):
                grown = np.zeros((max(len(self.ids), 2 * len(self.scores)), self.probs.shape[1]))
                grown[:self.known] = self.scores[:self.known]
                self.scores = grown
            self.scores[self.known:len(self.ids)] = got
            self.known = len(self.ids)
        flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        return segment_sums(self.scores[flat], counts), counts


def expected_counts(pieces: Pieces, probs: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in one language's words (probabilities: one column)."""
    probs = np.vstack([probs, np.zeros((1, 1))])
    out = np.zeros(len(probs))
    for at, codes in _by_length(words):
        spans = pieces.spans(codes)
        n, m = len(spans) - 1, len(at)
        prob = [[np.where((ids == len(probs) - 1) & (k == 0), UNKNOWN, probs[ids, 0]) for k, ids in enumerate(s)] for s in spans]
        alpha, beta = [np.ones(m)], [None] * n + [np.ones(m)]
        for end in range(1, n + 1):
            alpha.append(sum(alpha[end - k - 1] * prob[end][k] for k in range(len(spans[end]))))
        for start in range(n - 1, -1, -1):
            beta[start] = sum(prob[start + k][k - 1] * beta[start + k] for k in range(1, min(LONGEST, n - start) + 1))
        share = weights[at] / np.maximum(alpha[n], 1e-300)
        for end in range(1, n + 1):
            for k, ids in enumerate(spans[end]):
                out += np.bincount(ids, alpha[end - k - 1] * prob[end][k] * beta[end] * share, minlength=len(probs))
    return out[:-1]


def fit(docs: DataFrame, vocabulary_path: str = VOCABULARY, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> dict:
    """Model of the languages in ``lang``, learned from rows of ``docs`` (doc_id, text, lang) that the caller allows."""
    names = vocabulary(vocabulary_path)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return {"langs": [], "pieces": names, "probs": np.zeros((len(names), 0))}
    share = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(min(1.0, fit_rows / sizes[name])))])
    sample = stored(labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
                    .select("lang", "text").repartition(12), "language-sample")
    probs = np.full((len(names), len(langs)), 1.0 / len(names))
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], probs=probs) -> Iterator[pa.RecordBatch]:
            pieces, seen = Pieces(names), [defaultdict(int) for _ in langs]
            for batch in chunks(batches):
                for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                    have = seen[langs.index(lang)]
                    for w in WORD.findall(text.decode("utf-8", "replace").lower()):
                        for at in range(0, len(w), 40):  # learning only: longer runs of letters count as several words
                            have[w[at:at + 40]] += 1
            for k, have in enumerate(seen):
                if have:
                    got = expected_counts(pieces, probs[:, k:k + 1], list(have), np.array(list(have.values()), dtype=np.float64))
                    at = np.flatnonzero(got)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(got[at])],
                                                     names=["lang", "piece", "n"])

        rows = (sample.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))).toPandas()
        counts = np.full(probs.shape, SMOOTHING)
        counts[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
        probs = counts / counts.sum(axis=0)
    return {"langs": langs, "pieces": names, "probs": probs}


def identify(docs: DataFrame, model: dict, added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language (string) and its posterior (double) under the names of ``added``."""
    langs, names, probs = model["langs"], model["pieces"], model["probs"]
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Pieces(names), probs) if langs else None
        for batch in chunks(batches):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch)]
            lang, post = ["und"] * len(texts), np.zeros(len(texts))
            if langs:
                logs, words = scorer.documents(texts)
                best = logs.argmax(axis=1)
                p = np.exp(logs - logs.max(axis=1, keepdims=True))
                p = p.max(axis=1) / p.sum(axis=1)
                for i in np.flatnonzero(words):
                    if any(map(str.isalpha, texts[i])):
                        lang[i], post[i] = langs[best[i]], p[i]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(post)],
                                             names=[*batch.schema.names, *added])

    out = docs.schema
    for name, kind in zip(added, ("string", "double")):
        if name in docs.columns:
            raise ValueError(f"column {name} exists already; select or rename first")
        out = type(out)(list(out.fields)).add(name, kind)
    return docs.mapInArrow(score, out)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document; rows whose id has remainder 2 modulo 4 are never learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


MIN_SCORE = 0.5


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised language: those without letters, or whose best posterior is below ``MIN_SCORE``, go."""
    model = fit(docs.select("doc_id", "text", "lang"))
    scored = identify(docs, model, ("__language", "__posterior"))
    return scored.where((F.col("__language") != "und") & (F.col("__posterior") >= MIN_SCORE)).select(*docs.columns)
