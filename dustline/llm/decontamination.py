"""Benchmark decontamination by pigeonhole edit matching (operator 7).

A document leaks an item when some part of it is within ``budget = floor(EDITS * length)`` edits of
the whole item, both normalised (lower case, runs of blanks and ASCII punctuation as one blank).
If so, one of budget + 1 pieces of the item occurs unchanged. One Aho-Corasick automaton finds all
pieces of all items in a single pass over a text; windows around the hits are verified by
bit-parallel edit distance (one integer as wide as the item, a few operations per character).
Before, a window must hold as many of the item's GRAM-character strings as that many edits leave
intact (each edit spoils at most GRAM of them); this cannot drop a match.

Items go to the tasks in blocks of at most ``BLOCK_CHARS`` characters, so what is sent has a fixed
bound; a benchmark larger than a block costs one pass over the documents per block. Documents
never move: every block is one narrow job, safe to rerun on any executor.

An item under ``LEAST_CHARS`` normalised characters could occur inside other words by chance, so it is
searched with the blanks around it: as whole words, by the same automaton and budget.

Edge cases: null or empty documents and items match nothing; repeated documents give repeated rows; repeated items give a row each; extra columns are
ignored, names may clash; a very long text is searched whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import chunks, stored, table, texts_of

EDITS = 0.08  # edits allowed per character of an item
LEAST_CHARS = 24
GRAM = 5
BLOCK_CHARS = 2_000_000

_BLANKS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def normal(text: str | bytes | None) -> str:
    """Lower case, with ASCII blanks, controls and punctuation as single blanks."""
    if not text:
        return ""
    text = text.decode("utf-8", "replace") if isinstance(text, bytes) else text
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_BLANKS).split()).decode("utf-8", "replace")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 pieces that cover the item, sizes as even as possible."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(item: str, text: str) -> tuple[int, int]:
    """(smallest edit distance of ``item`` to any substring of ``text``, end of the first such substring)."""
    m = len(item)
    if not m:
        return 0, 0
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus, minus = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int | None, str]], edits: float = EDITS):
        self.short = [len(item) < LEAST_CHARS for _, item in items]
        self.items = [(i, f" {item} " if short and item else item) for (i, item), short in zip(items, self.short)]
        self.budget = [int(len(item) * edits) for _, item in items]
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, item) in enumerate(self.items):
            for offset, piece in pieces(item, self.budget[k]) if item else ():
                owners[piece].append((k, offset))
        self.grams = [[item[i:i + GRAM] for i in range(len(item) - GRAM + 1)] for _, item in self.items]
        self.needed = [len(g) - GRAM * b for g, b in zip(self.grams, self.budget)]
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Parts of ``text`` that can hold an item, per item: disjoint, in order."""
        starts: dict[int, list[int]] = defaultdict(list)
        for last, (size, where) in self.automaton.iter(text):
            for k, offset in where:
                starts[k].append(last - size + 1 - offset)
        out: dict[int, list[list[int]]] = {}
        for k, found in starts.items():
            size, budget, spans, seen = len(self.items[k][1]), self.budget[k], [], None
            for s in sorted(set(found)):
                lo, hi = max(0, s - budget), min(len(text), s + size + budget)
                near = spans and seen is not None and s - seen <= budget
                if not near and self.needed[k] > 0:
                    have = {text[i:i + GRAM] for i in range(lo, hi - GRAM + 1)}
                    if sum(g in have for g in self.grams[k]) < self.needed[k]:
                        continue
                seen = s
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
            if spans:
                out[k] = spans
        return out

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item, distance, end in the normalised text) of every item found, its best place first in the text."""
        out, padded = [], f" {text} "
        if self.any and text:
            for k, spans in self.windows(padded).items():
                best = min(((*best_distance(self.items[k][1], padded[lo:hi]), lo) for lo, hi in spans), key=lambda x: x[0])
                if best[0] <= self.budget[k]:
                    out.append((k, best[0], min(len(text), max(0, best[1] + best[2] - 1 - self.short[k]))))
        return out


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        item = normal(row["text"])
        if not item:
            continue
        if block and size + len(item) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], item))
        size += len(item)
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, distance, budget, end_at) for every document and item that match."""
    schema = "doc_id long, item_id long, distance int, budget int, end_at long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    done, waiting = [], None
    for block in _blocks(items):
        if waiting is not None:
            done.append(stored(waiting, "leaks"))

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, edits)
            for batch in chunks(batches):
                found = []
                for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                    for k, distance, end in matcher.matches(normal(text)):
                        found.append((doc_id, block[k][0], distance, matcher.budget[k], end))
                cols = list(zip(*found)) if found else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "distance", "budget", "end_at"])

        waiting = texts.mapInArrow(run, schema)
    if waiting is None:
        return docs.sparkSession.createDataFrame([], schema)
    for part in done:
        waiting = waiting.unionByName(part)
    return waiting


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and its distance."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def without_leaks(docs: DataFrame, items: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged; one narrow pass per block of items."""
    for block in _blocks(items):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, edits)
            for batch in chunks(batches):
                yield batch.filter(pa.array([not matcher.matches(normal(t)) for t in texts_of(batch)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; the others stay as they are."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))
