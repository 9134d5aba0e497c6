"""Divergence of the sources of a language by their term frequencies (operator 12).

Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. Every language keeps
the terms found in at least LEAST_DOCUMENTS of its documents. For a group (a source of a language,
or the whole language) a kept term has p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)),
all in integers.

Counting packs by length: terms of up to 8 bytes are one uint64 word, up to 16 bytes two words, both
radix-sorted by 16-bit digits and run-counted in numpy; longer terms go to buckets of their own
length class and are sorted by bytes. Documents enter a chunk ordered by group, and the sort is
stable, so a run of one term is already split into groups and documents; no term is hashed.

1. One pass over all texts: each task merges its run counts, and hands them on when MERGE_RUNS
   distinct (group, term) are held, so memory is bounded whatever the vocabulary.
2. Spark adds the counts by (lang, source, term): at most a row per task and key is shuffled, so a
   source with a third of all rows is no hot key. A second aggregation by (lang, term) gives the
   document counts and the kept terms.
3. Pairs: kept terms are dealt into blocks of BLOCK_TERMS and sources into blocks of BLOCK_SOURCES;
   a group is one pair of source blocks over one term block, a dense integer matrix of bounded
   size, and its partial sums are added. Terms without a count in a source have one value there,
   so only counts above zero are sent.
4. Single terms: a window with a rank limit, which Spark applies within each partition before the
   shuffle.

Edge cases: null text, lang or source count as empty strings; groups without terms are groups; a
language without kept terms gives pairs of value 0 and no terms; a language of one source has no
pairs; ties are ranked by the item's UTF-8 bytes; repeated rows count as documents of their own; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dustline.llm.common import chunks, stored, texts_of

LEAST_DOCUMENTS = 30
SCALE, PRIOR = 1_000_000_000, 5
TOP_TERMS = 50
SHORT, MIDDLE = 8, 16  # bytes in one word, in two
MERGE_RUNS = 1_000_000
LONG_BYTES = 32 << 20
BLOCK_TERMS, BLOCK_SOURCES = 1024, 128
WIDE = "decimal(38,0)"

# letters in lower case, all bytes of characters beyond ASCII, 0 for the rest
_LOWER = np.zeros(256, dtype=np.uint8)
_LOWER[128:] = np.arange(128, 256)
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = np.arange(97, 123)
#: masks[n] keeps the first n bytes of a big-endian word
_MASKS = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * n)) - 1) for n in range(9)], dtype=np.uint64)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by uint64 ``words``, the first the most significant: one counting pass for every 16-bit digit that varies."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]  # a radix sort on 16 bits
    return order


class Runs:
    """Sorted distinct (term, group) with occurrences and documents, for terms of one or of two words."""

    def __init__(self, words: int):
        self.words = words
        self.parts: list[tuple] = []
        self.held = 0

    def count(self, words: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> None:
        """Adds tokens, which come ordered by group and document."""
        if not len(group):
            return
        order = radix_order(words)
        words, group, doc = [w[order] for w in words], group[order], doc[order]
        new = np.ones(len(group), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        first_in_doc = new.copy()
        first_in_doc[1:] |= doc[1:] != doc[:-1]
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(group)))
        documents = np.add.reduceat(first_in_doc.astype(np.int64), starts)
        self.parts.append(([w[starts] for w in words], group[starts], counts, documents))
        self.held += len(starts)

    def merge(self) -> None:
        if len(self.parts) < 2:
            return
        words = [np.concatenate([p[0][i] for p in self.parts]) for i in range(self.words)]
        group, counts, documents = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 3))
        keys = [*words, group.astype(np.uint64)]
        order = radix_order(keys)
        new = np.ones(len(order), dtype=bool)
        new[1:] = False
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        starts = np.flatnonzero(new)
        pick = order[starts]
        self.parts = [([w[pick] for w in words], group[pick], np.add.reduceat(counts[order], starts), np.add.reduceat(documents[order], starts))]
        self.held = len(starts)

    def take(self) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray] | None:
        """All runs, the terms unpacked; nothing is held afterwards."""
        self.merge()
        if not self.parts:
            return None
        (words, group, counts, documents), = self.parts
        self.parts, self.held = [], 0
        packed = np.stack(words, axis=1).astype(">u8").view(f"S{8 * self.words}").reshape(-1)
        return packed.tolist(), group, counts, documents


class LongRuns:
    """The same for terms above MIDDLE bytes: a bucket for each length class, sorted by bytes."""

    def __init__(self):
        self.tokens: dict[int, list] = {}
        self.parts: dict[int, tuple] = {}
        self.held = self.waiting = 0

    def count(self, terms: list[bytes], group: np.ndarray, doc: np.ndarray) -> None:
        for term, g, d in zip(terms, group.tolist(), doc.tolist()):
            self.tokens.setdefault(len(term).bit_length(), []).append((term, g, d))
        self.waiting += sum(map(len, terms)) + 64 * len(terms)

    def merge(self) -> None:
        for bucket, tokens in self.tokens.items():
            runs = dict(self.parts.get(bucket, ()))
            tokens.sort()
            last = None
            for token in tokens:
                key = token[:2]
                counts, documents = runs.get(key, (0, 0))
                runs[key] = counts + 1, documents + (token != last)
                last = token
            self.parts[bucket] = tuple(runs.items())
        self.tokens, self.waiting = {}, 0
        self.held = sum(len(k[0]) + 64 for runs in self.parts.values() for k, _ in runs)

    def take(self):
        self.merge()
        runs = [r for bucket in sorted(self.parts) for r in self.parts[bucket]]
        self.parts, self.held = {}, 0
        if not runs:
            return None
        return ([k[0] for k, _ in runs], np.array([k[1] for k, _ in runs], dtype=np.int64),
                np.array([v[0] for _, v in runs], dtype=np.int64), np.array([v[1] for _, v in runs], dtype=np.int64))


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the terms in bytes already mapped by ``_LOWER``."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = data != 0
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    return starts, np.flatnonzero(edge == -1) - starts


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Big-endian words of the bytes from ``starts``, of which the first ``lengths`` (at most 8) count. ``data`` ends with 8 spare bytes."""
    word = np.zeros(len(starts), dtype=np.uint64)
    for i in range(min(8, int(lengths.max(initial=0)))):
        word |= data[starts + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    return word & _MASKS[lengths]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, c, d): occurrences and documents of each term in each group."""
    kind = "lang string, source string, term string, c long, d long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, int] = {}
        names: list[tuple] = []
        one, two, many = Runs(1), Runs(2), LongRuns()
        seen = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for runs in (one, two, many):
                got = runs.take()
                if got is None:
                    continue
                terms, group, counts, documents = got
                lang, source = pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string())
                at = pa.array(group.astype(np.int64))
                yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), pa.array(terms, pa.binary()).cast(pa.string()),
                                                  pa.array(counts.astype(np.int64)), pa.array(documents.astype(np.int64))], names=["lang", "source", "term", "c", "d"])
            groups.clear()
            names.clear()

        for batch in chunks(batches):
            number = np.empty(batch.num_rows, dtype=np.int64)
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                number[i] = groups.setdefault(key, len(groups))
                if number[i] == len(names):
                    names.append(key)
            texts = texts_of(batch)
            order = np.argsort(number, kind="stable")
            # one blank between texts keeps their terms apart
            joined = b" ".join([texts[i] for i in order.tolist()]) + b" " * 9
            ends = np.cumsum(np.array([len(texts[i]) + 1 for i in order.tolist()], dtype=np.int64))
            data = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
            starts, lengths = spans(data)
            place = np.searchsorted(ends, starts, side="right")
            doc = place + seen
            group = number[order][place] if len(starts) else np.zeros(0, dtype=np.int64)
            seen += batch.num_rows
            short, middle, long = lengths <= SHORT, (lengths > SHORT) & (lengths <= MIDDLE), lengths > MIDDLE
            one.count([packed(data, starts[short], lengths[short])], group[short], doc[short])
            eight = np.full(int(middle.sum()), 8)
            two.count([packed(data, starts[middle], eight), packed(data, starts[middle] + 8, lengths[middle] - 8)], group[middle], doc[middle])
            if long.any():
                raw = data.tobytes()
                many.count([raw[a:a + n] for a, n in zip(starts[long].tolist(), lengths[long].tolist())], group[long], doc[long])
            full = False
            for runs in (one, two):
                if runs.held > 2 * MERGE_RUNS:
                    runs.merge()
                    full |= runs.held > MERGE_RUNS
            if many.waiting > LONG_BYTES // 8:
                many.merge()
                full |= many.held > LONG_BYTES
            if full:  # equal keys meet again in the aggregation
                yield from flush()
        yield from flush()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*group_columns(), text.alias("text")).mapInArrow(run, kind)
    return rows.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def group_columns() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers of any size needed."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = (wide(count) + F.lit(PRIOR)) * F.lit(SCALE).cast("decimal(10,0)")
    below = wide(total) + wide(terms) * F.lit(PRIOR)
    return F.call_function("div", above.cast(WIDE), below.cast(WIDE)) + F.lit(1)


def kept_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, terms, groups): (lang, source, term, c) of kept terms; (lang, term, lang_c); one row per group with its totals
    (lang, source, number, group_n, lang_n, v)."""
    counted = stored(term_counts(docs), "audit-counts")
    terms = stored(counted.groupBy("lang", "term").agg(F.sum("c").alias("lang_c"), F.sum("d").alias("d")).where(F.col("d") >= least).drop("d"), "audit-terms")
    counts = stored(counted.join(terms.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "c"), "audit-kept")
    by_lang = terms.groupBy("lang").agg(F.sum("lang_c").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    by_group = counts.groupBy("lang", "source").agg(F.sum("c").alias("group_n"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number")  # over groups, not rows
    groups = docs.select(*group_columns()).distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return counts, terms, stored(groups.select("lang", "source", number, zero("group_n"), zero("lang_n"), zero("v")), "audit-groups")


def _distances(size: int, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of one pair of source blocks over one term block. Rows without a term give a source's value of absent terms; ``size``
    sources are a block."""
    lang, low, high = key[0], int(key[1]), int(key[2])
    base = rows[rows["term"].isna()].sort_values("number")
    numbers = base["number"].to_numpy()
    where = np.searchsorted(numbers, rows["number"].to_numpy())
    real = rows["term"].notna().to_numpy()
    codes, seen = pd.factorize(rows["term"][real])
    absent = base["p"].to_numpy(dtype=np.int64)
    width = int(base["block_terms"].iloc[0])
    matrix = np.repeat(absent[:, None], max(len(seen), 1), axis=1)
    matrix[where[real], codes] = rows["p"].to_numpy(dtype=np.int64)[real]
    rest = width - len(seen)  # kept terms of the block that none of these sources has
    left = np.flatnonzero(numbers // size == low)
    right = np.flatnonzero(numbers // size == high)
    a, b, value = [], [], []
    for i in left.tolist():
        others = right[right > i] if low == high else right
        if not len(others):
            continue
        total = np.abs(matrix[others] - matrix[i]).sum(axis=1) if len(seen) else np.zeros(len(others), dtype=np.int64)
        a += [int(numbers[i])] * len(others)
        b += numbers[others].tolist()
        value += (total + rest * np.abs(absent[others] - absent[i])).tolist()
    return pd.DataFrame({"lang": np.array([lang] * len(a), dtype=object), "a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64), "value": np.array(value, dtype=np.int64)})


def pair_sums(counts: DataFrame, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for the numbers a < b of two sources of a language that keeps terms."""
    size = BLOCK_SOURCES
    blocks = F.ceil(F.col("v") / BLOCK_TERMS)
    block = F.pmod(F.xxhash64("term"), blocks).alias("block")
    by_lang = groups.select("lang", "v", (F.max("number").over(Window.partitionBy("lang")) / BLOCK_SOURCES).cast("int").alias("last")).distinct().where("v > 0")
    widths = terms.join(by_lang, "lang").groupBy("lang", "last", block).agg(F.count(F.lit(1)).alias("block_terms"))
    part = (F.col("number") / BLOCK_SOURCES).cast("int")
    # each source block meets every other one, and itself
    low_high = F.explode(F.expr(f"transform(sequence(0, last), o -> struct(least(o, cast(number / {BLOCK_SOURCES} as int)) as low, "
                                f"greatest(o, cast(number / {BLOCK_SOURCES} as int)) as high))")).alias("pair")
    p = share(F.col("c"), F.col("group_n"), F.col("v"))
    present = counts.join(groups, ["lang", "source"]).join(by_lang.select("lang", "last"), "lang") \
        .select("lang", "last", "number", block, "term", p.alias("p"), F.lit(None).cast("long").alias("block_terms"))
    absent = groups.where("v > 0").join(widths, "lang").select(
        "lang", "last", "number", "block", F.lit(None).cast("string").alias("term"), share(F.lit(0), F.col("group_n"), F.col("v")).alias("p"), "block_terms")
    dealt = present.unionByName(absent).withColumn("part", part).select("lang", low_high, "block", "number", "term", "p", "block_terms") \
        .select("lang", "pair.low", "pair.high", "block", "number", "term", "p", "block_terms")
    return dealt.groupBy("lang", "low", "high", "block").applyInPandas(lambda key, part: _distances(size, key, part), "lang string, a long, b long, value long") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source)."""
    counts, terms, groups = kept_counts(docs, least)
    sums = stored(pair_sums(counts, terms, groups), "audit-pairs")
    name = groups.select("lang", "source", "number")
    both = sums.select("lang", F.col("a").alias("number"), F.col("b").alias("other"), "value") \
        .unionByName(sums.select("lang", F.col("b").alias("number"), F.col("a").alias("other"), "value"))
    # the pairs are the result itself, so meeting the sources of a language is its size and no more
    item = name.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    pairs = name.join(item, "lang").where("number <> other").join(both, ["lang", "number", "other"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    p, q = share(F.col("c"), F.col("group_n"), F.col("v")), share(F.col("lang_c"), F.col("lang_n"), F.col("v"))
    single = counts.where("c > 0").join(terms, ["lang", "term"]).join(groups, ["lang", "source"]).withColumn("value", p - q).where("value > 0") \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    single = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(single)


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language and the terms that mark each source."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
tokens AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
terms AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lc FROM tokens GROUP BY ALL HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(lc) AS ln FROM terms GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT g.lang, g.source, t.term, t.lc FROM groups g JOIN terms t USING (lang)),
counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM tokens SEMI JOIN terms USING (lang, term) GROUP BY ALL),
filled AS (SELECT lang, source, term, lc, coalesce(c, 0) AS c, sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS n FROM cells LEFT JOIN counts USING (lang, source, term)),
p AS (
  SELECT lang, source, term, c, 1 + CAST({SCALE} * (c + {PRIOR}) // (n + {PRIOR} * v) AS BIGINT) AS p, 1 + CAST({SCALE} * (lc + {PRIOR}) // (ln + {PRIOR} * v) AS BIGINT) AS q
  FROM filled JOIN langs USING (lang)),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) t ON t.lang = a.lang AND t.s = a.source AND t.o = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
