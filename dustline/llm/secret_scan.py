"""Secrets by a battery of randomness tests (operator 5), in column expressions only.

Exact patterns give the base spans, which always stay. Any other long token that could be encoded
bytes is tested: its encoding is inferred (hexadecimal, base 32, base 36 in one case, base
64 with or without digits), and
in that alphabet

* a chi-squared statistic tests whether all symbols are equally frequent,
* a runs test whether the lower and upper half of the alphabet alternate as by chance,
* a serial correlation whether a symbol depends on the one before.

The three p-values are combined by Fisher's method. For a random token the result is uniform on
[0, 1]; ordinary tokens crowd near 0. False discoveries are controlled per encoding and class of
length, since short tokens cannot fail a test as clearly as long ones: tokens above 0.5 tell how
many are random, and the threshold is the lowest at which the surplus of tokens above it, over
what that many random ones would give, stays within ``FALSE`` of them. These counts cover all
tokens of all documents and reach the driver as a table of fixed size.

Edge cases: a null text is empty; ids may be null or repeated, as nothing is joined; without
candidates only base spans are returned; other columns are ignored; patterns are possessive or
behind a look-behind, so long texts take linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import stored
from dustline.llm.spans import labelled, let, located

KINDS = ("assign", "access", "hex", "random")
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+"  # '=' only pads, so a value after NAME= is a token of its own

#: (name, pattern of the token, alphabet); the first that fits counts.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{24,}$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]{24,}$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]{20,}$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("BASE36", r"^(?=.*[0-9].*[0-9])(?=.*[A-Z])[A-Z0-9]{20,}$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])[a-z0-9]{20,}$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]{20,}$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("letters", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z+/]{20,}$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"),
)
FALSE = 0.1  # share of false discoveries allowed above a threshold
BINS = 20
LEAST_P = 1e-3  # a token below it is never called random, whatever the counts


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the base spans, by start, then kind."""
    def kept(kind: int, pattern: str, hint: Column | None, valid) -> Column:
        good = F.filter(located(text, pattern, hint), lambda s: valid(s["match"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    return F.array_sort(F.concat(
        kept(0, ASSIGN, None, lambda m: F.char_length(F.regexp_replace(m, "^" + ASSIGN_HEAD, "")) >= 6),
        kept(1, ACCESS, F.contains(text, F.lit("AKIA")), lambda m: F.char_length(m) >= 20),
        kept(2, HEX, None, lambda m: F.lit(True))))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, within 2e-4."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.070565992) * z * z * z, F.lit(500.0))))


def _combined(body: Column, alphabet: str) -> Column:
    """Fisher's combination of the three tests on a token over ``alphabet``."""
    k = float(len(alphabet))
    mean, var = (k - 1) / 2, (k * k - 1) / 12

    def tests(x: Column) -> Column:
        n = F.size(x).cast("double")
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda s, v: s + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
        chi = (squares * k / n - n - (k - 1)) / F.sqrt(F.lit(2 * (k - 1)) * (F.lit(1.0) - F.lit(1.0) / n))
        pairs = F.arrays_zip(F.slice(x, F.lit(1), F.size(x) - 1).alias("a"), F.slice(x, F.lit(2), F.size(x) - 1).alias("b"))
        changes = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.when((p["a"] >= k / 2) != (p["b"] >= k / 2), 1.0).otherwise(0.0))
        products = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        serial = products / var / F.sqrt(n - 1)
        logs = [F.log(F.greatest(p, F.lit(1e-30))) for p in (_upper_tail(chi), F.least(F.lit(1.0), 2 * _upper_tail(F.abs(runs))),
                                                            F.least(F.lit(1.0), 2 * _upper_tail(F.abs(serial))))]
        return let(-(logs[0] + logs[1] + logs[2]), lambda h: F.exp(-h) * (F.lit(1.0) + h + h * h / 2))

    letters = F.split(body, "")
    return let(F.transform(letters, lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double")), tests)


def tested(text: Column) -> Column:
    """array<struct<start, end, encoding, stratum, p>> of every token with an inferred encoding."""
    def one(s: Column) -> Column:
        body = F.regexp_replace(F.regexp_replace(s["match"], "=+$", ""), "-", "")
        body = F.regexp_replace(body, "_", "/")

        def judge(b: Column) -> Column:
            code, p = F.lit(-1), F.lit(None).cast("double")
            for i, (_, pattern, alphabet) in reversed(list(enumerate(ENCODINGS))):
                fits = b.rlike(pattern)
                code, p = F.when(fits, F.lit(i)).otherwise(code), F.when(fits, _combined(b, alphabet)).otherwise(p)
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), code.alias("encoding"),
                            F.floor(F.log2(F.char_length(b).cast("double")) * 2).cast("int").alias("stratum"), p.alias("p"))

        return let(body, judge)

    found = F.transform(located(text, TOKEN), one)
    return F.filter(found, lambda s: (s["encoding"] >= 0) & s["p"].isNotNull())


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, tested) of every row, in one projection of the texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", base_spans(text).alias("base"), tested(text).alias("tested"))


def thresholds(rows: DataFrame, false: float = FALSE) -> dict[tuple[int, int], float]:
    """Lowest p called random, by (encoding, stratum), from all tested tokens."""
    bins = rows.select(F.explode("tested").alias("t")).groupBy("t.encoding", "t.stratum", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[tuple[int, int], list[int]] = {}
    for r in bins:
        counts.setdefault((r["encoding"], r["stratum"]), [0] * BINS)[r["bin"]] = r["n"]
    out = {}
    for key, have in counts.items():
        random = 2 * sum(have[BINS // 2:])
        for b in range(BINS):
            above = sum(have[b:])
            if above and above - random * (1 - b / BINS) <= false * above:
                out[key] = max(b / BINS, LEAST_P)
                break
    return out


def with_random(rows: DataFrame, least: dict[tuple[int, int], float]) -> DataFrame:
    """``rows`` with ``added``: spans of tokens called random that touch no base span."""
    def passes(t: Column) -> Column:
        floor = F.lit(2.0)
        for (encoding, stratum), p in sorted(least.items()):
            floor = F.when((t["encoding"] == encoding) & (t["stratum"] == stratum), F.lit(p)).otherwise(floor)
        return t["p"] >= floor

    good = F.filter("tested", lambda t: passes(t) & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.withColumn("added", F.transform(good, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end"))))


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    rows = stored(scanned(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "secrets")
    rows = with_random(rows, thresholds(rows))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *map(number, KINDS[:3]), F.sha2(labelled(F.col("base"), KINDS), 256).alias("base_sha256"),
                       labelled(F.array_sort(F.concat("base", "added")), KINDS).alias("spans"))
