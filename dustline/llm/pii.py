"""Personal data by candidate gradient boosting (operator 1), in column expressions only.

Exact patterns with their checks give the base spans, which always stay. High-recall generators
propose further, overlapping spans: obfuscated addresses, dotted or coloured host numbers, grouped
digits with or without a plus sign. Boosted trees score every proposal from its format and from the
words around it; the scores are calibrated per kind on all proposals of all documents, in a
histogram of fixed size, and proposals above the threshold that touch no base span are added.

A proposal is a positive if it is a base span, or if it passes the check of its kind (letters at the
end of an address, octets or eight groups, digit sum, digit count) in personal context, whatever its
form; one that fails the check or has no such context is a negative. The trees learn from a bounded
sample of documents (``FIT_DOCUMENTS`` in expectation, chosen by a hash of the id). The checks
themselves are not features, so what looks like a base span in form and context scores alike. The fitted trees are turned into one column expression: marking and redacting
a text is a single narrow projection, without join, shuffle or Python.

Edge cases: a null text is empty; ids may be null or repeated, as nothing is joined on them; with
no proposals of both classes to learn from only base spans are returned; other columns are kept.
Patterns start behind a look-behind or \\G and use possessive loops: linear time and constant stack
on texts of any length, with the same matches as the plain patterns.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import stored
from dustline.llm.spans import labelled, let, located

KINDS = ("email", "ip", "card", "phone")
FIT_DOCUMENTS = 20_000
PRECISION = 0.95  # share of positives among the proposals at or above the threshold
LEAST_ROWS = 20  # proposals above a threshold
STEP, FAR = 0.01, 8.0  # width of a bin of scores, and where the outer bins begin
TREES, DEPTH = 10, 3

# The base patterns of the contract, in a form that never goes back over what it has read.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Generators (kind, pattern, condition for a cheap skip).
LOOSE_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?@\x20?|\x20?[(\[]at[)\]]\x20?|\x20at\x20)"
               r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++")
LOOSE_IP = r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?:[.,]\x20?[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])"
LOOSE_NUMBER = r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){8,22}(?![0-9A-Za-z])"

CONTEXT = {"email": "mail|contact|write|reach", "ip": "host|server|address|login|ping|ipv", "card": "card|visa|account|pay|iban|credit",
           "phone": "call|phone|tel|mobile|fax|dial"}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _octets(m: Column) -> Column:
    """All parts at most 255, whatever their number of leading zeros."""
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(m, r"\."), lambda p: (F.char_length(part(p)) <= 3) & (F.coalesce(F.when(
        F.char_length(part(p)).between(1, 3), part(p).cast("int")), F.lit(0)) <= 255))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the base spans, by start, then kind."""
    def kept(kind: int, pattern: str, hint: Column, valid) -> Column:
        good = F.filter(located(text, pattern, hint), lambda s: valid(s["match"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    length = lambda m: F.char_length(_digits(m))
    return F.array_sort(F.concat(
        kept(0, EMAIL, F.contains(text, F.lit("@")), lambda m: F.lit(True)),
        kept(1, IP, F.contains(text, F.lit(".")), _octets),
        kept(2, CARD, F.lit(True), lambda m: length(m).between(14, 19) & F.call_function("luhn_check", _digits(m))),
        kept(3, PHONE, F.contains(text, F.lit("+")), lambda m: length(m).between(10, 15))))


def _checked(kind: int, m: Column) -> Column:
    """Whether a proposal passes the check of its kind, in any form."""
    length = F.char_length(_digits(m))
    return (m.rlike(r"[A-Za-z]{2}$"),
            F.when(F.contains(m, F.lit(":")), F.size(F.split(m, ":")) == 8).otherwise(_octets(F.regexp_replace(m, r"[.,]\x20?", "."))),
            length.between(14, 19) & F.call_function("luhn_check", _digits(m)), length.between(10, 15))[kind]


def proposals(text: Column, checked: bool = False) -> Column:
    """array<struct<start, kind, end, f>> of generated spans with their format and context features; ``checked`` adds ``ok``."""
    def made(kind: int, found: Column) -> Column:
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"),
                                                     features(kind, s["start"], s["end"], s["match"]).alias("f"),
                                                     *([_checked(kind, s["match"]).alias("ok")] if checked else [])))

    def features(kind: int, start: Column, end: Column, m: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24))))
        after = F.lower(F.substring(text, end + 1, F.lit(12)))
        groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
        sizes = F.transform(groups, lambda g: F.char_length(g))
        values = [F.lit(kind), F.char_length(m), F.char_length(_digits(m)), F.char_length(F.regexp_replace(m, "[^A-Za-z]", "")), F.size(groups),
                  F.coalesce(F.array_max(sizes), F.lit(0)), F.coalesce(F.array_min(sizes), F.lit(0)), F.regexp_count(m, F.lit(r"\.")),
                  F.regexp_count(m, F.lit("-")), F.regexp_count(m, F.lit(r"\x20")), F.regexp_count(m, F.lit(r"[()]")), F.regexp_count(m, F.lit(":")),
                  before.rlike(r"[$€£#=/]\x20?$"), after.rlike(r"^\x20?(?:%|usd|eur|kg|km)"),
                  *(F.concat(before, F.lit(" "), after).rlike(CONTEXT[k]) for k in KINDS)]
        return F.array(*(v.cast("double") for v in values))

    digit = F.regexp_like(text, F.lit("[0-9]"))
    numbers = located(text, LOOSE_NUMBER, digit)
    size = lambda s: F.char_length(_digits(s["match"]))
    return F.concat(made(0, located(text, LOOSE_EMAIL, F.regexp_like(text, F.lit(r"@|\bat\b")))), made(1, located(text, LOOSE_IP, digit)),
                    let(numbers, lambda n: F.concat(made(2, F.filter(n, lambda s: size(s) >= 13)), made(3, F.filter(n, lambda s: size(s) <= 15)))))


def _key(s: Column) -> Column:
    """One number for kind, start and end."""
    return (s["start"].cast("long") * (1 << 31) + s["end"].cast("long")) * 4 + s["kind"].cast("long")


def _tree(node, f: Column) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[int(split.featureIndex())] <= float(split.threshold()), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


def _labelled_proposals(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, f, label) of every proposal of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", base_spans(text).alias("base"), proposals(text, checked=True).alias("made")) \
        .select("doc_id", F.transform("base", _key).alias("base"), F.explode("made").alias("p"))
    personal = F.col("p.ok") & (F.element_at("p.f", F.col("p.kind") - len(KINDS)) > 0)  # the last features are the contexts by kind
    return rows.select("doc_id", F.col("p.kind").alias("kind"), F.col("p.f").alias("f"), (F.array_contains("base", _key(F.col("p"))) | personal).cast("double").alias("label"))


def _bin(score: Column) -> Column:
    return F.floor(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), score)) / STEP).cast("int")


def fit(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS):
    """(margin of a feature array, least bin of it by kind index) learned from ``docs`` (doc_id, text), or None if one class is missing."""
    total = max(1, docs.count())
    sample = docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("personal")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, fit_documents / total)))
    rows = stored(_labelled_proposals(sample).select("f", "label"), "proposals")
    if {r["label"] for r in rows.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    train = rows.select(array_to_vector("f").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=7).fit(train)
    trees = [(float(w), t._java_obj.rootNode()) for w, t in zip(model.treeWeights, model.trees)]

    def margin(f: Column) -> Column:
        total = F.lit(0.0)
        for weight, root in trees:
            total = total + F.lit(weight) * _tree(root, f)
        return total

    bins = _labelled_proposals(docs).groupBy("kind", _bin(margin(F.col("f"))).alias("bin")).agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    least, above = {}, {}
    for r in sorted(bins, key=lambda r: -r["bin"]):
        good, n = above.get(r["kind"], (0, 0))
        above[r["kind"]] = good, n = good + r["good"], n + r["n"]
        if good >= PRECISION * n and n >= LEAST_ROWS:
            least[r["kind"]] = r["bin"]
    return margin, least


def marked(text: Column, model) -> Column:
    """struct<base, added>: base spans, and the model's spans that touch none of them, each by start, then kind."""
    def added(base: Column) -> Column:
        if model is None or not model[1]:
            return F.slice(base, 1, 0)
        margin, least = model
        taken = F.transform(base, _key)

        def passes(p: Column) -> Column:
            floor = F.lit(1 << 30)
            for kind, value in least.items():
                floor = F.when(p["kind"] == kind, F.lit(value)).otherwise(floor)
            return _bin(margin(p["f"])) >= floor

        good = let(taken, lambda keys: F.filter(proposals(text), lambda p: ~F.array_contains(keys, _key(p)) & passes(p)))
        plain = F.transform(good, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
        free = F.filter(plain, lambda p: ~F.exists(base, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"])))
        return F.array_sort(free)

    return let(base_spans(text), lambda base: F.struct(base.alias("base"), added(base).alias("added")))


def found(docs: DataFrame, model) -> DataFrame:
    """``docs`` with column ``pii``: struct<base, added> of span arrays (start, kind index, end)."""
    return docs.withColumn("pii", marked(F.coalesce(F.col("text").cast("string"), F.lit("")), model))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones together) replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(s: Column, x: Column) -> Column:
        fresh = x["start"] >= s["at"]
        out = F.when(fresh, F.concat(s["out"], F.array(F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.element_at(names, x["kind"] + 1)))).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, empty, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.char_length(text))))


def op1_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = found(docs, fit(docs)).select("doc_id", "pii")
    number = lambda kind: F.size(F.filter("pii.base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    everything = F.array_sort(F.concat("pii.base", "pii.added"))
    return rows.select("doc_id", *map(number, KINDS), F.sha2(labelled(F.col("pii.base"), KINDS), 256).alias("base_sha256"),
                       labelled(everything, KINDS).alias("spans"))


def personal_data_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its spans replaced; n_chars follows the new text."""
    model = fit(docs.select("doc_id", "text"))
    rows = docs.select(F.struct(*docs.columns).alias("row")).select("row", marked(F.coalesce(F.col("row.text"), F.lit("")), model).alias("pii"))
    clean = let(F.array_sort(F.concat("pii.base", "pii.added")), lambda spans: F.when(F.size(spans) > 0, redacted(F.col("row.text"), spans))
                .otherwise(F.col("row.text")))
    rows = rows.withColumn("clean", clean)
    return rows.select(*(F.col("clean").alias(c) if c == "text" else F.char_length("clean").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                         else F.col(f"row.{c}").alias(c) for c in docs.columns))
