"""Mixing documents to target weights with soft membership (operator 9), in DataFrame and MLlib operations only.

1. A multinomial logistic regression over hashed words, fitted on a bounded sample of the labelled
   table (``FIT_ROWS`` in expectation), gives every document a posterior over the domains, so a
   document belongs to several domains in part.
2. Rates r >= 0 are fitted by distributed projected-gradient least squares so that the expected
   tokens of each domain, sum of r * tokens * posterior, match the targets:

       minimise e' M e,   e = A' r - target,   A = tokens * posteriors,   M = inverse of A' A

   Gradient steps are summed up and projected onto r >= 0 from the start r = 1, so rates leave one
   only as far as the targets ask: r = max(0, 1 - A y), y the sum of steps M e. M is taken over the
   rows whose rate is positive, and a step that does not help is halved. One round is one
   aggregation; only a residual and a Gram matrix as wide as the list of domains reach the driver,
   and the rates are a column expression of a row's own posteriors.

The classifier's posteriors are written once (in the shared folder) and only their narrow columns
are read in each round. There is no join on the documents: labels of the sample are broadcast
(bounded by FIT_ROWS), so a hot source, id or text does not gather in one task.

Edge cases: null and empty texts have no tokens and keep rate 1; ids may be null or repeated;
without labelled rows all posteriors are uniform; a domain that no document can supply stays short
of its target and ``converged`` is false; clashing column names raise in ``rated``.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.llm.common import stored, table

DOMAINS = ("good", "poor", "toxic")
#: Shares of all tokens that the mixture should have.
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
FIT_ROWS = 5_000
FEATURES = 1 << 12
RIDGE = 1e-9  # of the Gram matrix's diagonal, for domains that no row supplies
TOLERANCE = 1e-4  # largest miss of a domain, as a share of all tokens
ROUNDS = 60


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, label) with label the index in DOMAINS; rows without labels are left out."""
    label = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    return labels.select(F.col("doc_id").alias("labelled_id"), label.cast("double").alias("label")).where("label is not null and labelled_id is not null")


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"\s+"), "")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """Classifier of the domains from hashed words, or None without labelled rows."""
    known = domains_of(labels)
    total = known.count()
    if not total:
        return None
    sample = known.where(F.pmod(F.xxhash64("labelled_id", F.lit("mix")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, fit_rows / total)))
    rows = docs.select(F.col("doc_id").alias("labelled_id"), "text").join(F.broadcast(sample), "labelled_id").select(_words("text").alias("words"), "label")
    rows = HashingTF(numFeatures=FEATURES, inputCol="words", outputCol="features").transform(rows).select("features", "label")
    rows = stored(rows, "mixing-sample")
    if rows.isEmpty():
        return None
    return LogisticRegression(maxIter=25, regParam=1e-3, family="multinomial").fit(rows.repartition(8))


def posteriors(docs: DataFrame, model, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """``docs`` with n_tokens and p_<domain>."""
    clash = set(docs.columns) & {"n_tokens", "rate", "converged", "__row", "__words", "features", "prediction", "probability", "rawPrediction",
                                 *(f"p_{d}" for d in domains)}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    rows = docs.withColumn("__words", _words("text"))
    n = F.size("__words").cast("long").alias("n_tokens")
    if model is None:
        return rows.select(*docs.columns, n, *(F.lit(1.0 / len(domains)).alias(f"p_{d}") for d in domains))
    rows = HashingTF(numFeatures=FEATURES, inputCol="__words", outputCol="features").transform(rows)
    rows = model.setProbabilityCol("probability").transform(rows).select(*docs.columns, n, vector_to_array("probability").alias("probability"))
    part = lambda i: F.coalesce(F.get("probability", F.lit(i)), F.lit(0.0))  # noqa: E731  a class may be missing from the sample
    return rows.select(*docs.columns, "n_tokens", *(part(i).alias(f"p_{d}") for i, d in enumerate(domains)))


def rated(rows: DataFrame, targets: dict[str, float], ridge: float = RIDGE, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (n_tokens, p_<domain>) with ``rate`` and ``converged``; targets are shares of all tokens."""
    names = list(targets)
    token = lambda d: F.col("n_tokens") * F.col(f"p_{d}")
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    everything = float(rows.agg(F.sum("n_tokens")).first()[0] or 0)
    if everything == 0:
        return rows.withColumns({"rate": F.lit(1.0), "converged": F.lit(True)})
    target = np.array([targets[d] for d in names]) * everything

    def rate(y: np.ndarray) -> Column:
        pull = F.lit(0.0)
        for d, x in zip(names, y):
            pull = pull + token(d) * F.lit(float(x))
        return F.greatest(F.lit(0.0), F.lit(1.0) - pull)

    y, best, least, step, metric, converged = np.zeros(len(names)), np.zeros(len(names)), np.inf, 1.0, None, False
    for _ in range(rounds):
        live = rows.withColumn("rate", rate(y)).select("rate", *(token(d).alias(d) for d in names))
        got = live.agg(*(F.coalesce(F.sum(F.col(d) * F.col("rate")), F.lit(0.0)).alias(f"s_{i}") for i, d in enumerate(names)),
                       *(F.coalesce(F.sum(F.when(F.col("rate") > 0, F.col(names[i]) * F.col(names[j]))), F.lit(0.0)).alias(f"g_{i}_{j}") for i, j in pairs)).first()
        miss = np.array([got[f"s_{i}"] for i in range(len(names))]) - target
        size = float(np.abs(miss).max())
        if size < least:
            gram = np.array([[got[f"g_{min(i, j)}_{max(i, j)}"] for j in range(len(names))] for i in range(len(names))])
            metric = np.linalg.pinv(gram + ridge * np.diag(np.diag(gram)), rcond=1e-12, hermitian=True)
            best, least, push, step = y, size, metric @ miss, min(1.0, 2 * step)
        else:
            step /= 2  # back to the best point, half as far
        if least <= tolerance * everything:
            converged = True
            break
        y = best + step * push
    return rows.withColumns({"rate": rate(best), "converged": F.lit(converged)})


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` with n_tokens, p_<domain>, rate (expected copies of the document in the mixture) and converged."""
    return rated(stored(posteriors(docs, fit(docs, labels)), "posteriors"), targets)


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Rate of every document for the target mixture."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = stored(posteriors(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text"), "posteriors")
    return rated(rows, TARGETS)


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its rate; the last stage, so columns are added."""
    return mix(docs, table(spark, sf_dir, "labels"))
