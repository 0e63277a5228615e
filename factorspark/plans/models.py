"""Model jobs L8-L17, E9 on Spark ML.  Closed forms (ridge on Gram sums,
multinomial naive Bayes counts) run as aggregations; grids over date folds are
in ``ridge``, ``selectk``, ``ensemble`` and ``crossval``, text classifiers in
``text.classify``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import bow


def gram_sums(df: DataFrame, features: list[str], target: str) -> tuple[np.ndarray, np.ndarray, int]:
    """X'X and X'y in one aggregation (K*K + K sums to the driver)."""
    aggs = [F.sum(F.col(a) * F.col(b)).alias(f"g_{i}_{j}") for i, a in enumerate(features)
            for j, b in enumerate(features)]
    aggs += [F.sum(F.col(a) * F.col(target)).alias(f"c_{i}") for i, a in enumerate(features)]
    aggs.append(F.count(F.lit(1)).alias("n"))
    r = df.dropna(subset=[*features, target]).agg(*aggs).first()
    k = len(features)
    g = np.array([[r[f"g_{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
    c = np.array([r[f"c_{i}"] or 0.0 for i in range(k)])
    return g, c, r["n"]


def ridge_gram(df: DataFrame, features: list[str], target: str, alpha: float) -> DataFrame:
    """Ridge without intercept, beta = (X'X + alpha I)^-1 X'y,
    as a (feature, coef) table."""
    g, c, _ = gram_sums(df, features, target)
    beta = np.linalg.solve(g + alpha * np.eye(len(features)), c)
    return df.sparkSession.createDataFrame([(f, float(b)) for f, b in zip(features, beta)],
                                           "feature string, coef double")


def score_linear(df: DataFrame, coefs: DataFrame, features: list[str], out: str = "pred") -> DataFrame:
    """Predictions x . beta for a small coefficient table."""
    cf = {r.feature: r.coef for r in coefs.collect()}      # K numbers
    return df.withColumn(out, sum(F.coalesce(F.col(f), F.lit(0.0)) * cf[f] for f in features))


def class_priors(labels: DataFrame, label: str = "label") -> DataFrame:
    """Log share of each class (0, 1) among the labelled rows."""
    n = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = labels.agg(F.count(F.lit(1)).alias("total"))
    return n.join(F.broadcast(total)).select(label, F.log(F.col("n") / F.col("total")).alias("log_prior"))


def naive_bayes(counts: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "label",
                alpha: float = 1.0) -> DataFrame:
    """Multinomial naive Bayes in closed form, one row per term of the
    labelled documents: log_0, log_1 = ln((n_tc + alpha) / (n_c + alpha V)).
    A term that a class lacks has the smoothed n_tc = 0; ``n``: rows with the
    term.  ``counts`` are term rows or bags."""
    tc = (bow.join_terms(counts, labels.select(key, label), key).groupBy("term")
          .agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.when(F.col(label) == k, F.col("tf"))), F.lit(0)).alias(f"n_{k}") for k in (0, 1)]))
    tot = tc.agg(F.count(F.lit(1)).alias("V"), F.sum("n_0").alias("c_0"), F.sum("n_1").alias("c_1"))   # one row
    return tc.join(F.broadcast(tot)).select(
        "term", "n", *[F.log((F.col(f"n_{k}") + alpha) / (F.col(f"c_{k}") + alpha * F.col("V"))).alias(f"log_{k}")
                  for k in (0, 1)])


def naive_bayes_probability(docs: DataFrame, counts: DataFrame, terms: DataFrame, priors: DataFrame,
                            key: str = "doc_id", out: str = "prob") -> DataFrame:
    """Probability of class 1 of every document; one without a known
    term keeps the prior."""
    pr = priors.agg(*[F.coalesce(F.max(F.when(F.col("label") == k, F.col("log_prior"))), F.lit(-1e9)).alias(f"p_{k}")
                      for k in (0, 1)])                                                               # one row
    rows = bow.terms_of(counts) if "bag" in counts.columns else counts
    s = bow.at_terms(rows, cut_lineage(terms), "n").groupBy(key).agg(F.sum(F.col("tf") * (F.col("log_1") - F.col("log_0"))).alias("_llr"))
    d = docs.join(s, key, "left").join(F.broadcast(pr))
    odds = F.coalesce("_llr", F.lit(0.0)) + F.col("p_1") - F.col("p_0")
    # exp of at most 700 stays finite
    return d.withColumn(out, 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(700.0)), F.lit(-700.0))))) \
        .drop("_llr", "p_0", "p_1")


def probability_score(prob) -> Column:
    """a probability as a score from -1 to 1."""
    return 2 * (F.col(prob) if isinstance(prob, str) else prob) - 1


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)
