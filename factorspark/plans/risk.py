"""Risk model R1-R12: long matrices, K x K algebra only on the driver.

Betas are ``(asset, k, beta)``, factor returns ``(date, k, f)``, variances
``(k, var)`` and ``(asset, var)``.  The N x N covariance B F B' + S is never
formed: portfolio risk is two aggregations (R10).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram(betas: DataFrame) -> np.ndarray:
    """B'B as a K x K numpy matrix (one small aggregation)."""
    b2 = betas.alias("a").join(betas.alias("b"), "asset") \
        .groupBy(F.col("a.k").alias("i"), F.col("b.k").alias("j")) \
        .agg(F.sum(F.col("a.beta") * F.col("b.beta")).alias("g"))
    rows = b2.collect()                                   # K*K rows
    k = int(max(max(r.i, r.j) for r in rows)) + 1
    g = np.zeros((k, k))
    for r in rows:
        g[int(r.i), int(r.j)] = r.g
    return g


def projection(betas: DataFrame) -> DataFrame:
    """P = (B'B)^-1 B' as a long table (asset, k, p)."""
    ginv = np.linalg.pinv(gram(betas))
    spark = betas.sparkSession
    gi = spark.createDataFrame([(int(i), int(j), float(ginv[i, j])) for i in range(ginv.shape[0])
                                for j in range(ginv.shape[1])], "k int, j int, gij double")
    return (betas.withColumnRenamed("k", "j").join(F.broadcast(gi), "j")   # K*K literals
            .groupBy("asset", "k").agg(F.sum(F.col("gij") * F.col("beta")).alias("p")))


def static_factor_returns(rets: DataFrame, betas: DataFrame) -> DataFrame:
    """Per-date least squares (no intercept) of returns on fixed betas;
    missing returns count as 0 like the reference's filled matrix.
    Returns (date, k, f)."""
    p = projection(betas)
    return rets.join(p, "asset").groupBy("date", "k").agg(
        F.sum(F.col("p") * F.col("r")).alias("f"))


def explained_variance(rets: DataFrame, betas: DataFrame, f: DataFrame) -> DataFrame:
    """1 - var(resid) / var(r) per date over all N assets (missing r = 0),
    from per-date sums and K x K constants (no dates x assets grid)."""
    n = betas.select("asset").distinct().count()
    g = gram(betas)
    b1 = {r.k: r.s for r in betas.groupBy("k").agg(F.sum("beta").alias("s")).collect()}
    k = g.shape[0]
    fw = f.groupBy("date").pivot("k", list(range(k))).agg(F.first("f"))
    s = rets.groupBy("date").agg(F.sum("r").alias("s1"), F.sum(F.col("r") ** 2).alias("s2"))
    x = s.join(fw, "date")
    fgf = sum(F.col(str(i)) * F.col(str(j)) * float(g[i, j]) for i in range(k) for j in range(k))
    yhat1 = sum(F.col(str(i)) * float(b1.get(i, 0.0)) for i in range(k))
    var_y = F.col("s2") / n - (F.col("s1") / n) ** 2
    var_e = (F.col("s2") - fgf) / n - ((F.col("s1") - yhat1) / n) ** 2
    return x.select("date", (1 - F.try_divide(var_e, var_y)).alias("exp_var"))


def factor_var(f: DataFrame, ann: float) -> DataFrame:
    """Annualised sample variance per factor (diagonal covariance)."""
    return f.groupBy("k").agg((F.var_samp("f") * ann).alias("var"))


def idio_var(rets: DataFrame, betas: DataFrame, f: DataFrame, ann: float) -> DataFrame:
    """Annualised sample variance over all T dates of r - f.B' per asset
    (missing r = 0), from sums: no dates x assets grid is built."""
    t = f.select("date").distinct().count()
    ff = {(r.i, r.j): r.s for r in f.alias("a").join(f.alias("b"), "date")
          .groupBy(F.col("a.k").alias("i"), F.col("b.k").alias("j"))
          .agg(F.sum(F.col("a.f") * F.col("b.f")).alias("s")).collect()}   # K*K
    f1 = {r.k: r.s for r in f.groupBy("k").agg(F.sum("f").alias("s")).collect()}
    k = 1 + max(f1)
    y = rets.groupBy("asset").agg(F.sum("r").alias("y1"), F.sum(F.col("r") ** 2).alias("y2"))
    yf = rets.join(f, "date").groupBy("asset").pivot("k", list(range(k))).agg(
        F.sum(F.col("r") * F.col("f")))
    bw = betas.groupBy("asset").pivot("k", list(range(k))).agg(F.first("beta"))
    bw = bw.select("asset", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"b{i}") for i in range(k)])
    yf = yf.select("asset", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"yf{i}") for i in range(k)])
    x = bw.join(y, "asset", "left").join(yf, "asset", "left").na.fill(0.0)
    s1 = F.col("y1") - sum(F.col(f"b{i}") * float(f1[i]) for i in range(k))
    s2 = (F.col("y2") - 2 * sum(F.col(f"b{i}") * F.col(f"yf{i}") for i in range(k))
          + sum(F.col(f"b{i}") * F.col(f"b{j}") * float(ff[(i, j)]) for i in range(k) for j in range(k)))
    return x.select("asset", (((s2 - s1 * s1 / t) / (t - 1)) * ann).alias("var"))


def portfolio_risk(w: DataFrame, betas: DataFrame, fvar: DataFrame, ivar: DataFrame,
                   keys=("port_name", "date")) -> DataFrame:
    """sqrt(sum_k var_k (sum_i b_ik w_i)^2 + sum_i s_i w_i^2)."""
    keys = list(keys)
    ex = (w.join(betas, "asset").groupBy(*keys, "k")
          .agg(F.sum(F.col("beta") * F.col("w")).alias("e"))
          .join(fvar, "k").groupBy(*keys).agg(F.sum(F.col("var") * F.col("e") ** 2).alias("fr")))
    idio = w.join(ivar, "asset").groupBy(*keys).agg(F.sum(F.col("var") * F.col("w") ** 2).alias("ir"))
    return ex.join(idio, keys, "full_outer").select(
        *keys, F.sqrt(F.coalesce("fr", F.lit(0.0)) + F.coalesce("ir", F.lit(0.0))).alias("risk"))


def equal_weights(assets: DataFrame) -> DataFrame:
    """1 / N on every asset."""
    a = assets.select("asset").distinct()
    n = a.agg(F.count(F.lit(1)).alias("_n"))                  # one row
    return a.join(F.broadcast(n)).select("asset", (1.0 / F.col("_n")).alias("w"))


# ---------------------------------------------------------------- PCA

def dates_gram(rets: DataFrame, dates: list) -> np.ndarray:
    """G = Rc Rc' over the dates, Rc the returns (missing = 0) less each
    asset's mean.  Dates are bounded by the calendar (T numbers an asset); the
    assets stay distributed: a task adds up its assets' T x T products, whose
    rows are summed as vectors by row number, so T rows reach the driver."""
    import pandas as pd
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    t = len(dates)
    at = {d: i for i, d in enumerate(dates)}

    def products(batches):
        g = np.zeros((t, t))
        for pdf in batches:
            x = np.zeros((len(pdf), t))
            for row, (ds, rs) in enumerate(zip(pdf["d"], pdf["r"])):
                x[row, [at[d] for d in ds]] = rs
            x -= x.mean(axis=1, keepdims=True)
            g += x.T @ x
        yield pd.DataFrame({"i": range(t), "g": list(g)})

    own = rets.groupBy("asset").agg(F.collect_list("date").alias("d"), F.collect_list("r").alias("r"))   # T an asset
    sums = (own.select("d", "r").mapInPandas(products, "i int, g array<double>")
            .groupBy("i").agg(Summarizer.sum(array_to_vector("g")).alias("g")))
    out = np.zeros((t, t))
    for r in sums.collect():                                  # T rows
        out[r.i] = r.g.toArray()
    return (out + out.T) / 2


class DualPca:
    """R2: principal components of the returns' covariance from the T x T
    Gram matrix: the same variances, and loadings b = Rc' u / sqrt(lambda)."""

    def __init__(self, rets: DataFrame, k: int):
        self.rets = rets
        self.dates = [r.date for r in rets.select("date").distinct().orderBy("date").collect()]   # T
        values, vectors = np.linalg.eigh(dates_gram(rets, self.dates))
        o = np.argsort(values)[::-1]
        values, self.vectors = np.maximum(values[o], 0.0), vectors[:, o]
        self.k = int(min(k, (values > 1e-12 * max(values[0], 1e-300)).sum()))
        self.total = float(values.sum()) / (len(self.dates) - 1)
        self.variance = values[:self.k] / (len(self.dates) - 1)
        self.scale = np.sqrt(values[:self.k])

    def betas(self) -> DataFrame:
        """(asset, k, beta); the largest absolute loading of a component
        is positive.  A component's dates sum to 0, so means drop out."""
        u = [(d, j, float(self.vectors[i, j] / self.scale[j])) for i, d in enumerate(self.dates)
             for j in range(self.k)]
        u = self.rets.sparkSession.createDataFrame(u, "date date, k int, u double")   # T * K rows, a calendar's bound
        b = (self.rets.join(F.broadcast(u), "date").groupBy("asset", "k")
             .agg(F.sum(F.col("r") * F.col("u")).alias("beta")))
        top = b.groupBy("k").agg(F.max_by("beta", F.struct(F.abs("beta"), "asset")).alias("top"))
        sign = F.when(F.col("top") < 0, -1.0).otherwise(1.0)
        return b.join(F.broadcast(top), "k").select("asset", "k", (F.col("beta") * sign).alias("beta"))   # K rows


def pca_factor_returns(rets: DataFrame, betas: DataFrame) -> DataFrame:
    """Projection of centred returns (column means removed; Spark's
    ``PCA.transform`` does not centre) on the loadings."""
    t = rets.select("date").distinct().count()
    mu = rets.groupBy("asset").agg((F.sum("r") / t).alias("mu"))
    # centred value of a missing (0) return is -mu: sum_i (r_i - mu_i) b_ik
    # = sum_present r_i b_ik - sum_all mu_i b_ik
    s = rets.join(betas, "asset").groupBy("date", "k").agg(F.sum(F.col("r") * F.col("beta")).alias("rb"))
    c = betas.join(mu, "asset").groupBy("k").agg(F.sum(F.col("mu") * F.col("beta")).alias("mb"))
    return s.join(F.broadcast(c), "k").select(   # K rows
        "date", "k", (F.col("rb") - F.col("mb")).alias("f"))
