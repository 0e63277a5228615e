"""Tail risk V1-V4 per portfolio over its loss series."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ranking


def empirical_var(losses: DataFrame, ci: float, by: str = "port_name",
                  loss: str = "loss") -> DataFrame:
    """V1: interpolated ci-quantile of losses (``np.quantile``)."""
    q = ranking.exact_quantiles(losses, [by], loss, [ci])
    return q.select(by, F.col("q").alias("var_empirical"))


def normal_var(losses: DataFrame, ci: float, by: str = "port_name", loss: str = "loss") -> DataFrame:
    """V2: mean + z(ci) * sample std."""
    z = NormalDist().inv_cdf(ci)
    return losses.groupBy(by).agg((F.avg(loss) + z * F.stddev_samp(loss)).alias("var_normal"))


def normal_cvar(losses: DataFrame, ci: float, by: str = "port_name", loss: str = "loss") -> DataFrame:
    """V4: expected loss beyond the normal VaR, mean + std * phi(z) / (1 - ci)."""
    z = NormalDist().inv_cdf(ci)
    phi = math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return losses.groupBy(by).agg(
        (F.avg(loss) + F.stddev_samp(loss) * phi / (1 - ci)).alias("cvar_normal"))


def kde_var(losses: DataFrame, ci: float, draws: int = 100_000, seed: int = 7,
            by: str = "port_name", loss: str = "loss") -> DataFrame:
    """V3: ci-quantile of a smoothed bootstrap (Gaussian KDE with Scott's
    bandwidth h = n^(-1/5) * std): each draw picks a loss at random and adds
    h * N(0, 1).  Draws are generated and aggregated on the executors."""
    spark = losses.sparkSession
    from pyspark.sql import Window
    idx = losses.select(by, loss).withColumn(
        "i", F.row_number().over(Window.partitionBy(by).orderBy(loss)) - 1)   # per-portfolio series
    st = losses.groupBy(by).agg(F.count(loss).alias("n"), F.stddev_samp(loss).alias("sd"))
    st = st.withColumn("h", F.pow(F.col("n"), -0.2) * F.col("sd"))
    ports = [r[by] for r in st.select(by).collect()]          # the portfolio names
    d = spark.range(draws).select(F.explode(F.array(*[F.lit(x) for x in ports])).alias(by))
    pick = (d.join(F.broadcast(st), by)                        # one row per portfolio
            .withColumn("i", F.floor(F.rand(seed) * F.col("n")).cast("int"))
            .withColumn("x", F.col("h") * F.randn(seed + 1)))
    sample = pick.join(idx, [by, "i"]).select(by, (F.col(loss) + F.col("x")).alias("s"))
    q = ranking.exact_quantiles(sample, [by], "s", [ci])
    return q.select(by, F.col("q").alias("var_kde"))
