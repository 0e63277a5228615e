"""Factor evaluation E1-E13 over a long factor table.

Input ``fd``: (factor, date, asset, session_idx, value, fwd_<k> ...), one row
per factor, date and asset.  Every statistic is computed for all factors in
one job: cross-section windows are partitioned by (factor, date), or split
where a date is too large for a task (``split``, see ``xsplit``), per-date
results are aggregated by (factor, date), and time statistics run on the
small (factor, date) table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats

from ..operators import xsplit

ANNUALIZATION = {"daily": 252.0, "weekly": 52.0, "monthly": 12.0, "none": 1.0}


def to_long(panel: DataFrame, factors: list[str], fwd_cols: list[str]) -> DataFrame:
    """Wide factor panel -> long (factor, date, asset, session_idx, value, fwd...)."""
    ids = ["date", "asset", "session_idx", *fwd_cols]
    return (panel.unpivot(ids, factors, "factor", "value")
            .filter(F.col("value").isNotNull()))


def factor_data(fd: DataFrame, periods: tuple[int, ...], quantiles: int | None = 5,
                bins: int | None = None, split: bool = False) -> DataFrame:
    """Drop rows with a missing factor or forward return, then the
    per-date quantile (1..q, ``pd.qcut`` edges) or equal-width bin."""
    cols = [f"fwd_{k}" for k in periods]
    by = ["factor", "date"]
    d = fd.dropna(subset=["value", *cols])
    d = d if split else d.repartition(*by)
    if quantiles:
        d = xsplit.qcut(d, "factor_quantile", "value", quantiles, by, split=split)
    elif bins:
        d = xsplit.cut(d, "factor_quantile", "value", bins, by, split).withColumn(
            "factor_quantile", F.col("factor_quantile") + 1)
    return d


def loss_report(fd: DataFrame, periods: tuple[int, ...]) -> DataFrame:
    """E12 input: share of rows dropped per factor for missing data."""
    cols = [f"fwd_{k}" for k in periods]
    ok = F.col("value").isNotNull()
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return (fd.groupBy("factor").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_if(~ok).alias("n_dropped"))
            .withColumn("loss", F.col("n_dropped") / F.col("n_rows")))


def skipped_factors(fd: DataFrame, periods: tuple[int, ...], max_loss: float = 0.35) -> DataFrame:
    """A factor that cannot be evaluated is listed with its status."""
    return loss_report(fd, periods).withColumn(
        "status", F.when(F.col("loss") > max_loss, "skipped").otherwise("ok"))


def factor_returns(fdq: DataFrame, period: int, split: bool = False) -> DataFrame:
    """Weights (f - mean) / sum|f - mean| per date; return = sum w * fwd."""
    return (xsplit.share_of_abs(fdq, "w", "value", ["factor", "date"], split)
            .groupBy("factor", "date")
            .agg(F.sum(F.col("w") * F.col(f"fwd_{period}")).alias("factor_return")))


def sharpe(daily: DataFrame, col: str, by: str | list[str] = "factor",
           frequency: str = "daily") -> DataFrame:
    """sqrt(ann) * mean / sample std of a return series."""
    ann = math.sqrt(ANNUALIZATION[frequency])
    return daily.groupBy(by).agg(
        (F.try_divide(F.avg(col), F.stddev_samp(col)) * ann).alias("sharpe"))


def rank_ic(fdq: DataFrame, period: int, split: bool = False) -> DataFrame:
    """Spearman correlation of factor and forward return per date."""
    by = ["factor", "date"]
    r = xsplit.rank_average(fdq, "rf", "value", by, split)
    r = xsplit.rank_average(r, "rr", f"fwd_{period}", by, split)
    return r.groupBy(*by).agg(stats.corr("rf", "rr").alias("ic"))


def rank_autocorr(fd: DataFrame, split: bool = False) -> DataFrame:
    """E5: correlation of an asset's factor rank at t with its rank at the
    previous session, over the assets present on both."""
    by = ["factor", "date"]
    r = xsplit.rank_average(fd if split else fd.repartition(*by), "rk", "value", by, split).select(
        "factor", "date", "session_idx", "asset", "rk")
    prev = r.select("factor", (F.col("session_idx") + 1).alias("session_idx"), "asset",
                    F.col("rk").alias("rk_prev"))
    return (r.join(prev, ["factor", "session_idx", "asset"])
            .groupBy("factor", "date").agg(stats.corr("rk", "rk_prev").alias("autocorr")))


def quantile_returns(fdq: DataFrame, period: int, split: bool = False) -> DataFrame:
    """Forward returns de-meaned per date, mean per (date, quantile), then
    mean and standard error over dates."""
    by = ["factor", "date"]
    f = f"fwd_{period}"
    d = xsplit.demean(fdq, "dm", f, by, split)
    per_date = d.groupBy("factor", "date", "factor_quantile").agg(F.avg("dm").alias("m"))
    return (per_date.groupBy("factor", "factor_quantile")
            .agg(F.avg("m").alias("mean_return"),
                 (F.stddev_samp("m") / F.sqrt(F.count("m"))).alias("std_error")))


def cumulative(daily: DataFrame, col: str, by: str = "factor", order: str = "date",
               out: str = "cum_return") -> DataFrame:
    """Running product of (1 + r) per factor over dates (small table)."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn(out, F.product(F.lit(1.0) + F.col(col)).over(w))


def information_ratio(ic: DataFrame, breadth_col: str = "breadth") -> DataFrame:
    """Q20: IC * sqrt(breadth) with breadth = assets per date."""
    return ic.withColumn("ir", F.col("ic") * F.sqrt(F.col(breadth_col)))


def split_by_date(df: DataFrame, cut: str, date: str = "date") -> DataFrame:
    """Label rows train (date < cut) or test."""
    return df.withColumn("split", F.when(F.col(date) < F.lit(cut).cast("date"), "train")
                         .otherwise("test"))


def rolling_mean_by_date(daily: DataFrame, col: str, n: int, by: str = "factor",
                         order: str = "date", out: str | None = None) -> DataFrame:
    """Rolling n-row mean (full window) of a per-date series."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-(n - 1), 0)
    return daily.withColumn(out or f"{col}_roll{n}",
                            F.when(F.count(col).over(w) == n, F.avg(col).over(w)))


def to_bps(c):
    """E13."""
    return F.col(c) * 1e4 if isinstance(c, str) else c * 1e4
