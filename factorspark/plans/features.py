"""Targets, splits and sampling T1-T12 (all date logic on the small date table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import safe_positive
from ..operators import ts, xsplit
from ..session import small_dim
from ..sources.panels import CALENDAR_BOUND, calendar


def fwd_targets(p: DataFrame, tau: int, name: str = "target") -> DataFrame:
    """(p_{t+tau} - p_t) / p_t by session, long form."""
    return p.select("date", "asset", ts.fwd_return("close", tau).alias(name))


def target_table(p: DataFrame, tau: int, universe: str | None = None, split: bool = False) -> DataFrame:
    """Returns(tau) masked to the universe, its 2/5/25-quantile labels
    (0-based like zipline ``quantiles``), the value ``tau`` sessions ahead
    (by session, B17) and its sign flag."""
    raw = ts.returns("close", tau)
    if universe:
        raw = F.when(F.col(universe), raw)
    d = p.withColumn("raw", raw)
    d = d if split else d.repartition("date")
    for q in (2, 5, 25):
        d = xsplit.qcut(d, f"q{q}", "raw", q, split=split)
    d = d.withColumns({f"q{q}": F.col(f"q{q}") - 1 for q in (2, 5, 25)})
    d = d.withColumn("fshift", ts.lead("raw", tau))
    return d.withColumn("fshift_is_positive", safe_positive("fshift"))


def split_by_fraction(df: DataFrame, train: float = 0.6, valid: float = 0.2,
                      test: float = 0.2) -> DataFrame:
    """train/valid/test cut on distinct dates at int(frac * n_dates)."""
    if abs(train + valid + test - 1.0) > 1e-9:
        raise ValueError("fractions must sum to 1")
    cal = calendar(df)
    w = Window.orderBy("date")   # on the distinct-date table only
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lab = cal.withColumn("split", F.when(F.col("session_idx") < F.floor(n * train), "train")
                         .when(F.col("session_idx") < F.floor(n * (train + valid)), "valid")
                         .otherwise("test")).select("date", "split")
    return df.join(small_dim(lab, CALENDAR_BOUND), "date")


def drop_last_sessions(df: DataFrame, tau: int) -> DataFrame:
    """T5: without the last ``tau`` distinct dates."""
    cal = calendar(df)
    n = cal.agg(F.count(F.lit(1)).alias("_n"))               # one row
    keep = cal.join(F.broadcast(n)).filter(F.col("session_idx") < F.col("_n") - tau).select("date")
    return df.join(small_dim(keep, CALENDAR_BOUND), "date", "left_semi")


def non_overlapping(df: DataFrame, n_skip: int, start: int = 0) -> DataFrame:
    """Keep dates start, start + skip + 1, ... of the distinct dates present."""
    cal = calendar(df)
    keep = cal.filter((F.col("session_idx") >= start) &
                      ((F.col("session_idx") - start) % (n_skip + 1) == 0)).select("date")
    return df.join(small_dim(keep, CALENDAR_BOUND), "date", "left_semi")


def time_folds(df: DataFrame, k: int) -> DataFrame:
    """Expanding-window folds (``TimeSeriesSplit``) on distinct dates:
    (fold, date, role) with test size n // (k + 1) and all earlier dates as train."""
    cal = calendar(df)
    w = Window.orderBy("date")
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    c = cal.withColumn("n", n).withColumn("tsz", F.floor(F.col("n") / (k + 1)))
    c = c.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("n") - (F.lit(k) - F.col("fold")) * F.col("tsz")
    role = (F.when(F.col("session_idx") < start, "train")
            .when(F.col("session_idx") < start + F.col("tsz"), "test"))
    return c.withColumn("role", role).filter(F.col("role").isNotNull()) \
            .select("fold", "date", "role")


def weekday_sample(df: DataFrame, key: str = "asset", seed: int = 42) -> DataFrame:
    """Keep a row when its weekday equals a per-row pseudo-random weekday
    in 0..4 (about one row in five); a hash, not ``rand``, so reruns agree."""
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).cast("long")
    pick = F.pmod(F.col(key).cast("long") * 2654435761 + day * 40503 + seed, F.lit(5))
    return df.filter(F.weekday("date") == pick)
