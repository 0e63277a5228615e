"""Cross-sectional operators: every expression is a window over one date
(optionally one date x group).  A date's cross-section is bounded by the asset
universe, not by history length, so a date fits one task; callers put
``repartition(date)`` once before a chain so all of these share one exchange.

Each function returns a Column; compose several in one ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Values closer than 1e-10 rank as ties: float noise from summation order must
# not reorder assets.
RANK_DIGITS = 10


def _key(x: Column) -> Column:
    return F.round(x, RANK_DIGITS)


def _by(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def xs_window(by: str | Sequence[str] = "date"):
    return Window.partitionBy(*_by(by))


def demean(x: Column | str, by: str | Sequence[str] = "date") -> Column:
    """X minus the mean of x over the date (and group)."""
    x = _c(x)
    return x - F.avg(x).over(xs_window(by))


def rank_ordinal(x: Column | str, by: str | Sequence[str] = "date",
                 tiebreak: str = "asset", ascending: bool = True) -> Column:
    """1..n ordinal rank within the date, ties broken by asset; NULL stays NULL."""
    x = _c(x)
    o = _key(x).asc() if ascending else _key(x).desc()
    w = Window.partitionBy(*_by(by), x.isNull()).orderBy(o, F.col(tiebreak).asc())
    return F.when(x.isNotNull(), F.row_number().over(w).cast("double"))


def rank_average(x: Column | str, by: str | Sequence[str] = "date") -> Column:
    """Average-tie rank (scipy ``rankdata`` default)."""
    x = _c(x)
    b = _by(by)
    w = Window.partitionBy(*b, x.isNull()).orderBy(_key(x))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*b, _key(x)))
    return F.when(x.isNotNull(), F.rank().over(w) + (ties - 1) / 2.0)


def zscore(x: Column | str, by: str | Sequence[str] = "date", ddof: int = 0) -> Column:
    """(x - mean) / std within the date; ddof 0 = population, 1 = sample.

    A zero (or undefined) deviation gives NULL (M9)."""
    x = _c(x)
    w = xs_window(by)
    sd = F.stddev_pop(x) if ddof == 0 else F.stddev_samp(x)
    return F.try_divide(x - F.avg(x).over(w), sd.over(w))


def rank_zscore(x: Column | str, by: str | Sequence[str] = "date", tiebreak: str = "asset") -> Column:
    """W2 then W4: the population z-score of the ordinal rank.  The ranks of n
    values are 1..n, so their mean and deviation follow from n, which is counted
    in the rank's own window: a task holds the date once and not twice."""
    x = _c(x)
    w = Window.partitionBy(*_by(by), x.isNull()).orderBy(_key(x).asc(), F.col(tiebreak).asc())
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("double")
    z = F.try_divide(F.row_number().over(w) - (n + 1) / 2, F.sqrt((n * n - 1) / 12))
    return F.when(x.isNotNull(), z)


def qcut(x: Column | str, q: int, by: str | Sequence[str] = "date") -> Column:
    """Equal-frequency bucket 1..q per date with interpolated edges,
    right-closed like ``pd.qcut``.  Not ``ntile`` (sizes differ on ties)."""
    x = _c(x)
    probs = [i / q for i in range(1, q)]
    edges = F.percentile(x, F.array(*[F.lit(p) for p in probs])).over(xs_window(by))
    above = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(x > e, 1).otherwise(0))
    return F.when(x.isNotNull(), (above + 1).cast("int"))


def cut(x: Column | str, bins: int, by: str | Sequence[str] = "date") -> Column:
    """Equal-width bin 0..bins-1 per date, right-closed like ``pd.cut``.

    A date whose values are all equal lands in the middle bin."""
    x = _c(x)
    w = xs_window(by)
    return bin_between(x, F.min(x).over(w), F.max(x).over(w), bins)


def bin_between(x: Column | str, lo: Column, hi: Column, bins: int) -> Column:
    """The equal-width bin of x between the date's extremes."""
    x = _c(x)
    # positions within 1e-9 of a bin edge snap to it (float noise, not data)
    raw = F.ceil(F.round(F.lit(bins) * (x - lo) / (hi - lo), 9)) - 1
    b = F.least(F.lit(bins - 1), F.greatest(F.lit(0), raw))
    mid = F.lit(int(-(-bins // 2)) - 1)
    return F.when(x.isNull(), None).when(hi == lo, mid).otherwise(b).cast("int")


def top_n_flag(x: Column | str, n: int, by: str | Sequence[str] = "date",
               tiebreak: str = "asset") -> Column:
    """True for the n largest non-null values of the date."""
    x = _c(x)
    w = Window.partitionBy(*_by(by), x.isNull()).orderBy(_key(x).desc(),
                                                         F.col(tiebreak).asc())
    return F.coalesce(x.isNotNull() & (F.row_number().over(w) <= n), F.lit(False))


def share_of_abs(x: Column | str, by: str | Sequence[str] = "date") -> Column:
    """(x - mean) / sum|x - mean| per date: the alphalens factor weights."""
    d = demean(x, by)
    return F.try_divide(d, F.sum(F.abs(d)).over(xs_window(by)))


def apply_xs(df: DataFrame, **cols: Column) -> DataFrame:
    """Repartition by date once, then add the cross-section columns."""
    return df.repartition("date").withColumns(cols)
