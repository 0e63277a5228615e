"""Time-series operators per asset over the dense session index.

Frames are RANGE frames on ``session_idx`` so "n sessions back" means n
calendar sessions even when the asset has no bar on some of them (a missing
bar is a missing value inside the window, like a NaN cell of a dense T x N
matrix).  All functions return Columns; several in one ``select`` share one
sort by (asset, session_idx) and one exchange by asset.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

IDX = "session_idx"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_window(asset: str = "asset", order: str = IDX):
    return Window.partitionBy(asset).orderBy(order)


def lag(x: Column | str, k: int = 1, asset: str = "asset", order: str = IDX) -> Column:
    """Value exactly k sessions earlier (NULL when that bar is absent)."""
    return F.first(_c(x)).over(ts_window(asset, order).rangeBetween(-k, -k))


def lead(x: Column | str, k: int = 1, asset: str = "asset", order: str = IDX) -> Column:
    """Value exactly k sessions later."""
    return F.first(_c(x)).over(ts_window(asset, order).rangeBetween(k, k))


def pct_change(x: Column | str, k: int = 1, **kw) -> Column:
    """x_t / x_{t-k} - 1."""
    return F.try_divide(_c(x), lag(x, k, **kw)) - 1


def returns(close: Column | str, window_length: int, **kw) -> Column:
    """``Returns(window_length=n)`` is an (n-1)-session change."""
    return pct_change(close, window_length - 1, **kw)


def fwd_return(close: Column | str, k: int = 1, start: int = 0, **kw) -> Column:
    """close_{t+start+k} / close_{t+start} - 1."""
    base = _c(close) if start == 0 else lead(close, start, **kw)
    return F.try_divide(lead(close, start + k, **kw), base) - 1


def _frame(n: int, asset: str, order: str):
    return ts_window(asset, order).rangeBetween(-(n - 1), 0)


def sma(x: Column | str, n: int, full: bool = False, asset: str = "asset",
        order: str = IDX) -> Column:
    """W6 (missing skipped) or, with ``full``, W5 (all n sessions present)."""
    x = _c(x)
    w = _frame(n, asset, order)
    m = F.avg(x).over(w)
    return F.when(F.count(x).over(w) == n, m) if full else m


def roll_sum(x: Column | str, n: int, asset: str = "asset", order: str = IDX) -> Column:
    """Rolling sum with missing counted as 0."""
    return F.coalesce(F.sum(_c(x)).over(_frame(n, asset, order)), F.lit(0.0))


def roll_std(x: Column | str, n: int, ddof: int = 0, asset: str = "asset",
             order: str = IDX) -> Column:
    """Rolling standard deviation (population by default)."""
    x = _c(x)
    f = F.stddev_pop if ddof == 0 else F.stddev_samp
    return f(x).over(_frame(n, asset, order))


def cumsum(x: Column | str, asset: str = "asset", order: str = IDX) -> Column:
    """W11."""
    w = ts_window(asset, order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(_c(x)).over(w)


def cumprod_1p(r: Column | str, asset: str = "asset", order: str = IDX) -> Column:
    """Running product of (1 + r)."""
    w = ts_window(asset, order).rowsBetween(Window.unboundedPreceding, 0)
    return F.product(F.lit(1.0) + _c(r)).over(w)


def interpolate(x: Column | str, asset: str = "asset", order: str = IDX) -> Column:
    """Linear interpolation of missing values between the neighbouring
    known values of the same asset, weighted by session distance; a trailing
    gap carries the last value forward, a leading gap stays NULL."""
    x = _c(x)
    o = F.col(order)
    back = ts_window(asset, order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = ts_window(asset, order).rowsBetween(0, Window.unboundedFollowing)
    pv = F.last(x, ignorenulls=True).over(back)
    pi = F.last(F.when(x.isNotNull(), o), ignorenulls=True).over(back)
    nv = F.first(x, ignorenulls=True).over(ahead)
    ni = F.first(F.when(x.isNotNull(), o), ignorenulls=True).over(ahead)
    lin = pv + (nv - pv) * (o - pi) / (ni - pi)
    return (F.when(x.isNotNull(), x)
            .when(pv.isNull(), None)
            .when(nv.isNull(), pv)
            .otherwise(lin))
