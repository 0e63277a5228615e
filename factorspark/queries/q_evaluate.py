"""Factor evaluation jobs E1-E13, Q20 over momentum and mean reversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.xsplit import wide_dates
from ..plans import evaluate as ev
from ..plans import factors as fx
from ..registry import register
from . import sqlkit as q
from .common import WEEKLY, nn, pw, r8
from .q_factors import sql_factor_panel

NAMES = ["momentum", "mean_reversion"]
PERIODS = (1, 2)


def _fd(spark, sf):
    """The long factor table, and whether its dates are too large for a task."""
    bars = pw(spark, sf)
    split = wide_dates(bars)
    fp = fx.factor_panel(bars, NAMES, WEEKLY, fwd_periods=PERIODS, split=split)
    return ev.to_long(fp, NAMES, [f"fwd_{k}" for k in PERIODS]), split


def _fdq(spark, sf):
    fd, split = _fd(spark, sf)
    return ev.factor_data(fd, PERIODS, quantiles=5, split=split), split


def _of(table, step, *args):
    """``step`` on a table that says how its dates are worked on."""
    d, split = table
    return step(d, *args, split=split)


FD_SQL = sql_factor_panel(NAMES, fwd_periods=PERIODS) + """,
fd AS (SELECT 'momentum' AS factor, date, asset, session_idx, momentum AS value, fwd_1, fwd_2 FROM fp
       WHERE momentum IS NOT NULL
       UNION ALL
       SELECT 'mean_reversion', date, asset, session_idx, mean_reversion, fwd_1, fwd_2 FROM fp
       WHERE mean_reversion IS NOT NULL),
fdq0 AS (SELECT *, quantile_cont(value, [0.2, 0.4, 0.6, 0.8]) OVER (PARTITION BY factor, date) AS edges
         FROM fd WHERE fwd_1 IS NOT NULL AND fwd_2 IS NOT NULL),
fdq AS (SELECT * EXCLUDE (edges), CAST(1 + list_sum([CASE WHEN value > x THEN 1 ELSE 0 END FOR x IN edges])
        AS INTEGER) AS factor_quantile FROM fdq0)"""


@register("factor_data", FD_SQL + """
SELECT factor, date, asset, round(value, 8) AS value, round(fwd_1, 8) AS fwd_1, round(fwd_2, 8) AS fwd_2,
       factor_quantile FROM fdq""")
def factor_data(spark, sf):
    """Factor with 1- and 2-session forward returns, complete rows only,
    per-date quintile."""
    d, _ = _fdq(spark, sf)
    return d.select("factor", "date", "asset", r8("value"), r8("fwd_1"), r8("fwd_2"),
                    "factor_quantile")


FR_SQL = FD_SQL + """,
wt AS (SELECT *, (value - avg(value) OVER (PARTITION BY factor, date)) /
       NULLIF(sum(abs(value - avg(value) OVER (PARTITION BY factor, date))) OVER (PARTITION BY factor, date), 0) AS w
       FROM fdq),
fr AS (SELECT factor, date, sum(w * fwd_1) AS factor_return FROM wt GROUP BY factor, date)"""


@register("factor_returns", FR_SQL.replace(
    "sum(abs(value - avg(value) OVER (PARTITION BY factor, date))) OVER (PARTITION BY factor, date)",
    "sum(abs(dm)) OVER (PARTITION BY factor, date)").replace(
    "wt AS (SELECT *, (value - avg(value) OVER (PARTITION BY factor, date)) /",
    "dmt AS (SELECT *, value - avg(value) OVER (PARTITION BY factor, date) AS dm FROM fdq),\n"
    "wt AS (SELECT *, dm /").replace("FROM fdq),\nfr AS", "FROM dmt),\nfr AS") +
    "\nSELECT factor, date, round(factor_return, 8) AS factor_return FROM fr")
def factor_returns(spark, sf):
    """Demeaned, gross-normalised factor weights times 1-session returns."""
    return _of(_fdq(spark, sf), ev.factor_returns, 1).select("factor", "date", r8("factor_return"))


_FR = FD_SQL + """,
dmt AS (SELECT *, value - avg(value) OVER (PARTITION BY factor, date) AS dm FROM fdq),
wt AS (SELECT *, dm / NULLIF(sum(abs(dm)) OVER (PARTITION BY factor, date), 0) AS w FROM dmt),
fr AS (SELECT factor, date, sum(w * fwd_1) AS factor_return FROM wt GROUP BY factor, date)"""


@register("factor_sharpe", _FR + """
SELECT factor, round(avg(factor_return) / NULLIF(stddev_samp(factor_return), 0) * sqrt(52.0), 8) AS sharpe
FROM fr GROUP BY factor""")
def factor_sharpe(spark, sf):
    """Annualised (weekly) Sharpe ratio of each factor's returns."""
    s = ev.sharpe(_of(_fdq(spark, sf), ev.factor_returns, 1), "factor_return", "factor", "weekly")
    return s.select("factor", r8("sharpe"))


@register("factor_cumret", _FR + """
SELECT factor, date, round(product(1 + factor_return) OVER (PARTITION BY factor ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 8) AS cum_return FROM fr""")
def factor_cumret(spark, sf):
    """Cumulative factor return, running product of (1 + r)."""
    c = ev.cumulative(_of(_fdq(spark, sf), ev.factor_returns, 1), "factor_return")
    return c.select("factor", "date", r8("cum_return"))


@register("factor_returns_bps", _FR + """
SELECT factor, round(avg(factor_return) * 1e4, 6) AS mean_return_bps FROM fr GROUP BY factor""")
def factor_returns_bps(spark, sf):
    """Mean factor return in basis points."""
    fr = _of(_fdq(spark, sf), ev.factor_returns, 1)
    return fr.groupBy("factor").agg(r8(ev.to_bps(F.avg("factor_return")), "mean_return_bps", 6))


IC_SQL = FD_SQL + f""",
rk AS (SELECT *, {q.rank_avg('value', 'factor, date')} AS rf, {q.rank_avg('fwd_1', 'factor, date')} AS rr FROM fdq),
ic AS (SELECT factor, date, {q.nan_null('corr(rf, rr)')} AS ic, count(*) AS breadth FROM rk GROUP BY factor, date)"""


@register("ic_rolling", IC_SQL + """
SELECT factor, date, round(ic, 8) AS ic, round(CASE WHEN count(ic) OVER w = 8 THEN avg(ic) OVER w END, 8) AS ic_roll8
FROM ic WINDOW w AS (PARTITION BY factor ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")
def ic_rolling(spark, sf):
    """Rank IC per date and its rolling 8-date mean (full window)."""
    ic = _of(_fdq(spark, sf), ev.rank_ic, 1).withColumn("ic", nn(F.col("ic")))
    r = ev.rolling_mean_by_date(ic, "ic", 8, out="ic_roll8")
    return r.select("factor", "date", r8("ic"), r8("ic_roll8"))


@register("information_ratio", IC_SQL + """
SELECT factor, round(avg(ic) * sqrt(avg(breadth)), 8) AS ir FROM ic GROUP BY factor""")
def information_ratio(spark, sf):
    """Q20: mean rank IC times sqrt(mean breadth)."""
    d, split = _fdq(spark, sf)
    ic = ev.rank_ic(d, 1, split).withColumn("ic", nn(F.col("ic")))
    br = d.groupBy("factor", "date").agg(F.count(F.lit(1)).alias("breadth"))
    j = ic.join(br, ["factor", "date"])
    return j.groupBy("factor").agg(r8(F.avg("ic") * F.sqrt(F.avg("breadth")), "ir"))


@register("rank_autocorr", FD_SQL + f""",
rk AS (SELECT factor, date, session_idx, asset, {q.rank_avg('value', 'factor, date')} AS rk FROM fd)
SELECT a.factor, a.date, round({q.nan_null('corr(a.rk, b.rk)')}, 8) AS autocorr
FROM rk a JOIN rk b ON a.factor = b.factor AND a.asset = b.asset AND a.session_idx = b.session_idx + 1
GROUP BY a.factor, a.date""")
def rank_autocorr(spark, sf):
    """E5: correlation of factor ranks between consecutive sessions."""
    r = _of(_fd(spark, sf), ev.rank_autocorr)
    return r.select("factor", "date", r8(nn(F.col("autocorr")), "autocorr"))


@register("quantile_returns", FD_SQL + """,
dm AS (SELECT *, fwd_1 - avg(fwd_1) OVER (PARTITION BY factor, date) AS d FROM fdq),
pd_ AS (SELECT factor, date, factor_quantile, avg(d) AS m FROM dm GROUP BY ALL)
SELECT factor, factor_quantile, round(avg(m), 8) AS mean_return,
       round(stddev_samp(m) / sqrt(count(m)), 8) AS std_error FROM pd_ GROUP BY factor, factor_quantile""")
def quantile_returns(spark, sf):
    """De-meaned forward return by quintile; mean and standard error over dates."""
    r = _of(_fdq(spark, sf), ev.quantile_returns, 1)
    return r.select("factor", "factor_quantile", r8("mean_return"), r8("std_error"))


@register("skipped_factors", FD_SQL + """
SELECT factor, count(*) AS n_rows, CAST(count_if(fwd_1 IS NULL OR fwd_2 IS NULL) AS BIGINT) AS n_dropped,
  round(count_if(fwd_1 IS NULL OR fwd_2 IS NULL) / count(*), 8) AS loss,
  CASE WHEN count_if(fwd_1 IS NULL OR fwd_2 IS NULL) / count(*) > 0.2 THEN 'skipped' ELSE 'ok' END AS status
FROM fd GROUP BY factor""")
def skipped_factors(spark, sf):
    """Share of rows lost to missing forward returns; 'skipped' above 20 %."""
    r = ev.skipped_factors(_fd(spark, sf)[0], PERIODS, max_loss=0.2)
    return r.select("factor", "n_rows", "n_dropped", r8("loss"), "status")


@register("factor_split", FD_SQL + """
SELECT factor, CASE WHEN date < DATE '1999-01-01' THEN 'train' ELSE 'test' END AS split,
       count(*) AS n_rows, round(avg(value), 8) AS mean_value FROM fdq GROUP BY ALL""")
def factor_split(spark, sf):
    """Factor data split at a date (train < 1999-01-01 <= test)."""
    d = ev.split_by_date(_fdq(spark, sf)[0], "1999-01-01")
    return d.groupBy("factor", "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                            r8(F.avg("value"), "mean_value"))
