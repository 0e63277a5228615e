"""Time-series jobs W5-W12, W15 per asset over the session index."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import ts
from ..registry import register
from ..sources.panels import with_session
from . import sqlkit as q
from .common import pw, r8

BASE = q.with_(q.PW, q.CAL)


def _p(spark, sf):
    return with_session(pw(spark, sf))


@register("ts_return", BASE + f"""
SELECT date, asset, round({q.returns('close', 5)}, 8) AS ret_4, round({q.returns('close', 2)}, 8) AS ret_1
FROM p""")
def ts_return(spark, sf):
    """1- and 4-session percentage change."""
    return _p(spark, sf).select("date", "asset", r8(ts.returns("close", 5), "ret_4"),
                                r8(ts.returns("close", 2), "ret_1"))


@register("ts_sma", BASE + f"""
SELECT date, asset, round(avg(close) {q.frame(4)}, 6) AS sma_4,
  round(CASE WHEN count(close) {q.frame(4)} = 4 THEN avg(close) {q.frame(4)} END, 6) AS sma_4_full FROM p""")
def ts_sma(spark, sf):
    """4-session mean, missing skipped / full window required."""
    return _p(spark, sf).select("date", "asset", r8(ts.sma("close", 4), "sma_4", 6),
                                r8(ts.sma("close", 4, full=True), "sma_4_full", 6))


@register("ts_roll_sum", BASE + f"""
SELECT date, asset, round({q.roll_sum('volume', 6)}, 4) AS vol_sum_6 FROM p""")
def ts_roll_sum(spark, sf):
    """6-session rolling sum, missing counted as 0."""
    return _p(spark, sf).select("date", "asset", r8(ts.roll_sum("volume", 6), "vol_sum_6", 4))


@register("ts_volatility", q.with_(q.PW, q.CAL, f"r AS (SELECT *, {q.returns('close', 2)} AS ret FROM p)") + f"""
SELECT date, asset, round(stddev_pop(ret) {q.frame(8)} * sqrt(252.0), 8) AS vol_8 FROM r""")
def ts_volatility(spark, sf):
    """W8 / D11 input: 8-session population std of returns, annualised."""
    p = _p(spark, sf).withColumn("ret", ts.returns("close", 2))
    return p.select("date", "asset",
                    r8(ts.roll_std("ret", 8) * math.sqrt(252.0), "vol_8"))


@register("ts_lead", BASE + f"""
SELECT date, asset, round({q.lead('close', 2)}, 4) AS close_lead_2,
       round({q.fwd('close', 2)}, 8) AS fwd_2 FROM p""")
def ts_lead(spark, sf):
    """Close two sessions ahead and the 2-session forward return."""
    return _p(spark, sf).select("date", "asset", r8(ts.lead("close", 2), "close_lead_2", 4),
                                r8(ts.fwd_return("close", 2), "fwd_2"))


@register("ts_cumsum", BASE + """
SELECT date, asset, round(sum(volume) OVER (PARTITION BY asset ORDER BY session_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cum_volume FROM p""")
def ts_cumsum(spark, sf):
    """Running total per asset."""
    return _p(spark, sf).select("date", "asset", r8(ts.cumsum("volume"), "cum_volume", 4))


@register("ts_cumprod", q.with_(q.PW, q.CAL, f"""
r AS (SELECT *, {q.returns('close', 2)} / 100.0 AS ret FROM p)""") + """
SELECT date, asset, round(product(1.0 + ret) OVER (PARTITION BY asset ORDER BY session_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 8) AS growth FROM r""")
def ts_cumprod(spark, sf):
    """Running product of (1 + r) with r = return / 100."""
    p = _p(spark, sf).withColumn("ret", ts.returns("close", 2) / 100.0)
    return p.select("date", "asset", r8(ts.cumprod_1p("ret"), "growth"))


@register("ts_interpolate", q.with_(q.PW, q.CAL, """
x AS (SELECT *, CASE WHEN session_idx % 3 = 1 THEN NULL ELSE close END AS v FROM p)""", """
y AS (SELECT *,
  last_value(v IGNORE NULLS) OVER (PARTITION BY asset ORDER BY session_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN v IS NOT NULL THEN session_idx END IGNORE NULLS) OVER (PARTITION BY asset ORDER BY session_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  first_value(v IGNORE NULLS) OVER (PARTITION BY asset ORDER BY session_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN v IS NOT NULL THEN session_idx END IGNORE NULLS) OVER (PARTITION BY asset ORDER BY session_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni
  FROM x)""") + """
SELECT date, asset, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * (session_idx - pi) / (ni - pi) END, 6) AS close_filled FROM y""")
def ts_interpolate(spark, sf):
    """Every third session's close blanked, then linearly
    interpolated per asset (trailing gaps carried forward)."""
    p = _p(spark, sf).withColumn("v", F.when(F.col("session_idx") % 3 == 1, None)
                                 .otherwise(F.col("close")))
    return p.select("date", "asset", r8(ts.interpolate("v"), "close_filled", 6))
