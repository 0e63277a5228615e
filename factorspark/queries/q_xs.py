"""Cross-section jobs W1-W4, W13, W14, W16 on 1-session returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ts, xsplit
from ..registry import register
from ..sources.panels import with_session
from . import sqlkit as q
from .common import pw, rd

RET = q.with_(q.PW, q.CAL, f"r AS (SELECT date, asset, sector_code, session_idx, "
              f"{q.returns('close', 2)} AS ret FROM p)")


def _ret(spark, sf):
    """Returns, and whether their dates are too large for a task."""
    bars = pw(spark, sf)
    split = xsplit.wide_dates(bars)
    r = with_session(bars).withColumn("ret", ts.returns("close", 2))
    return (r if split else r.repartition("date")), split


def _xs(name, step, sql_expr, doc, digits=False, **how):
    def job(spark, sf):
        r, split = _ret(spark, sf)
        out = step(r, name, "ret", split=split, **how)
        return out.select("date", "asset", rd(F.col(name)).alias(name) if digits else name)
    job.__doc__ = doc
    register(name, RET + f"\nSELECT date, asset, {sql_expr} AS {name} FROM r")(job)


_xs("xs_demean", xsplit.demean, f"round({q.demean('ret', 'date, sector_code')}, 8)",
    "W1: return minus (date, sector) mean.", True, by=["date", "sector_code"])
_xs("xs_rank_ordinal", xsplit.rank_ordinal, q.rank_ord("ret"), "W2: ordinal rank per date, ties by asset.")
_xs("xs_rank_average", xsplit.rank_average, q.rank_avg("ret"), "W3: average-tie rank per date.")
_xs("xs_zscore_pop", xsplit.zscore, f"round({q.zscore('ret')}, 8)", "W4: population z-score per date.", True)
_xs("xs_zscore_samp", xsplit.zscore, f"round({q.zscore('ret', ddof=1)}, 8)", "W4: sample z-score per date.", True,
    ddof=1)
_xs("xs_top_n", xsplit.top_n_flag, q.top_flag("ret", 10), "W16: flag of the 10 largest returns per date.", n=10)


@register("xs_qcut", RET + """,
e AS (SELECT *, quantile_cont(ret, [0.2, 0.4, 0.6, 0.8]) OVER (PARTITION BY date) AS edges FROM r)
SELECT date, asset, CASE WHEN ret IS NOT NULL THEN CAST(1 + list_sum([CASE WHEN ret > x THEN 1 ELSE 0 END
  FOR x IN edges]) AS INTEGER) END AS xs_qcut FROM e""")
def xs_qcut(spark, sf):
    """Quintile 1..5 per date with interpolated, right-closed edges."""
    r, split = _ret(spark, sf)
    return xsplit.qcut(r, "xs_qcut", "ret", 5, split=split).select("date", "asset", "xs_qcut")


@register("xs_cut", RET + f"""
SELECT date, asset, CAST(CASE WHEN ret IS NULL THEN NULL
  WHEN max(ret) OVER (PARTITION BY date) = min(ret) OVER (PARTITION BY date) THEN 4
  ELSE least(9, greatest(0, ceil(round(10 * (ret - min(ret) OVER (PARTITION BY date))
       / (max(ret) OVER (PARTITION BY date) - min(ret) OVER (PARTITION BY date)), 9)) - 1)) END AS INTEGER)
  AS xs_cut FROM r""")
def xs_cut(spark, sf):
    """10 equal-width bins per date (0-based, right-closed)."""
    r, split = _ret(spark, sf)
    return xsplit.cut(r, "xs_cut", "ret", 10, split=split).select("date", "asset", "xs_cut")
