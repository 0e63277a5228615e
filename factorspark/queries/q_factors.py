"""Alpha-factor jobs (D1-D20) and the flagship rank-IC job."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.xsplit import wide_dates
from ..plans import evaluate as ev
from ..plans import factors as fx
from ..registry import register
from . import sqlkit as q
from .common import WEEKLY, nn, pw, r8


def sql_factor_panel(names, cfg=WEEKLY, fwd_periods=(), src=q.PW) -> str:
    """DuckDB mirror of ``factor_panel``; ends in CTE ``fp``."""
    need = set(names)
    c = cfg
    t1 = [f"{q.roll_sum('close * volume', c.adv_window)} / {float(c.adv_window)} AS adv_u"]
    if need & {"momentum", "momentum_smoothed"}:
        t1.append(f"{q.returns('close', c.mom_window)} AS r_mom")
    if need & {"mean_reversion", "mean_reversion_smoothed"}:
        t1.append(f"{q.returns('close', c.mr_window)} AS r_mr")
    prev = q.lag("close", c.cto_window - 1)
    t1.append(f"(open - {prev}) / NULLIF({prev}, 0) AS cto_raw")
    t1.append(f"stddev_pop(ret_1d) {q.frame(c.vol_window)} * sqrt(252.0) AS vol_raw")
    t1.append(f"{q.roll_sum('close * volume', c.adv_rank_window)} / "
              f"{float(c.adv_rank_window)} AS adv_raw")
    for k in fwd_periods:
        t1.append(f"{q.fwd('close', k, 1)} AS fwd_{k}")
    ctes = [src, q.CAL,
            f"t0 AS (SELECT *, {q.returns('close', 2)} AS ret_1d FROM p)",
            f"t1 AS (SELECT *, {', '.join(t1)} FROM t0)",
            f"c1 AS (SELECT *, {q.top_flag('adv_u', c.top)} AS in_universe FROM t1)"]
    mx = "CASE WHEN in_universe THEN {} END"
    c2 = ["CASE WHEN in_universe THEN cto_raw END AS cto",
          f"{mx.format('vol_raw')} AS vol_x", f"{mx.format('adv_raw')} AS adv_x"]
    if "r_mom" in " ".join(t1):
        c2.append(f"{mx.format('r_mom')} AS mom_x")
    if "r_mr" in " ".join(t1):
        c2.append(f"{mx.format('r_mr')} AS mr_x")
    ctes.append(f"c2 AS (SELECT *, {', '.join(c2)} FROM c1)")
    c3, c4, c5 = ["1 AS _c3"], ["1 AS _c4"], ["1 AS _c5"]
    if "r_mom" in " ".join(t1):
        c3.append(f"{q.demean('mom_x', 'date, sector_code')} AS mom_dm")
        c4.append(f"{q.rank_ord('mom_dm')} AS mom_rk")
        c5.append(f"{q.zscore('mom_rk')} AS momentum")
    if "r_mr" in " ".join(t1):
        c3.append(f"{q.demean('mr_x', 'date, sector_code')} AS mr_dm")
        c4.append(f"{q.rank_ord('mr_dm')} AS mr_rk")
        c5.append(f"-{q.zscore('mr_rk')} AS mean_reversion")
    c4 += [f"{q.rank_ord('vol_x')} AS vol_rk", f"{q.rank_ord('adv_x')} AS adv_rk"]
    c5 += [f"{q.zscore('vol_rk')} AS volatility_rank", f"{q.zscore('adv_rk')} AS adv_rank"]
    ctes += [f"c3 AS (SELECT *, {', '.join(c3)} FROM c2)",
             f"c4 AS (SELECT *, {', '.join(c4)} FROM c3)",
             f"c5 AS (SELECT *, {', '.join(c5)} FROM c4)"]
    t2 = [f"{q.roll_sum('cto', c.trail_window)} AS trailing_overnight"]
    c6 = [f"{q.rank_ord('trailing_overnight')} AS on_rk"]
    c7 = [f"{q.zscore('on_rk')} AS overnight_sentiment"]
    if "r_mom" in " ".join(t1):
        t2.append(f"avg(momentum) {q.frame(c.mom_smooth)} AS mom_sm")
        c6.append(f"{q.rank_ord(mx.format('mom_sm'))} AS ms_rk")
        c7.append(f"{q.zscore('ms_rk')} AS momentum_smoothed")
    if "r_mr" in " ".join(t1):
        t2.append(f"avg(mean_reversion) {q.frame(c.mr_window)} AS mr_sm")
        c6.append(f"{q.rank_ord(mx.format('mr_sm'))} AS mrs_rk")
        c7.append(f"{q.zscore('mrs_rk')} AS mean_reversion_smoothed")
    ctes += [f"t2 AS (SELECT *, {', '.join(t2)} FROM c5)",
             f"c6 AS (SELECT *, {', '.join(c6)} FROM t2)",
             f"c7 AS (SELECT *, {', '.join(c7)} FROM c6)",
             f"t3 AS (SELECT *, avg(overnight_sentiment) {q.frame(c.trail_window)} AS on_sm FROM c7)",
             f"c8 AS (SELECT *, {q.rank_ord('on_sm')} AS os_rk FROM t3)",
             f"c9 AS (SELECT *, {q.zscore('os_rk')} AS overnight_smoothed FROM c8)",
             "mk AS (SELECT session_idx, stddev_pop(CASE WHEN in_universe THEN ret_1d END) AS disp, "
             "avg(ret_1d) AS mkt_ret FROM c9 GROUP BY session_idx)",
             f"mk2 AS (SELECT session_idx, avg(disp) OVER (ORDER BY session_idx RANGE BETWEEN "
             f"{c.disp_window - 1} PRECEDING AND CURRENT ROW) AS market_dispersion, "
             f"stddev_pop(mkt_ret) OVER (ORDER BY session_idx RANGE BETWEEN {c.mvol_window - 1} "
             f"PRECEDING AND CURRENT ROW) * sqrt(252.0) AS market_volatility FROM mk)"]
    cols = ", ".join([f"x.fwd_{k}" for k in fwd_periods] +
                     [f"x.{n}" if n not in ("market_dispersion", "market_volatility")
                      else f"mk2.{n}" for n in fx.ALL_FACTORS if n in need])
    ctes.append("fp AS (SELECT c.date, x.asset, c.session_idx, x.sector_code, x.in_universe, "
                f"x.cto_raw, x.ret_1d, {cols} FROM c9 x LEFT JOIN mk2 ON mk2.session_idx = x.session_idx "
                "JOIN cal c ON c.session_idx = x.session_idx + 1 WHERE x.in_universe)")
    return q.with_(*ctes)


def _factor_job(name):
    def job(spark, sf):
        fp = fx.factor_panel(pw(spark, sf), [name], WEEKLY)
        return fp.select("date", "asset", r8(name))
    job.__name__ = name
    job.__doc__ = f"{name} factor on the weekly supplier panel (universe: top ADV)."
    return job


for _n in ("momentum", "momentum_smoothed", "mean_reversion", "mean_reversion_smoothed",
           "overnight_sentiment", "overnight_smoothed", "volatility_rank", "adv_rank",
           "market_dispersion", "market_volatility"):
    register(_n, sql_factor_panel([_n]) +
             f"\nSELECT date, asset, round(CAST({_n} AS DOUBLE), 8) AS {_n} FROM fp")(_factor_job(_n))


@register("cto", sql_factor_panel(["cto", "trailing_overnight"]) +
          "\nSELECT date, asset, round(cto, 8) AS cto, round(trailing_overnight, 8) "
          "AS trailing_overnight FROM fp")
def cto(spark, sf):
    """Close-to-open return (universe-masked) and its trailing sum."""
    fp = fx.factor_panel(pw(spark, sf), ["cto", "trailing_overnight"], WEEKLY)
    return fp.select("date", "asset", r8("cto"), r8("trailing_overnight"))


def _rank_ic(spark, sf):
    """Flagship: sector-neutral momentum (Returns(5) -> region de-mean ->
    rank -> z, universe = top-50 ADV, stamped next session) evaluated by its
    Spearman rank IC with the next-session return, per date."""
    bars = pw(spark, sf)
    split = wide_dates(bars)
    fp = fx.factor_panel(bars, ["momentum"], WEEKLY, fwd_periods=(1,), split=split)
    fd = ev.factor_data(ev.to_long(fp, ["momentum"], ["fwd_1"]), (1,), quantiles=None, split=split)
    ic = ev.rank_ic(fd, 1, split)
    return ic.select("factor", "date", r8(nn(F.col("ic")), "ic"))


RANK_IC_SQL = sql_factor_panel(["momentum"], fwd_periods=(1,)) + f""",
fd AS (SELECT 'momentum' AS factor, date, asset, momentum AS value, fwd_1 FROM fp
       WHERE momentum IS NOT NULL AND fwd_1 IS NOT NULL),
r AS (SELECT *, {q.rank_avg('value', 'factor, date')} AS rf,
             {q.rank_avg('fwd_1', 'factor, date')} AS rr FROM fd)
SELECT factor, date, round({q.nan_null('corr(rf, rr)')}, 8) AS ic FROM r GROUP BY factor, date"""

register("rank_ic", RANK_IC_SQL)(_rank_ic)


@register("universe_adv_topn", q.with_(q.PW, q.CAL, f"""
u AS (SELECT date, asset, {q.roll_sum('close * volume', 4)} / 4.0 AS adv FROM p)""") + f"""
SELECT date, asset, round(adv, 4) AS adv FROM (SELECT *, {q.top_flag('adv', 20)} AS keep FROM u)
WHERE keep""")
def universe_adv_topn(spark, sf):
    """The 20 largest-ADV assets of each session (4-session ADV)."""
    u = fx.universe_screen(pw(spark, sf), 4, 20)
    return u.filter("in_universe").select("date", "asset", r8("adv", d=4))


@register("returns_masked", sql_factor_panel(["momentum"]).replace(
    "x.cto_raw, x.ret_1d,", "x.cto_raw, x.ret_1d, x.r_mom,") +
    "\nSELECT date, asset, round(r_mom, 8) AS ret FROM fp")
def returns_masked(spark, sf):
    """Returns(5) masked to the universe, stamped with the next session (M1)."""
    bars = pw(spark, sf)
    fp = fx.factor_panel(bars, ["momentum"], WEEKLY, keep=("r_mom",))
    return fp.select("date", "asset", r8("r_mom", "ret"))


_COMBO = ["momentum_smoothed", "mean_reversion_smoothed", "overnight_smoothed"]


@register("avg_combo", sql_factor_panel(_COMBO) + """
SELECT date, asset, round((coalesce(momentum_smoothed, 0) + coalesce(mean_reversion_smoothed, 0)
  + coalesce(overnight_smoothed, 0)) / NULLIF(CAST(momentum_smoothed IS NOT NULL AS INT)
  + CAST(mean_reversion_smoothed IS NOT NULL AS INT) + CAST(overnight_smoothed IS NOT NULL AS INT), 0), 8)
  AS avg_combo FROM fp""")
def avg_combo(spark, sf):
    """Row mean of the three smoothed alphas."""
    fp = fx.factor_panel(pw(spark, sf), _COMBO, WEEKLY)
    return fx.avg_combo(fp, _COMBO).select("date", "asset", r8("avg_combo"))


@register("sector_neutral", sql_factor_panel(["momentum_smoothed"]) + f"""
SELECT date, asset, round({q.demean('momentum_smoothed', 'date, sector_code')}, 8)
  AS momentum_smoothed_sector_neutral FROM fp""")
def sector_neutral(spark, sf):
    """Smoothed momentum minus its (date, sector) mean."""
    bars = pw(spark, sf)
    split = wide_dates(bars)
    out = fx.sector_neutral(fx.factor_panel(bars, ["momentum_smoothed"], WEEKLY, split=split), "momentum_smoothed",
                            split=split)
    return out.select("date", "asset", r8("momentum_smoothed_sector_neutral"))


def _cut_sql(x, bins, by="date"):
    lo = f"min({x}) OVER (PARTITION BY {by})"
    hi = f"max({x}) OVER (PARTITION BY {by})"
    mid = -(-bins // 2) - 1
    return (f"CAST(CASE WHEN {x} IS NULL THEN NULL WHEN {hi} = {lo} THEN {mid} ELSE "
            f"least({bins - 1}, greatest(0, ceil(round({bins} * ({x} - {lo}) / ({hi} - {lo}), 9)) - 1)) END AS INTEGER)")


@register("factor_alpha_binned", sql_factor_panel(["momentum"]) + f""",
b AS (SELECT date, asset, {_cut_sql('momentum', 7)} AS bin FROM fp)
SELECT date, asset, bin, round({q.zscore('CAST(bin AS DOUBLE)', ddof=1)}, 8) AS momentum_binned FROM b""")
def factor_alpha_binned(spark, sf):
    """Momentum cut into 7 equal-width bins per date, sample z of the bin."""
    bars = pw(spark, sf)
    split = wide_dates(bars)
    out = fx.binned_alpha(fx.factor_panel(bars, ["momentum"], WEEKLY, split=split), "momentum", 7, split=split)
    return out.select("date", "asset", F.col("momentum_binned_bin").alias("bin"),
                      r8("momentum_binned"))


@register("stepwise_chain", q.with_(q.PW, q.CAL, f"""
a AS (SELECT *, {q.returns('close', 2)} AS raw FROM p)""", f"""
b AS (SELECT *, {q.demean('raw', 'date, sector_code')} AS demeaned FROM a)""", f"""
c AS (SELECT *, {q.rank_ord('demeaned')} AS ranked FROM b)""", f"""
d AS (SELECT *, {q.zscore('ranked')} AS zscored FROM c)""", f"""
e AS (SELECT *, avg(zscored) {q.frame(5)} AS smoothed FROM d)""") + """
SELECT date, asset, round(raw, 8) AS raw, round(demeaned, 8) AS demeaned, ranked,
       round(zscored, 8) AS zscored, round(smoothed, 8) AS smoothed FROM e""")
def stepwise_chain(spark, sf):
    """1-session return -> sector de-mean -> rank -> z -> 5-session mean."""
    s = fx.stepwise_one_day(pw(spark, sf))
    return s.select("date", "asset", r8("raw"), r8("demeaned"), "ranked", r8("zscored"),
                    r8("smoothed"))
