"""Portfolio, back-test and attribution jobs (Q1-Q20) on momentum and
mean-reversion weights over the weekly supplier panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import xs
from ..operators.xsplit import wide_dates
from ..plans import factors as fx
from ..plans import portfolio as pf
from ..plans import risk as rk
from ..plans.evaluate import to_long
from ..registry import register
from ..session import cut_lineage
from ..sources.panels import calendar, with_session
from . import sqlkit as q
from .common import WEEKLY, pw, r8
from .q_factors import sql_factor_panel

PORTS = ["momentum", "mean_reversion"]
ADV_W = 4


class Book:
    """Shared Spark inputs: panel with session index, weights, returns, ADV."""

    def __init__(self, spark, sf):
        bars = pw(spark, sf)
        self.cal = calendar(bars)
        self.p = with_session(bars, self.cal)
        split = wide_dates(bars)
        fp = cut_lineage(fx.factor_panel(bars, PORTS, WEEKLY, split=split))
        self.sectors = fp.select("date", "asset", "sector_code")
        al = to_long(fp, PORTS, []).select(F.col("factor").alias("port_name"), "date", "session_idx",
                                           "asset", F.col("value").alias("alpha"))
        # the factor panel and the holdings are read by several joins of the
        # back-test, cost, exposure and attribution plans: write them once;
        # returns and ADV are single window passes over the stored bars
        self.alpha = al
        self.w = cut_lineage(pf.target_weights(self.alpha, split=split)
                             .select("port_name", "date", "session_idx", "asset", "w"))
        self.rets = pf.session_returns(self.p)
        self.adv = pf.adv_table(self.p, ADV_W)

    def pnl(self):
        return pf.backtest_pnl(self.w, self.rets, self.adv, self.cal, delay=1)


BOOK_SQL = sql_factor_panel(PORTS) + f""",
al AS (SELECT 'momentum' AS port_name, date, session_idx, asset, momentum AS alpha FROM fp WHERE momentum IS NOT NULL
       UNION ALL SELECT 'mean_reversion', date, session_idx, asset, mean_reversion FROM fp WHERE mean_reversion IS NOT NULL),
wd AS (SELECT *, alpha - avg(alpha) OVER (PARTITION BY port_name, date) AS dm FROM al),
wts AS (SELECT port_name, date, session_idx, asset, dm / NULLIF(sum(abs(dm)) OVER (PARTITION BY port_name, date), 0) AS w FROM wd),
rets AS (SELECT asset, session_idx, {q.returns('close', 2)} AS r FROM p),
advt AS (SELECT asset, session_idx, greatest(coalesce(CASE WHEN count(close * volume) {q.frame(ADV_W)} = {ADV_W}
           THEN avg(close * volume) {q.frame(ADV_W)} END, 1e4), 1e4) AS adv_clip FROM p),
base AS (SELECT DISTINCT port_name, session_idx FROM wts),
pairs AS (SELECT coalesce(a.port_name, b.port_name) AS port_name, coalesce(a.session_idx, b.session_idx + 1) AS session_idx,
            coalesce(a.asset, b.asset) AS asset, coalesce(a.w, 0) AS w, coalesce(b.w, 0) AS w_prev
          FROM wts a FULL OUTER JOIN wts b ON a.port_name = b.port_name AND a.asset = b.asset AND a.session_idx = b.session_idx + 1),
tc AS (SELECT x.port_name, x.session_idx, sum((w_prev - w) ^ 2 * 0.1 / coalesce(adv_clip, 1e4)) AS daily_transaction_cost
       FROM pairs x SEMI JOIN base USING (port_name, session_idx) LEFT JOIN advt USING (asset, session_idx) GROUP BY ALL),
pl AS (SELECT w.port_name, w.session_idx, coalesce(sum(w.w * r.r), 0) AS daily_pnl FROM wts w
       LEFT JOIN rets r ON r.asset = w.asset AND r.session_idx = w.session_idx + 1 GROUP BY ALL),
pnl0 AS (SELECT pl.port_name, c.date, pl.session_idx, c2.date AS returns_date, daily_pnl, daily_transaction_cost,
           daily_pnl - daily_transaction_cost AS daily_total
         FROM pl JOIN tc USING (port_name, session_idx) JOIN cal c ON c.session_idx = pl.session_idx
         JOIN cal c2 ON c2.session_idx = pl.session_idx + 1),
pnl AS (SELECT *, sum(daily_total) OVER (PARTITION BY port_name ORDER BY session_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS accum_total,
          sum(daily_transaction_cost) OVER (PARTITION BY port_name ORDER BY session_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS accum_transaction_cost FROM pnl0)"""


@register("target_weights", BOOK_SQL + "\nSELECT port_name, date, asset, round(w, 8) AS w FROM wts")
def target_weights(spark, sf):
    """Q1: (alpha - mean) / sum|alpha - mean| per portfolio and date."""
    return Book(spark, sf).w.select("port_name", "date", "asset", r8("w"))


@register("adv_table", BOOK_SQL + "\nSELECT asset, session_idx, round(adv_clip, 4) AS adv_clip FROM advt")
def adv_table(spark, sf):
    """Q7: 4-session ADV (close * volume) with the 1e4 floor."""
    return Book(spark, sf).adv.select("asset", "session_idx", r8("adv_clip", d=4))


@register("trans_cost", BOOK_SQL + """
SELECT port_name, session_idx, round(daily_transaction_cost, 8) AS daily_transaction_cost FROM tc""")
def trans_cost(spark, sf):
    """Q5 / Q6: quadratic transaction cost between consecutive sessions."""
    b = Book(spark, sf)
    return pf.trans_cost(b.w, b.adv).select("port_name", "session_idx", r8("daily_transaction_cost"))


@register("backtest_pnl", BOOK_SQL + """
SELECT port_name, date, returns_date, round(daily_pnl, 8) AS daily_pnl,
  round(daily_transaction_cost, 8) AS daily_transaction_cost, round(daily_total, 8) AS daily_total,
  round(accum_total, 6) AS accum_total, round(accum_transaction_cost, 6) AS accum_transaction_cost FROM pnl""")
def backtest_pnl(spark, sf):
    """Q8: PnL of the weight tables with a one-session delay, net of costs."""
    p = Book(spark, sf).pnl()
    return p.select("port_name", "date", "returns_date", r8("daily_pnl"), r8("daily_transaction_cost"),
                    r8("daily_total"), r8("accum_total", d=6), r8("accum_transaction_cost", d=6))


@register("portfolio_summary", BOOK_SQL + """
SELECT port_name, count(*) AS n, round(avg(daily_total), 8) AS mean_total, round(stddev_samp(daily_total), 8) AS std_total,
  round(max_by(accum_total, session_idx), 6) AS last_accum_total,
  round(avg(daily_total) / NULLIF(stddev_samp(daily_total), 0) * sqrt(52.0), 8) AS sharpe FROM pnl GROUP BY port_name""")
def portfolio_summary(spark, sf):
    """Stacked portfolios: count, mean, std, last cumulative
    total and annualised Sharpe per portfolio."""
    p = Book(spark, sf).pnl()
    import math
    return p.groupBy("port_name").agg(
        F.count(F.lit(1)).alias("n"), r8(F.avg("daily_total"), "mean_total"),
        r8(F.stddev_samp("daily_total"), "std_total"),
        r8(F.max_by("accum_total", "session_idx"), "last_accum_total", 6),
        r8(F.try_divide(F.avg("daily_total"), F.stddev_samp("daily_total")) * math.sqrt(52.0), "sharpe"))


@register("turnover", BOOK_SQL + """
SELECT port_name, session_idx, round(sum(abs(w - w_prev)), 8) AS turnover
FROM pairs SEMI JOIN base USING (port_name, session_idx) GROUP BY ALL""")
def turnover(spark, sf):
    """Q19: sum |w_t - w_{t-1}| per portfolio and session."""
    return pf.turnover(Book(spark, sf).w).select("port_name", "session_idx", r8("turnover"))


@register("book_value", BOOK_SQL + """
SELECT port_name, date, round(sum(abs(w)), 8) AS gross, round(sum(w), 8) AS net,
  round(coalesce(sum(CASE WHEN w > 0 THEN w END), 0), 8) AS long, round(coalesce(sum(CASE WHEN w < 0 THEN w END), 0), 8) AS short
FROM wts GROUP BY ALL""")
def book_value(spark, sf):
    """Q18: gross, net, long and short book."""
    b = pf.book_value(Book(spark, sf).w)
    return b.select("port_name", "date", *[r8(c) for c in ("gross", "net", "long", "short")])


BETA_SQL = f""",
vz AS (SELECT asset, {q.zscore('volume')} AS z, close / NULLIF(open, 0) AS co FROM bars),
betas AS (SELECT asset, 0 AS k, avg(z) AS beta FROM vz GROUP BY asset
          UNION ALL SELECT asset, 1, avg(co) - 1 FROM vz GROUP BY asset)"""


@register("factor_exposure", BOOK_SQL + BETA_SQL + """
SELECT port_name, date, k, round(sum(beta * w), 8) AS exposure FROM wts JOIN betas USING (asset) GROUP BY ALL""")
def factor_exposure(spark, sf):
    """Q10: B'w per portfolio, date and risk factor."""
    from .q_risk import given_betas
    b = Book(spark, sf)
    e = pf.factor_exposure(b.w, given_betas(b.p))
    return e.select("port_name", "date", "k", r8("exposure"))


@register("alpha_exposure", BOOK_SQL + """,
ab AS (SELECT asset, date, 'momentum' AS k, momentum AS beta FROM fp UNION ALL
       SELECT asset, date, 'mean_reversion', mean_reversion FROM fp)
SELECT port_name, date, k, round(sum(beta * w), 8) AS exposure
FROM wts JOIN ab USING (asset, date) WHERE beta IS NOT NULL GROUP BY ALL""")
def alpha_exposure(spark, sf):
    """Q11: exposure of each portfolio to each alpha factor (B_alpha' w)."""
    b = Book(spark, sf)
    ab = b.alpha.select("asset", "date", F.col("port_name").alias("k"), F.col("alpha").alias("beta"))
    j = b.w.join(ab, ["asset", "date"])
    return j.groupBy("port_name", "date", "k").agg(r8(F.sum(F.col("beta") * F.col("w")), "exposure"))


@register("weights_pnl_join", BOOK_SQL + """
SELECT w.port_name, w.date, w.asset, p.returns_date, round(p.daily_pnl, 8) AS daily_pnl,
  round(coalesce(w.w * r.r, 0), 8) AS asset_pnl, CASE WHEN w.w > 1e-12 THEN '1.long' ELSE '2.short' END AS position,
  round(abs(w.w), 8) AS abs_w
FROM wts w JOIN pnl p USING (port_name, session_idx)
LEFT JOIN rets r ON r.asset = w.asset AND r.session_idx = w.session_idx + 1""")
def weights_pnl_join(spark, sf):
    """Weights joined with portfolio PnL and delayed asset returns."""
    b = Book(spark, sf)
    j = pf.weights_pnl_join(b.w, b.pnl(), b.rets)
    return j.select("port_name", "date", "asset", "returns_date", r8("daily_pnl"), r8("asset_pnl"),
                    "position", r8("abs_w"))


@register("reconciliation", BOOK_SQL + """,
ap AS (SELECT w.port_name, w.session_idx, sum(coalesce(w.w * r.r, 0)) AS s FROM wts w
       LEFT JOIN rets r ON r.asset = w.asset AND r.session_idx = w.session_idx + 1 GROUP BY ALL)
SELECT p.port_name, count(*) AS n_dates, bool_and(abs(ap.s - p.daily_pnl) < 1e-9) AS ok
FROM pnl p JOIN ap USING (port_name, session_idx) GROUP BY p.port_name""")
def reconciliation(spark, sf):
    """Q16: the asset PnLs of every date add up to the portfolio PnL."""
    b = Book(spark, sf)
    j = pf.weights_pnl_join(b.w, b.pnl(), b.rets)
    s = j.groupBy("port_name", "session_idx").agg(F.sum("asset_pnl").alias("s"),
                                                  F.first("daily_pnl").alias("daily_pnl"))
    return s.groupBy("port_name").agg(F.count(F.lit(1)).alias("n_dates"),
                                      F.bool_and(F.abs(F.col("s") - F.col("daily_pnl")) < 1e-9).alias("ok"))


@register("sector_performance", BOOK_SQL + """,
sp AS (SELECT w.port_name, w.date, f.sector_code, w.session_idx,
         sum(CASE WHEN w.w > 0 THEN w.w ELSE 0 END) AS long_exposure, sum(CASE WHEN w.w < 0 THEN w.w ELSE 0 END) AS short_exposure,
         sum(coalesce(w.w * r.r, 0)) AS pnl
       FROM wts w JOIN fp f USING (date, asset) LEFT JOIN rets r ON r.asset = w.asset AND r.session_idx = w.session_idx + 1
       GROUP BY ALL)
SELECT port_name, date, sector_code, round(long_exposure, 8) AS long_exposure, round(short_exposure, 8) AS short_exposure,
  round(pnl, 8) AS pnl, round(sum(pnl) OVER (PARTITION BY port_name, sector_code ORDER BY session_idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_pnl FROM sp""")
def sector_performance(spark, sf):
    """Q17: long/short exposure and PnL per sector and date; cumulative PnL
    partitioned by sector (B13 fixed)."""
    from pyspark.sql import Window
    b = Book(spark, sf)
    j = (b.w.join(b.sectors, ["date", "asset"])
         .join(b.rets.withColumn("session_idx", F.col("session_idx") - 1), ["asset", "session_idx"], "left"))
    x = F.col("w")
    sp = j.groupBy("port_name", "date", "sector_code", "session_idx").agg(
        F.sum(F.when(x > 0, x).otherwise(0.0)).alias("long_exposure"),
        F.sum(F.when(x < 0, x).otherwise(0.0)).alias("short_exposure"),
        F.sum(F.coalesce(x * F.col("r"), F.lit(0.0))).alias("pnl"))
    run = Window.partitionBy("port_name", "sector_code").orderBy("session_idx") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return sp.select("port_name", "date", "sector_code", r8("long_exposure"), r8("short_exposure"),
                     r8("pnl"), r8(F.sum("pnl").over(run), "cum_pnl", 6))


@register("asset_performance_top", BOOK_SQL + """,
ap AS (SELECT w.port_name, w.asset, sum(coalesce(w.w * r.r, 0)) AS pnl, avg(abs(w.w)) AS avg_abs_w FROM wts w
       LEFT JOIN rets r ON r.asset = w.asset AND r.session_idx = w.session_idx + 1 GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY port_name ORDER BY round(pnl, 10) DESC, asset) AS rn FROM ap)
SELECT port_name, asset, round(pnl, 8) AS pnl, round(avg_abs_w, 8) AS avg_abs_w FROM rk WHERE rn <= 25""")
def asset_performance_top(spark, sf):
    """A2 / O3: total PnL per asset, the 25 best per portfolio (top-k report)."""
    b = Book(spark, sf)
    j = b.w.join(b.rets.withColumn("session_idx", F.col("session_idx") - 1), ["asset", "session_idx"], "left")
    ap = j.groupBy("port_name", "asset").agg(
        F.sum(F.coalesce(F.col("w") * F.col("r"), F.lit(0.0))).alias("pnl"),
        F.avg(F.abs("w")).alias("avg_abs_w"))
    top = ap.withColumn("keep", xs.top_n_flag("pnl", 25, "port_name")).filter("keep")
    return top.select("port_name", "asset", r8("pnl"), r8("avg_abs_w"))


@register("objective_score", BOOK_SQL + """,
sc AS (SELECT port_name, session_idx, -sum(alpha * w) AS neg_alpha, sqrt(sum(w * w)) AS l2
       FROM wts JOIN al USING (port_name, session_idx, asset) GROUP BY ALL)
SELECT port_name, session_idx, round(neg_alpha + 0.5 * l2 + coalesce(daily_transaction_cost, 0), 8) AS objective
FROM sc LEFT JOIN tc USING (port_name, session_idx)""")
def objective_score(spark, sf):
    """Q4: optimiser objective -alpha.w + 0.5 ||w||_2 + cost of a weight table."""
    b = Book(spark, sf)
    s = pf.objective_score(b.w, b.alpha, pf.trans_cost(b.w, b.adv))
    return s.select("port_name", "session_idx", r8("objective"))
