"""Portfolio construction audit, costs, back-test PnL and book statistics
(Q1-Q11, Q13, Q16-Q20).  Weights are a long table
``(port_name, date, session_idx, asset, w)``; every portfolio and date is
processed in one job (the reference's per-date Python loop becomes joins on
the session index)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ts, xsplit
from ..session import small_dim
from ..sources.panels import CALENDAR_BOUND

COST_SCALE = 0.1
# The reference's cost and book constants (ADV floor, cost factor
# 0.1, side labels, weight bound 0.55).
ADV_FLOOR = 1e4


def target_weights(alpha: DataFrame, value: str = "alpha", port: str = "port_name",
                   split: bool = False) -> DataFrame:
    """Q1: (alpha - mean alpha) / sum |alpha - mean alpha| per portfolio and date."""
    d = alpha if split else alpha.repartition(port, "date")
    return xsplit.share_of_abs(d, "w", value, [port, "date"], split)


def adv_table(p: DataFrame, window: int, floor: float = ADV_FLOOR) -> DataFrame:
    """Q7: mean close*volume over a full window of sessions (B1, B2 fixed)
    and the clipped value used for costs."""
    adv = ts.sma(F.col("close") * F.col("volume"), window, full=True)
    return p.select("asset", "session_idx", adv.alias("adv")).withColumn(
        "adv_clip", F.greatest(F.coalesce(F.col("adv"), F.lit(floor)), F.lit(floor)))


def session_returns(p: DataFrame) -> DataFrame:
    """1-session return of each asset on each session."""
    return p.select("asset", "session_idx", ts.returns("close", 2).alias("r"))


def _pairs(w: DataFrame) -> DataFrame:
    """Full outer join of each session's weights with the previous session's
    (J5): an asset that leaves or enters the book counts with weight 0."""
    prev = w.select("port_name", (F.col("session_idx") + 1).alias("session_idx"), "asset",
                    F.col("w").alias("w_prev"))
    cur = w.select("port_name", "session_idx", "asset", "w")
    j = cur.join(prev, ["port_name", "session_idx", "asset"], "full_outer")
    return j.select("port_name", "session_idx", "asset", F.coalesce("w", F.lit(0.0)).alias("w"),
                    F.coalesce("w_prev", F.lit(0.0)).alias("w_prev"))


def trans_cost(w: DataFrame, adv: DataFrame, scale: float = COST_SCALE) -> DataFrame:
    """Q5 / Q6: sum over the union of assets of (w_prev - w)^2 * 0.1 / adv,
    a positive cost (B4 fixed); sessions of the weight table only."""
    base = w.select("port_name", "session_idx").distinct()
    j = _pairs(w).join(base, ["port_name", "session_idx"], "left_semi") \
        .join(adv.select("asset", "session_idx", "adv_clip"), ["asset", "session_idx"], "left")
    coef = F.lit(scale) / F.coalesce(F.col("adv_clip"), F.lit(ADV_FLOOR))
    return j.groupBy("port_name", "session_idx").agg(
        F.sum((F.col("w_prev") - F.col("w")) ** 2 * coef).alias("daily_transaction_cost"))


def turnover(w: DataFrame) -> DataFrame:
    """Q19: sum |w_t - w_{t-1}| per portfolio and session."""
    base = w.select("port_name", "session_idx").distinct()
    return (_pairs(w).join(base, ["port_name", "session_idx"], "left_semi")
            .groupBy("port_name", "session_idx")
            .agg(F.sum(F.abs(F.col("w") - F.col("w_prev"))).alias("turnover")))


def backtest_pnl(w: DataFrame, rets: DataFrame, adv: DataFrame, cal: DataFrame,
                 delay: int = 1) -> DataFrame:
    """Q8: weights held at session t earn the returns of session t + delay;
    the cost of moving into them is subtracted; running totals per portfolio.
    Sessions without a (t + delay) session are dropped."""
    pnl = (w.join(rets.withColumn("session_idx", F.col("session_idx") - delay),
                  ["asset", "session_idx"], "left")
           .groupBy("port_name", "session_idx")
           .agg(F.coalesce(F.sum(F.col("w") * F.col("r")), F.lit(0.0)).alias("daily_pnl")))
    calb = small_dim(cal, CALENDAR_BOUND)
    rd = calb.select((F.col("session_idx") - delay).alias("session_idx"),
                     F.col("date").alias("returns_date"))
    t = (pnl.join(trans_cost(w, adv), ["port_name", "session_idx"])
         .join(calb, "session_idx").join(rd, "session_idx"))
    t = t.withColumn("daily_total", F.col("daily_pnl") - F.col("daily_transaction_cost"))
    run = Window.partitionBy("port_name").orderBy("session_idx") \
        .rowsBetween(Window.unboundedPreceding, 0)   # one row per (portfolio, session)
    return t.select("port_name", "date", "session_idx", "returns_date", "daily_pnl",
                    "daily_transaction_cost", "daily_total",
                    F.sum("daily_total").over(run).alias("accum_total"),
                    F.sum("daily_transaction_cost").over(run).alias("accum_transaction_cost"))


def factor_exposure(w: DataFrame, betas: DataFrame) -> DataFrame:
    """Q10 / Q11: B'w per portfolio, date and factor k."""
    return (w.join(betas, "asset").groupBy("port_name", "date", "k")
            .agg(F.sum(F.col("beta") * F.col("w")).alias("exposure")))


def book_value(w: DataFrame) -> DataFrame:
    """Q18: gross, net, long and short book per portfolio and date."""
    x = F.col("w")
    return w.groupBy("port_name", "date").agg(
        F.sum(F.abs(x)).alias("gross"), F.sum(x).alias("net"),
        F.coalesce(F.sum(F.when(x > 0, x)), F.lit(0.0)).alias("long"),
        F.coalesce(F.sum(F.when(x < 0, x)), F.lit(0.0)).alias("short"))


def weights_pnl_join(w: DataFrame, pnl: DataFrame, rets: DataFrame, delay: int = 1) -> DataFrame:
    """Weights with the portfolio PnL of the date and the asset's
    delayed return; asset PnL, position side and absolute weight."""
    j = (w.join(pnl.select("port_name", "session_idx", "returns_date", "daily_pnl"),
                ["port_name", "session_idx"])
         .join(rets.withColumn("session_idx", F.col("session_idx") - delay),
               ["asset", "session_idx"], "left"))
    return j.withColumns({"asset_pnl": F.coalesce(F.col("w") * F.col("r"), F.lit(0.0)),
                          # |w| <= 1e-12 is a flat (float noise), reported short
                          "position": F.when(F.col("w") > 1e-12, "1.long").otherwise("2.short"),
                          "abs_w": F.abs("w")})


def constraint_audit(w: DataFrame, exposures: DataFrame, risk: DataFrame | None = None,
                     risk_cap: float = 0.05, factor_bound: float = 10.0,
                     weight_bound: float = 0.55) -> DataFrame:
    """Q2: the optimiser's constraints checked on any weight table, one row per
    (portfolio, date, check_name): value, bound and ok."""
    tol = 1e-9
    per = w.groupBy("port_name", "date").agg(
        F.max("w").alias("w_max"), F.min("w").alias("w_min"),
        F.sum(F.abs("w")).alias("gross"), F.sum("w").alias("net"))
    rows = [
        ("weight_max", F.col("w_max"), F.lit(weight_bound), F.col("w_max") <= weight_bound + tol),
        ("weight_min", F.col("w_min"), F.lit(-weight_bound), F.col("w_min") >= -weight_bound - tol),
        ("gross_le_1", F.col("gross"), F.lit(1.0), F.col("gross") <= 1.0 + tol),
        ("net_zero", F.col("net"), F.lit(0.0), F.abs(F.col("net")) <= 1e-6)]
    out = per.select("port_name", "date", F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), v.cast("double").alias("value"),
                 lim.cast("double").alias("bound"), ok.alias("ok")) for n, v, lim, ok in rows])).alias("c"))
    out = out.select("port_name", "date", "c.*")
    ex = exposures.groupBy("port_name", "date").agg(F.max(F.abs("exposure")).alias("v")).select(
        "port_name", "date", F.lit("factor_exposure").alias("check_name"), F.col("v").alias("value"),
        F.lit(factor_bound).alias("bound"), (F.col("v") <= factor_bound).alias("ok"))
    out = out.unionByName(ex)
    if risk is not None:
        rk = risk.select("port_name", "date", F.lit("risk").alias("check_name"),
                         (F.col("risk") ** 2).alias("value"), F.lit(risk_cap ** 2).alias("bound"),
                         (F.col("risk") ** 2 <= risk_cap ** 2).alias("ok"))
        out = out.unionByName(rk)
    return out


def objective_score(w: DataFrame, alpha: DataFrame, cost: DataFrame, lam: float = 0.5) -> DataFrame:
    """Q4: -alpha.w + lambda * ||w||_2 + cost per portfolio and session."""
    s = (w.join(alpha.select("port_name", "session_idx", "asset", "alpha"),
                ["port_name", "session_idx", "asset"])
         .groupBy("port_name", "session_idx")
         .agg((-F.sum(F.col("alpha") * F.col("w"))).alias("neg_alpha"),
              F.sqrt(F.sum(F.col("w") ** 2)).alias("l2")))
    return s.join(cost, ["port_name", "session_idx"], "left").withColumn(
        "objective", F.col("neg_alpha") + F.lit(lam) * F.col("l2")
        + F.coalesce(F.col("daily_transaction_cost"), F.lit(0.0)))
