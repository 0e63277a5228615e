"""Alpha factors D1-D20 as phased window plans over a bar panel.

Work alternates between per-asset time-series windows and per-date
cross-section windows.  ``factor_panel`` computes any subset of the factors
in as few phases as the dependencies allow (ts -> cs -> ts -> cs ...), so all
requested factors share each exchange.  Catalyst prunes window expressions
that the final projection does not use.

Conventions (SURVEY 1.4): M1 - a factor stamped with session t uses data
through t-1 (``restamp``); M2 - ``Returns(n)`` is an (n-1)-session change;
M5 - mean reversion negates the final z-score; z-scores are population.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ts, xs, xsplit
from ..session import small_dim
from ..sources.panels import CALENDAR_BOUND, calendar, with_session

SQRT_252 = math.sqrt(252.0)

ALL_FACTORS = (
    "momentum", "momentum_smoothed", "mean_reversion", "mean_reversion_smoothed",
    "cto", "trailing_overnight", "overnight_sentiment", "overnight_smoothed",
    "volatility_rank", "adv_rank", "market_dispersion", "market_volatility",
)


@dataclass
class FactorConfig:
    adv_window: int = 120          # universe ADV window (sessions)
    top: int = 500                 # universe size
    use_universe: bool = True
    mom_window: int = 252
    mom_smooth: int = 5
    mr_window: int = 5
    cto_window: int = 2
    trail_window: int = 5
    vol_window: int = 20
    adv_rank_window: int = 20
    disp_window: int = 20
    mvol_window: int = 20
    restamp: bool = True           # M1
    screen: bool = True            # keep only universe rows in the output
    sector_col: str = "sector_code"


def universe_columns(cfg: FactorConfig) -> dict:
    """D1 inputs: average dollar volume over the window, missing counted as 0."""
    return {"adv_u": ts.roll_sum(F.col("close") * F.col("volume"), cfg.adv_window)
            / float(cfg.adv_window)}


def market_series(p: DataFrame, cfg: FactorConfig, need: set[str]) -> DataFrame | None:
    """D13 / D14 on the date table (one row per session), then joined back."""
    if not ({"market_dispersion", "market_volatility"} & need):
        return None
    d = (p.groupBy("session_idx")
         .agg(F.stddev_pop(F.when(F.col("in_universe"), F.col("ret_1d"))).alias("disp"),
              F.avg("ret_1d").alias("mkt_ret")))
    w = Window.orderBy("session_idx")   # date table: bounded by the session count
    cols = {}
    if "market_dispersion" in need:
        cols["market_dispersion"] = F.avg("disp").over(
            w.rangeBetween(-(cfg.disp_window - 1), 0))
    if "market_volatility" in need:
        cols["market_volatility"] = F.stddev_pop("mkt_ret").over(
            w.rangeBetween(-(cfg.mvol_window - 1), 0)) * SQRT_252
    return d.select("session_idx", *[c.alias(k) for k, c in cols.items()])


class _Dates:
    """How the dates of a panel are worked on: whole, in one task each, or
    split."""

    def __init__(self, bars: DataFrame, split: bool | None):
        self.split = xsplit.wide_dates(bars) if split is None else split

    def dealt(self, p: DataFrame) -> DataFrame:
        return p if self.split else p.repartition("date")

    def ranked(self, p: DataFrame, out: str, x) -> DataFrame:
        """The z-score of the ordinal rank of ``x`` on its date."""
        if not self.split:
            return p.withColumn(out, xs.rank_zscore(x))
        p = xsplit.rank_ordinal(p, f"_{out}", x, split=self.split)
        return xsplit.zscore(p, out, f"_{out}", split=self.split).drop(f"_{out}")


def factor_panel(bars: DataFrame, names=ALL_FACTORS, cfg: FactorConfig | None = None,
                 keep: tuple[str, ...] = (), fwd_periods: tuple[int, ...] = (),
                 split: bool | None = None) -> DataFrame:
    """Compute the named factors for every (date, asset) of ``bars``.

    ``bars`` has date, asset, open, close, volume and the sector column.
    ``fwd_periods`` adds ``fwd_<k>`` = close(t+k)/close(t) - 1 measured from
    the output date t, computed in the first time-series pass so evaluation
    needs no extra join.  Returns (date, asset, session_idx, sector, *keep,
    *fwd, *names).  ``split`` spreads each date over many tasks (``xsplit``);
    by default the bars' largest date decides."""
    cfg = cfg or FactorConfig()
    cs = _Dates(bars, split)
    need = set(names)
    unknown = need - set(ALL_FACTORS)
    if unknown:
        raise ValueError(f"unknown factors {sorted(unknown)}")
    cal = calendar(bars)
    p = with_session(bars, cal)
    sec = cfg.sector_col

    # ---- ts phase 1 (partitioned by asset)
    if need & {"market_dispersion", "market_volatility", "volatility_rank"}:
        p = p.withColumn("ret_1d", ts.returns("close", 2))
    t1 = {}
    if cfg.use_universe:
        t1.update(universe_columns(cfg))
    if need & {"momentum", "momentum_smoothed"}:
        t1["r_mom"] = ts.returns("close", cfg.mom_window)
    if need & {"mean_reversion", "mean_reversion_smoothed"}:
        t1["r_mr"] = ts.returns("close", cfg.mr_window)
    if need & {"cto", "trailing_overnight", "overnight_sentiment", "overnight_smoothed"}:
        prev = ts.lag("close", cfg.cto_window - 1)
        t1["cto_raw"] = F.try_divide(F.col("open") - prev, prev)
    if "volatility_rank" in need:
        t1["vol_raw"] = ts.roll_std("ret_1d", cfg.vol_window) * SQRT_252
    if "adv_rank" in need:
        t1["adv_raw"] = (ts.roll_sum(F.col("close") * F.col("volume"), cfg.adv_rank_window)
                         / float(cfg.adv_rank_window))
    shift = 1 if cfg.restamp else 0
    for k in fwd_periods:
        t1[f"fwd_{k}"] = ts.fwd_return("close", k, start=shift)
    if t1:
        p = p.withColumns(t1)

    # ---- cs phase 1 (one exchange by date while dates fit a task); universe
    # first so later (date, sector) windows reuse the date partitioning
    p = cs.dealt(p)
    if cfg.use_universe:
        p = xsplit.top_n_flag(p, "in_universe", "adv_u", cfg.top, split=cs.split)
    else:
        p = p.withColumn("in_universe", F.lit(True))
    u = F.col("in_universe")

    def m(c):
        return F.when(u, F.col(c))

    if need & {"momentum", "momentum_smoothed"}:
        p = xsplit.demean(p, "mom_dm", m("r_mom"), ["date", sec], split=cs.split)
        p = cs.ranked(p, "momentum", "mom_dm")
    if need & {"mean_reversion", "mean_reversion_smoothed"}:
        p = xsplit.demean(p, "mr_dm", m("r_mr"), ["date", sec], split=cs.split)
        p = cs.ranked(p, "mean_reversion", "mr_dm")
        p = p.withColumn("mean_reversion", -F.col("mean_reversion"))
    if need & {"cto", "trailing_overnight", "overnight_sentiment", "overnight_smoothed"}:
        p = p.withColumn("cto", m("cto_raw"))
    if "volatility_rank" in need:
        p = cs.ranked(p, "volatility_rank", m("vol_raw"))
    if "adv_rank" in need:
        p = cs.ranked(p, "adv_rank", m("adv_raw"))

    # ---- ts phase 2
    t2 = {}
    if need & {"trailing_overnight", "overnight_sentiment", "overnight_smoothed"}:
        t2["trailing_overnight"] = ts.roll_sum("cto", cfg.trail_window)
    if "momentum_smoothed" in need:
        t2["mom_sm"] = ts.sma("momentum", cfg.mom_smooth)
    if "mean_reversion_smoothed" in need:
        t2["mr_sm"] = ts.sma("mean_reversion", cfg.mr_window)
    if t2:
        p = cs.dealt(p.withColumns(t2))
        if "momentum_smoothed" in need:
            p = cs.ranked(p, "momentum_smoothed", m("mom_sm"))
        if "mean_reversion_smoothed" in need:
            p = cs.ranked(p, "mean_reversion_smoothed", m("mr_sm"))
        if need & {"overnight_sentiment", "overnight_smoothed"}:
            p = cs.ranked(p, "overnight_sentiment", "trailing_overnight")
    if "overnight_smoothed" in need:
        p = cs.dealt(p.withColumn("on_sm", ts.sma("overnight_sentiment", cfg.trail_window)))
        p = cs.ranked(p, "overnight_smoothed", "on_sm")

    mk = market_series(p, cfg, need)
    if mk is not None:
        p = p.join(mk, "session_idx", "left")

    if cfg.screen:
        p = p.filter(u)
    out = ["asset", "session_idx", sec, *keep, *[f"fwd_{k}" for k in fwd_periods],
           *[n for n in ALL_FACTORS if n in need]]
    p = p.select(*out)
    if cfg.restamp:
        p = restamp(p, cal)
    else:
        p = p.join(small_dim(cal, CALENDAR_BOUND), "session_idx")
    return p.select("date", *out)


def restamp(p: DataFrame, cal: DataFrame, lag: int = 1) -> DataFrame:
    """M1: values computed with data through session t are stamped t+lag.

    A join with the small calendar table; the last ``lag`` sessions drop out."""
    return (p.withColumn("session_idx", F.col("session_idx") + lag)
            .join(small_dim(cal, CALENDAR_BOUND), "session_idx"))


def returns_masked(bars: DataFrame, window: int, cfg: FactorConfig | None = None,
                   split: bool | None = None) -> DataFrame:
    """Returns(window) with the universe mask (NULL outside)."""
    cfg, cs = cfg or FactorConfig(), _Dates(bars, split)
    p = with_session(bars).withColumns(
        {"ret": ts.returns("close", window), **universe_columns(cfg)})
    p = xsplit.top_n_flag(cs.dealt(p), "in_universe", "adv_u", cfg.top, split=cs.split)
    return p.select("date", "asset", "session_idx",
                    F.when(F.col("in_universe"), F.col("ret")).alias("ret"))


def universe_screen(bars: DataFrame, window: int, top: int, split: bool | None = None) -> DataFrame:
    """``AverageDollarVolume(window).top(n)`` - the n most traded assets per
    session by mean close*volume over the window (missing bars count as 0)."""
    cs = _Dates(bars, split)
    p = with_session(bars).withColumn(
        "adv", ts.roll_sum(F.col("close") * F.col("volume"), window) / float(window))
    return (xsplit.top_n_flag(cs.dealt(p), "in_universe", "adv", top, split=cs.split)
            .select("date", "asset", "adv", "in_universe"))


def sector_neutral(df: DataFrame, col: str, sector: str = "sector_code",
                   out: str | None = None, split: bool = False) -> DataFrame:
    """Value minus its (date, sector) mean, for any column (fixes B9)."""
    d = df if split else df.repartition("date")
    return xsplit.demean(d, out or f"{col}_sector_neutral", col, ["date", sector], split=split)


def avg_combo(df: DataFrame, cols: list[str], out: str = "avg_combo") -> DataFrame:
    """Row mean of the alpha columns, missing values skipped."""
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.withColumn(out, F.try_divide(s, n.cast("double")))


def binned_alpha(df: DataFrame, col: str, bins: int, out: str | None = None,
                 by: str = "date", split: bool = False) -> DataFrame:
    """Equal-width bin per date, then sample z-score of the bin."""
    out = out or f"{col}_binned"
    d = xsplit.cut(df if split else df.repartition(by), f"{out}_bin", col, bins, by, split=split)
    return xsplit.zscore(d, out, F.col(f"{out}_bin").cast("double"), by, ddof=1, split=split)


def stepwise_one_day(bars: DataFrame, smooth: int = 5, sector: str = "sector_code",
                     split: bool | None = None) -> DataFrame:
    """The 1-session return chain keeping every stage as a column."""
    cs = _Dates(bars, split)
    p = cs.dealt(with_session(bars).withColumn("raw", ts.returns("close", 2)))
    p = xsplit.demean(p, "demeaned", "raw", ["date", sector], split=cs.split)
    p = xsplit.rank_ordinal(p, "ranked", "demeaned", split=cs.split)
    p = xsplit.zscore(p, "zscored", "ranked", split=cs.split)
    p = p.withColumn("smoothed", ts.sma("zscored", smooth))
    return p.select("date", "asset", "session_idx", "raw", "demeaned", "ranked",
                    "zscored", "smoothed")
