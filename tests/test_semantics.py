"""Hand-made panels pinning the conventions and fixes (1.5)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorspark.operators import ranking, ts, xs
from factorspark.plans import factors as fx
from factorspark.plans import portfolio as pf
from factorspark.sources.panels import calendar, with_session

D0 = dt.date(2014, 1, 1)


def bars(spark, closes, opens=None):
    rows = []
    for a, series in closes.items():
        for i, c in enumerate(series):
            if c is None:
                continue
            o = opens[a][i] if opens else c
            rows.append((D0 + dt.timedelta(days=i), int(a), float(o), float(c), 100.0, int(a) % 2))
    return spark.createDataFrame(rows, "date date, asset long, open double, close double, "
                                       "volume double, sector_code int")


def test_returns_window_is_n_minus_1_sessions(spark):
    p = with_session(bars(spark, {1: [10, 11, 12.1, 13.31]}))
    r = p.select("session_idx", ts.returns("close", 2).alias("r1"), ts.returns("close", 3).alias("r2")) \
        .orderBy("session_idx").collect()
    assert r[0].r1 is None and abs(r[1].r1 - 0.1) < 1e-12
    assert abs(r[2].r2 - 0.21) < 1e-12


def test_lag_is_by_session_not_row(spark):
    p = with_session(bars(spark, {1: [10, None, 12], 2: [5, 6, 7]}))
    r = {(x.asset, x.session_idx): x.l for x in p.select("asset", "session_idx", ts.lag("close", 1).alias("l")).collect()}
    assert r[(1, 2)] is None          # session 1 missing for asset 1
    assert r[(2, 2)] == 6.0


def test_factor_restamp_M1(spark):
    b = bars(spark, {1: [10, 11, 12, 13], 2: [10, 9, 8, 7], 3: [10, 10, 10, 11]})
    cfg = fx.FactorConfig(use_universe=False, mom_window=2)
    out = fx.factor_panel(b, ["momentum"], cfg, keep=("r_mom",))
    first = out.filter("r_mom IS NOT NULL").orderBy("date", "asset").first()
    # the 1-session return of day 1 (session 1) is stamped on day 2
    assert first.date == D0 + dt.timedelta(days=2)
    assert abs(first.r_mom - 0.1) < 1e-12


def test_zscore_population_and_sample(spark):
    df = spark.createDataFrame([(D0, i, float(v)) for i, v in enumerate([1, 2, 3, 4])], "date date, asset long, x double")
    r = df.select(xs.zscore("x").alias("p"), xs.zscore("x", ddof=1).alias("s")).orderBy("p").collect()
    v = np.array([1, 2, 3, 4.0])
    assert abs(r[0].p - (1 - v.mean()) / v.std()) < 1e-12
    assert abs(r[0].s - (1 - v.mean()) / v.std(ddof=1)) < 1e-12


def test_ranks_ordinal_and_average(spark):
    df = spark.createDataFrame([(D0, 1, 2.0), (D0, 2, 1.0), (D0, 3, 2.0), (D0, 4, None)], "date date, asset long, x double")
    r = {x.asset: (x.o, x.a) for x in df.select("asset", xs.rank_ordinal("x").alias("o"),
                                                  xs.rank_average("x").alias("a")).collect()}
    assert r[2] == (1.0, 1.0) and r[1] == (2.0, 2.5) and r[3] == (3.0, 2.5) and r[4] == (None, None)


def test_qcut_and_cut_match_pandas(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=41), 3)
    df = spark.createDataFrame([(D0, i, float(v)) for i, v in enumerate(x)], "date date, asset long, x double")
    got = df.select("asset", xs.qcut("x", 5).alias("q"), xs.cut("x", 7).alias("c")).toPandas().sort_values("asset")
    assert (got.q.values == pd.qcut(x, 5, labels=False) + 1).all()
    assert (got.c.values == pd.cut(x, 7, labels=False)).all()


def test_interpolate(spark):
    p = with_session(bars(spark, {1: [1, 2, 3, 4, 5]})).withColumn(
        "v", F.when(F.col("session_idx").isin(1, 2, 4), None).otherwise(F.col("close")))
    r = [x.f for x in p.select("session_idx", ts.interpolate("v").alias("f")).orderBy("session_idx").collect()]
    assert r == [1.0, 2.0, 3.0, 4.0, 4.0]   # trailing gap carried forward


def test_skew_safe_rank_and_quantiles_match_pandas(spark):
    rng = np.random.default_rng(0)
    n = 3000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n),
                        "x": np.where(rng.random(n) < 0.35, 1.5, rng.integers(0, 400, n) / 7.0)})
    df = spark.createDataFrame(pdf)
    r = ranking.average_rank(df, ["g"], "x").toPandas()
    exp = pdf.assign(rank=pdf.groupby("g")["x"].rank(method="average")).drop_duplicates()
    m = r.drop_duplicates().merge(exp, on=["g", "x"], suffixes=("", "_e"))
    assert np.allclose(m["rank"], m["rank_e"])
    q = ranking.exact_quantiles(df, ["g"], "x", [0.05, 0.5, 0.95]).collect()
    for row in q:
        assert abs(np.quantile(pdf[pdf.g == row.g].x, row.p) - row.q) < 1e-9


def test_neighbours(spark):
    df = spark.createDataFrame([("a", 5), ("a", 1), ("a", 9), ("b", 2)], "t string, o long")
    r = {(x.t, x.o): x.prev for x in ranking.neighbours(df, ["t"], "o").collect()}
    assert r == {("a", 1): None, ("a", 5): 1, ("a", 9): 5, ("b", 2): None}


@pytest.mark.parametrize("prev_assets", [["A", "B", "C"], ["A", "B", "C", "X"], ["A", "B"]])
def test_transaction_cost_is_positive_over_asset_union(spark, prev_assets):
    rng = np.random.default_rng(3)
    cur = [("p", 1, a, float(w)) for a, w in zip("ABC", [0.5, -0.2, -0.3])]
    pw = rng.random(len(prev_assets))
    prev = [("p", 0, a, float(w / pw.sum())) for a, w in zip(prev_assets, pw)]
    w = spark.createDataFrame(cur + prev, "port_name string, session_idx int, asset string, w double")
    adv = spark.createDataFrame([(a, s, 1e5) for a in "ABCX" for s in (0, 1)], "asset string, session_idx int, adv_clip double")
    c = {x.session_idx: x.daily_transaction_cost for x in pf.trans_cost(w, adv).collect()}
    prevd = dict(zip(prev_assets, pw / pw.sum()))
    exp = sum((prevd.get(a, 0.0) - dict(zip("ABC", [0.5, -0.2, -0.3])).get(a, 0.0)) ** 2
              for a in set(prev_assets) | set("ABC")) * 0.1 / 1e5
    assert c[1] > 0 and abs(c[1] - exp) < 1e-15


def test_target_weights_net_zero_gross_one(spark):
    a = spark.createDataFrame([("p", D0, i, float(v)) for i, v in enumerate([3, 1, 4, 1, 5])],
                              "port_name string, date date, asset long, alpha double")
    r = pf.target_weights(a).agg(F.sum("w").alias("net"), F.sum(F.abs("w")).alias("gross")).first()
    assert abs(r.net) < 1e-12 and abs(r.gross - 1) < 1e-12
