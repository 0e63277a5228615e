"""The z-score of a rank, from one window."""

import datetime as dt
import random

from pyspark.sql import functions as F

from factorspark.operators import xs
from factorspark.plans import factors as fx

DAY = dt.date(2021, 3, 1)


def test_rank_zscore_is_the_zscore_of_the_rank(spark):
    r = random.Random(1)
    rows = [(DAY + dt.timedelta(days=d), a, r.choice([None, 0.0, 1.0, r.random()])) for d in range(6) for a in range(25)]
    rows += [(DAY + dt.timedelta(days=9), 1, 2.0), (DAY + dt.timedelta(days=9), 2, None), (None, 1, 1.0), (None, 2, 3.0)]
    d = spark.createDataFrame(rows, "date date, asset long, x double").withColumn("rank", xs.rank_ordinal("x"))
    for row in d.withColumn("want", xs.zscore("rank")).withColumn("got", xs.rank_zscore("x")).collect():
        assert (row.want is None) == (row.got is None) and (row.got is None or abs(row.want - row.got) < 1e-12), row
        assert row.got is not None or row.x is None or row.asset == 1                      # alone on its date


def test_a_smoothed_factor_has_fewer_windows(spark):
    """Every window holds the rows of a date until its task ends."""
    rows = [(DAY + dt.timedelta(days=7 * d), a, 1.0 + a, 2.0 + a * d, 3.0, a % 2) for d in range(12) for a in range(4)]
    bars = spark.createDataFrame(rows, "date date, asset long, open double, close double, volume double, sector_code int")
    names = ["momentum_smoothed", "mean_reversion_smoothed", "overnight_smoothed"]
    p = fx.factor_panel(bars, names, fx.FactorConfig(adv_window=4, top=2, mom_window=5, mom_smooth=3, mr_window=3), split=False)
    plan = p.select(F.sum(sum(F.col(n) for n in names)))._jdf.queryExecution().optimizedPlan().toString()
    by_date = [x for x in plan.splitlines() if "Window [" in x and ", [date#" in x]
    assert 0 < len(by_date) <= 11, plan
