"""Cross-section steps on split dates give what the windows give."""

import datetime as dt
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF0
from factorspark.operators import xs, xsplit

DAYS = [dt.date(2022, 1, d) for d in range(1, 6)]


@pytest.fixture(scope="module")
def panel(spark):
    """Most rows on one date; ties, zeros, missing values, wide ranges, a date
    of equal values and one of a single row."""
    r = random.Random(4)
    rows = []
    for a in range(900):
        x = r.choice([0.0, 0.0, r.gauss(0, 1), r.gauss(0, 1e-6), r.gauss(0, 1e9), round(r.gauss(0, 1), 1), None, 1e-12, -0.0])
        rows.append((DAYS[0], a, x, r.choice([0, 1, None])))
    rows += [(DAYS[1], a, r.choice([None, r.random()]), a % 3) for a in range(40)]
    rows += [(DAYS[2], a, 2.5, 0) for a in range(9)] + [(DAYS[3], 1, 7.0, 1)] + [(DAYS[4], a, None, 1) for a in range(4)]
    return spark.createDataFrame(rows, "date date, asset long, x double, sector int").repartition(6)


STEPS = {
    "demean": lambda d, s: xsplit.demean(d, "out", "x", split=s),
    "demean_sector": lambda d, s: xsplit.demean(d, "out", "x", ["date", "sector"], split=s),
    "zscore_pop": lambda d, s: xsplit.zscore(d, "out", F.col("x") * 2, split=s),
    "zscore_samp": lambda d, s: xsplit.zscore(d, "out", "x", ddof=1, split=s),
    "rank_ordinal": lambda d, s: xsplit.rank_ordinal(d, "out", "x", split=s),
    "rank_descending": lambda d, s: xsplit.rank_ordinal(d, "out", "x", ascending=False, split=s),
    "rank_average": lambda d, s: xsplit.rank_average(d, "out", "x", split=s),
    "qcut": lambda d, s: xsplit.qcut(d, "out", "x", 7, split=s),
    "cut": lambda d, s: xsplit.cut(d, "out", "x", 9, split=s),
    "top_n": lambda d, s: xsplit.top_n_flag(d, "out", "x", 25, split=s),
    "share_of_abs": lambda d, s: xsplit.share_of_abs(d, "out", "x", split=s),
}


@pytest.mark.parametrize("step", STEPS)
def test_split_is_the_window(panel, step):
    got, want = ({(r.date, r.asset): r.out for r in STEPS[step](panel, s).collect()} for s in (True, False))
    assert STEPS[step](panel, True).columns == [*panel.columns, "out"]
    assert len(want) == len(got) == panel.count()
    for k, w in want.items():
        g = got[k]
        if isinstance(w, float):
            assert g is not None and math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-12 * max(1.0, abs(w))), (k, g, w)
        else:
            assert g == w, (k, g, w)


def test_a_date_is_spread_over_tasks(spark):
    """No bucket of a large date holds more than a small share of its rows."""
    d = spark.range(50_000).select(F.lit(DAYS[0]).alias("date"), F.col("id").alias("asset"), F.randn(3).alias("x"))
    share = d.groupBy(xsplit.order_bucket(F.round("x", 10))).count().agg(F.max("count") / 50_000).first()[0]
    assert share < 0.05
    zeros = d.groupBy(xsplit.order_bucket(F.col("asset").cast("double"))).count().agg(F.max("count") / 50_000).first()[0]
    assert zeros < 0.05
    plan = xsplit.rank_ordinal(d, "r", "x", split=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "_b#" in plan and ", _a#" in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=2, max_size=40))
def test_buckets_keep_the_order(spark, values):
    d = spark.createDataFrame([(float(v),) for v in values], "x double").select(
        F.round("x", xs.RANK_DIGITS).alias("x")).withColumn("b", xsplit.order_bucket(F.col("x")))
    rows = sorted((r.x, r.b) for r in d.collect())
    for (x, b), (y, c) in zip(rows, rows[1:]):
        assert b <= c and (x != y or b == c)
        assert (b == 0) == (x == 0)


def test_wide_dates(panel):
    assert xsplit.wide_dates(panel, bound=899) and not xsplit.wide_dates(panel, bound=900)
    assert not xsplit.wide_dates(panel.limit(0))


@pytest.mark.parametrize("job", ["momentum_smoothed", "rank_ic", "quantile_returns", "target_quantiles", "target_weights",
                                 "universe_adv_topn", "factor_alpha_binned", "sector_neutral"])
def test_jobs_on_split_dates(spark, monkeypatch, job):
    whole = E.queries()[job](spark, SF0).collect()
    monkeypatch.setattr(xsplit, "DATE_ROWS", 0)
    split = E.queries()[job](spark, SF0).collect()
    key = lambda rows: sorted((tuple(None if v is None else round(v, 7) if isinstance(v, float) else v for v in r)
                               for r in rows), key=str)
    assert len(whole) and key(whole) == key(split)
