"""Feature, target and sampling jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators.xsplit import wide_dates
from ..plans import features as ft
from ..registry import register
from ..sources.panels import with_session
from . import sqlkit as q
from .common import pe, pw, r8


@register("fwd_targets", q.with_(q.PW, q.CAL) + f"""
SELECT date, asset, round({q.fwd('close', 4)}, 8) AS target FROM p""")
def fwd_targets(spark, sf):
    """4-session forward return per asset and date."""
    t = ft.fwd_targets(with_session(pw(spark, sf)), 4)
    return t.select("date", "asset", r8("target"))


def _qc(x, k):
    probs = ", ".join(str(i / k) for i in range(1, k))
    return (f"CASE WHEN {x} IS NOT NULL THEN CAST(list_sum([CASE WHEN {x} > e THEN 1 ELSE 0 END FOR e IN "
            f"quantile_cont({x}, [{probs}]) OVER (PARTITION BY date)]) AS INTEGER) END")


TGT_SQL = q.with_(q.PW, q.CAL, f"a AS (SELECT *, {q.returns('close', 5)} AS raw FROM p)",
                  f"b AS (SELECT *, {_qc('raw', 2)} AS q2, {_qc('raw', 5)} AS q5, {_qc('raw', 25)} AS q25, "
                  f"{q.lead('raw', 5)} AS fshift FROM a)")


def _targets(spark, sf):
    bars = pw(spark, sf)
    return ft.target_table(with_session(bars), 5, split=wide_dates(bars))


@register("target_quantiles", TGT_SQL + """
SELECT date, asset, round(raw, 8) AS raw, q2, q5, q25, round(fshift, 8) AS fshift,
       CASE WHEN fshift IS NOT NULL THEN CAST(fshift >= 0 AS INTEGER) END AS fshift_is_positive FROM b""")
def target_quantiles(spark, sf):
    """Returns(5) target, its 0-based 2/5/25-quantile labels per
    date, the value 5 sessions ahead and its sign flag."""
    t = _targets(spark, sf)
    return t.select("date", "asset", r8("raw"), "q2", "q5", "q25", r8("fshift"),
                    "fshift_is_positive")


@register("target_crosstab", TGT_SQL + """
SELECT q2, raw > 0 AS is_up, count(*) AS n FROM b WHERE raw IS NOT NULL GROUP BY ALL""")
def target_crosstab(spark, sf):
    """A5: median-split label against the sign of the raw target."""
    from ..operators.reshape import crosstab
    t = _targets(spark, sf).filter(F.col("raw").isNotNull())
    return crosstab(t.withColumn("is_up", F.col("raw") > 0), "q2", "is_up")


_DF_SQL = """
  CAST(month(date) = 1 AS INTEGER) AS is_January, CAST(month(date) = 12 AS INTEGER) AS is_December,
  CAST(date = CAST(last_day(date) - CAST(greatest(isodow(last_day(date)) - 5, 0) AS INTEGER) AS DATE) AS INTEGER) AS month_end,
  CAST(date = CAST(CAST(date_trunc('month', date) AS DATE) + CASE isodow(CAST(date_trunc('month', date) AS DATE))
    WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AS INTEGER) AS month_start,
  CAST(date = CAST(last_day(date) - CAST(greatest(isodow(last_day(date)) - 5, 0) AS INTEGER) AS DATE) AND month(date) % 3 = 0
    AS INTEGER) AS qtr_end,
  CAST(date = CAST(CAST(date_trunc('month', date) AS DATE) + CASE isodow(CAST(date_trunc('month', date) AS DATE))
    WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS DATE) AND month(date) % 3 = 1 AS INTEGER) AS qtr_start,
  CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
""" + ",\n".join(f"  CAST(isodow(date) - 1 = {i} AS INTEGER) AS weekday_{i}" for i in range(7)) + ",\n" + \
    ",\n".join(f"  CAST(quarter(date) = {i} AS INTEGER) AS qtr_{i}" for i in range(1, 5))


@register("date_features", "WITH dd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)\n"
          f"SELECT date, {_DF_SQL} FROM dd")
def date_features(spark, sf):
    """Calendar flags and one-hot weekday/quarter for every
    order date (month, quarter and year ends all occur)."""
    from ..sources.tables import read
    d = read(spark, sf, "orders", "o_orderdate").select(
        F.col("o_orderdate").cast("date").alias("date")).distinct()
    return d.withColumns(dates.date_features("date"))


@register("onehot_sector", q.with_(q.PE) + "\nSELECT date, asset, " +
          ", ".join(f"CAST(sector_code = {i} AS INTEGER) AS sector_code_{i}" for i in range(5)) + " FROM bars")
def onehot_sector(spark, sf):
    """one-hot sector columns."""
    return pe(spark, sf).select("date", "asset", *[c.alias(k) for k, c in
                                                   dates.one_hot("sector_code", range(5), "sector_code").items()])


@register("split_by_fraction", q.with_(q.PE, q.CAL) + """,
lab AS (SELECT date, CASE WHEN session_idx < floor(count(*) OVER () * 0.6) THEN 'train'
          WHEN session_idx < floor(count(*) OVER () * (0.6 + 0.2)) THEN 'valid' ELSE 'test' END AS split FROM cal)
SELECT b.date, b.asset, l.split FROM bars b JOIN lab l USING (date)""")
def split_by_fraction(spark, sf):
    """60/20/20 train/valid/test cut on distinct dates."""
    return ft.split_by_fraction(pe(spark, sf)).select("date", "asset", "split")


@register("split_by_date", q.with_(q.PE) + """
SELECT date, asset, CASE WHEN date < DATE '2024-01-20' THEN 'train' ELSE 'test' END AS split FROM bars""")
def split_by_date(spark, sf):
    """Train before 2024-01-20, test after."""
    from ..plans.evaluate import split_by_date as sbd
    return sbd(pe(spark, sf), "2024-01-20").select("date", "asset", "split")


@register("non_overlapping", q.with_(q.PW, q.CAL) + """
SELECT date, asset FROM p WHERE session_idx >= 1 AND (session_idx - 1) % 5 = 0""")
def non_overlapping(spark, sf):
    """Every fifth session starting at the second (n_skip=4, start=1)."""
    return ft.non_overlapping(pw(spark, sf), 4, 1).select("date", "asset")


@register("time_folds", q.with_(q.PW, q.CAL) + """,
c AS (SELECT *, count(*) OVER () AS n, floor(count(*) OVER () / 4) AS tsz FROM cal),
f AS (SELECT c.*, fold FROM c, range(0, 3) t(fold)),
r AS (SELECT fold, date, CASE WHEN session_idx < n - (3 - fold) * tsz THEN 'train'
        WHEN session_idx < n - (3 - fold) * tsz + tsz THEN 'test' END AS role FROM f)
SELECT CAST(fold AS INTEGER) AS fold, date, role FROM r WHERE role IS NOT NULL""")
def time_folds(spark, sf):
    """Three expanding-window folds over the weekly sessions."""
    return ft.time_folds(pw(spark, sf), 3)


@register("weekday_sample", q.with_(q.PE) + """
SELECT date, asset FROM bars
WHERE isodow(date) - 1 = (CAST(asset AS BIGINT) * 2654435761 + (date - DATE '1970-01-01') * 40503 + 42) % 5""")
def weekday_sample(spark, sf):
    """About one row in five, the row's weekday matching a hash of (asset, date)."""
    return ft.weekday_sample(pe(spark, sf)).select("date", "asset")


@register("yearly_fwd_return", q.with_(q.PW) + """,
y AS (SELECT asset, CAST(year(date) AS INTEGER) AS year, max_by(close, date) AS close FROM bars GROUP BY ALL)
SELECT asset, year, round(lead(close) OVER (PARTITION BY asset ORDER BY year) / NULLIF(close, 0) - 1, 8) AS fwd_1y
FROM y""")
def yearly_fwd_return(spark, sf):
    """Year-end close per asset and the next year's return
    (``pct_change(1).shift(-1)`` on yearly bars)."""
    from pyspark.sql import Window
    y = pw(spark, sf).groupBy("asset", F.year("date").alias("year")).agg(F.max_by("close", "date").alias("close"))
    w = Window.partitionBy("asset").orderBy("year")     # one row per asset-year
    return y.select("asset", F.col("year").cast("int").alias("year"),
                    r8(F.try_divide(F.lead("close").over(w), F.col("close")) - 1, "fwd_1y"))


@register("class_labels", TGT_SQL + """
SELECT date, asset, q5 - 2 AS label_quintile,
  CASE WHEN raw IS NOT NULL THEN CAST(raw >= 0 AS INTEGER) END AS label_sign FROM b""")
def class_labels(spark, sf):
    """Quintile class labels -2..2 and the sign label of the target."""
    t = _targets(spark, sf)
    return t.select("date", "asset", (F.col("q5") - 2).alias("label_quintile"),
                    dates.safe_positive("raw").alias("label_sign"))


_BDAY = ("(SELECT max(x) FROM (SELECT x, row_number() OVER (ORDER BY x) AS i FROM (SELECT CAST(unnest(generate_series("
         "date + INTERVAL 1 DAY, date + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS x) WHERE isodow(x) < 6) WHERE i = 7)")


@register("calendar_arithmetic", "WITH dd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)\n" + f"""
SELECT date, CAST(date + INTERVAL 1 YEAR AS DATE) AS year_on, CAST(date - INTERVAL 14 MONTH AS DATE) AS months_back,
  CAST(date + INTERVAL 1 MONTH + INTERVAL 10 DAY AS DATE) AS month_and_days, CAST({_BDAY} AS DATE) AS week_days_on FROM dd""")
def calendar_arithmetic(spark, sf):
    """years, months, days and weekdays on and back from every order date."""
    from ..sources.tables import read
    d = read(spark, sf, "orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return d.select("date", dates.shifted("date", years=1).alias("year_on"),
                    dates.shifted("date", years=-1, months=-2).alias("months_back"),
                    dates.shifted("date", months=1, days=10).alias("month_and_days"),
                    dates.add_business_days("date", 7).alias("week_days_on"))
