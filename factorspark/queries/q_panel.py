"""Panel, source and dimension jobs (S1-S5, S20, W18, A15, A17, P-rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..registry import register
from ..session import configure, small_dim
from ..sources import panels
from . import sqlkit as q
from ..sources.tables import read
from .common import pe, pw, r8


@register("panel_weekly", q.with_(q.PW) + """
SELECT date, asset, round(open, 4) AS open, round(close, 4) AS close, round(volume, 4) AS volume,
       sector_code FROM bars""")
def panel_weekly(spark, sf):
    """S1 adapter: weekly supplier bars with region as sector."""
    return pw(spark, sf).select("date", "asset", r8("open", d=4), r8("close", d=4),
                                r8("volume", d=4), "sector_code")


@register("panel_events", q.with_(q.PE) + """
SELECT date, asset, round(open, 6) AS open, round(close, 6) AS close, round(volume, 6) AS volume,
       sector_code FROM bars""")
def panel_events(spark, sf):
    """S1 adapter: daily bars per user from the event stream."""
    return pe(spark, sf).select("date", "asset", r8("open", d=6), r8("close", d=6),
                                r8("volume", d=6), "sector_code")


@register("calendar_index", q.with_(q.PW, q.CAL) + "\nSELECT date, session_idx FROM cal")
def calendar_index(spark, sf):
    """Dense session index over the distinct dates of the panel."""
    return panels.calendar(pw(spark, sf))


def shipped(start: str, end: str):
    """Ship dates in [start, end), pushed into the scan; both are Mondays."""
    return (F.col("l_shipdate") >= F.lit(start).cast("date")) & (F.col("l_shipdate") < F.lit(end).cast("date"))


@register("price_slice", q.with_(q.PW) + """
SELECT date, asset, round(close, 4) AS close FROM bars
WHERE date > DATE '1996-01-01' AND date <= DATE '1997-06-30'
  AND asset IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def price_slice(spark, sf):
    """Close prices for an asset list (suppliers with positive balance),
    sessions in (1996-01-01, 1997-06-30]."""
    from ..sources.tables import read
    assets = read(spark, sf, "supplier", "s_suppkey", "s_acctbal").filter("s_acctbal > 0") \
        .select(F.col("s_suppkey").alias("asset"))
    configure(spark)
    # sessions are Mondays: those in (1996-01-01, 1997-06-30] are whole weeks of ship dates
    weeks = shipped("1996-01-08", "1997-07-07")
    out = panels.price_slice(panels.weekly_supplier_bars(spark, sf, weeks, assets), assets, "1996-01-01", "1997-06-30")
    return out.select("date", "asset", r8("close", d=4))


@register("sector_lookup", """
SELECT c_custkey AS asset, coalesce(CAST(n.n_regionkey AS INTEGER), -1) AS sector_code
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def sector_lookup(spark, sf):
    """Sector code per customer; -1 if it has no known nation."""
    from ..sources.tables import read
    cust = read(spark, sf, "customer", "c_custkey", "c_nationkey")
    nat = read(spark, sf, "nation", "n_nationkey", "n_regionkey")
    sectors = cust.join(small_dim(nat, 1000), cust.c_nationkey == nat.n_nationkey) \
        .select(F.col("c_custkey").alias("asset"), F.col("n_regionkey").cast("int").alias("sector_code"))
    assets = cust.select(F.col("c_custkey").alias("asset"))
    return panels.sector_lookup(assets, sectors)


@register("sector_names", """
SELECT * FROM (SELECT DISTINCT CAST(r_regionkey AS INTEGER) AS sector_code, r_name AS sector FROM region)
UNION ALL SELECT -1, 'No sector'""")
def sector_names(spark, sf):
    """De-duplicated sector names plus the sentinel row."""
    return panels.sector_names(spark, sf)


@register("coverage", q.with_(q.PW) + """
SELECT date, count(close) AS n_assets FROM bars GROUP BY date""")
def coverage(spark, sf):
    """Assets with a price per session."""
    return pw(spark, sf).groupBy("date").agg(F.count("close").alias("n_assets"))


@register("distinct_sessions", q.with_(q.PE) + """
SELECT DISTINCT date, CAST(isodow(date) - 1 AS INTEGER) AS weekday FROM bars""")
def distinct_sessions(spark, sf):
    """A15 + F1: distinct dates of the daily panel and their weekday (Mon=0)."""
    return pe(spark, sf).select("date").distinct() \
        .withColumn("weekday", F.weekday("date"))


@register("max_factor_by_date", q.with_(q.PW) + """
SELECT date, round(max(close / open), 8) AS max_close_open FROM bars GROUP BY date""")
def max_factor_by_date(spark, sf):
    """Maximum per date of a per-asset value (close/open)."""
    return pw(spark, sf).groupBy("date").agg(
        r8(F.max(F.try_divide("close", "open")), "max_close_open"))


@register("yield_columns", """
WITH m AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS px
           FROM orders GROUP BY 1)
SELECT date, round(px / 1e5 * 365 / 90 / 100, 8) AS yield_3mo, round(px / 1e5 / 100, 8) AS yield_1yr,
       round(px / NULLIF(lag(px) OVER (ORDER BY date), 0) - 1, 8) AS index_return FROM m""")
def yield_columns(spark, sf):
    """Yield columns (3-month rate * 365/90/100, 1-year / 100) and the
    index return, over a daily average-order-price series."""
    from pyspark.sql import Window
    from ..sources.tables import read
    m = read(spark, sf, "orders", "o_orderdate", "o_totalprice") \
        .groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.avg("o_totalprice").alias("px"))
    w = Window.orderBy("date")   # one row per day: the date series is bounded
    return m.select("date", r8(F.col("px") / 1e5 * 365 / 90 / 100, "yield_3mo"),
                    r8(F.col("px") / 1e5 / 100, "yield_1yr"),
                    r8(F.try_divide(F.col("px"), F.lag("px").over(w)) - 1, "index_return"))


def _ret_panel(spark, sf):
    from ..operators import ts
    return panels.with_session(pw(spark, sf)).withColumn("ret", ts.returns("close", 2))


_RET_SQL = q.with_(q.PW, q.CAL, f"r AS (SELECT *, {q.returns('close', 2)} AS ret FROM p)")


@register("sector_return_pivot", _RET_SQL + "\nSELECT date, " + ", ".join(
    f"round(avg(CASE WHEN sector_code = {i} THEN ret END), 8) AS sector_{i}" for i in range(5)) +
    " FROM r GROUP BY date")
def sector_return_pivot(spark, sf):
    """Mean return per sector and date, one column per sector (the
    pivot values are the five known sectors, so the width is fixed)."""
    r = _ret_panel(spark, sf)
    w = r.groupBy("date").pivot("sector_code", list(range(5))).agg(F.avg("ret"))
    return w.select("date", *[r8(F.col(str(i)), f"sector_{i}") for i in range(5)])


@register("sector_value_counts", q.with_(q.PW) + """
SELECT sector_code, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM bars GROUP BY sector_code""")
def sector_value_counts(spark, sf):
    """A3: rows per sector and their share (normalised value counts)."""
    from pyspark.sql import Window
    c = pw(spark, sf).groupBy("sector_code").agg(F.count(F.lit(1)).alias("n"))
    return c.select("sector_code", "n", r8(F.col("n") / F.sum("n").over(Window.partitionBy()), "share"))


@register("asset_key_sets", q.with_(q.PW) + """,
a AS (SELECT DISTINCT asset FROM bars WHERE year(date) = 1995),
b AS (SELECT DISTINCT asset FROM bars WHERE year(date) = 2001)
SELECT asset, 'both' AS key_set FROM (SELECT asset FROM a INTERSECT SELECT asset FROM b)
UNION ALL SELECT asset, 'only_first' FROM (SELECT asset FROM a EXCEPT SELECT asset FROM b)""")
def asset_key_sets(spark, sf):
    """Assets trading in both 1995 and 2001 (intersection) and
    those of 1995 missing in 2001 (difference / anti-join report)."""
    configure(spark)
    # the Mondays of 1995 and of 2001 with the weeks they begin
    a = panels.weekly_supplier_bars(spark, sf, shipped("1995-01-02", "1996-01-01")).select("asset").distinct()
    b = panels.weekly_supplier_bars(spark, sf, shipped("2001-01-01", "2002-01-07")).select("asset").distinct()
    return (a.intersect(b).withColumn("key_set", F.lit("both"))
            .unionByName(a.join(b, "asset", "left_anti").withColumn("key_set", F.lit("only_first"))))


@register("tagged_union", q.with_(q.PW) + """,
u AS (SELECT 'weekly' AS tag, date, asset FROM bars
      UNION ALL SELECT 'events', CAST(ts AS DATE), user_id FROM events)
SELECT tag, count(*) AS n, count(DISTINCT (date, asset)) AS n_distinct FROM u GROUP BY tag""")
def tagged_union(spark, sf):
    """Two keyed tables stacked with a tag and a duplicate-key
    check (rows vs distinct keys per tag)."""
    ev = read(spark, sf, "events", "ts", "user_id").select(
        F.lit("events").alias("tag"), F.col("ts").cast("date").alias("date"), F.col("user_id").alias("asset"))
    u = pw(spark, sf).select(F.lit("weekly").alias("tag"), "date", "asset").unionByName(ev)
    return u.groupBy("tag").agg(F.count(F.lit(1)).alias("n"),
                                F.count_distinct("date", "asset").alias("n_distinct"))


@register("group_extremes", q.with_(q.PW) + """
SELECT sector_code, count(*) AS n, round(min(close), 4) AS min_close, round(max(close), 4) AS max_close,
  arg_max(asset, (close, asset)) AS top_asset FROM bars GROUP BY sector_code""")
def group_extremes(spark, sf):
    """Size, min and max per sector and the asset with the highest
    close (``max_by``: partial aggregation, no per-group sort)."""
    p = pw(spark, sf)
    return p.groupBy("sector_code").agg(
        F.count(F.lit(1)).alias("n"), r8(F.min("close"), "min_close", 4), r8(F.max("close"), "max_close", 4),
        F.max_by("asset", F.struct("close", "asset")).alias("top_asset"))


@register("latest_per_asset", q.with_(q.PW) + """
SELECT asset, max(date) AS date, round(arg_max(close, date), 4) AS close, count(*) AS n_dup FROM bars GROUP BY asset""")
def latest_per_asset(spark, sf):
    """Keep the last row per asset in date order (``max_by``, so a
    huge asset is reduced map-side instead of sorted in one task)."""
    p = pw(spark, sf)
    return p.groupBy("asset").agg(F.max("date").alias("date"), r8(F.max_by("close", "date"), "close", 4),
                                  F.count(F.lit(1)).alias("n_dup"))
