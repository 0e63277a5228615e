"""Bar panels and dimension tables.

The test tables carry no equity bars, so two adapters build bar panels in the
shape ``(date, asset, open, close, volume, sector_code)``:

* ``weekly_supplier_bars`` - weekly bars from ``lineitem`` (asset = supplier,
  price = quantity-weighted price of the shipping day, sector = region).
* ``daily_event_bars`` - daily bars from ``events`` (asset = user).

Everything downstream takes any DataFrame of that schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import nan_to_null, small_dim
from .tables import read

BARS_COLS = ("date", "asset", "open", "close", "volume", "sector_code")


def weekly_supplier_bars(spark: SparkSession, sf_dir: str, weeks: Column | None = None,
                         assets: DataFrame | None = None) -> DataFrame:
    """Weekly bars; ``weeks`` (a condition on ``l_shipdate`` that keeps or
    drops weeks, Monday to Sunday, whole) and ``assets`` reach the scan."""
    li = read(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate",
              "l_extendedprice", "l_quantity")
    if weeks is not None:
        li = li.filter(weeks)
    if assets is not None:
        li = li.join(assets.select(F.col("asset").alias("l_suppkey")), "l_suppkey", "left_semi")
    # partial aggregation map-side: a hot supplier collapses to one row per day
    daily = (li.groupBy(F.col("l_suppkey").alias("asset"),
                        F.col("l_shipdate").cast("date").alias("d"))
             .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("px"),
                  F.sum("l_quantity").alias("vol")))
    weekly = (daily.groupBy("asset",
                            F.date_trunc("week", F.col("d")).cast("date").alias("date"))
              .agg(F.min_by("px", "d").alias("open"),
                   F.max_by("px", "d").alias("close"),
                   F.sum("vol").alias("volume")))
    return _with_sector(spark, sf_dir, weekly)


def supplier_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asset, sector_code): supplier -> region through its nation."""
    sup = read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nat = small_dim(read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"), 25)
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .select(F.col("s_suppkey").alias("asset"),
                    F.col("n_regionkey").cast("int").alias("sector_code")))


def _with_sector(spark, sf_dir, bars: DataFrame) -> DataFrame:
    sec = supplier_sectors(spark, sf_dir)
    return (bars.join(sec, "asset")
            .select(*[nan_to_null(c).alias(c) if c in ("open", "close", "volume")
                      else F.col(c) for c in BARS_COLS]))


def daily_event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events", "user_id", "ts", "value", "event_id")
    b = (ev.groupBy(F.col("user_id").alias("asset"), F.col("ts").cast("date").alias("date"))
         .agg(F.sum("value").alias("volume"),
              F.max_by("value", "event_id").alias("close"),
              F.min_by("value", "event_id").alias("open")))
    return b.select("date", "asset", nan_to_null("open").alias("open"),
                    nan_to_null("close").alias("close"),
                    nan_to_null("volume").alias("volume"),
                    (F.col("asset") % 5).cast("int").alias("sector_code"))


def sector_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated sector-name dimension plus the (-1, 'No sector') row."""
    reg = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    names = (reg.select(F.col("r_regionkey").cast("int").alias("sector_code"),
                        F.col("r_name").alias("sector")).dropDuplicates())
    sentinel = spark.createDataFrame([(-1, "No sector")], "sector_code int, sector string")
    return names.unionByName(sentinel)


def calendar(panel: DataFrame, date_col: str = "date") -> DataFrame:
    """Dense session index over the distinct dates of a panel.

    The window runs on the distinct-date table (one row per session, thousands
    at most), never on the panel itself.
    """
    d = panel.select(F.col(date_col).alias("date")).distinct()
    return d.select("date", (F.row_number().over(Window.orderBy("date")) - 1)
                    .cast("int").alias("session_idx"))


# One calendar row per session: at most 366 a year, a few tens of thousands
# for a century, whatever the data volume.  Broadcasting it keeps the panel
# where it is (no shuffle of the panel by date just to attach an index).
CALENDAR_BOUND = 366 * 100


def with_session(panel: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    cal = calendar(panel) if cal is None else cal
    return panel.join(small_dim(cal, CALENDAR_BOUND), "date")


def price_slice(panel: DataFrame, assets: DataFrame, start: str, end: str,
                field: str = "close") -> DataFrame:
    """One field for an asset list, sessions in (start, end]."""
    p = panel.filter((F.col("date") > F.lit(start).cast("date")) &
                     (F.col("date") <= F.lit(end).cast("date")))
    return p.join(assets.select("asset"), "asset", "left_semi").select("date", "asset", field)


def sector_lookup(assets: DataFrame, sectors: DataFrame) -> DataFrame:
    """Sector code per asset, -1 when the asset has none."""
    return (assets.join(sectors, "asset", "left")
            .select("asset", F.coalesce(F.col("sector_code"), F.lit(-1)).cast("int")
                    .alias("sector_code")))
