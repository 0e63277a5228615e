"""Stored bars (S1): read from CSV, written once, partitioned by year, and
read by every job with the years, dates, assets and columns that it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import nan_to_null

SCHEMA = "date date, asset long, open double, close double, volume double, sector_code int"
#: The columns of a bar file, one file per symbol.
CSV_SCHEMA = "date string, open double, high double, low double, close double, volume double, dividend double, split double"


def read_bars_csv(spark: SparkSession, path: str, symbols: DataFrame, glob: str = "*.csv",
                  date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A folder of bar files, one per symbol (the file's name), with a
    header; ``symbols`` (symbol, asset, sector_code) names the assets.  Files of
    other symbols and rows without a date are left out; NaN is missing."""
    raw = (spark.read.schema(CSV_SCHEMA).option("header", True).option("pathGlobFilter", glob)
           .option("recursiveFileLookup", True).csv(path)
           .withColumn("symbol", F.regexp_replace("_metadata.file_name", r"\.csv(\.\w+)?$", "")))
    d = raw.join(symbols.select("symbol", "asset", "sector_code"), "symbol")
    day = F.to_date(F.substring("date", 1, 10), date_format)
    return d.select(day.alias("date"), F.col("asset").cast("long").alias("asset"),
                    *(nan_to_null(c).alias(c) for c in ("open", "close", "volume")),
                    F.col("sector_code").cast("int").alias("sector_code")).where("date IS NOT NULL")


def store_bars(bars: DataFrame, path: str) -> None:
    """Write the panel, partitioned by year; a year is written by as many tasks
    as its dates need, rows in the order of date and asset, so that row groups
    can be skipped by date."""
    n = max(1, int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (bars.select("date", "asset", "open", "close", "volume", "sector_code").withColumn("year", F.year("date"))
     .repartitionByRange(n, "date").sortWithinPartitions("year", "date", "asset")
     .write.mode("overwrite").partitionBy("year").parquet(path))


def stored_bars(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                assets: list[int] | None = None) -> DataFrame:
    """The stored panel from ``start`` to ``end`` (dates, both included): only
    the years between are listed, only matching row groups read; columns that a
    job doesn't use are pruned at the scan."""
    d = spark.read.schema(f"{SCHEMA}, year int").parquet(path)
    for bound, ge in ((start, True), (end, False)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            year = F.lit(int(bound[:4]))
            d = d.where((F.col("year") >= year) & (F.col("date") >= day) if ge
                        else (F.col("year") <= year) & (F.col("date") <= day))
    if assets is not None:
        d = d.where(F.col("asset").isin(assets))
    return d.drop("year")
