"""File scans: whole-text filings, CSV tables, lexicon and ticker maps
(S3, S6-S11).  Schemas are explicit; Catalyst prunes columns at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.text.sections import file_key
from .text import SENTIMENTS


def read_filings_text(spark: SparkSession, path: str, glob: str = "*.{txt,txt.gz}") -> DataFrame:
    """One row per file (whole text, plain or gzip) keyed by its
    name ``{ticker}_{type}_{yyyymmdd}.ext``."""
    d = (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
         .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    return file_key(d)


def read_filings_by_number(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per file keyed by its integer stem (``123.txt``); files
    with another stem have no number and are left out."""
    d = (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
         .select(F.regexp_extract("_metadata.file_name", r"^(\d+)\.[^.]+$", 1).alias("stem"),
                 F.col("value").alias("text")))
    return d.filter("stem <> ''").select(F.col("stem").cast("long").alias("number"), "text")


def read_csv_table(spark: SparkSession, path: str, schema: str, cols: list[str] | None = None,
                   date_cols: tuple[str, ...] = ()) -> DataFrame:
    """Header CSV (one file, a folder or a glob) with an explicit
    schema, selected columns and dates parsed."""
    d = spark.read.schema(schema).option("header", True).csv(path)
    if cols:
        d = d.select(*cols)
    for c in date_cols:
        d = d.withColumn(c, F.to_date(c))
    return d


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Sentiment lexicon CSV: lower-case headers, the word and six flag
    columns, stacked to (word, sentiment) where the flag is set."""
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    flags = [s for s in SENTIMENTS if s in raw.columns]
    long = raw.select(F.lower("word").alias("word"), *flags).unpivot(["word"], flags, "sentiment", "flag")
    return long.filter(F.col("flag").cast("double") > 0).select("word", "sentiment")


def read_cik_map(spark: SparkSession, path: str) -> DataFrame:
    """Ticker -> CIK zero-padded to 10 digits."""
    d = spark.read.option("header", True).csv(path)
    return d.select(F.lower("ticker").alias("ticker"), F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """One sentence per line -> (file, line, tokens), lines numbered from
    0 in each file: the place in the split, after the lines of earlier splits,
    which are counted first (one row a split)."""
    d = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.split(F.trim("value"), r"\s+").alias("tokens"))
    splits = d.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return d.join(splits, ["file", "block"]).select(
        "file", (F.col("before") + F.col("id") - F.col("first")).alias("line"), "tokens")
