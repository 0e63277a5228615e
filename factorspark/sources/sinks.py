"""Sinks (S12-S14, S17, R12): partitioned parquet/CSV tables, compressed
text, models and one-row metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table (partitioned for pruning)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_text(df: DataFrame, col: str, path: str, compression: str = "gzip") -> None:
    """One text column, compressed."""
    df.select(col).write.mode("overwrite").option("compression", compression).text(path)


def save_model(model, path: str, meta: dict, spark: SparkSession) -> None:
    """Spark ML model plus its metadata as a one-row table."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string") \
        .write.mode("overwrite").json(f"{path}/meta")
