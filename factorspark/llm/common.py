"""Shared by the operators of this folder: inputs, task settings, lineage cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows and bytes an Arrow batch holds at most; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20

#: Words that a task gathers before it sends what it has found (bounds memory).
FLUSH_WORDS = 2_000_000

#: Stands for a missing id, after all others.
NO_ID = (1 << 63) - 1

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query of this folder; ``sql`` is its DuckDB oracle."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that hold for tasks with Python: small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(run):
    """``run`` for ``mapInArrow``; the worker, which Spark keeps for later
    tasks, gives the memory of this one back to the system."""
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidy


def parts(spark: SparkSession) -> int:
    """Partitions that data-sized blocks are dealt to: the cluster's setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text); a null text is empty.  Whatever else ``docs``
    carries, under whatever name, stays out of the way of the operators."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``texts`` and the key of the row itself, (place, one, two): its id, with
    ``NO_ID`` for none, and 64 bits of the text's hash, 128 without an id.
    Rows with the same id and text share it."""
    d = texts(docs, id_col, text_col)
    return d.select("doc_id", "text", *row_key(d["doc_id"], d["text"]))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(NO_ID)).alias("place"), F.xxhash64(text).alias("one"),
            F.when(doc_id.isNull(), F.xxhash64(F.lit(1), text)).otherwise(F.lit(0).cast("long")).alias("two")]


def keyed(docs: DataFrame, id_col: str) -> Column:
    return docs[id_col].cast("long")


__all__ = ["QUERIES", "ORACLES", "query", "prepare", "parts", "table", "texts", "identified", "row_key", "NO_ID", "keyed", "cut_lineage", "frugal", "give_back",
           "BATCH_ROWS", "BATCH_BYTES", "FLUSH_WORDS"]
