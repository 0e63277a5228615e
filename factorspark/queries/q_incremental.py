"""Incremental filing ingestion (G1) over filings derived from ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..registry import register
from ..session import checkpoint_dir, configure
from ..sources import text as st
from ..streaming import incremental as inc


@register("incremental_sections")
def incremental_sections(spark, sf):
    """Filings land in two drops; the availableNow stream processes
    each drop once (a third run over unchanged input adds nothing).  Returns
    the sections table with the batch count of each run."""
    configure(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/ckpt"
    raw = st.raw_filings(spark, sf)
    raw.filter(F.col("doc_id") % 2 == 0).write.parquet(f"{landing}/drop=1")
    runs = [inc.ingest(spark, landing, out, ckpt)]
    raw.filter(F.col("doc_id") % 2 == 1).write.parquet(f"{landing}/drop=2")
    runs.append(inc.ingest(spark, landing, out, ckpt))
    runs.append(inc.ingest(spark, landing, out, ckpt))
    res = spark.read.parquet(f"{out}/sections")
    return res.select("doc_id", "batch", F.length("text").alias("n_chars"),
                      F.lit(",".join(map(str, runs))).alias("batches_per_run"))
