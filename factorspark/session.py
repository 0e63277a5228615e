"""Session settings, NaN handling, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings every job relies on (safe to set on a live session).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Largest table (bytes) AQE may turn into a broadcast at run time.  The
# measured shuffle size is the check; beyond it the join stays sort-merge.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "factorspark",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench: UI off, UTC, AQE on."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("FS_DRIVER_MEM", "16g"))
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold",
                 str(BROADCAST_LIMIT_BYTES))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL so aggregates skip missing values like pandas does (M6, M7)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared lineage-cut folder: the cluster's ``spark.checkpoint.dir``.

    A local session that names none gets a scratch folder; a cluster must
    name one, as executors cannot see each other's own folders.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not re.match(r"local(\[.*)?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="factorspark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_dim(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a dimension that ``max_rows`` bounds: the rows are
    counted, up to one more than that, and a larger table keeps the join that
    Spark picks for it."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def rnd(c: Column | str, digits: int = 8) -> Column:
    """Round for oracle comparison (same half-up rule in Spark and DuckDB)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)
