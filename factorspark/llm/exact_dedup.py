"""Operator 7, exact dedup: one document of each group of equal texts stays.

Native: DataFrame functions only.  Rows are grouped by the 128-bit content
hash of the normalised text and, inside a hash, by the bytes of that text, so
two texts that collide are never merged.  The partial aggregation keeps each
distinct text of a task once, whatever the number of copies; a hot text moves
once per task.  Members find their group by hash in a plain join, whose hot
keys Spark can split; no group is ever gathered.

Defined cases: a null text is empty, and empty texts equal each other; rows
that repeat a ``doc_id`` count one by one and share the result of their text; a
row without id can only stay if no equal text has an id; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table, texts

#: The characters that do not count, ``[\x20\x09-\x0D]``.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text):
    return reduce(lambda c, b: F.replace(c, F.lit(b), F.lit("")), BLANKS, text)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points, then the smallest id,
    stays.
    """
    d = texts(docs, id_col, text_col).select(
        "doc_id", normalised(F.col("text")).alias("norm"), F.length("text").cast("long").alias("n"))
    d = d.withColumn("hash", F.unhex(F.md5(F.col("norm").cast("binary"))))
    # ~id falls as id grows and cannot overflow; a null id is the least of all.
    groups = (d.groupBy("hash", "norm")
              .agg(F.max(F.struct("n", F.bitwise_not("doc_id").alias("inv"))).alias("best"),
                   F.count(F.lit(1)).alias("group_size"))
              .select("hash", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                      F.bitwise_not("best.inv").alias("keep_id"), "group_size"))
    rows = d.select("doc_id", "hash", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    return (rows.join(groups, ["hash", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept,
       sha256(norm) AS text_sha256
FROM k
"""


@query("op7_exact_dedup", ORACLE)
def op7_exact_dedup(spark, sf_dir):
    """Exact duplicates of all documents by content hash and bytes."""
    return exact_dedup(table(spark, sf_dir, "documents"))
