"""Documents -> packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.

toxicity         documents that are toxic by their language's threshold go
line_dedup       later repeated runs of lines are cut; a document whose lines
                 all were in such runs goes
ngram_join       of documents linked at 80 % of their shingles the one with the
                 smallest id stays, then the smallest hash of the text (rows
                 are told apart by id and text; rows without id come last);
                 rows that repeat id and text become one
decontamination  spans that match the benchmark are cut; documents that mostly
                 consist of them go
packing          what is left becomes token sequences
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factorspark.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from factorspark.llm.common import table
from factorspark.session import checkpoint_dir


def _counted(docs):
    """``n_chars``, if there, says again how long the text is."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else docs


def reject_toxic(spark, docs, sf_dir):
    return toxicity.reject(docs, toxicity.fit_on(spark, sf_dir, docs))


def cut_repeated_lines(spark, docs, sf_dir):
    return _counted(line_dedup.remove(docs))


def one_of_each_group(spark, docs, sf_dir):
    return ngram_join.one_of_each(docs)


def cut_benchmark(spark, docs, sf_dir):
    return _counted(decontaminate.remove(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("decontamination", cut_benchmark),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer decide the rows; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on ``documents``; each result is written as Parquet to the
    shared folder and read again as the next one's documents."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
