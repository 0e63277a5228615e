"""Text sources: filings, file-name keys, lexicon and word tables.

The test tables hold invented prose (``documents``), not filings, so the
adapters below only *shape* it into the inputs the text jobs expect:

* ``raw_filings`` - one filing per document in the EDGAR submission layout:
  a main ``<DOCUMENT>`` of type 10-K whose lines are headed in turn by
  "Item 1A / 7 / 7A" headers in the HTML spellings filings use (entity
  spaces, upper case), preceded by a table of contents, plus an exhibit
  document.  Finding, de-duplicating and slicing the headers is the job's
  work (``plans.text.sections``), which does not assume this layout.
* ``lexicon`` - six sentiment word lists drawn from the corpus vocabulary
  by a fixed character rule (FIXTURES B.3), a few words in two lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from .tables import read

# The six sentiment categories of the financial lexicon, in
# the reference's column order (their order is the merge priority of X18).
SENTIMENTS = ["negative", "positive", "uncertainty", "litigious", "constraining", "interesting"]

_HEADERS = ["<p><b>Item&#160;1A.</b> Risk Factors</p>", "<p>ITEM 7 Management discussion</p>",
            "<p><b>Item&nbsp;7A.</b> Market risk</p>", "<div>>Item 1A. continued</div>"]
_TOC = "<table><tr><td>>Item 1A</td><td>>Item 7</td><td>>Item 7A</td></tr></table>"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings keyed like the reference: ticker = source, a filing date
    derived from the document id (inside the bar history, so filings can be
    joined to prices), the text."""
    d = read(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    return d.select("doc_id", F.col("source").alias("ticker"), "lang",
                    F.date_add(F.lit("1995-01-02").cast("date"), (F.col("doc_id") % 2400).cast("int"))
                    .alias("date"), "text")


def raw_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    hdr = F.array(*[F.lit(h) for h in _HEADERS])
    lines = F.split(F.col("text"), "\n")
    body = F.array_join(F.transform(lines, lambda ln, i: F.concat(
        F.when(i % 3 == 0, F.element_at(hdr, (F.floor(i / 3) % 4 + 1).cast("int"))).otherwise(F.lit("")),
        F.lit("<p>"), ln, F.lit("</p>"))), "\n")
    main = F.concat(F.lit("<DOCUMENT>\n<TYPE>10-K\n<TEXT>\n"), F.lit(_TOC), F.lit("\n"), body,
                    F.lit("\n</TEXT>\n</DOCUMENT>\n"))
    exhibit = F.concat(F.lit("<DOCUMENT>\n<TYPE>EX-21\n<TEXT>\n"), F.element_at(lines, 1),
                       F.lit("\n</TEXT>\n</DOCUMENT>\n"))
    return d.select("doc_id", "ticker", "date", F.concat(main, exhibit).alias("raw"))


def section_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed-filing text with sections separated by the degree sign and
    headed 'Item N.' (the input of X7): each document line becomes a section,
    items 1-4 in turn."""
    d = documents(spark, sf_dir)
    secs = F.transform(F.split(F.col("text"), "\n"), lambda ln, i: F.concat(
        F.lit("Item "), (i % 4 + 1).cast("string"), F.lit(". "), ln))
    return d.select("doc_id", F.array_join(secs, "°").alias("text"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored-filing names ``{ticker}_{doc_type}_{yyyymmdd}.txt`` (S18 input)."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.concat(F.lit("/data/filings/"), "ticker", F.lit("_10-K_"),
                                       F.date_format("date", "yyyyMMdd"), F.lit(".txt")).alias("path"))


def lexicon(spark: SparkSession, sf_dir: str, vocab: DataFrame | None = None) -> DataFrame:
    """(word, sentiment): vocabulary words of 3+ letters; sentiment by the
    first character's code mod 6, words of 10+ letters also by length mod 6.
    ``vocab`` (column ``term``) saves re-tokenising when the caller has it."""
    if vocab is None:
        d = read(spark, sf_dir, "documents", "text")
        vocab = d.select(F.explode(tokens(F.lower("text"), min2=True)).alias("term"))
    words = vocab.select(F.col("term").alias("word")).filter(F.length("word") >= 3).distinct()
    names = F.array(*[F.lit(s) for s in SENTIMENTS])
    a = words.select("word", F.element_at(names, (F.ascii("word") % 6 + 1).cast("int")).alias("sentiment"))
    b = words.filter(F.length("word") >= 10).select(
        "word", F.element_at(names, (F.length("word") % 6 + 1).cast("int")).alias("sentiment"))
    return a.unionByName(b).distinct()


def ticker_assets(docs: DataFrame) -> DataFrame:
    """Ticker -> asset id of the price panel (``srcN`` -> supplier N + 1):
    the link the reference gets from its ticker/CIK tables."""
    return docs.select("ticker").distinct().select(
        "ticker", (F.regexp_extract("ticker", r"(\d+)$", 1).cast("long") + 1).alias("asset"))
