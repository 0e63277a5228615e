"""Filing structure X1-X7, S15, S18: documents, types, section headers and
their positions, section text, cleaning.  Everything about a filing happens in
its own row: the main document is picked, headers are located (``split`` piece
lengths stand in for ``finditer``) and sections are cut with array functions,
and only small results are exploded, so no text is ever shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import text as tx

KEY = ("ticker", "date", "doc_id")
_BODIES = r"(?s)<DOCUMENT>(.*?)</DOCUMENT>"
_TYPE = r"<TYPE>([^\n]+)"


def split_documents(filings: DataFrame, key=KEY, raw: str = "raw") -> DataFrame:
    """The ``<DOCUMENT>`` bodies of a submission with their position
    and ``<TYPE>``."""
    bodies = F.regexp_extract_all(F.col(raw), F.lit(_BODIES), 1)
    d = filings.select(*key, F.posexplode(bodies).alias("doc_pos", "body"))
    return d.withColumn("doc_type", F.regexp_extract("body", _TYPE, 1))


def main_documents(filings: DataFrame, doc_type: str = "10-K", key=KEY, raw: str = "raw",
                   since: str | None = None) -> DataFrame:
    """The first document of the target type of every filing that has one,
    of filings not older than ``since`` (yyyy-mm-dd)."""
    f = filings if since is None else filings.filter(F.col("date") >= F.lit(since).cast("date"))
    own = F.filter(F.regexp_extract_all(F.col(raw), F.lit(_BODIES), 1),
                   lambda b: F.regexp_extract(b, _TYPE, 1) == doc_type)
    # A generator of none or one row: a filter on the body would find it twice.
    return f.select(*key, F.explode(F.slice(own, 1, 1)).alias("body"))


def headers(text: Column, pattern: str = tx.SECTION_HEADER) -> Column:
    """array of struct (start_pos, end_pos, item) of every header match:
    a match starts after all pieces and matches before it."""
    m = F.regexp_extract_all(text, F.lit(pattern), 0)
    both = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(m)).alias("piece"), m.alias("match"))
    none = F.array().cast("array<struct<start_pos:bigint,end_pos:bigint,item:string>>")

    def step(seen, x):
        start = (seen["at"] + F.length(x["piece"])).cast("bigint")
        end = (start + F.length(x["match"])).cast("bigint")
        found = F.struct(start.alias("start_pos"), end.alias("end_pos"), tx.normalise_item(x["match"]).alias("item"))
        return F.struct(end.alias("at"), F.concat(seen["found"], F.array(found)).alias("found"))

    return F.aggregate(both, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found")), step,
                       lambda seen: seen["found"])


def sections(docs: DataFrame, key=KEY, text: str = "body") -> DataFrame:
    """X4 / S15 in the document's row: ``sections``, an array of struct (item,
    start_pos, end_pos, next_start).

    The last match of an item counts (which skips the table of contents, B7
    fixed); a section ends where the next one kept starts (B8 fixed) or with
    the text; a document without headers is one section 'all'.
    """
    size = F.length(text).cast("bigint")
    d = docs.select(*key, text, headers(F.col(text)).alias("_h"))
    items = F.array_distinct(F.transform("_h", lambda h: h["item"]))
    last = F.array_sort(F.transform(items, lambda i: F.element_at(F.filter("_h", lambda h: h["item"] == i), -1)))
    d = d.select(*key, text, last.alias("_last"))
    cut = F.transform("_last", lambda h, i: F.struct(
        h["item"].alias("item"), h["start_pos"].alias("start_pos"), h["end_pos"].alias("end_pos"),
        F.coalesce(F.get(F.col("_last"), i + 1)["start_pos"], size).alias("next_start")))
    zero = F.lit(0).cast("bigint")
    whole = F.array(F.struct(F.lit("all").alias("item"), zero.alias("start_pos"), zero.alias("end_pos"),
                             size.alias("next_start")))
    return d.select(*key, text, F.when(F.size("_last") > 0, cut).otherwise(whole).alias("sections"))


def section_positions(docs: DataFrame, key=KEY, text: str = "body") -> DataFrame:
    """One row per section (also the S15 audit table).

    The generator reads an expression: of a plain column Catalyst infers a
    filter on its size and spells its whole chain out again below.
    """
    return sections(docs, key, text).select(*key, F.inline(F.transform("sections", lambda s: F.struct(
        *(s[c].alias(c) for c in ("item", "start_pos", "end_pos", "next_start"))))))


def _cut(text: Column, s: Column) -> Column:
    return F.substr(text, (s["end_pos"] + 1).cast("int"), (s["next_start"] - s["end_pos"]).cast("int"))


def section_text(docs: DataFrame, key=KEY, text: str = "body") -> DataFrame:
    """Each section between its header's end and the next section."""
    cut = F.transform("sections", lambda s: F.struct(s["item"].alias("item"), _cut(F.col(text), s).alias("section")))
    return sections(docs, key, text).select(*key, F.inline(cut))


def clean_filing(docs: DataFrame, key=KEY, text: str = "body") -> DataFrame:
    """Cleaned (HTML-stripped, lower-case) text of all sections of a
    filing, concatenated in item order."""
    clean = F.array_sort(F.transform("sections", lambda s: F.struct(
        s["item"].alias("item"), tx.strip_html(_cut(F.col(text), s)).alias("clean"))))
    return sections(docs, key, text).select(*key, F.array_join(F.transform(clean, lambda s: s["clean"]), " ")
                                            .alias("text"))


def longest_sections(marked: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Split on the section mark, keep pieces that start with 'item ',
    key = second word without '.:,', longest text per key."""
    p = marked.select(key, F.posexplode(F.split(F.lower(text), "°")).alias("pos", "piece"))
    p = p.filter(F.col("piece").startswith("item "))
    words = F.split(F.regexp_replace(F.col("piece"), r"^\s+|\s+$", ""), r"\s+")
    p = p.filter(F.size(words) > 1).select(
        key, F.regexp_replace(F.element_at(words, 2), r"[.:,]", "").alias("item"),
        F.array_join(F.slice(words, 3, 1 << 30), " ").alias("text"))
    return p.groupBy(key, "item").agg(F.max_by("text", F.struct(F.length("text"), F.col("text"))).alias("text"))


def file_key(paths: DataFrame, path: str = "path") -> DataFrame:
    """Ticker, document type and date from ``{ticker}_{type}_{yyyymmdd}.ext``."""
    parts = F.split(F.regexp_extract(F.col(path), r"([^/]+)$", 1), r"[._]")
    return paths.select("*", F.element_at(parts, 1).alias("ticker"), F.element_at(parts, 2).alias("doc_type"),
                        F.to_date(F.element_at(parts, 3), "yyyyMMdd").alias("date"))
