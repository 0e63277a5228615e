"""Text expressions: tokenisers, regex cleaning and HTML stripping, all
built-in (JVM) functions; the same patterns run in DuckDB for the oracle."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's Unicode \w, spelled out so Spark (Java) and DuckDB (RE2) agree
WORD = r"([\p{L}\p{N}_]+)"
WORD2 = r"([\p{L}\p{N}_]{2,})"

# The header pattern of the risk sections (items 1A, 7, 7A) as
# the reference writes it.
SECTION_HEADER = r"(>Item(\s|&#160;|&nbsp;)(1A|7A|7)\.{0,1})|(ITEM\s(1A|7A|7))"

SENTENCE_SPLIT = r"[.!?]+\s+|\n+"

# A short English stop-word list (function words).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in",
              "is", "it", "its", "of", "on", "or", "that", "the", "to", "was", "were", "will",
              "with", "this", "which", "we", "our", "they", "their", "not", "but", "have", "had"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


NON_WORD = r"[^\p{L}\p{N}_]+"


def tokens(text, min2: bool = False) -> Column:
    """Word tokens (``\\w+`` or ``\\w\\w+``): the maximal runs of
    word characters, found by splitting on non-word runs (same tokens as
    ``regexp_extract_all`` of the word pattern, about 3x cheaper)."""
    parts = F.split(_c(text), NON_WORD)
    n = 2 if min2 else 1
    return F.filter(parts, lambda t: F.length(t) >= n)


def doc_len(text) -> Column:
    """X11: number of ``\\w+`` tokens."""
    return F.size(tokens(text))


def normalise_item(header) -> Column:
    """X4: '>Item&#160;1A.' -> 'item1a' (lower, drop entities, blanks, '.', '>')."""
    return F.regexp_replace(F.lower(_c(header)), r"&#160;|&nbsp;|\s|\.|>", "")


ENTITY = r"&(#[0-9]{1,7}|#x[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"


def _char(code: Column) -> Column:
    """Character of a code point; of no character, U+FFFD."""
    fine = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def bound(value, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body
    names it (a lambda's variable is not spelled out again)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _decoded(x: Column) -> Column:
    names = F.create_map(*[F.lit(v) for k, c in sorted(name2codepoint.items()) for v in (k, chr(c))])
    found = F.transform(F.regexp_extract_all(x, F.lit(ENTITY), 1), lambda e: (
        F.when(e.startswith("#x"), _char(F.conv(F.substr(e, F.lit(3)), 16, 10).cast("long")))
        .when(e.startswith("#"), _char(F.substr(e, F.lit(2)).try_cast("long")))
        .otherwise(F.coalesce(F.try_element_at(names, e), F.concat(F.lit("&"), e, F.lit(";"))))))
    # There is one piece more than there are entities.
    return F.array_join(F.zip_with(F.split(x, ENTITY, -1), found, lambda piece, e: F.concat(
        piece, F.coalesce(e, F.lit("")))), "")


def decode_entities(text) -> Column:
    """Named (HTML 4), decimal and hexadecimal entities to their characters, a
    no-break space to a blank; unknown names stay.  Linear in the text."""
    return bound(_c(text), lambda x: F.replace(F.when(x.contains("&"), _decoded(x)).otherwise(x),
                                               F.lit("\u00a0"), F.lit(" ")))


def strip_html(html) -> Column:
    """drop script/style blocks, comments and tags, decode entities,
    collapse blanks, lower-case."""
    x = F.regexp_replace(_c(html), r"(?is)<script[^>]*>.*?</script\s*>", " ")
    x = F.regexp_replace(x, r"(?is)<style[^>]*>.*?</style\s*>", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"<[^>]*>", " ")
    x = F.regexp_replace(decode_entities(x), r"\s+", " ")
    return F.lower(F.trim(x))


def clean_tokens(toks, stop: list[str] = STOP_WORDS) -> Column:
    """Keep alphabetic tokens that are not stop words."""
    sw = F.array(*[F.lit(w) for w in stop])
    return F.filter(_c(toks), lambda t: t.rlike(r"^\p{L}+$") & ~F.array_contains(sw, t))


def sentences(text) -> Column:
    """Sentence split at . ! ? followed by blanks, or at line breaks
    (the closing punctuation is dropped; tokens ignore it anyway)."""
    return F.split(_c(text), SENTENCE_SPLIT)
