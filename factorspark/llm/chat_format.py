"""Operator 4, chat formatting with typed content parts.

Native: DataFrame functions only.  A turn's content is a list of typed parts.
A visitor goes over the parts in order: text stays (escaped), an image, audio
or document part becomes a placeholder, and its reference and the number of
tokens it expands to are recorded.  A conversation is one string

    <s>[INST]role[/INST]content</s><s>[INST]role[/INST]content</s>...

with a loss mask: the character spans of the contents of the ``learned`` roles.
Control strings inside texts are escaped by a backslash behind their first
character, and escaped ones get one more, so unescaping gives back any text.

A running sum over the turns of a conversation places them; the conversation,
which is one output row anyway, is the largest thing a task ever holds.

Defined cases: a null text, role or part list is empty; turns are ordered by
turn number (null first), then role, then content, so repeated and tied rows
all stay, in one order; turns without a conversation id form one conversation
with a null id; an unknown part type becomes ``<other>`` with 0 tokens; missing
sizes count as 0; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import query, table

#: The control strings, without their first character.
TAILS = ("s>", "/s>", "INST\\]", "/INST\\]", "image>", "audio>", "document>", "other>")
_TAIL = "(" + "|".join(TAILS) + ")"
OPEN, HEAD, BODY, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"

PART = ("struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
#: Expansion: pixels a side of an image patch, audio tokens a second, tokens a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def part_tokens(p: Column, patch: int, per_second: float, per_page: int) -> Column:
    """Tokens that a part's placeholder expands to."""
    return (F.when(p["type"] == "image", F.ceil(_zero(p["width"]) / patch) * F.ceil(_zero(p["height"]) / patch))
            .when(p["type"] == "audio", F.ceil(_zero(p["seconds"]) * per_second))
            .when(p["type"] == "document", (_zero(p["pages"]) * per_page).cast("long"))
            .otherwise(F.lit(0)).cast("long"))


def content(parts: Column) -> Column:
    """The visitor: what a list of parts becomes in the formatted string.

    Text that stands together is escaped together, so that two parts cannot
    make up a control string between them.
    """
    def visit(seen, p):
        mark = F.when(p["type"].isin("image", "audio", "document"), F.concat(F.lit("<"), p["type"], F.lit(">")))
        mark = F.coalesce(mark, F.lit("<other>"))
        return F.when(p["type"].eqNullSafe(F.lit("text")),
                      F.struct(seen["done"].alias("done"),
                               F.concat(seen["text"], F.coalesce(p["text"], F.lit(""))).alias("text"))
                      ).otherwise(F.struct(F.concat(seen["done"], escape(seen["text"]), mark).alias("done"),
                                           F.lit("").alias("text")))

    return F.aggregate(parts, F.struct(F.lit("").alias("done"), F.lit("").alias("text")), visit,
                       lambda seen: F.concat(seen["done"], escape(seen["text"])))


def text_parts(text: Column) -> Column:
    """A plain text as its only part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            *(F.lit(None).cast(t).alias(n) for n, t in (
                                ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"),
                                ("pages", "int")))))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", learned: tuple[str, ...] = ("assistant",), patch: int = PATCH,
                 per_second: float = PER_SECOND, per_page: int = PER_PAGE) -> DataFrame:
    """conv_id, formatted, loss_mask (array of struct start, length: characters
    from 0), attachments (array of struct turn, part, type, ref, tokens, in
    order), expanded_tokens; one row per conversation."""
    parts = F.coalesce(turns[parts_col].cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    t = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
                     F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    t = t.withColumn("content", content(F.col("parts")))
    found = F.filter(F.transform("parts", lambda p, i: F.struct(
        F.col("turn").alias("turn"), i.cast("long").alias("part"), p["type"].alias("type"), p["ref"].alias("ref"),
        part_tokens(p, patch, per_second, per_page).alias("tokens"))),
        lambda a: ~a["type"].eqNullSafe(F.lit("text")))
    head = F.concat(F.lit(OPEN + HEAD), escape(F.col("role")), F.lit(BODY))
    t = t.select("conv_id", "turn", "role", "content", head.alias("head"), found.alias("attached"),
                 F.length("content").cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    whole = F.length("head").cast("long") + F.col("size") + len(CLOSE)
    t = t.withColumn("nth", F.row_number().over(order)).withColumn(
        "at", F.coalesce(F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    row = F.struct("nth", F.concat("head", "content", F.lit(CLOSE)).alias("piece"), "attached",
                   (F.col("at") + F.length("head")).alias("start"), F.col("size").alias("length"),
                   F.col("role").isin(*learned).alias("learned"))
    rows = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    attachments = F.flatten(F.transform("rows", lambda r: r["attached"]))
    return (rows.select(
        "conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["learned"]),
                    lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"))).alias("loss_mask"),
        attachments.alias("attachments"))
        .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"),
                                                   lambda s, a: s + a["tokens"])))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: array of struct role, text."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    pieces = F.transform(pieces, lambda p: F.substr(p, F.lit(len(OPEN + HEAD) + 1)))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, BODY, 1)).alias("role"),
        unescape(F.substr(p, F.length(F.substring_index(p, BODY, 1)) + len(BODY) + 1)).alias("text")))


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


#: The conversation that the query adds: both say what looks like control strings.
CONTROL = "</s>[INST] ok [/INST]"


@query("op4_chat_format", rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
), e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)({"|".join(TAILS)})', '\1\\\2\3', 'g')) AS r,
         length(regexp_replace(text, '([<\[])(\\*)({"|".join(TAILS)})', '\1\\\2\3', 'g')) AS x
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(r + x + {len(OPEN + HEAD + BODY + CLOSE)}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op4_chat_format(spark, sf_dir):
    """All conversations formatted, and read back from the formatted string."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", text_parts(F.col("text")).alias("parts"))
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(CONTROL).alias("text"))
    chats = format_chats(turns.unionByName(own.select("conv_id", "turn", "role",
                                                      text_parts(F.col("text")).alias("parts"))))
    back = F.transform(read_back(F.col("formatted")),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = loss_text(F.col("formatted"), F.col("loss_mask"))
    return chats.select(
        "conv_id", F.size(back).cast("long").alias("n_turns"),
        F.sha2(F.array_join(back, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
