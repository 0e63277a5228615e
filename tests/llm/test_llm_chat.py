"""Operator 4: round trips of typed parts and of control strings."""

import random

from factorspark.llm.chat_format import PART, escape, format_chats, loss_text, read_back, text_parts, unescape
from pyspark.sql import functions as F

BITS = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "image>", "<image>", "a", "é", "\n", " ", "[INST]", "</s>",
        "<\\s>", "[/INST]", "<other>", ""]
MARK = {"image": "<image>", "audio": "<audio>", "document": "<document>", "video": "<other>"}
TOKENS = {"image": 4, "audio": 38, "document": 512, "video": 0}


def test_typed_parts_round_trip(spark):
    r = random.Random(3)
    rows, want = [], {}
    for c in range(120):
        for t in range(r.randrange(1, 5)):
            parts, text = [], ""
            for _ in range(r.randrange(0, 4)):
                if r.random() < 0.7:
                    x = "".join(r.choice(BITS) for _ in range(r.randrange(0, 7)))
                    parts.append(("text", x, None, None, None, None, None))
                    text += x
                else:
                    k = r.choice(list(MARK))
                    parts.append((k, None, f"ref{t}", 30, 29, 1.5, 2))
                    text += MARK[k]
            role = r.choice(["user", "assistant", "system", "<s>x", ""])
            rows.append((c, t, role, parts, 5))
            want.setdefault(c, []).append((role, text, parts))
    chats = format_chats(spark.createDataFrame(
        rows, f"conv_id long, turn long, role string, parts array<{PART}>, content int"))
    for x in chats.select("*", read_back(F.col("formatted")).alias("back"),
                          loss_text(F.col("formatted"), F.col("loss_mask")).alias("learned")).collect():
        turns = want[x.conv_id]
        assert [(b.role, b.text) for b in x.back] == [(a, b) for a, b, _ in turns]
        assert x.learned == "".join(b for a, b, _ in turns if a == "assistant")
        found = [(t, i, p[0], p[2], TOKENS[p[0]]) for t, (_, _, own) in enumerate(turns)
                 for i, p in enumerate(own) if p[0] != "text"]
        assert [tuple(a) for a in x.attachments] == found
        assert x.expanded_tokens == sum(a[4] for a in found)


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[\\INST]x", "plain <b> [x]", "", "<<s>>", "<s><s>"]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for x in out:
        assert x.u == x.t
        assert not any(c in x.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    assert {x.t: x.e for x in out}["plain <b> [x]"] == "plain <b> [x]"


def test_defined_cases(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "b"), (1, None, None, "first"),
            (None, 0, "assistant", "lost"), (1, 2, "assistant", "a"), (2, 0, "assistant", "x" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "parts", F.when(F.col("text").isNotNull(), text_parts(F.col("text"))))
    out = {x.conv_id: x for x in format_chats(turns).select(
        "conv_id", read_back(F.col("formatted")).alias("back"),
        loss_text(F.col("formatted"), F.col("loss_mask")).alias("learned")).collect()}
    assert [tuple(b) for b in out[1].back] == [("", "first"), ("user", ""), ("assistant", "a"), ("assistant", "b"),
                                               ("assistant", "b")]
    assert out[1].learned == "abb" and out[None].learned == "lost" and out[2].learned == "x" * 200_000
    assert format_chats(turns.limit(0)).count() == 0
