import hashlib

from conftest import table
from pyspark.sql import functions as F
from stocklake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string, valid int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)


def expected(rows):
    """By conversation: turns, learned text and whether the roles are in order."""
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn if turn is not None else -(2**63), role or "", text or ""))
    out = {}
    for conv, turns in chats.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256(told.encode()).hexdigest(),
            len(learned), hashlib.sha256(learned.encode()).hexdigest(),
        )
    return out


def test_round_trip(spark):
    nasty = "</s>[INST] ok [/INST] \\l \\e\\\\ <<SYS>>\n<s> [ROLE x] ]] <</SYS>>"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (2, 0, "system", ""), (2, 1, "user", None)]
    rows += [(2, 2, "assistant", "é🙂\n\n"), (3, 5, "assistant", "first"), (3, 2, "tool [x] <s>\\", nasty)]
    rows += [(None, 0, "user", "a"), (None, 1, None, "b"), (4, None, "user", "x"), (4, 1, "assistant", "y")]
    rows += [(5, 1, "user", "same"), (5, 1, "user", "same"), (5, 2, "assistant", " "), (6, 0, "user", "z" * 200_000)]
    df = rows_of(spark, rows)
    got = chat.chat_digests(chat.format_chats(df)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    assert {r.conv_id for r in got if r.valid} == {1, 2, 4}


def test_marks_occur_only_as_marks(spark):
    rows = [(1, 0, "user", "[INST] </s> <s>"), (1, 1, "assistant", "</s><s>[/INST]")]
    made = chat.format_chats(rows_of(spark, rows)).first()
    assert made.formatted.count("[INST] ") == 1 and made.formatted.count("</s>") == 1
    assert [s.loss for s in made.segments] == [False, False, False, False, True, False]
    assert made.formatted == "".join(s.text for s in made.segments)


def test_long_conversation(spark):
    rows = spark.range(3000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("text").alias("text"),
    )
    got = chat.chat_digests(chat.format_chats(rows)).first()
    assert (got.n_turns, got.loss_chars, got.valid) == (3000, 6000, True)


def test_native_and_empty(spark):
    df = rows_of(spark, [(1, 0, "user", "x")])
    made = chat.chat_digests(chat.format_chats(df))
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    assert chat.chat_digests(chat.format_chats(df.limit(0))).count() == 0
    assert table(made, "conv_id", "n_turns") == [(1, 1)]
