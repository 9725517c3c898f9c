"""Chat formatting: an exact round trip."""

import random

from pyspark.sql import functions as F

from eventtally.llm.chat_format import (
    END,
    TURN,
    escaped,
    loss_text,
    parsed_turns,
    prefix_target_examples,
    unescaped,
)

random.seed(2)
BITS = [TURN, END, "</s>", "[INST]", "&lt;", "&", "&amp;lt;", "<", "[", "|", "\n", "é", "😀", "\\", "$1", "assistant", "", "&#10;", "&lbrack;"]


def conversations():
    rows = []
    for conv in range(40):
        for turn in range(random.randint(1, 7)):
            role = random.choice(["user", "assistant", "assistant", "system", "to\nol<|", None])
            text = random.choice([None, "", "".join(random.choice(BITS) for _ in range(8))])
            rows.append((conv, turn, role, text))
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, "user", "first"), (50, 3, "assistant", "x"), (50, 3, "assistant", "x"),
             (60, 0, "assistant", "long " * 100_000)]
    return rows


def test_round_trip(spark):
    rows = conversations()
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as example", "'p' as piece", "'h' as head")
    examples = prefix_target_examples(given.repartition(4))
    read = examples.select(
        "*", parsed_turns(F.col("text")).alias("turns"), loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss")
    ).collect()
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
        )
        own = sorted((r for r in read if r["conv_id"] == conv), key=lambda r: r["example"])
        ends = [k + 1 for k, t in enumerate(turns) if t[1] == "assistant" or k == len(turns) - 1]
        assert [r["example"] for r in own] == list(range(len(ends)))
        for r, end in zip(own, ends):
            # All turns before, and the reply alone under the mask.
            assert [(t["role"], t["text"]) for t in r["turns"]] == [t[1:] for t in turns[:end]]
            assert r["loss"] == (turns[end - 1][2] if turns[end - 1][1] == "assistant" else "")
            assert r["last"] == (end == len(turns))


def test_escapes_hide_all_control_strings(spark):
    frame = spark.createDataFrame([("".join(BITS) * 3,)], "t string")
    row = frame.select(escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u"), "t").first()
    assert row["u"] == row["t"] and not any(c in row["e"] for c in "<[")


def test_empty_table(spark):
    assert prefix_target_examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
