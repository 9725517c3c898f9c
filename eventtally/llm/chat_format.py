"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context and only its
reply is trainable. What follows the last reply is kept as one further example without a
trainable part, so that no turn of a conversation is lost.

Template: `<|turn|>` role, line feed, text, `<|end|>`. Inside roles and texts `&`, `<` and `[`
are written as `&amp;`, `&lt;` and `&lbrack;`, so no control string of this or another bracketed
template can occur in them; a line feed in a role is `&#10;`. `unescaped` undoes this exactly.

Defined cases: rows of a conversation are ordered by turn, then role, then text; null turns come
first. Rows with a null conv_id form one conversation. Repeated rows are turns of their own. A
null text or role is empty. Other columns of the input are ignored, whatever their names.
The output grows with the square of a conversation's turns, as the expansion asks; one
conversation must fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.llm.common import joined, query, table

TURN, END = "<|turn|>", "<|end|>"
REPLY_ROLE = "assistant"

# Written in this order, read back in the opposite one.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lbrack;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def prefix_target_examples(rows: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, loss_start (from 0), loss_chars, last.

    The loss mask of an example is the stretch of `text` from loss_start over loss_chars code
    points. `last` marks the example that holds all turns of its conversation.
    """
    turns = rows.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    head = F.transform(
        "turns", lambda t: F.concat(F.lit(TURN), escaped(t["role"], ROLE_ESCAPES), F.lit("\n"))
    )
    body = F.transform("turns", lambda t: escaped(t["text"]))
    reply = F.transform("turns", lambda t: t["role"] == REPLY_ROLE)
    laid = whole.select("conv_id", head.alias("head"), body.alias("body"), reply.alias("reply"))
    laid = laid.withColumn(
        "piece", F.zip_with("head", "body", lambda h, b: F.concat(h, b, F.lit(END)))
    )
    # Places of the replies, and of the last turn when it is not a reply.
    size = F.size("reply")
    places = F.filter(
        F.sequence(F.lit(1), size), lambda k: F.element_at("reply", k) | (k == size)
    )
    each = laid.select("conv_id", "head", "body", "reply", "piece", F.posexplode(places).alias("example", "k"))
    context = joined(F.slice("piece", F.lit(1), F.col("k") - 1))
    here = F.element_at("head", F.col("k"))
    answer = F.element_at("body", F.col("k"))
    trained = F.element_at("reply", F.col("k"))
    before = F.concat(context, here)
    return each.select(
        "conv_id",
        F.col("example").cast("int").alias("example"),
        F.concat(before, answer, F.lit(END)).alias("text"),
        F.when(trained, F.length(before)).otherwise(0).alias("loss_start"),
        F.when(trained, F.length(answer)).otherwise(0).alias("loss_chars"),
        (F.col("k") == F.size("reply")).alias("last"),
    )


def parsed_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.split(text, r"<\|turn\|>")
    parts = F.slice(parts, F.lit(2), F.size(parts))
    return F.transform(
        parts,
        lambda p: F.struct(
            unescaped(F.substring_index(p, "\n", 1), ROLE_ESCAPES).alias("role"),
            unescaped(
                F.substr(
                    p,
                    F.instr(p, "\n") + 1,
                    F.length(p) - F.instr(p, "\n") - len(END),
                )
            ).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    return unescaped(F.substr(text, start + 1, chars))


PROBE_ID = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"

OP9_SQL = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 8 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lbrack;'), chr(10), '&#10;'))
    + 1 + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lbrack;')) + 7 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM every),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS reach FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(reach) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


@query(OP9_SQL)
def op9_prefix_targets(spark, sf_dir):
    """What is read back from the examples of every conversation."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY_ROLE).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    examples = prefix_target_examples(given.unionByName(probe))
    read = examples.select(
        "conv_id",
        F.when(F.col("last"), F.col("text")).alias("whole"),
        F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss")).alias("e"),
        F.length("text").cast("long").alias("chars"),
    )
    back = read.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.array_sort(F.collect_list("e")).alias("examples"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = back.select(
        "conv_id",
        parsed_turns(F.col("whole")).alias("turns"),
        joined(F.col("examples.loss")).alias("loss"),
        "formatted_chars",
    )
    text = joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
