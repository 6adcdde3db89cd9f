"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log has events ``(conv_id, seq, turn, kind, role, text)``. By ``seq`` they fold into final messages: a ``delta`` adds
its text to the turn's message, an ``edit`` replaces what the turn had, and a ``regenerate`` does so too and takes back every
later turn recorded before it. The messages are rendered in the order of turns.

Template: each turn is ``<s>role\\ntext</s>``. Inside role and text ``\\`` becomes ``\\e``, ``<`` becomes ``\\l`` and ``[`` becomes
``\\b`` (in a role also a new line ``\\n``), so no control string with an angle or square bracket, this template's own included, can occur in
them, and reading back is exact.

``loss_mask`` has for each turn how many code points to skip from its start and how many to take; it takes assistant texts.

Nulls: a null text or role is empty, a null turn comes first, rows without conv_id are one conversation. Rows of one
turn are messages of their own, by role and text. A text of any length is one string of its conversation's, which a row must be able to hold. Other columns are left alone,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainfold.llm.common import table

OPEN, CLOSE = "<s>", "</s>"


def replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column) -> Column:
    return replaced(text, ("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))


def unescape(text: Column) -> Column:
    return replaced(text, ("\\l", "<"), ("\\b", "["), ("\\e", "\\"))


def fold(events: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``: the messages that stand when the log ends."""
    turn = Window.partitionBy("conv_id", "turn")
    earlier = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    resets = F.max(F.when(F.col("kind") != "delta", F.col("seq"))).over(turn)
    taken = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    live = events.withColumns({"reset": resets, "taken": taken})
    live = live.where("(reset is null or seq >= reset) and (taken is null or seq > taken)")
    parts = F.array_sort(F.collect_list(F.struct("seq", "role", "text")))
    return live.groupBy("conv_id", "turn").agg(parts.alias("parts")).select("conv_id", "turn", F.element_at("parts", -1)["role"].alias("role"), F.array_join(F.col("parts.text"), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_mask)`` of messages ``(conv_id, turn, role, text)``."""
    body = escape(F.col("text"))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    mask = F.struct(F.length("head").alias("skip"), F.when(F.col("role") == "assistant", F.length("body")).otherwise(0).alias("take"))
    turns = messages.select("conv_id", "turn", "role", head.alias("head"), body.alias("body"))
    turns = turns.select("conv_id", F.struct("turn", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), mask.alias("mask")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return turns.select("conv_id", F.array_join(F.col("ts.piece"), "").alias("formatted"), F.col("ts.mask").alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold: ``turns`` (role, text) and ``loss``, the texts under the mask."""
    parts = F.split("formatted", OPEN, -1)
    pieces = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: F.concat(F.lit(OPEN), p))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.substr(head, F.lit(len(OPEN) + 1))
        text = F.substr(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - len(CLOSE))
        return F.struct(unescape(F.replace(role, F.lit("\\n"), F.lit("\n"))).alias("role"), unescape(text).alias("text"))

    loss = F.zip_with("pieces", "loss_mask", lambda p, m: unescape(F.substr(p, m["skip"] + 1, m["take"])))
    return formatted.withColumn("pieces", pieces).select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.array_join(loss, "").alias("loss"))


def as_events(conversations: DataFrame) -> DataFrame:
    """Finished conversations as the log that would have led to them, by turn; every row is a turn of its own.

    A text was streamed as two deltas; of an assistant's only the first half, which an edit then replaced by the whole.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("at"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turn = F.row_number().over(Window.partitionBy("conv_id").orderBy("at", "role", "text")).cast("long")
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda n, kind, text: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), text.alias("part"))
    second = F.when(F.col("role") == "assistant", event(1, "edit", F.col("text"))).otherwise(event(1, "delta", F.substr("text", half + 1)))
    events = rows.withColumn("turn", turn).select("conv_id", "turn", "role", F.inline(F.array(event(0, "delta", F.substr("text", F.lit(1), half)), second)))
    return events.select("conv_id", (2 * F.col("turn") + F.col("n")).alias("seq"), "role", F.col("part").alias("text"), "turn", "kind")


def format_conversations(conversations: DataFrame) -> DataFrame:
    return render(fold(as_events(conversations)))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(format_conversations(rows)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b'), chr(10), '\n') AS own_role,
    replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b') AS own_text FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(8 + length(own_role) + length(own_text)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
