"""Chat formatting by event-sourced reconstruction, in DataFrame operations only.

An event log is partitioned by conversation and ordered by sequence; streamed deltas, edits and regenerations fold
into final messages, and these are rendered with turn marks. Work is split below the conversation: messages fold one by one,
and rendering runs over chunks of ``CHUNK`` sequence numbers, so that a very long conversation is many small pieces.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``, so no mark can appear in a text and the escape is undone by dropping the first of each such backslash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_of

CHUNK = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.when(F.instr(text, "\\") == 0, text).otherwise(F.regexp_replace(text, r"(?s)\\(.)", "$1"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, role, text) of events (conv_id, seq, message_id, kind, role, text).

    Kinds: ``message`` and ``edit`` set a message's text, ``regenerate`` starts it afresh, ``delta`` appends. Unknown and
    null kinds count as ``message``; null text as empty. A message stands where its first event stands and has
    the last role that is not null. Equal sequence numbers are ordered by kind and text, and equal events are
    one event only if they are all equal in kind ``message``, ``edit`` or ``regenerate`` (each sets the same text); equal
    deltas append twice. Null conversation and message ids are ordinary values.
    """
    rows = events.select("conv_id", "message_id", "seq", "role", F.coalesce("kind", F.lit("message")).alias("kind"), text_of("text").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("seq", "kind", "text")))
    made = rows.groupBy("conv_id", "message_id").agg(
        F.min("seq").alias("seq"), F.max_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"), parts.alias("parts")
    )
    text = F.aggregate("parts", F.lit(""), lambda a, e: F.when(e["kind"] == "delta", F.concat(a, e["text"])).otherwise(e["text"]))
    return made.select("conv_id", "seq", "role", text.alias("text"))


def rendered(messages: DataFrame, mask_role: str = "assistant") -> DataFrame:
    """Chunks (conv_id, chunk, formatted, spans) of messages (conv_id, seq, role, text).

    Chunks hold ``CHUNK`` consecutive sequence numbers and in order make up the conversation. ``spans`` are the
    ranges [start, end) of characters of the chunk's ``formatted`` under the loss mask: the escaped texts of ``mask_role``.
    Messages are ordered by seq (null first), then role and text; null roles and texts are empty.
    """
    turn = F.struct(
        F.col("seq"), text_of("role").alias("role"), text_of("text").alias("text"),
    )
    chunk = F.coalesce(F.floor(F.col("seq") / CHUNK), F.lit(-(1 << 62))).cast("long")
    grouped = messages.select("conv_id", chunk.alias("chunk"), turn.alias("turn")).groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == mask_role).alias("loss"),
    ))
    grouped = grouped.select("conv_id", "chunk", pieces.alias("p"))
    tail = len(CLOSE) + 1
    ends = F.aggregate(
        "p", F.array().cast("array<int>"),
        lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + F.length(x["head"]) + F.length(x["body"]) + tail)),
    )
    grouped = grouped.withColumn("e", ends)
    spans = F.filter(F.transform("p", lambda x, i: F.struct(
        (F.col("e")[i] - tail - F.length(x["body"])).alias("start"), (F.col("e")[i] - tail).alias("end"), x["loss"].alias("loss"))), lambda s: s["loss"])
    formatted = F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE + "\n"))), "")
    return grouped.select("conv_id", "chunk", formatted.alias("formatted"), F.transform(spans, lambda s: F.struct(s["start"], s["end"])).alias("spans"))


def parsed(chunks: DataFrame) -> DataFrame:
    """Chunks read back: conv_id, chunk, n_turns, turns (role, \\n, text, \\n of each turn), loss (text under the mask), size."""
    turns = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.length("formatted") + 1)
    body = lambda t: F.substring(t, 1, F.length(t) - len(CLOSE) - 1)
    shown = F.transform(turns, lambda t: F.concat(unescaped(body(t)), F.lit("\n")))
    loss = F.transform("spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return chunks.select(
        "conv_id", "chunk", F.size(turns).cast("long").alias("n_turns"), F.array_join(shown, "").alias("turns"),
        F.array_join(loss, "").alias("loss"), F.length("formatted").cast("long").alias("size"),
    )


def whole(chunks: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per conversation: text columns of its chunks joined in order, under new names."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", *columns)))
    grouped = chunks.groupBy("conv_id").agg(parts.alias("p"))
    field = lambda c: F.array_join(F.transform("p", lambda x: x[c]), "")
    return grouped.select("conv_id", *[field(c).alias(new) for c, new in columns.items()])


def format_chats(messages: DataFrame, mask_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted): each conversation as one text."""
    return whole(rendered(messages, mask_role=mask_role), {"formatted": "formatted"})


def chat_digests(messages: DataFrame, mask_role: str = "assistant") -> DataFrame:
    """Per conversation, read back from the formatted chunks: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = parsed(rendered(messages, mask_role=mask_role))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "turns", "loss")))
    grouped = read.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.sum("size").alias("formatted_chars"), parts.alias("p"))
    turns, loss = (F.array_join(F.transform("p", f), "") for f in (lambda x: x["turns"], lambda x: x["loss"]))
    return grouped.withColumn("loss", loss).select(
        "conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped, replace(replace(role, '\', '\\'), '<|', '<\|') AS shown FROM c
), j AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(12 + length(shown) + 1 + length(escaped) + 11) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM j
"""
