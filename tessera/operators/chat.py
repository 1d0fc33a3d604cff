"""Chat records: item-to-message conversion, turn tables, chat rendering.

Rendering follows the chat template: per message
``<|im_start|>{role}\\n{content}<|im_end|>\\n`` for the roles system, user and
assistant, nothing for other roles; a null content renders as ``None`` (the
template engine prints Python's None that way). The generation prompt adds
``<|im_start|>assistant\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import (BOS_TOKEN, CHAT_ROLE_MAP, CHAT_ROLES, EOS_TOKEN, GENERATION_PROMPT,
                       PREPARE_SYSTEM_PROMPT, SAMPLING_SYSTEM_PROMPT)

MESSAGE_TYPE = "struct<role:string,content:string>"
TURN_ROLE_MAP = (("user", "user"), ("assistant", "assistant"))


def _role_map_expr(role: Column, role_map) -> Column:
    expr = None
    for src, dst in role_map:
        expr = (F.when(role == F.lit(src), F.lit(dst)) if expr is None
                else expr.when(role == F.lit(src), F.lit(dst)))
    return expr


def message_piece(role: Column, content: Column) -> Column:
    """Rendered text of one message."""
    return F.when(role.isin(*CHAT_ROLES),
                  F.concat(F.lit(BOS_TOKEN), role, F.lit("\n"),
                           F.coalesce(content, F.lit("None")), F.lit(EOS_TOKEN + "\n"))
                  ).otherwise(F.lit(""))


def to_messages(df: DataFrame, items_col: str = "items", role_map=CHAT_ROLE_MAP,
                system_prompt: str = PREPARE_SYSTEM_PROMPT, out: str = "messages") -> DataFrame:
    """Chat items (array of ``{from, value, missing}``) to messages.

    Items whose ``from`` is not in ``role_map`` vanish, order kept; a missing
    ``value`` gives ``''``, a JSON null gives null; the system message is
    always first. Per row, no shuffle."""
    srcs = [s for s, _ in role_map]

    def keep(x):
        return F.coalesce(x["from"].isin(*srcs), F.lit(False))

    def make(x):
        content = F.when(x["missing"], F.lit("")).otherwise(x["value"])
        return F.struct(_role_map_expr(x["from"], role_map).alias("role"), content.alias("content"))

    system = F.array(F.struct(F.lit("system").alias("role"),
                              F.lit(system_prompt).cast("string").alias("content")))
    msgs = F.concat(system, F.transform(F.filter(F.col(items_col), keep), make))
    return df.withColumn(out, msgs.cast(f"array<{MESSAGE_TYPE}>"))


def messages_long(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text", role_map=TURN_ROLE_MAP,
                  system_prompt: str = PREPARE_SYSTEM_PROMPT) -> DataFrame:
    """Messages of a turn table in long form ``(conv, seq, role, content)``.

    ``seq`` orders the messages of a conversation: -1 for the prepended
    system message, the turn number otherwise. Turns with roles outside
    ``role_map`` vanish. No row is grouped: the system rows come from the
    distinct conversation ids (partial distinct per task), the rest is a
    filter and a projection."""
    srcs = [s for s, _ in role_map]
    kept = (turns.filter(F.col(role).isin(*srcs))
            .select(F.col(conv), F.col(turn).cast("long").alias("seq"),
                    _role_map_expr(F.col(role), role_map).alias("role"),
                    F.col(text).alias("content")))
    system = (turns.select(conv).distinct()
              .select(F.col(conv), F.lit(-1).cast("long").alias("seq"),
                      F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    return system.unionByName(kept)


def group_messages(long: DataFrame, conv: str = "conv_id", seq: str = "seq",
                   out: str = "messages") -> DataFrame:
    """Long messages to one ``array<struct<role, content>>`` per conversation.

    The array is the output record of a conversation, so its rows meet in one
    task by definition; partial aggregation happens map-side."""
    return (long.groupBy(conv)
            .agg(F.array_sort(F.collect_list(F.struct(seq, "role", "content"))).alias("m_"))
            .select(conv, F.transform("m_", lambda m: F.struct(m["role"].alias("role"),
                                                                m["content"].alias("content")))
                    .cast(f"array<{MESSAGE_TYPE}>").alias(out)))


def render_messages(df: DataFrame, messages_col: str = "messages",
                    generation_prompt: bool = False, out: str = "text") -> DataFrame:
    """Render an array of messages with the chat template (per row)."""
    body = F.array_join(F.transform(F.col(messages_col),
                                    lambda m: message_piece(m["role"], m["content"])), "")
    if generation_prompt:
        body = F.concat(body, F.lit(GENERATION_PROMPT))
    return df.withColumn(out, body)


def render_long(long: DataFrame, conv: str = "conv_id", seq: str = "seq",
                generation_prompt: bool = False, out: str = "text") -> DataFrame:
    """Render long-form messages: pieces are rendered per row before the
    shuffle, then joined in ``seq`` order per conversation."""
    pieces = long.select(conv, seq, message_piece(F.col("role"), F.col("content")).alias("p_"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, "p_"))),
                                    lambda x: x["p_"]), "")
    if generation_prompt:
        body = F.concat(body, F.lit(GENERATION_PROMPT))
    return pieces.groupBy(conv).agg(body.alias(out))


def render_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", role_map=TURN_ROLE_MAP,
                 system_prompt: str = PREPARE_SYSTEM_PROMPT, generation_prompt: bool = False,
                 out: str = "text") -> DataFrame:
    """Render a turn table per conversation in one aggregation: kept turns
    are rendered row by row before the shuffle, joined in turn order, and
    the system message is prepended after grouping (same text as
    ``render_long(messages_long(...))`` without the extra distinct pass)."""
    srcs = [s for s, _ in role_map]
    r = _role_map_expr(F.col(role), role_map)
    piece = F.when(F.col(role).isin(*srcs), message_piece(r, F.col(text))).otherwise(F.lit(""))
    pieces = turns.select(conv, F.col(turn).cast("long").alias("t_"), piece.alias("p_"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t_", "p_"))),
                                    lambda x: x["p_"]), "")
    full = F.concat(message_piece(F.lit("system"), F.lit(system_prompt)), body)
    if generation_prompt:
        full = F.concat(full, F.lit(GENERATION_PROMPT))
    return pieces.groupBy(conv).agg(full.alias(out))


def render_prompt(df: DataFrame, prompt_col: str = "prompt",
                  system_prompt: str = SAMPLING_SYSTEM_PROMPT, out: str = "text") -> DataFrame:
    """Generation prompt: system message, the prompt as user message, and the
    open assistant header. Per row."""
    body = F.concat(message_piece(F.lit("system"), F.lit(system_prompt)),
                    message_piece(F.lit("user"), F.col(prompt_col)),
                    F.lit(GENERATION_PROMPT))
    return df.withColumn(out, body)


def with_bos(df: DataFrame, col: str = "text", bos: str = BOS_TOKEN, out: str | None = None) -> DataFrame:
    """Prefix the BOS token text (pretraining samples)."""
    return df.withColumn(out or col, F.concat(F.lit(bos), F.col(col)))


__all__ = ["to_messages", "messages_long", "group_messages", "render_messages", "render_long",
           "render_prompt", "with_bos", "message_piece", "EOS_TOKEN"]
