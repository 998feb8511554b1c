"""Conversations to chat-marked text."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairprep import constants as C
from pairprep.functions.text import text_or_empty

CHUNK_TURNS = 10_000


def _block(role: Column | str, text: Column | str) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    text = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit(C.TURN_START), role, F.lit("\n"), text, F.lit(C.TURN_END + "\n"))


def json_text(value: Column) -> Column:
    """A value of any type as JSON with a blank after every comma and colon, nulls included.

    The pattern takes a string with the brackets behind it as a whole, so what is inside stays.
    """
    compact = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    compact = F.substr(compact, F.lit(6), F.length(compact) - 6)
    spaced = F.regexp_replace(compact, r'("(?:[^"\\]|\\.)*+"[\]}]*)?([,:]|\z)', "$1$2 ")
    return F.regexp_replace(spaced, r" +\z", "")


def _tool_calls(messages: DataFrame, calls: str) -> Column:
    """The marked calls of a message, an empty text without any; a call may be wrapped as `function`."""
    fields = messages.schema[calls].dataType.elementType
    if not isinstance(fields, StructType):
        raise ValueError(f"'{calls}' must hold structs with name and arguments")
    inner = (lambda c: c["function"]) if "function" in fields.names else (lambda c: c)

    def marked(call: Column) -> Column:
        call = inner(call)
        name = F.coalesce(call["name"], F.lit(""))
        return F.concat(F.lit(C.CALL_START), name, F.lit(C.CALL_BETWEEN), json_text(call["arguments"]), F.lit(C.CALL_END))

    return F.coalesce(F.array_join(F.transform(calls, marked), ""), F.lit(""))


def chat_pieces(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    chunk_turns: int = CHUNK_TURNS,
    tools: Sequence[Mapping] = (),
    calls: str | None = None,
) -> DataFrame:
    """(conversation, chunk, turn, piece): what each message adds to its conversation's text.

    A message needs to know whether those next to it are tool turns. That is looked up inside a
    chunk of the conversation; across chunks it comes from a row per chunk, so one huge
    conversation spreads over tasks.
    """
    called = _tool_calls(df, calls) if calls else F.lit("")
    messages = df.select(
        conv, turn, text_or_empty("role").alias("role"), text_or_empty("text").alias("text"), called.alias("_calls")
    ).withColumns(
        {"_chunk": F.floor(F.col(turn) / chunk_turns), "_tool": (F.col("role") == "tool").cast("int")}
    )
    edges = messages.groupBy(conv, "_chunk").agg(
        F.min_by("_tool", turn).alias("_opens"), F.max_by("_tool", turn).alias("_closes")
    )
    across = Window.partitionBy(conv).orderBy("_chunk")
    edges = edges.select(
        conv,
        "_chunk",
        F.lag("_closes").over(across).alias("_before"),
        F.lead("_opens").over(across).alias("_after"),
    )
    inside = Window.partitionBy(conv, "_chunk").orderBy(turn)
    placed = messages.withColumns(
        {"_prev": F.lag("_tool").over(inside), "_next": F.lead("_tool").over(inside)}
    ).join(edges, [conv, "_chunk"])
    previous = F.coalesce("_prev", "_before")
    following = F.coalesce("_next", "_after")
    role = F.col("role")
    opens = previous.isNull()
    if tools:
        signatures = "".join("\n" + json.dumps(t, ensure_ascii=False) for t in tools)
        system = F.when(role == "system", F.col("text")).otherwise(C.DEFAULT_SYSTEM)
        offered = F.concat(system, F.lit(C.TOOLS_BEFORE + signatures + C.TOOLS_AFTER))
        header = F.when(opens, _block("system", offered)).otherwise("")
    else:
        header = F.when(opens & (role != "system"), _block("system", C.DEFAULT_SYSTEM)).otherwise("")
    tool = F.concat(
        F.when(F.coalesce(previous, F.lit(0)) == 0, C.TURN_START + "user").otherwise(""),
        F.lit("\n<tool_response>\n"),
        F.col("text"),
        F.lit("\n</tool_response>"),
        F.when(F.coalesce(following, F.lit(0)) == 0, C.TURN_END + "\n").otherwise(""),
    )
    content = F.when(F.col("text") != "", F.concat(F.lit("\n"), F.col("text"))).otherwise("")
    calling = F.concat(F.lit(C.TURN_START + "assistant"), content, F.col("_calls"), F.lit(C.TURN_END + "\n"))
    body = (
        F.when((role == "assistant") & (F.col("_calls") != ""), calling)
        # With tools the header has said what the first message says.
        .when((role == "system") & opens & F.lit(bool(tools)), "")
        .when(role.isin("user", "assistant", "system"), _block(role, F.col("text")))
        .when(role == "tool", tool)
        .otherwise("")
    )
    return placed.select(conv, "_chunk", turn, F.concat(header, body).alias("piece"))


def _joined(order: str, piece: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(order, piece)))
    return F.array_join(F.transform(ordered, lambda x: x[piece]), "")


def render_chat(
    df: DataFrame,
    add_generation_prompt: bool = False,
    conv: str = "conv_id",
    turn: str = "turn",
    chunk_turns: int = CHUNK_TURNS,
    tools: Sequence[Mapping] = (),
    calls: str | None = None,
) -> DataFrame:
    """One row per conversation with its whole text, put together chunk by chunk.

    (conversation, turn) must be unique. Roles other than system, user, assistant and tool add
    nothing. `tools` are the signatures that every conversation is offered; `calls` names a column
    of arrays of (name, arguments), the calls that an assistant message makes; arguments may be
    nested in any way and are written as JSON.
    """
    pieces = chat_pieces(df, conv, turn, chunk_turns, tools, calls)
    chunks = pieces.groupBy(conv, "_chunk").agg(_joined(turn, "piece").alias("piece"))
    ending = C.TURN_START + "assistant\n" if add_generation_prompt else ""
    return chunks.groupBy(conv).agg(F.concat(_joined("_chunk", "piece"), F.lit(ending)).alias("text"))
