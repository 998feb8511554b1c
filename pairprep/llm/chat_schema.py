"""Chat formatting by schema fingerprints.

A raw record is a JSON object in one of many layouts. The hash of its nested field paths selects a
declarative mapping, which says where turns, roles and texts lie; so a new layout is a new mapping
and no new code. The canonical turns are then formatted in the JVM, in chunks of CHUNK turns of a
conversation, so that a conversation with very many turns is not gathered by one task.

The template marks a turn as `[INST]role[/INST]text</s>`. Control strings inside roles and texts
get a backslash behind their first character, backslashes are doubled; `read_back` undoes both.

Defined results: a null role or text is empty; a record that is null, no JSON object or of unknown
layout has no turns and keeps its row, with a null mapping; repeated rows are turns of their own;
turns with equal numbers are ordered by role and text, a null number comes first; other columns are
kept by `canonical_turns`, those named mapping or turns are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 256
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = r"\[/?INST\]|</?s>"
INSIDE_CONTROL = r"(?<=\[)(?=/?INST\])|(?<=<)(?=/?s>)"
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """`paths` are all field paths of the layout (`[]` for list items); `turns` lists (role, text),
    where a role that starts with `=` is fixed and a text may join several paths. With `each`, the
    paths of a turn start at the items of that list. `conv` and `turn` may name numbers."""

    name: str
    paths: frozenset[str]
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    each: str = ""
    conv: str = ""
    turn: str = ""
    roles: dict[str, str] = field(default_factory=dict, hash=False)


def layout(name: str, paths: str, turns, **rest) -> Mapping:
    return Mapping(name, frozenset(paths.split()), tuple((r, tuple(t.split("+"))) for r, t in turns), **rest)


MAPPINGS = (
    layout("turn", "conv_id turn role text", [("role", "text")], conv="conv_id", turn="turn"),
    layout("from_value", "id position from value", [("from", "value")], conv="id", turn="position", roles=ROLE_NAMES),
    layout(
        "nested",
        "chat chat.id message message.index message.author message.author.role message.content message.content.parts",
        [("message.author.role", "message.content.parts")],
        conv="chat.id",
        turn="message.index",
    ),
    layout("messages", "messages messages[] messages[].role messages[].content", [("role", "content")], each="messages"),
    layout(
        "conversations",
        "conversations conversations[] conversations[].from conversations[].value",
        [("from", "value")],
        each="conversations",
        roles=ROLE_NAMES,
    ),
    layout("prompt", "prompt completion", [("=user", "prompt"), ("=assistant", "completion")]),
    layout("instruction", "instruction output", [("=user", "instruction"), ("=assistant", "output")]),
    layout(
        "instruction_input", "instruction input output", [("=user", "instruction+input"), ("=assistant", "output")]
    ),
)


def paths_of(value: object, prefix: str = "") -> set[str]:
    """All nested field paths; a list of plain values is a leaf."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            path = f"{prefix}.{name}" if prefix else name
            found |= {path} | paths_of(inner, path)
        return found
    if isinstance(value, list) and any(isinstance(x, dict | list) for x in value):
        return set().union({f"{prefix}[]"}, *(paths_of(x, f"{prefix}[]") for x in value))
    return set()


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _at(value: object, path: str) -> object:
    for name in path.split(".") if path else ():
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value: object) -> str:
    if isinstance(value, list):
        return "".join(_text(x) for x in value)
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[int | None, int | None, str, str]]:
    """(conversation, turn, role, text) in order."""
    items = _at(record, mapping.each) if mapping.each else [record]
    conv, number = _number(record, mapping.conv), _number(record, mapping.turn)
    found = []
    for item in items or ():
        for role, texts in mapping.turns:
            name = role[1:] if role.startswith("=") else _text(_at(item, role))
            parts = [_text(_at(item, t)) for t in texts]
            said = "\n\n".join(p for i, p in enumerate(parts) if p or not i)
            found.append((conv, len(found) if not mapping.turn else number, mapping.roles.get(name, name), said))
    return found


def _number(record: dict, path: str) -> int | None:
    value = _at(record, path) if path else None
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def canonical_turns(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Add mapping, the name of the layout, and turns, a list of (conv_id, turn, role, text)."""
    known = {fingerprint(m.paths): m for m in mappings}
    kind = "mapping string, turns array<struct<conv_id:long,turn:long,role:string,text:string>>"

    @F.arrow_udf(kind)
    def convert(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        turn = pa.struct([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        form = pa.struct([("mapping", pa.string()), ("turns", pa.list_(turn))])
        for records in batches:
            rows = []
            for raw in records:
                try:
                    value = json.loads(raw.as_py() or "null")
                except ValueError:
                    value = None
                mapping = known.get(fingerprint(paths_of(value))) if isinstance(value, dict) else None
                found = turns_of(value, mapping) if mapping else []
                names = ("conv_id", "turn", "role", "text")
                rows.append({"mapping": mapping and mapping.name, "turns": [dict(zip(names, t)) for t in found]})
            yield pa.array(rows, form)

    made = df.drop("mapping", "turns").withColumn("_made", convert.asNondeterministic()(record))
    kept = [c for c in made.columns if c != "_made"]
    return made.select(*kept, "_made.mapping", "_made.turns")


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), INSIDE_CONTROL, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, formatted): the chunks of a conversation in order make its whole text.

    The chunk follows from the turn's number, so it is known without ranking the turns.
    """
    said = lambda c: escape(F.coalesce(c, F.lit("")))
    line = F.concat(F.lit(OPEN), said("role"), F.lit(MIDDLE), said("text"), F.lit(CLOSE))
    row = F.struct("turn", "role", "text", line.alias("line"))
    return (
        turns.withColumn("chunk", F.floor(F.col("turn") / chunk))
        .groupBy("conv_id", "chunk")
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"))
        .select("conv_id", "chunk", F.array_join(F.transform("_rows", lambda r: r["line"]), "").alias("formatted"))
    )


def read_back(formatted: Column | str) -> Column:
    """Roles and texts of a formatted chunk."""
    pieces = F.slice(F.split(formatted, CLOSE), 1, F.size(F.split(formatted, CLOSE)) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, MIDDLE, 1)
        text = F.substring(piece, F.length(role) + len(MIDDLE) + 1, F.length(piece))
        return F.struct(unescape(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(turns: Column) -> Column:
    """What the loss mask covers: the texts of the assistant."""
    own = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(own, lambda t: t["text"]), "")


def _raw_records(conversations: DataFrame) -> DataFrame:
    """The turns as JSON records in three layouts, chosen by conversation; roles that a layout has
    no name for stay in the plain one."""
    names = F.create_map(*[F.lit(x) for pair in (("user", "human"), ("assistant", "gpt"), ("system", "system")) for x in pair])
    json_of = lambda value: F.to_json(value, {"ignoreNullFields": "false"})
    plain = json_of(F.struct("conv_id", "turn", "role", "text"))
    named = json_of(
        F.struct(
            F.col("conv_id").alias("id"),
            F.col("turn").alias("position"),
            F.try_element_at(names, F.col("role")).alias("from"),
            F.col("text").alias("value"),
        )
    )
    nested = json_of(
        F.struct(
            F.struct(F.col("conv_id").alias("id")).alias("chat"),
            F.struct(
                F.col("turn").alias("index"),
                F.struct("role").alias("author"),
                F.struct(F.array("text").alias("parts")).alias("content"),
            ).alias("message"),
        )
    )
    kind = F.pmod("conv_id", F.lit(3))
    known = F.col("role").isin("user", "assistant", "system")
    record = F.when((kind == 1) & known, named).when(kind == 2, nested).otherwise(plain)
    return conversations.select(record.alias("record"))


def op4_chat_schema(spark, sf_dir: str) -> DataFrame:
    columns = "conv_id long, turn long, role string, text string"
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], columns)
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = canonical_turns(_raw_records(table.union(own))).select(F.inline("turns"))
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chunks = format_chats(turns).withColumn("_turns", read_back("formatted"))
    part = F.struct("chunk", whole.alias("whole"), loss_text(F.col("_turns")).alias("loss"))
    joined = lambda name: F.array_join(F.transform("_parts", lambda p: p[name]), "")
    return (
        chunks.groupBy("conv_id")
        .agg(
            F.sum(F.size("_turns")).alias("n_turns"),
            F.array_sort(F.collect_list(part)).alias("_parts"),
            F.sum(F.length("formatted")).alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.col("n_turns").cast("long").alias("n_turns"),
            F.sha2(joined("whole"), 256).alias("turns_sha256"),
            F.length(joined("loss")).cast("long").alias("loss_chars"),
            F.sha2(joined("loss"), 256).alias("loss_sha256"),
            F.col("formatted_chars").cast("long").alias("formatted_chars"),
        )
    )


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, role || text AS x,
    length(role) + length(text) + 2 * length(role || text) - length(replace(role, '\', '')) - length(replace(text, '\', ''))
    - length(role || text)
    + len(regexp_extract_all(role, '\[/?INST\]|</?s>')) + len(regexp_extract_all(text, '\[/?INST\]|</?s>')) AS shown
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + shown) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
