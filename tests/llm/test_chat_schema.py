"""Layouts to canonical turns, and the template's round trip."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairprep.llm import chat_schema as C

RECORDS = {
    "turn": ({"conv_id": 4, "turn": 2, "role": "user", "text": "a"}, [(4, 2, "user", "a")]),
    "from_value": ({"id": 1, "position": 0, "from": "gpt", "value": None}, [(1, 0, "assistant", "")]),
    "nested": (
        {"chat": {"id": 9}, "message": {"index": 1, "author": {"role": "system"}, "content": {"parts": ["x", "y"]}}},
        [(9, 1, "system", "xy")],
    ),
    "messages": (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]},
        [(None, 0, "user", "q"), (None, 1, "assistant", "r")],
    ),
    "conversations": ({"conversations": [{"from": "human", "value": "é"}]}, [(None, 0, "user", "é")]),
    "prompt": ({"prompt": "p", "completion": "c"}, [(None, 0, "user", "p"), (None, 1, "assistant", "c")]),
    "instruction": ({"instruction": "i", "output": "o"}, [(None, 0, "user", "i"), (None, 1, "assistant", "o")]),
    "instruction_input": (
        {"instruction": "i", "input": "n", "output": 5},
        [(None, 0, "user", "i\n\nn"), (None, 1, "assistant", "5")],
    ),
}


def test_layouts_have_their_own_fingerprints():
    assert len({C.fingerprint(m.paths) for m in C.MAPPINGS}) == len(C.MAPPINGS)
    for name, (record, _) in RECORDS.items():
        assert C.paths_of(record) == next(m.paths for m in C.MAPPINGS if m.name == name)


def test_canonical_turns(spark):
    rows = [(name, json.dumps(record), "x") for name, (record, _) in RECORDS.items()]
    rows += [("null", None, "x"), ("list", "[1]", "x"), ("broken", "{", "x"), ("unknown", '{"a": {"b": 1}}', "x")]
    df = C.canonical_turns(spark.createDataFrame(rows, "name string, record string, turns string"))
    got = {r.name: (r.mapping, [tuple(t) for t in r.turns]) for r in df.collect()}
    for name, (_, turns) in RECORDS.items():
        assert got[name] == (name, turns)
    for name in ("null", "list", "broken", "unknown"):
        assert got[name] == (None, [])


TEXTS = [None, "", "\\", "a\\</s>[INST]\\\\<", "\\[/INST\\][/INST]<</s>s>é\n\\", "</s", "[", "/INST]", "<\\/s>", "<s></s>"]


@pytest.mark.parametrize("chunk", [1, 2, 256])
def test_round_trip(spark, chunk):
    rows = [(1, i, "assistant" if i % 2 else t, t) for i, t in enumerate(TEXTS)] + [(2, None, None, None), (None, 0, "u", "x")]
    rows += [(3, 0, "u", "same"), (3, 0, "u", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = C.format_chats(turns, chunk).withColumn("back", C.read_back("formatted")).orderBy("conv_id", "chunk").collect()
    got = {}
    for r in made:
        got.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.back)
    assert got[1] == [(r or "", t or "") for _, _, r, t in rows[: len(TEXTS)]]
    assert got[2] == [("", "")] and got[None] == [("u", "x")] and got[3] == [("u", "same")] * 2
    assert C.format_chats(turns.limit(0)).count() == 0


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.text(alphabet="\\<>[]/INSTsa\n", max_size=30), min_size=1, max_size=20))
def test_escape_leaves_no_control_string(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", C.escape(F.col("t")))
    for r in df.withColumn("b", C.unescape(F.col("e"))).collect():
        assert r.b == r.t
        assert not any(c in r.e for c in ("[INST]", "[/INST]", "</s>", "<s>"))
