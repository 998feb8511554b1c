import json
import random

import pytest
from pairprep.operators.chat import json_text, render_chat
from pyspark.sql import functions as F

SCHEMA = "conv_id int, turn int, role string, text string"


def render(messages, prompt=False):
    out = ""
    if messages[0][0] != "system":
        out += "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
    open_tool = False
    for role, text in messages:
        if open_tool and role != "tool":
            out += "<|im_end|>\n"
            open_tool = False
        if role in ("user", "assistant", "system"):
            out += f"<|im_start|>{role}\n{text}<|im_end|>\n"
        elif role == "tool":
            if not open_tool:
                out += "<|im_start|>user"
                open_tool = True
            out += f"\n<tool_response>\n{text}\n</tool_response>"
    if open_tool:
        out += "<|im_end|>\n"
    return out + ("<|im_start|>assistant\n" if prompt else "")


@pytest.mark.parametrize("chunk", [1, 3, 10_000])
@pytest.mark.parametrize("prompt", [False, True])
def test_render(spark, chunk, prompt):
    rng = random.Random(5)
    talks = {}
    for conv in range(40):
        roles = rng.choices(["system", "user", "assistant", "tool", "note"], [1, 3, 3, 4, 1], k=rng.randint(1, 25))
        turns = sorted(rng.sample(range(40), len(roles)))
        talks[conv] = [(t, r, f"{r} says {i}\n") for i, (t, r) in enumerate(zip(turns, roles))]
    rows = [(c, *m) for c, messages in talks.items() for m in messages]
    random.Random(6).shuffle(rows)
    got = {
        r.conv_id: r.text
        for r in render_chat(spark.createDataFrame(rows, SCHEMA), prompt, chunk_turns=chunk).collect()
    }
    assert got == {c: render([m[1:] for m in messages], prompt) for c, messages in talks.items()}


def render_calls(messages, tools):
    """With signatures and calls; a message is (role, text, calls)."""
    first = messages[0][1] or "" if messages[0][0] == "system" else "You are a helpful assistant."
    listed = "".join("\n" + json.dumps(t, ensure_ascii=False) for t in tools)
    out = (
        f"<|im_start|>system\n{first}\n\n# Tools\n\nYou may call one or more functions to assist with the user query."
        f"\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>{listed}\n</tools>\n\n"
        "For each function call, return a json object with function name and arguments within <tool_call></tool_call> "
        'XML tags:\n<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call><|im_end|>\n'
    )
    for role, text, calls in messages[messages[0][0] == "system" :]:
        if role == "assistant" and calls:
            said = "".join(
                f'\n<tool_call>\n{{"name": "{name}", "arguments": {json.dumps(a, ensure_ascii=False)}}}\n</tool_call>'
                for name, a in calls
            )
            out += "<|im_start|>assistant" + (f"\n{text}" if text else "") + said + "<|im_end|>\n"
        else:
            out += f"<|im_start|>{role}\n{text or ''}<|im_end|>\n"
    return out


CALLS = "array<struct<name: string, arguments: map<string, string>>>"


@pytest.mark.parametrize("wrapped", [False, True])
def test_tools_and_calls(spark, wrapped):
    tools = [{"name": "a", "é": [1, {"x": None}]}, {"name": 'quoted "b"'}]
    odd = {"query": 'say "x, y": [1] \\ é 字', "empty": ""}
    talks = {
        1: [("system", "Be brief", None), ("user", "hi", None), ("assistant", "", [("a", odd), ("b", {})])],
        2: [("user", "hi", []), ("assistant", "I look", [("a", {"k": "v}],:"})]), ("system", "later", None)],
        3: [("assistant", None, [("a", {"k": "1"})]), ("assistant", "plain", [])],
        4: [("system", None, None), ("user", "no calls here", [("a", {"k": "v"})])],
    }
    rows = [(c, t, *m) for c, messages in talks.items() for t, m in enumerate(messages)]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, text string, tool_calls {CALLS}")
    if wrapped:
        df = df.withColumn("tool_calls", F.transform("tool_calls", lambda c: F.struct(c.alias("function"))))
    got = {r.conv_id: r.text for r in render_chat(df, tools=tools, calls="tool_calls", chunk_turns=2).collect()}
    assert got == {c: render_calls(messages, tools) for c, messages in talks.items()}


def test_calls_without_signatures(spark):
    rows = [(1, 0, "user", "hi", None), (1, 1, "assistant", "so", [("a", {"k": "v"})])]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, text string, tool_calls {CALLS}")
    text = render_chat(df, calls="tool_calls").first().text
    assert text.startswith("<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user")
    assert text.endswith('so\n<tool_call>\n{"name": "a", "arguments": {"k": "v"}}\n</tool_call><|im_end|>\n')
    with pytest.raises(ValueError):
        render_chat(df.withColumn("tool_calls", F.array(F.lit("x"))), calls="tool_calls")


def test_json_text(spark):
    kind = "struct<a: array<struct<b: int, c: map<string, double>>>, d: string, e: boolean>"
    value = ([(1, {'x, y: q"\\"': 0.5}), (None, {})], "tail \\", True)
    df = spark.createDataFrame([(value, "plain, text: \"x\" "), ((None, None, None), None)], f"v {kind}, t string")
    rows = df.select(json_text(F.col("v")).alias("v"), json_text(F.col("t")).alias("t")).collect()
    nested = {"a": [{"b": 1, "c": {'x, y: q"\\"': 0.5}}, {"b": None, "c": {}}], "d": "tail \\", "e": True}
    assert rows[0].v == json.dumps(nested) and rows[0].t == json.dumps('plain, text: "x" ')
    assert rows[1].v == json.dumps({"a": None, "d": None, "e": None}) and rows[1].t == "null"
