"""Sub-word ids against merges applied by rank in plain Python, and round trips."""

import json
import os
import random
import subprocess
import sys

import pytest
from pairprep import constants as C
from pairprep.operators.subwords import decode_subwords, encode_subwords, tokenize_pairs_subwords, vocabulary

P = pytest.importorskip("public_tokenizers")
FILE = P.path("byte_bpe_50k.json")


def merged(word, ranks):
    """Join the neighbours with the lowest rank, again and again."""
    parts = list(word)
    while True:
        known = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        if not known:
            return parts
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_ids_follow_the_merges(spark):
    with open(FILE, encoding="utf-8") as file:
        model = json.load(file)["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ranks = {pair: rank for rank, pair in enumerate(pairs)}
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzeeettaa", k=rnd.randint(1, 18))) for _ in range(300)]
    words += ["aaaa", "banana", "x" * 500, "tokenization", "the"]
    df = spark.createDataFrame(list(enumerate(words)), "i int, text string")
    for row in encode_subwords(df, FILE, "text", max_length=None).collect():
        assert row.ids == [model["vocab"][p] for p in merged(row.text, ranks)], row.text


def test_round_trip(spark):
    rnd = random.Random(9)
    parts = ["word", " ", "\n", "\t", "é", "字", "😀", "<|endoftext|>", "'s", "12", " ", "\r\n", "fn(x)"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(200)] + ["", " " * 5000, "ab" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "i int, text string")
    coded = encode_subwords(df, FILE, "text", max_length=None)
    back = {r.i: (r.text, r.back, r.ids) for r in decode_subwords(coded, FILE, "ids", "back").collect()}
    assert back.pop(-1) == (None, None, None)
    assert all(text == again for text, again, _ in back.values())
    special = vocabulary(FILE).token_to_id("<|endoftext|>")
    assert not any(special in ids for _, _, ids in back.values())
    cut = encode_subwords(df, FILE, "text", max_length=3).collect()
    assert all(r.ids is None or r.ids == back[r.i][2][:3] for r in cut)
    assert encode_subwords(df.limit(0), FILE, "text").count() == 0


def test_unknown_ids_are_nothing(spark):
    word = vocabulary(FILE).encode("word", add_special_tokens=False).ids
    special = vocabulary(FILE).token_to_id("<|endoftext|>")
    df = spark.createDataFrame([([-1, *word, None, 1 << 30, special],)], "ids array<int>")
    assert decode_subwords(df, FILE, "ids").first().text == "word"
    assert decode_subwords(df, FILE, "ids", skip_special=False).first().text == "word<|endoftext|>"


def test_ids_are_kept_row_by_row(spark):
    word = vocabulary(FILE).encode("word", add_special_tokens=False).ids
    lists = [None, [], [-1, None], word, None, [None, *word, 1 << 30, *word], [-5], word]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, ids array<int>").coalesce(1)
    back = {r.i: r.text for r in decode_subwords(df, FILE, "ids").collect()}
    assert back == dict(enumerate([None, "", "", "word", None, "wordword", "", "word"]))
    empty = spark.sql("SELECT array(null) AS ids UNION ALL SELECT null")
    assert {r.text for r in decode_subwords(empty, FILE, "ids").collect()} == {"", None}


def test_a_task_works_on_one_core():
    """Encoding and decoding in batches start no threads of the library's own."""
    code = f"""
import os, numpy, pyarrow, tokenizers
from pairprep.operators.subwords import subword_tokenizer, vocabulary
words, threads = vocabulary({FILE!r}), lambda: len(os.listdir("/proc/self/task"))
before = threads()
ids = subword_tokenizer({FILE!r})()(["some words"] * 100)
assert words.decode_batch(ids) == ["some words"] * 100
print(threads() - before)
"""
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, check=True)
    assert run.stdout.strip() == "0"


def test_file_sent_along(spark, tmp_path):
    (tmp_path / "sent-vocabulary.json").write_bytes(open(FILE, "rb").read())
    spark.sparkContext.addFile(str(tmp_path / "sent-vocabulary.json"))
    df = spark.createDataFrame([("some words",)], "text string")
    assert encode_subwords(df, "sent-vocabulary.json", "text").first().ids == encode_subwords(df, FILE, "text").first().ids


def test_pairs(spark):
    df = spark.createDataFrame([(1, "+a line", "Add a line", "train"), (2, None, "x", "train")], "pair_id long, diff string, message string, split string")
    rows = {r.pair_id: r for r in tokenize_pairs_subwords(df, FILE, max_length=10).collect()}
    words = vocabulary(FILE)
    whole = words.encode(f"+a line{C.SEPARATOR}Add a line{C.EOS_TOKEN}", add_special_tokens=False).ids
    prompt = len(words.encode(f"+a line{C.SEPARATOR}", add_special_tokens=False).ids)
    assert rows[1].input_ids == whole[:10]
    assert rows[1].labels == [-100] * min(prompt, 10) + whole[prompt:10]
    assert rows[2].input_ids is None
