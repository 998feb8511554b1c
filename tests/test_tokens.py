import random
import re

import pytest
from pairprep import constants as C
from pairprep.functions import tokens as K
from pairprep.operators.tokenizing import token_stats, tokenize_pairs, tokenize_pairs_with
from pairprep.operators.vocabulary import ROW_BYTES, _blocks, build_vocab, decode, encode, lookup_ids, token_counts
from pairprep.sources import scratch
from pyspark.sql import functions as F

PAIRS = [
    (1, "train", "+ add x1", "Add x"),
    (2, "train", "- drop  y\n+ y", " starts with space"),
    (3, "test", "zz " * 40, "Long diff here"),
    (4, "test", "", ""),
]
SCHEMA = "pair_id long, split string, diff string, message string"


def cut(text):
    return re.findall(r"[^\W\d_]+|\d|\s+|(?:[^\w\s]|_)+", text)


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, SCHEMA)


@pytest.fixture(scope="module")
def vocab(pairs):
    return build_vocab(pairs, 12, "diff", "message")


def test_vocab_is_by_count_then_token(pairs, vocab):
    counts = {}
    for _, _, d, m in PAIRS:
        for t in cut(d) + cut(m):
            counts[t] = counts.get(t, 0) + 1
    assert {r.token: r.n for r in token_counts(pairs, "diff", "message").collect()} == counts
    top = sorted(counts, key=lambda t: (-counts[t], t))[:12]
    got = {r.token: r.id for r in vocab.collect()}
    assert got == {C.EOS_TOKEN: 0, C.UNKNOWN_TOKEN: 1} | {t: i + 2 for i, t in enumerate(top)}


@pytest.mark.parametrize("separator", [C.SEPARATOR, "|", ""])
@pytest.mark.parametrize("max_length", [512, 3])
def test_tokenize_pairs(pairs, vocab, separator, max_length):
    ids = {r.token: r.id for r in vocab.collect()}
    got = {r.pair_id: r for r in tokenize_pairs(pairs, vocab, separator=separator, max_length=max_length).collect()}
    joined = {
        r.pair_id: r
        for r in tokenize_pairs(
            pairs, vocab, separator=separator, max_length=max_length, block_bytes=600
        ).collect()
    }
    assert got == joined
    for key, split, diff, message in PAIRS:
        whole = [ids.get(t, 1) for t in cut(diff + separator + message)] + [0]
        whole = whole[:max_length]
        hidden = min(len(cut(diff + separator)), max_length, len(whole))
        row = got[key]
        assert row.split == split
        assert row.input_ids == whole
        assert row.attention_mask == [1] * len(whole)
        assert row.labels == [-100] * hidden + whole[hidden:]


def test_columns_kept_on_request(pairs, vocab):
    assert tokenize_pairs(pairs, vocab).columns == ["pair_id", "split", "input_ids", "attention_mask", "labels"]
    assert tokenize_pairs(pairs, vocab, keep_columns=True).columns[:4] == pairs.columns


def test_own_tokenizer(pairs):
    def build():
        return lambda texts: [[ord(c) for c in t] for t in texts]

    got = {r.pair_id: r for r in tokenize_pairs_with(pairs, build, separator="|", eos="$", max_length=20).collect()}
    for key, _, diff, message in PAIRS:
        whole = [ord(c) for c in f"{diff}|{message}$"][:20]
        hidden = min(len(diff) + 1, len(whole))
        assert got[key].input_ids == whole
        assert got[key].labels == [-100] * hidden + whole[hidden:]


BLOCKS = [64_000_000, 500]


@pytest.mark.parametrize("block_bytes", BLOCKS)
def test_encode_and_decode(spark, pairs, block_bytes):
    full = build_vocab(pairs, 1000, "diff", "message")
    texts = [(1, "+ add x1"), (2, "new y"), (3, ""), (4, None), (1, "+ add x1"), (None, "y")]
    df = spark.createDataFrame(texts, "pair_id long, text string")
    ids = {r.token: r.id for r in full.collect()}
    coded = encode(df, full, "text", max_length=None, block_bytes=block_bytes)
    plus = [ids[t] for t in cut("+ add x1")]
    got = sorted(((r.pair_id or 0, r.ids) for r in coded.collect()), key=repr)
    assert got == sorted([(1, plus), (1, plus), (2, [1, ids[" "], ids["y"]]), (3, []), (4, None), (0, [ids["y"]])], key=repr)
    back = decode(coded, full, "ids", "back", block_bytes=block_bytes)
    assert sorted(str(r.back) for r in back.collect()) == sorted(["+ add x1", " y", "", "None", "+ add x1", "y"])
    spelled = decode(coded, full, "ids", "back", skip_special=False, block_bytes=block_bytes)
    assert {r.pair_id: r.back for r in spelled.collect()}[2] == C.UNKNOWN_TOKEN + " y"
    short = encode(df, full, "text", max_length=2, block_bytes=block_bytes).where("pair_id = 1").first().ids
    assert short == [ids["+"], ids[" "]]


@pytest.mark.parametrize("block_bytes", BLOCKS)
def test_odd_ids_and_vocabularies(spark, block_bytes):
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("b", 9), ("c", 3), (None, 5), ("d", None)], "token string, id int")
    rows = [(1, [2, 3, 99, -100, -1, 0, 9]), (2, None), (3, []), (4, [None, 2]), (5, [5])]
    df = spark.createDataFrame(rows, "pair_id long, ids array<int>")
    got = {r.pair_id: r.t for r in decode(df, vocab, "ids", "t", skip_special=False, block_bytes=block_bytes).collect()}
    assert got == {1: "abb", 2: None, 3: "", 4: "a", 5: ""}
    texts = spark.createDataFrame([(1, "a b"), (2, None)], "pair_id long, text string")
    got = {r.pair_id: r.ids for r in encode(texts, vocab, "text", block_bytes=block_bytes).collect()}
    assert got == {1: [2, 1, 3], 2: None}
    empty = vocab.limit(0)
    assert {r.t for r in decode(df, empty, "ids", "t", block_bytes=block_bytes).collect()} == {"", None}
    assert encode(texts, empty, "text", block_bytes=block_bytes).where("pair_id = 1").first().ids == [1, 1, 1]


def test_null_texts_have_null_arrays(spark, vocab):
    df = spark.createDataFrame([(1, "test", None, "m"), (2, "test", "d", None)], SCHEMA)
    build = lambda: lambda texts: [[ord(c) for c in t] for t in texts]
    for made in (tokenize_pairs(df, vocab), tokenize_pairs_with(df, build)):
        assert all(r.input_ids is None and r.labels is None for r in made.collect())


def test_a_filter_behind_tokenising_copies_no_python(pairs, vocab):
    def build():
        return lambda texts: [[ord(c) for c in t] for t in texts]

    for made in (tokenize_pairs(pairs, vocab), tokenize_pairs_with(pairs, build)):
        plan = made.where(K.has_target("labels"))._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"(?:Arrow|Python)\w*EvalPython|ArrowEvalPython", plan)) == 1


def test_token_stats(spark):
    rows = [("a", [1, 2, 3], [-100, 2, 3]), ("a", [1], [-100]), ("b", [5] * 4, [5] * 4)]
    df = spark.createDataFrame(rows, "split string, input_ids array<int>, labels array<int>")
    got = {tuple(r) for r in token_stats(df, max_length=4).collect()}
    assert got == {("a", 2, 4, 3, 2.0, 0, 2, 1), ("b", 1, 4, 4, 4.0, 1, 4, 0)}


def test_label_scalars(spark):
    rows = [(1, [-100, -100, 5, -100, 6]), (2, [-100]), (3, []), (4, [7, 8])]
    df = spark.createDataFrame(rows, "k int, labels array<int>").withColumn("ids", F.transform("labels", F.abs))
    got = {
        r.k: tuple(r)[1:]
        for r in df.select(
            "k",
            K.prompt_len("labels"),
            K.has_target("labels"),
            K.target_ids("labels"),
            K.prompt_ids("ids", "labels"),
        ).collect()
    }
    assert got == {
        1: (2, True, [5, 6], [100, 100]),
        2: (1, False, [], [100]),
        3: (0, False, [], []),
        4: (0, True, [7, 8], []),
    }


def test_later_blocks_see_only_items_that_are_still_open(spark, tmp_path):
    """Frequent tokens are in the first block and strangers in none; other columns stay, nulls too."""
    words = [chr(97 + i % 26) * (1 + i // 26) for i in range(120)]
    vocab = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "token string, id int")
    ids = {w: i + 2 for i, w in enumerate(words)}
    rng = random.Random(3)
    rows = [(i, None if i % 11 == 5 else [rng.choice([*words, *words[:3] * 90, "?!", None]) for _ in range(i % 70)]) for i in range(90)]
    df = spark.createDataFrame(rows, "pair_id long, tokens array<string>").repartition(3)
    before = len(scratch._made)
    got = {r.pair_id: r.ids for r in lookup_ids(df, vocab, "tokens", "ids", 3000).collect()}
    assert got == {i: None if t is None else [ids.get(x, 1) for x in t] for i, t in rows}
    stages = [spark.read.parquet(p).select("tokens.*").collect() for p in scratch._made[before:]]
    assert len(stages) >= 2
    for found in stages:
        flat = [x for r in found for x in r.rest or ()]
        assert "?!" not in flat and not {"a", "b", "c"} & set(flat)
    assert sum(len(r.rest or ()) for r in stages[-1]) < sum(len(r.rest or ()) for r in stages[0])
    texts = spark.createDataFrame([(i, t and [ids.get(x, 1) for x in t]) for i, t in rows], "pair_id long, ids array<int>")
    said = {r.pair_id: r["text"] for r in decode(texts, vocab, "ids", block_bytes=3000).collect()}
    assert said == {i: None if t is None else "".join(x for x in t if x in ids) for i, t in rows}


def test_ids_far_apart_make_bounded_blocks(spark):
    vocab = spark.createDataFrame([(str(i) * 9, i) for i in range(-50, 50)] + [("z" * 99, 2**31 - 1)], "token string, id int")
    rows = spark.createDataFrame([(1, [str(7) * 9, "z" * 99, str(-3) * 9, "y"])], "pair_id long, tokens array<string>")
    assert lookup_ids(rows, vocab, "tokens", "ids", 900).first().ids == [7, 2**31 - 1, -3, 1]
    sizes = [sum(len(t) + ROW_BYTES for t in table) for table, _ in _blocks(vocab, "token", 900)]
    assert len(sizes) > 8 and max(sizes) < 2700
