"""What Python holds at once is bounded in bytes, however long the rows are."""

import pyarrow as pa
import pytest
from pairprep import constants as C
from pairprep.operators.slices import BATCH_BYTES, SETTING, SLICE_BYTES, bounded_batches, slices
from pairprep.operators.subwords import decode_subwords, encode_subwords
from pairprep.operators.tokenizing import tokenize_pairs_with
from pairprep.operators.vocabulary import lookup_ids


@pytest.mark.parametrize("at_once", [1, 7, 8, 1000])
def test_slices_are_the_rows_in_order(at_once):
    texts = ["", "abc", None, "é", "x" * 20, "", "12345678", None]
    lists = [[1], None, [], [1, 2, 3], None, [5], [None], [7] * 9]
    a, b = pa.array(texts, pa.string()), pa.array(lists, pa.list_(pa.int32()))
    cut = list(slices(a, b, at_once=at_once))
    assert [x for s, _ in cut for x in s.to_pylist()] == texts and [x for _, s in cut for x in s.to_pylist()] == lists
    for s, t in cut:
        held = sum(len((x or "").encode()) for x in s.to_pylist()) + sum(4 * len(x or []) for x in t.to_pylist())
        assert len(s) == len(t) and (held <= at_once or len(s) == 1)
    # A slice of a slice counts its own rows only.
    assert [x for (s,) in slices(a.slice(3), at_once=at_once) for x in s.to_pylist()] == texts[3:]
    assert list(slices(a.slice(0, 0))) == []


def test_a_tokenizer_gets_bounded_slices(spark):
    """One partition of 20 MB of texts, all in one batch of rows."""

    def factory():
        def encode(texts):
            held = sum(len(t) for t in texts)
            assert held <= SLICE_BYTES or len(texts) == 2, f"{held} bytes at once"
            return [[len(t)] * 3 for t in texts]

        return encode

    pairs = spark.range(0, 400, 1, 1).selectExpr(
        f"id AS {C.KEY}", f"repeat('x', IF(id = 7, 3000000, 25000)) AS {C.DIFF}", f"IF(id = 5, NULL, 'Add it') AS {C.MESSAGE}", f"'train' AS {C.SPLIT}"
    )
    rows = {r[C.KEY]: r for r in tokenize_pairs_with(pairs, factory, max_length=2).collect()}
    assert len(rows) == 400 and rows[5].input_ids is None and rows[5].labels is None
    whole = 25000 + len(C.SEPARATOR) + len("Add it") + len(C.EOS_TOKEN)
    assert rows[6].input_ids == [whole] * 2 and rows[6].labels == [C.IGNORED_LABEL] * 2


def test_operators_bound_the_batches_of_their_session(spark):
    texts = spark.createDataFrame([("a",)], "text string")
    ids = spark.createDataFrame([([1],)], "ids array<int>")
    words = spark.createDataFrame([(["a"],)], "words array<string>")
    vocab = spark.createDataFrame([("a", 5)], "token string, id int")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    calls = (
        lambda: encode_subwords(texts, path, "text"),
        lambda: decode_subwords(ids, path, "ids"),
        lambda: lookup_ids(words, vocab, "words", "ids"),
    )
    for call in calls:
        spark.conf.unset(SETTING)
        call()
        assert spark.conf.get(SETTING) == str(BATCH_BYTES)
    for held, after in (("64m", str(BATCH_BYTES)), ("1000", "1000")):
        spark.conf.set(SETTING, held)
        bounded_batches(spark)
        assert spark.conf.get(SETTING) == after
    spark.conf.unset(SETTING)
