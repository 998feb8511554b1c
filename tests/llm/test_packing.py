"""Packing: every id once, gapless sequences, ids equal to the tokenizer library's."""

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pairprep.llm import packing as K


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_patterns_hold_every_piece_once(histogram):
    patterns = K.plan_patterns(histogram, 64)
    placed = {}
    for repeats, pattern in patterns:
        assert sum(length * n for length, n in pattern.items()) <= 64
        for length, n in pattern.items():
            placed[length] = placed.get(length, 0) + repeats * n
    assert placed == histogram
    assert len(patterns) <= 2 * max(len(histogram), 1) + 2


def test_little_padding_on_many_lengths():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.integers(1, 1025, 20_000), return_counts=True)
    patterns = K.plan_patterns(dict(zip(lengths.tolist(), counts.tolist())))
    used = sum(r * sum(length * n for length, n in p.items()) for r, p in patterns)
    assert used / (1024 * sum(r for r, _ in patterns)) > 0.995


def test_pieces_and_places(spark, docs):
    texts = ["word " * 3000, "", None, "a <|endoftext|> b", "é字 twice", "é字 twice", "x" * 9000]
    table = docs(list(enumerate(texts)) + [(5, "é字 twice"), (None, "no id")], "ids string, offset string")
    rows = K.pack(K.token_pieces(table)).collect()
    tokenizer = Tokenizer.from_file(P.path(K.VOCABULARY))
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.start)):
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts[:5]):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in by_doc[i]]).tolist() == want
        assert {r.doc_tokens for r in by_doc[i]} == {len(want)}
    assert len(by_doc[5]) == 2 and len(by_doc[None]) == 1
    places = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert K.pack(K.token_pieces(table.limit(0))).count() == 0


def test_ranks_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_ROWS", 10)
    pieces = spark.range(500).selectExpr("id as doc_id", "0L as start", "300L as length", "'k' as own")
    rows = K.pack(pieces).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 500
    assert {r.offset for r in rows} == {0, 300, 600}
    assert max(r.sequence_id for r in rows) == 166


def test_very_long_runs_have_the_ids_of_the_contract():
    tokenizer = Tokenizer.from_file(P.path(K.VOCABULARY))
    encode = K._encoder()
    for run in (" ", "\n", "a", "\t "):
        text = run * (2_000_000 // len(run))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
