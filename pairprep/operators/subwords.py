"""Sub-word ids by the merges of a vocabulary file, and back.

The file is one that the `tokenizers` library reads, at a path that every task can open: a file of
an installed package, on shared storage, or sent along with `SparkContext.addFile` and given by its
name. Nothing is learned here. A task reads the file once; texts go in slices of bounded bytes to the
library, which works on many rows at a time, remembers the words that it has split, and holds some
hundred bytes for every token until the rows are done. It works on them one after the other, on the
core that the task has, unless TOKENIZERS_PARALLELISM is set.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.tokens import truncate
from pairprep.operators.slices import bounded_batches, slices
from pairprep.operators.tokenizing import Tokenizer, tokenize_pairs_with


@functools.cache
def vocabulary(path: str):
    """The vocabulary of a file; special strings in a text are ordinary text to it."""
    from tokenizers import Tokenizer as FromFile

    # With threads of its own in every task, a full executor spends its cores on their waiting.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    found = FromFile.from_file(path if os.path.exists(path) else SparkFiles.get(path))
    found.encode_special_tokens = True
    return found


def subword_tokenizer(path: str) -> Callable[[], Tokenizer]:
    """What `tokenize_pairs_with` takes."""

    def factory() -> Tokenizer:
        words = vocabulary(path)

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in words.encode_batch_fast(texts, add_special_tokens=False)]

        return encode

    return factory


def encode_subwords(
    df: DataFrame, path: str, text: str, out: str = "ids", max_length: int | None = C.MAX_LENGTH
) -> DataFrame:
    """Text to ids, cut to max_length of them unless that is None; a null text stays null."""

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        encode = subword_tokenizer(path)()
        for batch in batches:
            for (texts,) in slices(batch):
                rows = texts.to_pylist()
                made = iter(encode([t for t in rows if t is not None]))
                yield pa.array([None if t is None else next(made) for t in rows], pa.list_(pa.int32()))

    bounded_batches(df.sparkSession)
    # Not deterministic to the optimiser, or a filter behind it would tokenise once more.
    coded = df.withColumn(out, ids_of.asNondeterministic()(text))
    return coded if max_length is None else coded.withColumn(out, truncate(out, max_length))


def _known_ids(lists: pa.Array, size: int) -> list[list[int]]:
    """The ids from 0 to size - 1 of each list that is not null."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = lists.drop_null()
    ids = pc.list_flatten(lists).cast(pa.int64())
    known = pc.fill_null(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, size)), False)
    owners = pc.list_parent_indices(lists).filter(known).to_numpy()
    ends = np.cumsum(np.bincount(owners, minlength=len(lists))).tolist()
    kept = ids.filter(known).to_numpy().tolist()
    return [kept[start:end] for start, end in zip([0, *ends], ends)]


def decode_subwords(df: DataFrame, path: str, ids: str, out: str = "text", skip_special: bool = True) -> DataFrame:
    """Ids to text; special ids are dropped when skip_special. Ids that are null, negative or beyond the
    vocabulary are nothing; a null array stays null. Bytes that make no character become U+FFFD."""

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        words = vocabulary(path)
        size = words.get_vocab_size()
        for batch in batches:
            for (lists,) in slices(batch):
                made = iter(words.decode_batch(_known_ids(lists, size), skip_special_tokens=skip_special))
                yield pa.array([next(made) if present else None for present in lists.is_valid().to_pylist()], pa.string())

    bounded_batches(df.sparkSession)
    return df.withColumn(out, text_of.asNondeterministic()(ids))


def tokenize_pairs_subwords(df: DataFrame, path: str, **settings) -> DataFrame:
    """`tokenize_pairs_with` the vocabulary of a file; `settings` are its other arguments."""
    return tokenize_pairs_with(df, subword_tokenizer(path), **settings)
