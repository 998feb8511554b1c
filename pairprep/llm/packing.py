"""Packing tokenised documents into fixed-size sequences: shortest-pack-first over the histogram
of piece lengths.

A document longer than a sequence is cut into whole sequences and one rest. The histogram has at
most `size` entries whatever the input, so the patterns are planned on the driver: lengths are
placed longest first, each into the pattern with the most space left, and only pattern counts are
updated. Pieces then find their place by their rank among the pieces of their length; ranks are
taken inside hash buckets, so neither a common length nor a repeated text meets in one task.

Defined results: a null or empty text is one piece that holds only the end id; repeated rows are
documents of their own, also under one doc_id; a null doc_id stays null; an empty table gives no
pieces; other columns are ignored by `token_pieces` and kept by `pack`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairprep.sources.scratch import stage

SEQUENCE = 1024
END_ID = 0
BUCKET_ROWS = 50_000
# Ids handed on at once; the JVM and a worker hold them at the same time.
IDS_AT_ONCE = 1_000_000
VOCABULARY = "byte_bpe_50k.json"
# Text that the tokenizer file maps to an id of its own; such texts take the slower library.
SPECIAL = "<|endoftext|>"


@functools.cache
def _tokenizers(json_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@functools.cache
def _ranks(rank_path: str, pattern: str):
    import base64

    import tiktoken

    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoder():
    """text -> ids as uint32 array. The rank file holds the same vocabulary as the JSON file and is
    read by a library that is five times as fast. Texts with the special string go to the other, and
    so do those that the fast one gives up on: its pattern has a limit on runs of blanks."""
    import numpy as np
    import public_tokenizers as P

    fast = _ranks(P.path(VOCABULARY.replace(".json", ".tiktoken")), P.PATTERN)

    def encode(text: str):
        if SPECIAL not in text:
            try:
                return fast.encode_to_numpy(text)
            except ValueError:
                pass
        slow = _tokenizers(P.path(VOCABULARY))
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def token_pieces(docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids of every piece; ids are little-endian unsigned
    32-bit numbers, and the last piece of a document ends with `end_id`."""
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        encode = _encoder()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                for at in range(0, len(ids), size):
                    part = ids[at : at + size]
                    for column, value in zip(rows, (doc.as_py(), at, len(part), len(ids), part.tobytes())):
                        column.append(value)
                    held += len(part)
                if held > IDS_AT_ONCE:
                    yield _batch(pa, rows)
                    rows, held = [[], [], [], [], []], 0
            if rows[0]:
                yield _batch(pa, rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def _batch(pa, rows):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)


def plan_patterns(histogram: Mapping[int, int], size: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: pieces of that length}) of every pattern.

    Each step either uses up a pattern or a length, so there are at most two patterns a length.
    """
    open_packs: dict[int, list[tuple[int, dict[int, int]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max((s for s in open_packs if s >= length), default=None)
            if space is None:
                # Several pieces of a short length share a fresh pack, as one by one they would.
                fit = min(size // length, left)
                repeats = left // fit
                open_packs.setdefault(size - fit * length, []).append((repeats, {length: fit}))
                left -= repeats * fit
                continue
            repeats, pattern = open_packs[space].pop()
            if not open_packs[space]:
                del open_packs[space]
            used = min(repeats, left)
            if repeats > used:
                open_packs.setdefault(space, []).append((repeats - used, pattern))
            grown = {**pattern, length: pattern.get(length, 0) + 1}
            open_packs.setdefault(space - length, []).append((used, grown))
            left -= used
    return [p for space in sorted(open_packs) for p in open_packs[space]]


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank behind the last, pieces a pack, first sequence, offset in a pack)."""
    rows, taken, sequence = [], {}, 0
    for repeats, pattern in patterns:
        offset = 0
        for length, count in pattern.items():
            first = taken.get(length, 0)
            taken[length] = first + repeats * count
            rows.append((length, first, taken[length], count, sequence, offset))
            offset += length * count
        sequence += repeats
    return rows


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` from 1 to `size`. Columns of these two
    names are replaced, all others stay; names that start with an underscore are the operator's."""
    spark = pieces.sparkSession
    held = stage(pieces.drop("sequence_id", "offset"), "pieces")
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = sum(histogram.values()) // BUCKET_ROWS + 1
    slots = spark.createDataFrame(
        _slots(plan_patterns(histogram, size)),
        "length long, _first long, _behind long, _count long, _sequence long, _offset long",
    )
    placed = held.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    running = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket"))
    before = (
        placed.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("length", "_bucket", (running - F.col("_n")).alias("_before"))
    )
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start")
    rank = F.col("_at") + F.col("_before") - 1
    since = F.col("_rank") - F.col("_first")
    return (
        placed.withColumn("_at", F.row_number().over(inside))
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", rank)
        .join(F.broadcast(slots), "length")
        .where((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_behind")))
        .select(
            *held.columns,
            (F.col("_sequence") + F.floor(since / F.col("_count"))).cast("long").alias("sequence_id"),
            (F.col("_offset") + since % F.col("_count") * F.col("length")).cast("long").alias("offset"),
        )
    )


def op1_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = token_pieces(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(pieces)
