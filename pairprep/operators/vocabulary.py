"""Learning a vocabulary, and turning text into ids and back with it.

The ids follow token frequency behind two reserved ones. A vocabulary is looked up in blocks of a
bounded size in bytes, each sent to all tasks and looked up on whole Arrow arrays: no token is
shuffled, so one that fills a third of the corpus costs nothing extra. Nearly every vocabulary is
one block; a larger one takes one more pass per block, by the same code, over the items that no
earlier block knew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions.text import split_tokens
from pairprep.functions.tokens import truncate
from pairprep.operators.ranking import global_rank
from pairprep.operators.slices import bounded_batches
from pairprep.sources.scratch import stage

BLOCK_BYTES = 64_000_000
# Bytes counted for a row beside its token.
ROW_BYTES = 64
# Ranges of ids whose sizes the driver is told, to make blocks of.
ID_RANGES = 4096
# Bits that stand for the entries of all blocks.
FILTER_BITS = 1 << 26


def token_counts(df: DataFrame, *texts: Column | str) -> DataFrame:
    """Occurrences of every token in the given text columns, combined before the shuffle."""
    lists = F.concat(*[split_tokens(t) for t in texts])
    return df.select(F.explode(lists).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def build_vocab(df: DataFrame, size: int, *texts: Column | str) -> DataFrame:
    """(token, id) of the `size` most frequent tokens, ties in token order, and the reserved ids.

    Learn it on whole training texts, separator included, or decoding loses the separator. Ranks
    come from a range-partitioned order, so no task sees more than its part of the tokens.
    """
    ranked = global_rank(token_counts(df, *texts), (F.desc("n"), F.asc("token")), "_rank")
    learned = ranked.where(F.col("_rank") < size).select(
        "token", (F.col("_rank") + C.RESERVED_IDS).cast("int").alias("id")
    )
    return reserved_tokens(df).unionByName(learned)


def reserved_tokens(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(C.EOS_TOKEN, C.EOS_ID), (C.UNKNOWN_TOKEN, C.UNKNOWN_ID)], "token string, id int"
    )


def _blocks(vocab: DataFrame, key: str, block_bytes: int) -> Iterator[tuple[dict, bool]]:
    """The vocabulary as lookup tables of at most about block_bytes, smallest ids first, and whether
    it is the last.

    Of a repeated token or id the smallest partner counts; rows with a null are no entries.
    """
    value = "id" if key == "token" else "token"
    rows = vocab.select(key, value).where(F.col(key).isNotNull() & F.col(value).isNotNull())
    rows = rows.withColumn("_bytes", F.octet_length("token") + ROW_BYTES)
    wanted = _id_ranges(rows, block_bytes)
    for number, ((first, last), parts) in enumerate(wanted):
        inside = rows if first is None else rows.where(F.col("id").between(first, last))
        for part in range(parts):
            mine = inside if parts == 1 else inside.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
            table = mine.groupBy(key).agg(F.min(value).alias(value)).toArrow()
            yield (
                dict(zip(*(table.column(c).to_pylist() for c in (key, value)))),
                (number, part) == (len(wanted) - 1, parts - 1),
            )


def _id_ranges(rows: DataFrame, block_bytes: int) -> list[tuple[tuple, int]]:
    """Ranges of ids that hold at most block_bytes each, and 1, or narrow ones that hold more, and in
    how many parts to cut these. One range without ends where all rows fit."""
    number = F.col("id").cast("long")
    least, most, total = rows.agg(F.min(number), F.max(number), F.sum("_bytes")).first()
    if (total or 0) < block_bytes:
        return [((None, None), 1)]
    width = (most - least) // ID_RANGES + 1
    at = F.floor((number - least) / width)
    ranges, held = [], 0
    for place, size in rows.groupBy(at.alias("_at")).agg(F.sum("_bytes")).orderBy("_at").collect():
        first = least + place * width
        own = (first, first + width - 1)
        if ranges and held + size <= block_bytes:
            ranges[-1] = ((ranges[-1][0][0], own[1]), 1)
            held += size
        else:
            ranges.append((own, -(-size // block_bytes)))
            held = size
    return ranges


def _entries_filter(vocab: DataFrame, key: str) -> np.ndarray:
    """A bitmap of fixed size with the bit of every token or id of the vocabulary."""
    import numpy as np

    at = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(FILTER_BITS)) + 1
    groups = (
        vocab.where(F.col("token").isNotNull() & F.col("id").isNotNull())
        .groupBy(F.bitmap_bucket_number(at).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    )
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, bits in groups.toLocalIterator():
        whole[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return whole


def _look_up(df: DataFrame, vocab: DataFrame, key: str, inputs: str, out: str, block_bytes: int) -> DataFrame:
    """Replace every item of an array by its partner, block by block; the array itself is used up. An
    item without a partner becomes the unknown id or an empty text; the texts of a row are joined at
    the end.

    With several blocks the first pass leaves of a row its distinct items, and the places of all items
    among them as one cell. A bitmap settles nearly all items that are in no block at all; of the others
    only those that no block knew yet go on to the next one: few, as a learned vocabulary has its
    frequent tokens in front. The last pass puts the row together.

    The lookup counts as non-deterministic, or a filter on what follows from it would copy it.
    """
    to_ids = key == "token"
    bounded_batches(df.sparkSession)
    found = df.drop(out)
    state = [F.col(f"{inputs}.{c}") for c in ("rest", "known", "places")]
    context, bits = df.sparkSession.sparkContext, None
    for number, (table, last) in enumerate(_blocks(vocab, key, block_bytes)):
        if not last and bits is None:
            bits = context.broadcast(_entries_filter(vocab, key))
        lookup = _lookup_udfs(context.broadcast(table), bits, to_ids)
        if last:
            made = lookup["last"](*state) if number else lookup["only"](inputs)
            return found.withColumn(out, made).drop(inputs)
        if not number:
            found = found.withColumn(inputs, lookup["first"](inputs))
        else:
            updated = f"{inputs}_next"
            found = found.withColumn(updated, lookup["next"](*state[:2]))
            kept = F.struct(state[2], F.col(f"{updated}.known"), F.col(f"{updated}.rest"))
            found = found.withColumn(inputs, kept).drop(updated)
        found = stage(found, "looked-up")


def _lookup_udfs(shared, bits, to_ids: bool) -> dict:
    """The lookup in one block: of all items (only), or as the first, a further or the last one of several.

    `bits` has the entries of all blocks; the first lookup asks it."""
    given, partner, result = ("string", "int", "array<int>") if to_ids else ("int", "string", "string")
    still = f"known array<{partner}>, rest array<{given}>"
    unknown = C.UNKNOWN_ID if to_ids else ""

    def looked_up(items: pa.Array) -> tuple[pa.Array, pa.DictionaryArray]:
        import pyarrow as pa

        # Only the distinct items of a batch are looked up one by one.
        coded = items.dictionary_encode(null_encoding="encode")
        known = [shared.value.get(x) for x in coded.dictionary.to_pylist()]
        return pa.array(known, pa.int32() if to_ids else pa.string()), coded

    def absent(items: pa.Array, partners: pa.Array) -> np.ndarray:
        """Which items without a partner are in no block either. A null may be taken for an entry."""
        import numpy as np
        import pyarrow.compute as pc
        import xxhash

        missing = pc.indices_nonzero(partners.is_null())
        hashes = (xxhash.xxh64_intdigest(str(x), 42) for x in items.take(missing).to_pylist())
        at = np.fromiter(hashes, np.uint64, len(missing)) & np.uint64(FILTER_BITS - 1)
        hits = bits.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        return missing.to_numpy()[hits == 0]

    def ends_of(sizes: pa.Array) -> np.ndarray:
        """Where the lists begin, and the end of the last one."""
        import numpy as np
        import pyarrow.compute as pc

        return np.concatenate([[0], np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))])

    def listed(items: pa.Array, ends: np.ndarray, like: pa.Array) -> pa.Array:
        """Lists of items, null where `like` is."""
        import pyarrow as pa

        mask = like.is_null() if like.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items, mask=mask)

    def finished(partners: pa.Array, ends: np.ndarray, like: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        made = listed(pc.fill_null(partners, unknown), ends, like)
        return made if to_ids else pc.binary_join(made, "")

    def open_ones(items: pa.Array, partners: pa.Array, ends: np.ndarray, like: pa.Array) -> pa.Array:
        """Of lists of items those that have no partner."""
        import numpy as np

        missing = partners.is_null()
        before = np.concatenate([[0], np.cumsum(missing.to_numpy(zero_copy_only=False))])
        return listed(items.filter(missing), before[ends], like)

    def filled(rest: pa.Array, known: pa.Array) -> pa.Array:
        """The partners known so far, with those of the rest where they were missing."""
        import pyarrow.compute as pc

        partners, coded = looked_up(rest.flatten())
        before = known.flatten().cast(partners.type)
        return pc.replace_with_mask(before, before.is_null(), partners.take(coded.indices))

    @F.arrow_udf(result)
    def only(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow.compute as pc

        for lists in batches:
            partners, coded = looked_up(lists.flatten())
            yield finished(partners.take(coded.indices), ends_of(pc.list_value_length(lists)), lists)

    @F.arrow_udf(f"struct<places binary, {still}>")
    def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for lists in batches:
            partners, coded = looked_up(lists.flatten())
            n, ends = len(coded.dictionary), ends_of(pc.list_value_length(lists))
            # All items that are nowhere count as one.
            nowhere, same, settled = absent(coded.dictionary, partners), np.arange(n), np.zeros(n, bool)
            same[nowhere] = nowhere[:1]
            settled[nowhere] = True
            partners = pc.if_else(pa.array(settled), unknown, partners)
            row = np.repeat(np.arange(len(lists)), np.diff(ends))
            each = pa.array(row * n + same[coded.indices.to_numpy()]).dictionary_encode()
            distinct, at = each.dictionary.to_numpy(), each.indices.to_numpy()
            own = np.searchsorted(distinct // max(n, 1), np.arange(len(lists) + 1))
            places = (at - own[row]).astype(np.int32)
            valid = lists.is_valid().buffers()[1] if lists.null_count else None
            cells = [valid, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(places)]
            which = pa.array(distinct % max(n, 1))
            known, items = partners.take(which), coded.dictionary.take(which)
            yield pa.StructArray.from_arrays(
                [
                    pa.BinaryArray.from_buffers(pa.binary(), len(lists), cells),
                    listed(known, own, lists),
                    open_ones(items, known, own, lists),
                ],
                ["places", "known", "rest"],
            )

    @F.arrow_udf(f"struct<{still}>")
    def next_one(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import pyarrow as pa
        import pyarrow.compute as pc

        for rest, known in batches:
            partners = filled(rest, known)
            own = partners.filter(known.flatten().is_null())
            still_open = open_ones(rest.flatten(), own, ends_of(pc.list_value_length(rest)), rest)
            whole = listed(partners, ends_of(pc.list_value_length(known)), known)
            yield pa.StructArray.from_arrays([whole, still_open], ["known", "rest"])

    @F.arrow_udf(result)
    def last(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for rest, known, places in batches:
            begin = ends_of(pc.list_value_length(known))[:-1]
            ends = ends_of(pc.binary_length(places)) // 4
            at = np.frombuffer(b"".join(places.drop_null().to_pylist()), np.int32)
            at = at + np.repeat(begin, np.diff(ends))
            yield finished(filled(rest, known).take(pa.array(at)), ends, places)

    made = {"only": only, "first": first, "next": next_one, "last": last}
    return {name: udf.asNondeterministic() for name, udf in made.items()}


def lookup_ids(
    df: DataFrame, vocab: DataFrame, tokens: str, out: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Token array to id array; a token outside the vocabulary becomes the unknown id, a null
    array stays null. The token array is not kept."""
    return _look_up(df, vocab, "token", tokens, out, block_bytes)


def encode(
    df: DataFrame,
    vocab: DataFrame,
    text: str,
    out: str = "ids",
    max_length: int | None = C.MAX_LENGTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Text to ids, cut to max_length tokens unless that is None; a null text stays null."""
    tokens = split_tokens(text)
    if max_length is not None:
        tokens = truncate(tokens, max_length)
    return lookup_ids(df.withColumn("_tokens", tokens), vocab, "_tokens", out, block_bytes)


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids: str,
    out: str = "text",
    skip_special: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Ids to text. Reserved ids are dropped when skip_special, spelled out otherwise; any id
    without a token, negative ones included, is nothing. A null array stays null."""
    wanted = F.col(ids)
    if skip_special:
        wanted = F.filter(wanted, lambda x: x >= C.RESERVED_IDS)
    return _look_up(df.withColumn("_wanted", wanted), vocab, "id", "_wanted", out, block_bytes)
