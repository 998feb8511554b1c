"""Near copies by SimHash and five-word similarity, through byte-position indexes of fingerprints.

Two texts are copies where the sets of their SHINGLE-word shingles have a Jaccard similarity of 0.8
or more. The SimHash fingerprints of `simhash_bytes` and its index propose pairs first. Texts at 0.8
differ in more SimHash bits than that index covers, so further pairs come from one with a setting of
its own: a fingerprint of 80 bytes, each from the smallest shingle under an order of its own, so that
a byte is equal with a probability of the similarity. The sets decide on what either proposes.

1. The index is cut into 20 lists per fingerprint by four bytes each. A pair at 0.8 misses all of
   them in one of 40,000 cases, a closer one more rarely.
2. Inside a list the equal bytes of a pair are tallied and pairs with fewer than LEAST_EQUAL of 80
   are dropped (4.5 standard deviations below the mean at 0.8). The others connect candidates.
3. In every candidate component the shingle sets themselves are compared; only pairs of at least
   0.8 are links, and the components of those are the groups.

Equal sets are one node, however many rows have them. A list or component above its limits is cut
into blocks and compared block against block, in tasks of bounded size; inside one, whatever is
linked is taken out at once, so a dense group costs one pass and gives a spanning forest, not pairs.

Shingles are compared by 64-bit hashes, sets by a 128-bit one.

Defined results: words are those of `simhash_bytes`; a text of fewer than SHINGLE words is one
shingle; null and wordless texts are copies of each other; other columns are kept; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairprep.llm.collocations import bitmap_of, in_bitmap
from pairprep.llm.components import components
from pairprep.llm.simhash_bytes import fingerprint_links, fingerprint_of
from pairprep.sources.scratch import forget, made, stage

SHINGLE = 5
SEED = 42
BYTES = 80
LIST_BYTES = 4
LEAST_EQUAL = 48
DIGEST = 16
LIST_ROWS = 8192
# Limits of a block of candidates whose sets are compared.
BLOCK_ROWS = 2048
BLOCK_BYTES = 8_000_000
# Shingles whose orders are worked out together.
SHINGLES_AT_ONCE = 2048


def shingles_of(text: str | None):
    """Sorted distinct hashes of the word shingles."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(SHINGLE, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return np.unique(
        np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())], np.uint64)
    )


@functools.cache
def _orders():
    """A mask and an odd factor per byte of the fingerprint."""
    import numpy as np

    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BYTES, 1), dtype=np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def mark_of(shingles) -> bytes:
    """Digest of the set, then its fingerprint."""
    import numpy as np
    import xxhash

    mask, factor = _orders()
    least = np.full(BYTES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        np.minimum(least, ((shingles[at : at + SHINGLES_AT_ONCE] ^ mask) * factor).min(axis=1), out=least)
    octets = ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)
    return xxhash.xxh3_128_digest(shingles.tobytes()) + octets.tobytes()


def with_mark(docs: DataFrame) -> DataFrame:
    """Add _mark, the digest of the shingle set and its fingerprint, and _fp, the SimHash of the text."""

    @F.arrow_udf("mark binary, fp long")
    def marks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        for texts in batches:
            found = pa.array([mark_of(shingles_of(t.as_py())) for t in texts], pa.binary())
            fps = np.fromiter((fingerprint_of(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.StructArray.from_arrays([found, pa.array(fps.view(np.int64))], ["mark", "fp"])

    made = docs.withColumn("_made", marks.asNondeterministic()("text"))
    return made.withColumns({"_mark": F.col("_made.mark"), "_fp": F.col("_made.fp")}).drop("_made")


def spanning_forest(n: int, near: Callable) -> list[tuple[int, int]]:
    """Links that connect what near(x, others) connects; each number is asked for at most once,
    against those that nothing has reached yet."""
    import numpy as np

    links, left = [], np.arange(n)
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            x = reached.pop()
            hit = near(x, left)
            found = left[hit].tolist()
            links += [(x, y) for y in found]
            reached += found
            left = left[~hit]
    return links


def candidate_forest(sketches) -> list[tuple[int, int]]:
    """Links of pairs with at least LEAST_EQUAL equal bytes."""
    return spanning_forest(
        len(sketches), lambda x, others: (sketches[others] == sketches[x]).sum(axis=1) >= LEAST_EQUAL
    )


def similar_forest(sets: list) -> list[tuple[int, int]]:
    """Links of pairs of sets with a Jaccard similarity of at least 0.8."""
    import numpy as np

    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.zeros(len(values), np.int8)
    running = np.zeros(len(codes) + 1, np.int64)

    def near(x: int, others):
        mine = codes[ends[x] - sizes[x] : ends[x]]
        own[mine] = 1
        np.cumsum(own[codes], out=running[1:])
        own[mine] = 0
        common = running[ends[others]] - running[ends[others] - sizes[others]]
        return 5 * common >= 4 * np.maximum(sizes[others] + sizes[x] - common, 1)

    return spanning_forest(len(sets), near)


def _dealt(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """Every row once for each pair of blocks that its block is in, groups together and sorted."""
    block = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    pairs = (
        rows.withColumn("_block", block)
        .withColumn("_other", other)
        .select(key, F.least("_block", "_other").alias("one"), F.greatest("_block", "_other").alias("two"), "node", *columns)
    )
    return pairs.repartition(key, "one", "two").sortWithinPartitions(key, "one", "two")


def _group_links(dealt: DataFrame, read: Callable, forest: Callable) -> DataFrame:
    """(u, v) links of the forest of every (key, one, two) group; read makes a value of a cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        def links_of(held):
            nodes = np.array(list(held), np.int64)
            found = np.array(forest(list(held.values())), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(nodes[found[:, 0]]), pa.array(nodes[found[:, 1]])], names=["u", "v"])

        now, held = None, {}
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for key, node, cell in zip(keys, batch.column(3).to_pylist(), batch.column(4)):
                if key != now:
                    if len(held) > 1:
                        yield links_of(held)
                    now, held = key, {}
                held[node] = read(cell.as_py())
        if len(held) > 1:
            yield links_of(held)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def candidate_links(sets: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(u, v) links between nodes of (node, sketch), enough for the components of candidates."""
    keys = [
        F.xxhash64(F.lit(n), F.substring("sketch", LIST_BYTES * n + 1, LIST_BYTES)) for n in range(BYTES // LIST_BYTES)
    ]
    lists = sets.select(F.explode(F.array(*keys)).alias("list"), "node")
    shared = stage(lists.groupBy("list").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    listed = stage(lists.join(shared, "list"), "listed")
    # Copies meet in many lists with the same members: of equal lists one will do.
    members = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")]
    alike = listed.groupBy("list", "n").agg(F.min("node").alias("low"), *members)
    once = stage(alike.groupBy("n", "low", "x", "y").agg(F.min("list").alias("list")), "once")
    blocks = once.select("list", F.ceil(F.col("n") / list_rows).cast("long").alias("_blocks"))
    rows = listed.select("list", "node").join(blocks, "list").join(sets, "node")

    def forest(cells: list) -> list[tuple[int, int]]:
        import numpy as np

        return candidate_forest(np.frombuffer(b"".join(cells), np.uint8).reshape(-1, BYTES))

    return _group_links(_dealt(rows, "list", "sketch"), bytes, forest)


def similar_links(members: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v) links of at least 0.8 inside each candidate component of (root, node, text)."""
    size = F.greatest(F.count("*") / block_rows, F.sum(F.coalesce(F.octet_length("text"), F.lit(0))) / BLOCK_BYTES)
    roots = stage(members.groupBy("root").agg(F.ceil(F.greatest(size, F.lit(1))).cast("long").alias("_blocks")), "roots")
    return _group_links(_dealt(members.join(roots, "root"), "root", "text"), shingles_of, similar_forest)


def rows_of(rows: DataFrame, nodes: DataFrame) -> Column:
    """Whether a row's _row may be one of (node); few others are taken for one, and none is missed.

    What is broadcast is a bitmap of fixed size, so the texts of all other rows stay where they are.
    """
    bits = rows.sparkSession.sparkContext.broadcast(bitmap_of(nodes.select(F.xxhash64("node").alias("hash"))))

    @F.arrow_udf("boolean")
    def known(hashes: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        return pa.array(in_bitmap(bits.value, np.asarray(hashes).view(np.uint64)))

    return known(F.xxhash64("_row"))


def simhash_links(marked: DataFrame) -> DataFrame:
    """(u, v) links between nodes of (node, fp) whose fingerprints lie within 4 bits, enough for the
    components of those; a node may have several."""
    fps = stage(marked.groupBy("fp").agg(F.min("node").alias("least")), "fps")
    ends = stage(fingerprint_links(fps.select("fp")), "fp-links")
    u, v = fps.select(F.col("fp").alias("u"), F.col("least").alias("a")), fps.select(F.col("fp").alias("v"), F.col("least").alias("b"))
    near = ends.join(u, "u").join(v, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    equal = marked.join(fps, "fp").where("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v"))
    return near.union(equal).distinct()


def grouped(held: DataFrame) -> DataFrame:
    """(_row, component) of every row of (_row, _mark, _fp, text)."""
    digest = F.substring("_mark", 1, DIGEST).alias("digest")
    sketch = F.substring("_mark", DIGEST + 1, BYTES)
    sets = stage(held.groupBy(digest).agg(F.min("_row").alias("node"), F.min(sketch).alias("sketch")), "sets")
    marked = held.select(digest, F.col("_fp").alias("fp")).distinct().join(sets, "digest").select("node", "fp")
    proposed = simhash_links(stage(marked, "marked")).union(candidate_links(sets.select("node", "sketch")))
    near = components(proposed)
    texts = held.where(rows_of(held, near)).select(F.col("_row").alias("node"), "text")
    members = stage(texts.join(near, "node").select("root", "node", "text"), "members")
    roots = components(similar_links(members)).withColumnRenamed("root", "component")
    named = sets.join(roots, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return held.select("_row", digest).join(named, "digest").select("_row", "component")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, nulls last, then the
    smallest hash of its text.

    Rows are told apart by an id of their own, not by doc_id, so repeated and missing ids are
    searched and kept or dropped like any other. They lie in a struct, so columns of any name stay.
    """
    before = made()
    inner = docs.select(F.struct("*").alias("row"), "text", F.monotonically_increasing_id().alias("_row"))
    held = stage(with_mark(inner).drop("text"), "rows")
    seen = held.select("_row", "_mark", "_fp", F.col("row.text").alias("text"))
    rank = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", F.xxhash64("row.text"), "_row")
    places = stage(grouped(seen).join(held.select("_row", rank.alias("rank")), "_row"), "places")
    first = places.groupBy("component").agg(F.count("*").alias("n"), F.min("rank").alias("least")).where("n > 1")
    copies = places.join(first, "component").where("rank <> least").select(F.col("_row").alias("node"))
    dropped = stage(copies, "dropped")
    forget(docs.sparkSession, before, ("rows", "dropped"))
    maybe = rows_of(held, dropped)
    rest = held.where(maybe).join(dropped.withColumnRenamed("node", "_row"), "_row", "left_anti")
    return held.where(~maybe).select("row.*").unionByName(rest.select("row.*"))
