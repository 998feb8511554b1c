"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Fingerprints that differ in at most 4 of 64 bits differ in at most 4 of their 8 bytes, so at least
4 positional bytes are equal: the guaranteed minimum of matches. Any 4 of 8 positions contain one
of 20 fixed position triples (a covering of all quadruples), so the index is cut into lists by
(triple, its three bytes). Inside a list the shared positional bytes of a pair are tallied, pairs
with fewer than 4 are dropped, and the rest is verified bit by bit. No linked pair can be missed.

Only distinct fingerprints are indexed, however many documents carry one. A list gives the links of
a spanning forest, not all pairs: everything within reach of a pivot is linked to it at once, so a
dense group costs one pass per pivot. A list above LIST_ROWS fingerprints is cut into blocks and
compared block against block, all pairs of blocks, in tasks of bounded size.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a
repeated row gets the same values again; a null doc_id never names a component unless nothing else
is in it; an empty table gives no rows; other columns are ignored by `near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairprep.llm.components import components
from pairprep.sources.scratch import stage

SHINGLE = 4
SEED = 42
BYTES = 8
MAX_BITS = 4
LIST_ROWS = 8192
# Words whose hashes are unpacked to bits together.
HASHES_AT_ONCE = 1 << 16


def position_triples() -> list[tuple[int, int, int]]:
    """Triples such that any 4 of the 8 positions contain one: with the positions in three groups,
    those inside a group, and two of a group with one of the next (the rule of Turán)."""
    group = [p % 3 for p in range(BYTES)]

    def taken(triple: tuple[int, ...]) -> bool:
        groups = sorted(group[p] for p in triple)
        first, second, third = groups
        if first == third:
            return True
        if first == second or second == third:
            lone = third if first == second else first
            return (second + 1) % 3 == lone
        return False

    return [t for t in combinations(range(BYTES), 3) if taken(t)]


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, as an unsigned number."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())], "<u8"
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[at : at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Add the fingerprint as a long with the same bits."""

    @F.arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        for texts in batches:
            made = np.fromiter((fingerprint_of(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.array(made.view(np.int64))

    return docs.withColumn(out, fingerprints.asNondeterministic()(text))


def _byte(position: int):
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def _lists(fps: DataFrame) -> DataFrame:
    """(list, fp): every fingerprint in its 20 lists."""
    keys = [
        F.lit(n << 24).cast("long")
        + _byte(a) * F.lit(1 << 16)
        + _byte(b) * F.lit(1 << 8)
        + _byte(c)
        for n, (a, b, c) in enumerate(position_triples())
    ]
    return fps.select(F.explode(F.array(*keys)).alias("list"), "fp")


def forest(fps, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect what pairs within max_bits connect, among unsigned 64-bit numbers.

    Pairs are compared by the positional bytes they share first (at least 8 - max_bits), then bit
    by bit. Pivots lie further apart than max_bits, so parts of two pivots can only be linked when
    the pivots are within three times max_bits; such parts are compared until one link is found.
    """
    import numpy as np

    octets = fps.view(np.uint8).reshape(-1, BYTES)

    def near(one: int, others):
        found = (octets[others] == octets[one]).sum(axis=1) >= BYTES - max_bits
        found[found] = np.bitwise_count(fps[others[found]] ^ fps[one]) <= max_bits
        return found

    links, parts, left = [], [], np.arange(len(fps))
    while len(left):
        pivot, rest = left[0], left[1:]
        within = near(pivot, rest)
        links += [(int(pivot), int(x)) for x in rest[within]]
        parts.append(np.append(rest[within], pivot))
        left = rest[~within]
    root = list(range(len(parts)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    pivots = fps[[p[-1] for p in parts]]
    for i in range(len(parts)):
        gaps = np.bitwise_count(pivots[i + 1 :] ^ pivots[i])
        for j in np.flatnonzero(gaps <= 3 * max_bits) + i + 1:
            if find(i) == find(int(j)):
                continue
            few, many = sorted((parts[i], parts[j]), key=len)
            for x in few:
                if len(hit := many[near(x, many)]):
                    links.append((int(x), int(hit[0])))
                    root[find(i)] = find(int(j))
                    break
    return links


def _list_links(lists: DataFrame) -> DataFrame:
    """Links of every (list, one, two) group, whose rows arrive together and sorted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        def links_of(keys, fps):
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = np.concatenate(([0], edges, [len(keys)]))
            us, vs = [], []
            for k in np.flatnonzero(np.diff(bounds) > 1):
                own = np.unique(fps[bounds[k] : bounds[k + 1]])
                for a, b in forest(own.view(np.uint64)):
                    us.append(own[a])
                    vs.append(own[b])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(us, np.int64)), pa.array(np.array(vs, np.int64))], names=["u", "v"]
            )

        keys, fps = np.empty((0, 3), np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            keys = np.concatenate((keys, new))
            fps = np.concatenate((fps, batch.column(3).to_numpy(zero_copy_only=False)))
            if not len(keys):
                continue
            whole = len(keys) - int((keys == keys[-1]).all(axis=1)[::-1].argmin())
            if (keys == keys[-1]).all():
                continue
            yield links_of(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield links_of(keys, fps)

    return lists.mapInArrow(run, "u long, v long")


def fingerprint_links(fps: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """(u, v) links between distinct fingerprints within 4 bits, enough for their components."""
    lists = _lists(fps)
    long_lists = (
        lists.groupBy("list")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > list_rows)
        .select("list", F.ceil(F.col("_n") / list_rows).cast("long").alias("_blocks"))
    )
    block = F.pmod(F.xxhash64("fp"), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    dealt = (
        lists.join(long_lists, "list", "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long")))
        .withColumn("_block", block)
        .withColumn("_other", other)
        .select("list", F.least("_block", "_other").alias("one"), F.greatest("_block", "_other").alias("two"), "fp")
    )
    return _list_links(
        dealt.repartition("list", "one", "two").sortWithinPartitions("list", "one", "two")
    ).distinct()


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id in reach."""
    held = stage(with_fingerprint(docs.select("doc_id", text), text).select("doc_id", "fp"), "fingerprints")
    fps = stage(held.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(fingerprint_links(fps.select("fp"))).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = stage(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    named = rooted.join(least, "root").select("fp", "component_id")
    return held.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest doc_id; repeats of that row's id go too.

    Rows without a doc_id are never taken for copies and stay.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    kept = near_duplicates(known).where("doc_id = component_id").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    once = (
        known.join(kept, "doc_id", "left_semi")
        .withColumn("_first", F.row_number().over(first))
        .where("_first = 1")
        .drop("_first")
    )
    return once.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))


def op10_simhash_bytes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")
