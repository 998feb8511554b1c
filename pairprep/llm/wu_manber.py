"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The symbols are words, the patterns all windows of 13 consecutive words of the benchmark items (an
item of fewer words is one window). Per pattern length there is a shift table over blocks of two
words: how far the search may move on because no pattern has that block nearer to its end. Where
the shift is zero, the suffix block selects a bucket, the first block narrows it, and a direct
comparison confirms. Occurrences may overlap.

The tables are built on the driver and broadcast, from benchmark blocks of a bounded size: a larger
benchmark is searched block by block, and the hits of each block are added to the rows.

Defined results: a null or wordless text has no words and no hits; a null or wordless item matches
nothing; items that repeat an id count once, a null item_id is no item; repeated rows each get their
own result; other columns are kept, those named n_words, hits or items are replaced; an empty table of
documents gives no rows, an empty benchmark leaves every document without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairprep.sources.scratch import stage

WINDOW = 13
# Text bytes of benchmark items whose tables are broadcast together.
BLOCK_BYTES = 16_000_000
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HITS = "n_words long, hits array<struct<start:long,end:long>>, items array<long>"


def words_of(text: str | None) -> list[bytes]:
    """Lower-case only A to Z, then words."""
    import re

    return re.findall(WORD, (text or "").encode().lower())


class Searcher:
    """Shift and bucket tables for the windows of (item_id, text) pairs."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        patterns: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            codes = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            size = min(window, len(codes))
            for at in range(len(codes) - size + 1 if size else 0):
                patterns.setdefault(size, {}).setdefault(tuple(codes[at : at + size]), set()).add(item)
        self.base = len(self.ids) + 1
        self.tables = [(size, *self._table(size, found)) for size, found in sorted(patterns.items())]

    def _table(self, size: int, found: dict[tuple[int, ...], set[int]]):
        width = min(2, size)
        shift: dict[int, int] = {}
        buckets: dict[int, dict[int, list[tuple[list[int], set[int]]]]] = {}
        for pattern, items in found.items():
            for end in range(width, size + 1):
                block = self._block(pattern[end - width : end])
                shift[block] = min(shift.get(block, size), size - end)
            last, first = self._block(pattern[-width:]), self._block(pattern[:width])
            buckets.setdefault(last, {}).setdefault(first, []).append((list(pattern), items))
        return width, shift, buckets

    def _block(self, codes) -> int:
        return codes[0] if len(codes) == 1 else codes[0] * self.base + codes[1]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges covered by occurrences, joined and in order, and the items found."""
        get = self.ids.get
        codes = [get(w, 0) for w in words]
        base, n, spans, items = self.base, len(codes), [], set()
        for size, width, shift, buckets in self.tables:
            default, at, jump = size - width + 1, size - 1, shift.get
            while at < n:
                block = codes[at - 1] * base + codes[at] if width == 2 else codes[at]
                move = jump(block, default)
                if move:
                    at += move
                    continue
                start = at - size + 1
                first = codes[start] * base + codes[start + 1] if width == 2 else codes[start]
                part = None
                for pattern, owners in buckets[block].get(first, ()):
                    part = part or codes[start : at + 1]
                    if part == pattern:
                        spans.append((start, at + 1))
                        items |= owners
                at += 1
        return join_spans(spans), items


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def _search_with(df: DataFrame, items: list[tuple[int, str]], window: int, earlier: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Searcher(items, window))

    def found(texts: pa.Array, before: pa.Array | None) -> pa.Array:
        import pyarrow as pa

        search, rows = shared.value.search, []
        old = before.to_pylist() if before is not None else [None] * len(texts)
        for text, held in zip(texts, old):
            words = words_of(text.as_py())
            spans, items = search(words)
            if held:
                spans = join_spans(spans + [(h["start"], h["end"]) for h in held["hits"]])
                items |= set(held["items"])
            rows.append(
                {
                    "n_words": len(words),
                    "hits": [{"start": s, "end": e} for s, e in spans],
                    "items": sorted(items),
                }
            )
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(span)), ("items", pa.list_(pa.int64()))])
        return pa.array(rows, kind)

    if earlier:

        @F.arrow_udf(HITS)
        def add(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, before in batches:
                yield found(texts, before)

        return df.withColumn("_found", add.asNondeterministic()("text", "_found"))

    @F.arrow_udf(HITS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield found(texts, None)

    return df.withColumn("_found", scan.asNondeterministic()("text"))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Add n_words, hits (word ranges inside occurring windows) and items (their ids) to documents."""
    named = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    named = named.select(F.col("item_id").cast("long"), "text")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    found = docs.drop("n_words", "hits", "items", "_found")
    for block in range(blocks):
        part = named.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = _search_with(found, [tuple(r) for r in part.collect()], window, block > 0)
        if blocks > 1:
            found = stage(found, "searched")
    kept = [c for c in found.columns if c != "_found"]
    return found.select(*kept, "_found.n_words", "_found.hits", "_found.items")


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated():
    """At least one word in twenty lies in an occurring window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = find_contamination(docs.select(F.struct("*").alias("_row"), "text"), benchmark)
    return found.withColumn("n_hit", n_hit()).where(~contaminated()).select("_row.*")


def op8_wu_manber(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return (
        found.withColumn("n_hit", n_hit())
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(names, 256).alias("items_sha256"),
            contaminated().alias("contaminated"),
        )
    )


OP8_SQL = r"""
WITH w AS (
  SELECT item_id, list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), grams AS (
  SELECT DISTINCT item_id, n, g FROM (
    SELECT item_id, least(13, len(ws)) AS n,
      unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
        lambda i: array_to_string(ws[i : i + least(13, len(ws)) - 1], ' '))) AS g
    FROM w WHERE len(ws) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents
), windows AS (
  SELECT r, n, pos, array_to_string(ws[pos : pos + n - 1], ' ') AS g FROM (
    SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos
    FROM d CROSS JOIN (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n)
), hits AS (SELECT r, pos, windows.n, item_id FROM windows JOIN grams USING (n, g)),
covered AS (
  SELECT r, count(DISTINCT word) AS n_hit FROM (
    SELECT r, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
