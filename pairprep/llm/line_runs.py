"""Repeated lines, found with levelled sorted runs of line hashes, in DataFrame expressions only.

A run is a table (key, n, holder) bucketed and sorted by key, the md5 of a normalised line: n
documents of one batch of documents hold it, and holder is the largest doc_id. Batches come in
falling order of doc_id. Each is grouped by key, merged with the runs that are there, and becomes a
run of its own; what no run holds yet (the anti-join) is seen for the first time, so its largest
doc_id is the largest of all, and a key that is known brings only its count. FAN_OUT runs of one
level are merged into one of the next. All runs have the same buckets: neither the merge join nor
the compaction shuffles a run.

A key that very many documents hold is counted before the shuffle. When the keys to drop meet the
documents again, keys that hold more than one of HEAVY_KEYS parts of all lines go by broadcast (there
cannot be more than HEAVY_KEYS of them), the rest through a join in which no key is large.

Defined results: a null or empty text is one empty line; lines are never compared by less than all
their characters; every row counts as a document, so repeated rows count each; rows without a doc_id
come below all others and, if only such hold a line, all of them keep it; rows with the holder's
doc_id all keep it; other columns are kept, those with a result's name are replaced; an empty table
gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairprep.sources.scratch import fresh_path, remove, stage

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FAN_OUT = 2
KEYS_PER_BUCKET = 4_000_000
HEAVY_KEYS = 10_000
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RESULTS = ("n_lines", "n_dropped", "kept")


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at both ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), CAPITALS, CAPITALS.lower())


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_places(docs: DataFrame, text: str, key: str, min_chars: int) -> DataFrame:
    """(doc, mark, key, place, first) for every line of min_chars or more: the md5 of its key, its
    place, and whether it is the first with that key in its row. `mark` tells texts of one doc_id apart.

    Equal keys are neighbours in the sorted array, so telling the first apart takes no shuffle.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    keyed = F.transform(lines_of(F.col(text)), lambda x, i: F.struct(line_key(x).alias("line"), i.alias("place")))
    long_ones = F.filter(keyed, lambda x: F.length(x["line"]) >= min_chars)
    hashed = F.transform(long_ones, lambda x: F.struct(F.unhex(F.md5(x["line"])).alias("key"), x["place"].alias("place")))
    # `inline` computes the sorted array once, not once per element that looks at its neighbour.
    ready = docs.select(
        F.col(key).alias("doc"),
        F.xxhash64(value).alias("mark"),
        F.inline(F.array(F.struct(F.sort_array(hashed).alias("_places")))),
    )
    again = lambda x, j: F.coalesce(F.get("_places", j - 1)["key"] == x["key"], F.lit(False))
    flagged = F.transform("_places", lambda x, j: F.struct(x["key"], x["place"], (~again(x, j)).alias("first")))
    return ready.select("doc", "mark", F.inline(flagged))


def with_batches(places: DataFrame, docs: DataFrame, key: str, batches: int) -> DataFrame:
    """Add batch, from 0, by falling doc_id in about equal parts; a missing doc_id is in the last."""
    shares = [1 - (i + 1) / batches for i in range(batches - 1)]
    edges = docs.agg(F.percentile_approx(F.col(key).cast("long"), shares)).first()[0] if shares else []
    batch = F.lit(batches - 1)
    for number in range(len(edges or []) - 1, -1, -1):
        batch = F.when(F.col("doc") > edges[number], number).otherwise(batch)
    return places.withColumn("batch", batch)


class LineRuns:
    """A family of sorted runs on the shared storage, to which batches of lines are added.

    With as many buckets as shuffle partitions a batch moves once, and every task writes one file.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_out: int = FAN_OUT):
        self.spark, self.buckets, self.fan_out = spark, buckets, fan_out
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        path, name = fresh_path(self.spark, "line-run"), f"line_run_{uuid.uuid4().hex}"
        spread = rows.repartition(self.buckets, "key")
        writer = spread.write.option("path", path).bucketBy(self.buckets, "key").sortBy("key")
        writer.saveAsTable(name)
        return name, path

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def with_known(self, keys: DataFrame) -> DataFrame:
        """Add known: whether a run holds the key. One merge join for each run."""
        marked, flags = keys, []
        for number, run in enumerate(self.runs()):
            flags.append(f"_in{number}")
            marked = marked.join(run.select("key", F.lit(True).alias(flags[-1])).hint("merge"), "key", "left")
        known = F.coalesce(*flags, F.lit(False)) if flags else F.lit(False)
        return marked.withColumn("known", known).drop(*flags)

    def add(self, places: DataFrame) -> None:
        """Add a batch of `line_places`, all of whose doc_ids lie below those of earlier batches."""
        own = places.groupBy("key").agg(F.count_if("first").alias("n"), F.max("doc").alias("holder"))
        marked = self.with_known(own.repartition(self.buckets, "key"))
        self._put(marked.select("key", "n", F.when(~F.col("known"), F.col("holder")).alias("holder")), 0)

    def _put(self, rows: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) == self.fan_out:
            merged = self.levels[level]
            self._put(_merged([self.spark.table(name) for name, _ in merged]), level + 1)
            self.levels[level] = []
            self._forget(merged)

    def _forget(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, path)

    def merged(self) -> DataFrame | None:
        """(key, n, holder) over all batches, or None where nothing was added."""
        return _merged(self.runs()) if any(self.levels) else None

    def close(self) -> None:
        for level in self.levels:
            self._forget(level)
        self.levels = []


def _merged(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.join(
            run.select("key", F.col("n").alias("_n"), F.col("holder").alias("_holder")).hint("merge"), "key", "full"
        ).select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"),
            F.greatest("holder", "_holder").alias("holder"),
        )
    return rows


def repeated_keys(
    places: DataFrame, min_docs: int, batches: int, buckets: int, fan_out: int = FAN_OUT
) -> DataFrame:
    """(key, n, holder) of the lines that min_docs or more rows hold, as a written table."""
    family = LineRuns(places.sparkSession, buckets, fan_out)
    for batch in range(batches):
        family.add(places.where(F.col("batch") == batch))
    found = stage(family.merged().where(F.col("n") >= min_docs), "repeated-lines")
    family.close()
    return found


def _places_to_drop(places: DataFrame, keys: DataFrame, total: int) -> DataFrame:
    """(doc, mark, places) of the rows that lose lines; total is the sum of n over all keys."""
    heavy = F.col("n") > total / HEAVY_KEYS
    use = keys.select("key", "n", "holder")
    hot = places.join(F.broadcast(use.where(heavy)), "key")
    rest = places.join(use.where(~heavy), "key")
    hits = hot.unionByName(rest).where(~F.col("doc").eqNullSafe(F.col("holder")))
    return hits.groupBy("doc", "mark").agg(F.collect_set("place").alias("places"))


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """Add kept, the text without its repeated lines, n_lines (before) and n_dropped.

    A line whose key has min_chars code points and is in min_docs rows goes everywhere but in the
    largest doc_id that holds it. The texts move once, to the places that they lose.
    """
    docs = docs.drop(*RESULTS)
    found = with_batches(line_places(docs, text, key, min_chars), docs, key, batches)
    places = stage(found, "line-places", ("batch",))
    total = places.agg(F.count_if("first")).first()[0]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // KEYS_PER_BUCKET)
    keys = repeated_keys(places, min_docs, batches, buckets)
    drop = _places_to_drop(places, keys, total)
    # The rows go in one struct, so that no column of the caller's can be taken for one of these.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark")
    )
    held = drop.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "places").hint("shuffle_hash")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    met = rows.join(held, same, "left").select("row", F.coalesce("places", F.array().cast("array<int>")).alias("places"))
    lines = F.inline(F.array(F.struct(lines_of(F.col(f"row.{text}")).alias("lines"))))
    cut = met.select("row", "places", lines)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    results = cut.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("places").cast("long").alias("n_dropped"),
        F.when(F.size("places") == 0, F.coalesce(F.col(f"row.{text}"), F.lit(""))).otherwise(kept).alias("kept"),
    )
    return results.select("row.*", *RESULTS)


def op12_line_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), repeated AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5
), m AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.holder AS gone FROM k LEFT JOIN repeated h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
