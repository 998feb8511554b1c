"""Exact long-match removal with a logarithmic family of suffix arrays.

Every byte covered by a SIZE-byte string that also starts anywhere else is marked. Strings are
gathered into content-defined runs (see windows.py) whose core they all contain, so equal strings
have equal cores:

1. Cores that occur once in all texts are set aside; only hashes are shuffled for that, combined
   before the shuffle.
2. Of each kind of run (equal bytes, so copies of any number) two go on with their bytes to the
   partition of their core, or the only one there is.
3. There every new batch gets suffix arrays: the texts from the core on, and backwards from it, in
   order, with the lengths of their common starts. The batch is merge-scanned against the existing
   levels: a string is found again where one other run shares enough on both sides. Levels of
   equal size merge geometrically.
4. A core with more than HOT_RUNS such runs is too much for one task. Its runs are cut in two, the
   strings that start far before the core and the others; each piece has a longer core of its own,
   and steps 1 to 4 begin again for the pieces, down to pieces of a single string if need be.
5. What was found in a kind holds for all runs of that kind.

Kinds and cores are told apart by two 64-bit hashes. They only choose what is compared and carry a
result to further copies: every removed string was found by the levels, in bytes.

Defined results: a null or short text has no removed bytes; repeated rows are texts of their own,
so they remove each other; a null doc_id stays; other columns are kept, whatever their names, those
named spans or kept are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairprep.llm import windows as W
from pairprep.sources.scratch import forget, made, stage

# Different runs of a core that one task compares.
HOT_RUNS = 50_000
# Content bytes of one partition of step 3, and runs of one batch there.
PART_BYTES = 8_000_000
BATCH_RUNS = 4096
ROW = ["_doc", "_hash"]
KIND = ["core", "run"]
PIECE = [*KIND, *ROW, "first", "last", "at", "lo", "hi", "of_core", "of_run", "skip", "content"]


def _sketch(docs: DataFrame) -> DataFrame:
    """(core, run, row, first, last, at) of every run of every text; the core begins at first + at."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        names = ["core", "run", "_doc", "_hash", "first", "last", "at"]
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(2)):
                core, whole, *places = W.runs_of((text.as_py() or "").encode())
                if len(core):
                    held.append((core.view(np.int64), whole.view(np.int64), np.full(len(core), i), *places))
                    size += len(core)
                if held and (size > 200_000 or i + 1 == batch.num_rows):
                    core, whole, row, *places = map(np.concatenate, zip(*held))
                    rows = [batch.column(c).take(pa.array(row)) for c in (0, 1)]
                    columns = [pa.array(core), pa.array(whole), *rows, *map(pa.array, places)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    held, size = [], 0

    return docs.select(*ROW, "_text").mapInArrow(
        run, "core long, run long, _doc long, _hash long, first long, last long, at long"
    )


class Level:
    """Suffix arrays of a set of runs: texts from the core on, and backwards from the core."""

    def __init__(self, members, ahead, back) -> None:
        self.members = members  # numbers of the runs
        self.ahead, self.back = ahead, back  # run numbers, in the order of their texts

    def __len__(self) -> int:
        return len(self.members)


class LevelFamily:
    """Levels whose sizes differ by at least two, and which strings of which run were found twice.

    Run i has `ahead[i]` (bytes from the core on) and `back[i]` (bytes before the core, backwards);
    its string number a starts a bytes before the core.
    """

    def __init__(self, size: int = W.SIZE) -> None:
        self.size = size
        self.ahead: list[bytes] = []
        self.back: list[bytes] = []
        self.levels: list[Level] = []
        self.marks: list = []

    def add(self, runs: list[tuple[bytes, bytes]]) -> None:
        """Index a batch of (ahead, back) and scan it against itself and all levels."""
        import numpy as np

        begin = len(self.ahead)
        for ahead, back in runs:
            self.ahead.append(ahead)
            self.back.append(back)
            self.marks.append(np.zeros(len(back) + 1, bool))
        new = list(range(begin, len(self.ahead)))
        batch = Level(new, sorted(new, key=self.ahead.__getitem__), sorted(new, key=self.back.__getitem__))
        self._scan(batch)
        for level in self.levels:
            self._scan(self._merged(batch, level))
        while self.levels and len(self.levels[-1]) < 2 * len(batch):
            batch = self._merged(self.levels.pop(), batch)
        self.levels.append(batch)

    def _merged(self, one: Level, two: Level) -> Level:
        """Two sorted runs joined; the sort finds and merges them in linear time."""
        return Level(
            one.members + two.members,
            sorted(one.ahead + two.ahead, key=self.ahead.__getitem__),
            sorted(one.back + two.back, key=self.back.__getitem__),
        )

    def _scan(self, level: Level) -> None:
        """Mark the strings that two runs of the level share.

        Runs that agree in a bytes backwards are neighbours in one order, runs that agree in the
        other size - a bytes are neighbours in the other; equal in both is an equal string.
        """
        import numpy as np

        members = np.array(level.members)
        place = {m: i for i, m in enumerate(level.members)}
        before = np.array([len(self.back[m]) for m in level.members])
        behind = np.array([len(self.ahead[m]) for m in level.members])
        orders = []
        for order, texts in ((level.back, self.back), (level.ahead, self.ahead)):
            common = np.array([-1] + [_common(texts[x], texts[y]) for x, y in zip(order, order[1:])])
            orders.append((np.array([place[m] for m in order]), common))
        found = np.zeros((len(members), int(before.max(initial=-1)) + 1), bool)
        for a in range(found.shape[1]):
            own = np.flatnonzero((before >= a) & (behind >= self.size - a))
            if len(own) < 2:
                continue
            code = np.zeros(len(members), np.int64)
            for (where, common), depth in zip(orders, (a, self.size - a)):
                group = np.empty(len(members), np.int64)
                group[where] = np.cumsum(common < depth)
                code = code * (len(members) + 1) + group
            own = own[np.argsort(code[own])]
            same = np.flatnonzero(code[own[1:]] == code[own[:-1]])
            found[own[same], a] = found[own[same + 1], a] = True
        for i in np.flatnonzero(found.any(axis=1)):
            marks = self.marks[level.members[i]]
            marks |= found[i, : len(marks)]


def _common(x: bytes, y: bytes) -> int:
    """Length of the common start."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _scan_runs(contents: DataFrame) -> DataFrame:
    """Found strings of the kinds of a partition as (kind, one, two), counted from the run's first.

    Rows that are repeated as a whole bring a run more than once; two are enough.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        family, kinds, copies, new = LevelFamily(), [], {}, []
        for batch in batches:
            for core, kind, *place, at, content in zip(*batch.to_pydict().values()):
                key = (core, kind, *place)
                copies[key] = copies.get(key, 0) + 1
                if copies[key] <= 2:
                    kinds.append((core, kind, at))
                    new.append((content[at:], content[:at][::-1]))
                if len(new) == BATCH_RUNS:
                    family.add(new)
                    new = []
        if new:
            family.add(new)
        found = set()
        for (core, kind, at), marks in zip(kinds, family.marks):
            hits = np.flatnonzero(marks)
            for group in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1) if len(hits) else ():
                found.add((core, kind, at - int(group[-1]), at - int(group[0])))
        rows = list(found)
        for part in range(0, len(rows), 100_000):
            columns = zip(*rows[part : part + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*KIND, "one", "two"])

    return contents.select(*KIND, *ROW, "first", "at", "content").mapInArrow(
        run, "core long, run long, one long, two long"
    )


def _halves(contents: DataFrame) -> DataFrame:
    """The runs cut in two: strings that start lo to hi bytes before the core become those of the lower
    and those of the upper half of these distances. All strings of a piece contain its new core. It
    begins skip strings behind the run of the kind (of_core, of_run)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            made = []
            for r in batch.to_pylist():
                content, at = r["content"], r["at"]
                middle = (r["lo"] + r["hi"]) // 2
                for lo, hi in ((r["lo"], middle), (middle + 1, r["hi"])):
                    near, far = max(lo, at - len(content) + W.SIZE), min(hi, at)
                    if near > far:
                        continue
                    own = content[at - far : at - near + W.SIZE]
                    shape = f"{r['core']} {lo} {far} {near} ".encode()
                    core = f"{r['core']} {lo} ".encode() + content[at - lo : at - hi + W.SIZE]
                    hashes = [_signed(xxhash.xxh3_64_intdigest(x, n)) for n, x in enumerate((core, shape + own))]
                    first = r["first"] + at - far
                    place = (r["_doc"], r["_hash"], first, first + far - near, far, lo, hi)
                    made.append((*hashes, *place, r["core"], r["run"], at - far, own))
            if made:
                columns = [pa.array(c, t) for c, t in zip(zip(*made), [*[pa.int64()] * 12, pa.binary()])]
                yield pa.RecordBatch.from_arrays(columns, names=PIECE)

    kinds = ", ".join(f"{c} long" for c in PIECE[:-1])
    return contents.mapInArrow(run, f"{kinds}, content binary")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _same_row(left: str, right: str) -> Column:
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in ROW]
    return same[0] & same[1]


def _contents(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The runs with their bytes."""
    place = F.struct(*KIND, "first", "last", "at")
    listed = runs.groupBy(*ROW).agg(F.collect_set(place).alias("_runs"))
    octets = F.col("_text").cast("binary")
    width = F.col("_r.last") - F.col("_r.first") + W.SIZE
    return (
        docs.alias("x")
        .join(listed.alias("y"), _same_row("x", "y"))
        .select("x._doc", "x._hash", "_text", F.explode("_runs").alias("_r"))
        .select(
            "_r.core",
            "_r.run",
            *ROW,
            "_r.first",
            "_r.at",
            F.lit(0).cast("long").alias("lo"),
            F.lit(W.SPREAD).cast("long").alias("hi"),
            F.substring(octets, (F.col("_r.first") + 1).cast("int"), width.cast("int")).alias("content"),
        )
    )


def _shared(runs: DataFrame) -> DataFrame:
    """The runs whose core is that of another run too."""
    # Counts are written before they are joined: a join right behind an aggregate keeps all rows of
    # a key in one task, one of two tables is split where a key is common.
    cores = stage(runs.groupBy("core").agg(F.count("*").alias("_n")).where("_n > 1").select("core"), "cores")
    return runs.join(cores, "core", "left_semi")


def _two_of_each(runs: DataFrame) -> DataFrame:
    """The least and the greatest run of every kind, or the only one."""
    place = F.struct(*[c for c in runs.columns if c not in KIND])
    kinds = runs.groupBy(*KIND).agg(F.count("*").alias("n"), F.min(place).alias("one"), F.max(place).alias("two"))
    both = F.when(F.col("n") > 1, F.array("one", "two")).otherwise(F.array("one"))
    return kinds.select(*KIND, F.explode(both).alias("_r")).select(*KIND, "_r.*")


def _matches(contents: DataFrame, hot_runs: int) -> DataFrame:
    """(kind, one, two): strings of the runs in `contents` that start elsewhere too."""
    hot = stage(
        contents.where("lo < hi").groupBy("core").agg(F.count("*").alias("_n")).where(F.col("_n") > hot_runs).select("core"),
        "hot",
    )
    size = contents.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    found = _scan_runs(contents.join(hot, "core", "left_anti").repartition(size // PART_BYTES + 1, "core"))
    if hot.isEmpty():
        return stage(found, "matches")
    pieces = stage(_halves(contents.join(hot, "core", "left_semi")), "pieces")
    inner = _matches(stage(_two_of_each(_shared(pieces)), "contents"), hot_runs)
    strings = [(F.col("skip") + F.col(c)).alias(c) for c in ("one", "two")]
    back = pieces.join(inner, KIND).select(F.col("of_core").alias("core"), F.col("of_run").alias("run"), *strings)
    return stage(found.union(back.distinct()), "matches")


def repeated_strings(docs: DataFrame, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(row, first, last): starts of strings that start elsewhere too, as ranges, for every row of
    `docs`(_doc, _hash, _text)."""
    before = made()
    runs = stage(_shared(_sketch(docs)), "runs")
    matches = _matches(stage(_contents(docs, _two_of_each(runs)), "contents"), hot_runs)
    forget(docs.sparkSession, before, but=("runs", "matches"))
    strings = [(F.col("first") + F.col(c)).alias(n) for c, n in (("one", "first"), ("two", "last"))]
    return runs.join(matches, KIND).select(*ROW, *strings)


def _spans(found: DataFrame) -> DataFrame:
    """Ranges of string starts to the maximal runs of bytes that these strings cover, per row."""
    inside = Window.partitionBy(*ROW).orderBy("first", "last")
    before = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1)) + W.SIZE
    new = F.coalesce((F.col("first") > before).cast("int"), F.lit(0))
    return (
        found.distinct()
        .withColumn("_new", new)
        .withColumn("_run", F.sum("_new").over(inside))
        .groupBy(*ROW, "_run")
        .agg(F.min("first").alias("start"), (F.max("last") + W.SIZE).alias("end"))
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def remove_repeated(docs: DataFrame, text: str = "text", hot_runs: int = HOT_RUNS) -> DataFrame:
    """Add spans, the maximal runs of removed bytes, and kept, the bytes that are left."""
    docs = docs.drop("spans", "kept")
    # The caller's columns travel as one, so that none is taken for one of this module.
    rows = docs.select(
        F.struct("*").alias("_all"),
        F.col("doc_id").cast("long").alias("_doc"),
        F.xxhash64(text).alias("_hash"),
        F.col(text).alias("_text"),
    )
    spans = _spans(repeated_strings(rows.select(*ROW, "_text"), hot_runs))
    octets = F.coalesce(F.col("_text"), F.lit("")).cast("binary")
    n = F.octet_length(octets).cast("long")
    # What lies between the spans, before the first and behind the last.
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(n))
    piece = lambda g: F.substring(octets, (g["s"] + 1).cast("int"), (g["e"] - g["s"]).cast("int"))
    pieces = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    kept = F.aggregate(pieces, F.lit(b""), lambda done, g: F.concat(done, piece(g)))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = rows.alias("x").join(spans.alias("y"), _same_row("x", "y"), "left")
    made_of = joined.select(
        "_all",
        F.coalesce("spans", none).alias("spans"),
        F.when(F.col("spans").isNull(), octets).otherwise(kept).alias("kept"),
    )
    return made_of.select("_all.*", "spans", "kept")


def op5_suffix_levels(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeated(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
