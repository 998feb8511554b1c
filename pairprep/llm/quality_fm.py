"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pair sum is taken in linear
time as half of sum_f (sum_i v_if x_i)**2 - sum_i (v_if x_i)**2. Words are hashed to DIM places and
weighed by their share; structure numbers and the n_chars column follow behind them, so all of them
interact through their factors.

The machine is fitted on at most TRAIN_ROWS labelled rows, those with the smallest hash of their
id; their sparse features are made by Spark and only those reach the driver. Scoring runs over all
rows in Arrow batches. lang, source, doc_id and the labels are never inputs of a score.

Defined results: a null text counts as empty and gets the score of an empty text; a null n_chars
counts as the length of the text; rows with a null or other label than 0 and 1 are not learned
from; repeated rows get equal scores; other columns are kept, one named score is replaced; an empty
table gives no rows, and a fit without labelled rows gives the score 0.5 to all.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 1 << 14
FACTORS = 8
TRAIN_ROWS = 6000
EPOCHS = 12
BATCH = 64
RATE = 0.1
DECAY = 1e-5
SEED = 42
THRESHOLD = 0.3
STRUCTURE = 14
MARKS = b"#*$%&|<>!"


@functools.cache
def _hash_table() -> np.ndarray:
    """A value for each byte at each of 64 places in a word."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, 64 * 256, dtype=np.uint64)


@functools.cache
def _byte_kinds() -> np.ndarray:
    """Rows: blank, upper case, lower case, digit, mark, other ASCII, newline, beyond ASCII."""
    kinds = np.zeros((8, 256), bool)
    code = np.arange(256)
    kinds[0] = (code == 32) | ((code >= 9) & (code <= 13))
    kinds[1] = (code >= 65) & (code <= 90)
    kinds[2] = (code >= 97) & (code <= 122)
    kinds[3] = (code >= 48) & (code <= 57)
    kinds[4, list(MARKS)] = True
    kinds[5] = (code < 128) & ~kinds[:5].any(axis=0)
    kinds[6] = code == 10
    kinds[7] = code >= 128
    return kinds


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text, words first."""
    data = (text or "").encode()
    octets = np.frombuffer(data, np.uint8)
    counts = np.bincount(octets, minlength=256)
    share = (_byte_kinds() @ counts) / max(len(octets), 1)
    words = _word_hashes(octets)
    n = max(len(words), 1)
    places, found = np.unique(words % np.uint64(DIM), return_counts=True)
    values = found / np.sqrt((found.astype(float) ** 2).sum()) if len(found) else found.astype(float)
    letters = share[1] + share[2]
    structure = [
        share[1] / letters if letters else 0.0,
        *share[3:8],
        len(octets) * (1 - share[0]) / n / 20,
        len(np.unique(words)) / n,
        np.count_nonzero(words[1:] == words[:-1]) / n,
        (found.max() / n) if len(found) else 0.0,
        min(share[4] * 10, 3.0),
        np.log1p(len(words)) / 10,
        np.log1p(len(text or "") if n_chars is None else max(n_chars, 0)) / 12,
        1.0 if not len(words) else 0.0,
    ]
    return (
        np.concatenate((places.astype(np.int32), np.arange(DIM, DIM + STRUCTURE, dtype=np.int32))),
        np.concatenate((values, structure)).astype(np.float32),
    )


def _word_hashes(octets: np.ndarray) -> np.ndarray:
    """One hash per word; ASCII letters count as lower case."""
    blank = _byte_kinds()[0][octets]
    inside = np.concatenate(([True], blank, [True]))
    starts = np.flatnonzero(inside[:-1] & ~inside[1:])
    if not len(starts):
        return np.empty(0, np.uint64)
    lower = octets + 32 * _byte_kinds()[1][octets].astype(np.uint8)
    begin = np.zeros(len(octets), np.int64)
    begin[starts] = starts
    place = np.arange(len(octets)) - np.maximum.accumulate(begin)
    values = _hash_table()[(place & 63) * 256 + lower]
    values[blank] = 0
    h = np.add.reduceat(values, starts)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, places: np.ndarray, values: np.ndarray, begin: np.ndarray):
        """Sums per row before the sigmoid, and the factor sums that a gradient needs."""
        scaled = self.factor[places] * values[:, None]
        sums = np.add.reduceat(scaled, begin, axis=0)
        squares = np.add.reduceat(scaled**2, begin, axis=0)
        linear = np.add.reduceat(self.weight[places] * values, begin)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums, scaled

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        places, values, begin = _stacked(rows)
        return 1 / (1 + np.exp(-np.clip(self.raw(places, values, begin)[0].astype(float), -30, 30)))


def _stacked(rows):
    sizes = [len(p) for p, _ in rows]
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    return np.concatenate([p for p, _ in rows]), np.concatenate([v for _, v in rows]), begin


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Logistic loss, one adaptive step size per parameter, fixed seed."""
    rng = np.random.default_rng(SEED)
    size = DIM + STRUCTURE
    machine = Machine(0.0, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32))
    if not rows:
        return machine
    seen = [1e-6, np.full(size, 1e-6, np.float32), np.full((size, FACTORS), 1e-6, np.float32)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            places, values, begin = _stacked([rows[i] for i in part])
            raw, sums, scaled = machine.raw(places, values, begin)
            off = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[part]) / len(part)
            row = np.repeat(np.arange(len(part)), np.diff(np.append(begin, len(places))))
            slope = (off[row] * values).astype(np.float32)
            used, where = np.unique(places, return_inverse=True)
            step = np.zeros(len(used), np.float32)
            np.add.at(step, where, slope)
            turn = np.zeros((len(used), FACTORS), np.float32)
            np.add.at(turn, where, slope[:, None] * (sums[row] - scaled))
            step += DECAY * machine.weight[used]
            turn += DECAY * machine.factor[used]
            seen[0] += float(off.sum()) ** 2
            seen[1][used] += step**2
            seen[2][used] += turn**2
            machine.bias -= RATE * float(off.sum()) / seen[0] ** 0.5
            machine.weight[used] -= RATE * step / np.sqrt(seen[1][used])
            machine.factor[used] -= RATE * turn / np.sqrt(seen[2][used])
    return machine


def _features_udf():
    @F.arrow_udf("places array<int>, values array<float>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import pyarrow as pa

        form = pa.struct([("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])
        for texts, sizes in batches:
            made = [features(t.as_py(), n.as_py()) for t, n in zip(texts, sizes)]
            yield pa.array([{"places": p, "values": v} for p, v in made], form)

    return run


def _inputs(docs: DataFrame, text: str) -> list[Column]:
    size = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length(text).cast("long")
    return [F.col(text), size]


def held_out(doc_id: str = "doc_id") -> Column:
    """One id in five, by the checksum of its digits; never learned from."""
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = TRAIN_ROWS) -> Machine:
    """Fit on labelled rows that are not held out, at most `rows` of them."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` short rows by construction.
    joined = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", *_renamed(_inputs(docs, text)))
    made = joined.withColumn("_x", _features_udf().asNondeterministic()("_text", "_size"))
    table = made.select("doc_id", "quality", "_x.places", "_x.values").toArrow().sort_by("doc_id")
    found = list(zip(_cells(table.column("places")), _cells(table.column("values"))))
    return train(found, np.array(table.column("quality").to_pylist(), np.float32))


def _cells(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Each cell as a view of the column's numbers; as Python objects they take ten times the memory."""
    found = []
    for chunk in column.chunks:
        numbers, ends = chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())
        found += [numbers[a:b] for a, b in zip(np.append(0, ends), ends)]
    return found


def _renamed(inputs: list[Column]) -> list[Column]:
    return [inputs[0].alias("_text"), inputs[1].alias("_size")]


def with_score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Add score, from 0 to 1, to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        for texts, sizes in batches:
            scores = []
            for at in range(0, len(texts), 200):
                made = [
                    features(t.as_py(), n.as_py()) for t, n in zip(texts[at : at + 200], sizes[at : at + 200])
                ]
                scores.append(shared.value.score(made))
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())

    return docs.withColumn("score", run.asNondeterministic()(*_inputs(docs, text)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least THRESHOLD, with their own columns."""
    row = docs.select(F.struct("*").alias("_row"), "text", "n_chars")
    scored = with_score(row, fit(docs, labels))
    return scored.where(F.col("score") >= THRESHOLD).select("_row.*")


def op2_quality_fm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    machine = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return with_score(docs, machine).select("doc_id", held_out().alias("held_out"), "score", predicted)
