"""Tokenised splits kept on shared storage, reused only for the settings that made them."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.sources.scratch import names, remove

# The leading underscore keeps the record out of the table's own file listing.
_RECORD = "_pairprep_cache"


def _plain(value: object) -> object:
    """Settings as JSON values that do not depend on the process."""
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, set | frozenset):
        return sorted(map(_plain, value), key=repr)
    if isinstance(value, list | tuple):
        return [_plain(v) for v in value]
    if value is None or isinstance(value, str | int | float | bool):
        return value
    raise TypeError(f"a setting of type {type(value).__name__} has no stable form")


def fingerprint(**settings: object) -> str:
    """Digest of the settings that decide the arrays."""
    text = json.dumps(_plain(settings), sort_keys=True)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _record_of(spark: SparkSession, path: str):
    schema = "splits array<string>, digest string, folder string"
    try:
        return spark.read.schema(schema).json(f"{path}/{_RECORD}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_token_cache(df: DataFrame, path: str, settings_digest: str) -> None:
    """Arrays into a folder of their own, then the record that names it: until the record changes
    the old cache is whole and in use. Other arrays, also of a job that failed, go last. One writer
    at a time.

    The record lists the splits the table holds, which is a handful of names.
    """
    spark = df.sparkSession
    folder = f"arrays-{uuid.uuid4().hex}"
    df.write.partitionBy(C.SPLIT).parquet(f"{path}/{folder}")
    record = (
        spark.read.parquet(f"{path}/{folder}")
        .groupBy()
        .agg(F.array_sort(F.collect_set(C.SPLIT)).alias("splits"))
        .withColumns({"digest": F.lit(settings_digest), "folder": F.lit(folder)})
    )
    record.write.mode("overwrite").json(f"{path}/{_RECORD}")
    for name in names(spark, path):
        if name.startswith("arrays-") and name != folder:
            remove(spark, f"{path}/{name}")


def load_token_cache(
    spark: SparkSession,
    path: str,
    settings_digest: str,
    splits: tuple[str, ...] = C.SPLITS,
) -> DataFrame | None:
    """The cached table, or None unless it is there, complete and made with these settings."""
    found = _record_of(spark, path)
    if found is None or found.digest != settings_digest or not set(splits) <= set(found.splits or ()):
        return None
    return spark.read.parquet(f"{path}/{found.folder}")


# A store of tokenised contents. Every update leaves one more manifest, which names all folders with
# arrays; it counts once Spark has marked it complete, so a reader sees the store before an update or
# after it.
_MANIFEST = "_manifest-"
_CONTENT = "content"
_ARRAYS = ("input_ids", "attention_mask", "labels")


def content_digest(*texts: str) -> Column:
    """Digest of a row's texts; a missing one differs from an empty one."""
    return F.sha2(F.to_json(F.struct(*texts)), 256)


def _manifests(spark: SparkSession, root: str) -> list[str]:
    try:
        found = sorted(n for n in names(spark, root) if n.startswith(_MANIFEST))
    except Py4JJavaError as error:
        if "FileNotFoundException" not in str(error.java_exception):
            raise
        return []
    return [n for n in found if "_SUCCESS" in names(spark, f"{root}/{n}")]


def stored_folders(spark: SparkSession, path: str, settings_digest: str) -> list[tuple[str, int]]:
    """(folder, contents) of every update that the newest manifest names."""
    root = f"{path}/{settings_digest}"
    manifests = _manifests(spark, root)
    if not manifests:
        return []
    rows = spark.read.schema("folder string, n long").json(f"{root}/{manifests[-1]}").collect()
    return sorted((f"{root}/{r.folder}", r.n) for r in rows)


def _stored(spark: SparkSession, folders: list[tuple[str, int]]) -> DataFrame | None:
    return spark.read.parquet(*[f for f, _ in folders]) if folders else None


def update_token_store(
    df: DataFrame,
    tokenize: Callable[[DataFrame], DataFrame],
    path: str,
    settings_digest: str,
    texts: tuple[str, ...] = (C.DIFF, C.MESSAGE),
    key: str = C.KEY,
    split: str = C.SPLIT,
) -> DataFrame:
    """The tokenised rows of df, of which only those are tokenised whose texts the store does not hold.

    tokenize gets one row of each new content, with the digest as the column `content` next to the
    texts, and returns that column with the arrays; a content is stored once, however many rows have
    it. The arrays are written to a folder of their own, then one more manifest names it: a job that
    fails leaves nothing that counts. Rows are addressed by content, so the texts of other rows,
    their keys and splits may change. One writer at a time.
    """
    spark = df.sparkSession
    root = f"{path}/{settings_digest}"
    folders = stored_folders(spark, path, settings_digest)
    known = _stored(spark, folders)
    wanted = df.withColumn(_CONTENT, content_digest(*texts))
    fresh = wanted.select(_CONTENT, *texts)
    if known is not None:
        fresh = fresh.join(known.select(_CONTENT), _CONTENT, "left_anti")
    folder = f"arrays-{uuid.uuid4().hex}"
    tokenize(fresh.dropDuplicates([_CONTENT])).select(_CONTENT, *_ARRAYS).write.parquet(f"{root}/{folder}")
    made = spark.read.parquet(f"{root}/{folder}").count()
    if made:
        manifests = _manifests(spark, root)
        number = int(manifests[-1].removeprefix(_MANIFEST)) + 1 if manifests else 0
        entries = [(f.rpartition("/")[2], n) for f, n in folders] + [(folder, made)]
        manifest = spark.createDataFrame(entries, "folder string, n long").coalesce(1)
        # A manifest of this number can only be one that was never completed.
        manifest.write.mode("overwrite").json(f"{root}/{_MANIFEST}{number:012d}")
        folders = stored_folders(spark, path, settings_digest)
    else:
        remove(spark, f"{root}/{folder}")
    known = _stored(spark, folders)
    if known is None:
        known = spark.createDataFrame([], f"{_CONTENT} string, " + ", ".join(f"{a} array<int>" for a in _ARRAYS))
    return wanted.select(key, split, _CONTENT).join(known, _CONTENT).drop(_CONTENT)
