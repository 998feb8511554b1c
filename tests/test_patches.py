import gzip
import random
import re

import pytest
from pairprep.operators.cleaning import clean_pairs, clean_pairs_counted, retention_of, retention_report
from pairprep.plans import catalog
from pairprep.sources.pairs import read_patches
from pairprep.sources.patches import FILE_NAME, PatchReader, read_patch_sections, sections, write_patches
from pyspark.sql import functions as F


def whole(data):
    """(offset, section) by one look at all bytes."""
    cuts = [0] + [m.start() + 1 for m in re.finditer(rb"\n(?=diff --git )", data)] + [len(data)]
    return [(a, data[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def made(rnd):
    parts = ["diff --git a/f b/f\n", "\n", "+x\n", "diff --git", " diff --git a\n", "é字\n", "-" * 40 + "\n", "diff --git \n"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))).encode()


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_ranges_make_the_sections_of_the_whole_file(block):
    rnd = random.Random(block)
    for _ in range(60):
        data = made(rnd)
        split = rnd.choice([1, 2, 5, 13, 50, 10_000])
        reads = []

        def read(at, n):
            reads.append(n)
            return data[at : at + n]

        got = [
            s for at in range(0, len(data), split)
            for s in sections(read, len(data), at, min(at + split, len(data)), block)
        ]
        assert got == whole(data)
        assert max(reads) <= block


def test_a_file_that_got_shorter_is_an_error():
    with pytest.raises(OSError):
        list(sections(lambda at, n: b"", 10, 0, 10))


def test_files_of_several_splits_are_read_by_several_tasks(spark, tmp_path):
    rnd = random.Random(3)
    files = {f"sub{i % 2}/p{i}.diff": b"".join(made(rnd) for _ in range(60)) for i in range(4)}
    files |= {"empty.diff": b"", "_hidden": b"diff --git x\n", "bytes.diff": b"diff --git \xff\n"}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    df = read_patch_sections(spark, str(tmp_path), 500)
    rows = df.selectExpr("*", "spark_partition_id() AS task").collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.path, r.position)):
        got.setdefault(r.path.removeprefix(f"{tmp_path}/"), []).append((r.position, r.diff))
    wanted = {n: [(at, s.decode("utf-8", "replace")) for at, s in whole(d)] for n, d in files.items() if d and n[0] != "_"}
    assert got == wanted
    assert len({r.task for r in rows}) >= 4
    whole_text = spark.read.text(str(tmp_path / "sub0"), wholetext=True).collect()
    joined = {"".join(s for _, s in got[n]) for n in got if n.startswith("sub0/")}
    assert {r.value for r in whole_text} == joined


def test_dealing(tmp_path):
    (tmp_path / "large").write_bytes(b"x" * 1_000_000)
    for i in range(50):
        (tmp_path / f"small{i}").write_bytes(b"y")
    def tasks(n):
        return PatchReader({"path": f"file://{tmp_path}", "splitBytes": "300000", "tasks": str(n)}).partitions()

    for n in (1, 3, 100):
        ranges = [r for t in tasks(n) for r in t.ranges]
        assert len(ranges) == 4 + 50 and sum(r.end - r.start for r in ranges) == 1_000_050
    assert len(tasks(1)) == 1 and len(tasks(3)) in (3, 4)
    # With tasks enough every large range is one's own, and small files still go together.
    many = tasks(100)
    assert sum(any("large" in r.path for r in t.ranges) for t in many) == 4
    assert max(len(t.ranges) for t in many) > 3
    with pytest.raises(ValueError):
        PatchReader({"path": str(tmp_path), "splitBytes": "0"})


def test_an_empty_folder_has_no_sections(spark, tmp_path):
    assert read_patch_sections(spark, str(tmp_path)).count() == 0


def test_cleaning_counts_what_it_keeps_in_its_own_pass(spark, tmp_path):
    rows = [(i, "+" + "x" * (i % 80), f"Add the {i}\r\n" if i % 3 else "fix", ("train", "test")[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows + [(500, None, None, "train"), (501, "+", "x", "other")], "pair_id long, diff string, message string, split string")
    df.repartition(3).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    cleaned, counted = clean_pairs_counted(raw)
    assert sorted(cleaned.collect()) == sorted(clean_pairs(raw).collect())
    report = retention_of(spark, counted)
    assert sorted(report.collect()) == sorted(retention_report(raw).where("split <> 'other'").collect())
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("CollectMetrics") == 1


def test_written_patches_come_back_by_their_key(spark, tmp_path):
    texts = {1: "diff --git a\n+é", -2: "", 3: None, 4: "a\r\nb\n\ndiff --git c\n"}
    rows = spark.createDataFrame(list(texts.items()), "pair_id long, diff string").repartition(3)
    write_patches(rows, str(tmp_path))
    name = F.regexp_extract("path", FILE_NAME, 1).cast("long")
    got = {}
    for r in sorted(read_patch_sections(spark, str(tmp_path), 3).withColumn("key", name).collect(), key=lambda r: (r.path, r.position)):
        got[r.key] = got.get(r.key, "") + r.diff
    assert got == {k: t + "\n" for k, t in texts.items() if t is not None}
    again = {r.key: r.diff for r in read_patches(spark, str(tmp_path)).withColumn("key", name).collect()}
    assert again == got


@pytest.mark.parametrize("query", [catalog.read_patches, catalog.read_patch_sections])
def test_files_share_their_folders(spark, tmp_path, query, monkeypatch):
    monkeypatch.setattr(catalog.scratch, "fresh_path", lambda spark, name: f"{tmp_path}/{name}")
    spark.range(300).selectExpr("id AS doc_id", "concat('text ', id) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    assert query(spark, str(tmp_path)).count() >= 250
    folders = [p for p in tmp_path.glob("patch*/**/") if p.is_dir()]
    assert 2 <= len(folders) <= 2 + 8


def as_spark_reads(spark, path):
    rows = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return sorted(rows.select("_metadata.file_path", F.hex("value")).collect())


def test_whole_files_are_those_that_spark_reads(spark, tmp_path):
    root = tmp_path / "a dir%41 é"
    names = ["a b.txt", "p%20q.txt", "é\u00a0字#?;[1].txt", "_k=1/z.txt", "sub +x/t&=~'\".txt", "sub +x/_h/n.txt", "_x", ".y"]
    names += ["c._COPYING_", "tab\tq{}|^`<>@,!$*().txt", "100%.txt", "deep/er/_k/_l=2/x", "deep/er/z"]
    for i, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x\xff\xef\xbb\xbf\r\n\x00" * i)
    (root / "no files").mkdir()
    for path in (str(root), f"file://{root}/", f"{root}/deep", f"{root}/no files"):
        got = read_patches(spark, path).select("path", F.hex("diff"))
        assert sorted(got.collect()) == as_spark_reads(spark, path)
    (root / "deep" / "packed.gz").write_bytes(gzip.compress(b"packed"))
    for path in (str(root), f"{root}/deep/er/z", f"{root}/deep/*"):
        assert sorted(read_patches(spark, path).select("path", F.hex("diff")).collect()) == as_spark_reads(spark, path)


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"f{i % 7}").mkdir(exist_ok=True)
        (tmp_path / f"f{i % 7}" / f"{i}.patch").write_text(f"text {i}")
    rows = read_patches(spark, str(tmp_path))
    assert sorted(r.diff for r in rows.collect()) == sorted(f"text {i}" for i in range(300))
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert "FileScan" not in rows._jdf.queryExecution().executedPlan().toString()
