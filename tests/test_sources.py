import json

import pytest
from pairprep.plans.prepare import load_or_tokenize
from pairprep.sources import pairs as P
from pairprep.sources import predictions as O
from pairprep.sources import scratch
from pairprep.sources import token_cache as TC
from pyspark.sql import functions as F

DIFF = "+" + "x y " * 20


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [
        (i, DIFF + str(i), f"Add the feature {i}", ("train", "validation", "test")[min(i % 4, 2)]) for i in range(40)
    ]
    return spark.createDataFrame(rows, "pair_id long, diff string, message string, split string")


def test_save_and_load_pairs(spark, pairs, tmp_path):
    path = str(tmp_path / "pairs")
    P.save_pairs(pairs, path)
    assert (tmp_path / "pairs" / "split=train").is_dir()
    back = P.load_pairs(spark, path)
    assert sorted(back.select(*pairs.columns).collect()) == sorted(pairs.collect())
    pruned = back.where("split = 'test'").select("pair_id")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "ReadSchema: struct<pair_id:bigint>" in plan
    typed = P.load_pairs(spark, path, schema="pair_id long, split string")
    assert set(typed.columns) == {"pair_id", "split"}
    with pytest.raises(ValueError):
        P.load_pairs(spark, path + "/split=train")


def test_split_inventory(pairs):
    got = {r.split: (r.n_rows, r.columns) for r in P.split_inventory(pairs).collect()}
    names = "pair_id,diff,message"
    assert got == {"train": (10, names), "validation": (10, names), "test": (20, names)}


def test_read_patches(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    files = {"a.patch": "diff --git é\n+x\r\n", "deep/b.patch": "", "deep/c.patch": "one line"}
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    got = {r.path.split("/")[-1]: r.diff for r in P.read_patches(spark, str(tmp_path)).collect()}
    assert got == {name.split("/")[-1]: text for name, text in files.items() if text}


def test_predictions(spark, tmp_path):
    rows = [("One\nTwo\\n\r", 0.5, "d")]
    df = spark.createDataFrame(rows, "commit_message string, generation_time double, diff string")
    for with_diff, keys in ((False, 2), (True, 3)):
        path = tmp_path / f"json{with_diff}"
        O.write_predictions_json(df, str(path), with_diff)
        (line,) = [x for f in path.glob("part-*") for x in f.read_text().splitlines()]
        assert len(json.loads(line)) == keys and json.loads(line)["commit_message"] == rows[0][0]
    O.write_predictions_text(df, str(tmp_path / "text"))
    assert [r.value for r in spark.read.text(str(tmp_path / "text")).collect()] == ["One\\nTwo\\\\n\\r"]


def test_token_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    digest = TC.fingerprint(a=1)
    assert TC.load_token_cache(spark, path, digest) is None
    rows = [(1, "train", [1]), (2, "test", [2])]
    df = spark.createDataFrame(rows, "pair_id long, split string, input_ids array<int>")
    TC.save_token_cache(df, path, digest)
    assert TC.load_token_cache(spark, path, digest) is None
    found = TC.load_token_cache(spark, path, digest, ("train", "test"))
    assert sorted(tuple(r) for r in found.select(*df.columns).collect()) == rows
    assert TC.load_token_cache(spark, path, TC.fingerprint(a=2), ("train",)) is None


def test_load_or_tokenize_reuses_only_its_own_settings(spark, pairs, tmp_path):
    path = str(tmp_path / "tokens")
    caps = {"train": 5, "validation": 100, "test": 3}
    made = load_or_tokenize(pairs, path, 50, "pairs", caps=caps)
    assert {r.split: r["count"] for r in made.groupBy("split").count().collect()} == {
        "train": 5,
        "validation": 10,
        "test": 3,
    }
    again = load_or_tokenize(pairs.where("false"), path, 50, "pairs", caps=caps)
    assert again.count() == 18
    with pytest.raises(ValueError):
        load_or_tokenize(pairs.where("false"), path, 51, "pairs", caps=caps)


def test_shared_dir_comes_from_the_session(spark):
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_fingerprint_does_not_depend_on_the_process(tmp_path):
    import subprocess
    import sys

    code = "from pairprep.sources.token_cache import fingerprint as f; print(f(a={'x', 'y', 'z'}, b={'k': (1, 2)}))"
    made = {
        subprocess.run([sys.executable, "-c", code], env={"PYTHONHASHSEED": seed, "PYTHONPATH": ":".join(sys.path)}, capture_output=True, text=True).stdout
        for seed in ("1", "2", "3")
    }
    assert len(made) == 1 and len(made.pop().strip()) == 64
    with pytest.raises(TypeError):
        TC.fingerprint(a=object())


def test_cache_stays_whole_until_the_new_one_is(spark, pairs, tmp_path):
    path = str(tmp_path / "cache")
    TC.save_token_cache(pairs, path, "old")

    broken = pairs.selectExpr("*", "raise_error('stop') AS late")
    with pytest.raises(Exception):
        TC.save_token_cache(broken, path, "new")
    assert TC.load_token_cache(spark, path, "old", ("train",)).count() == pairs.count()
    TC.save_token_cache(pairs.limit(5), path, "new")
    assert TC.load_token_cache(spark, path, "old", ("train",)) is None
    assert len(list((tmp_path / "cache").glob("arrays-*"))) == 1


def test_other_splits_that_share_texts(spark):
    from pairprep.operators.cleaning import reject_breakdown, split_overlap

    rows = [("train", "d\r\n", "m"), ("train", "e", None), ("test", " d", "m"), ("test", "e", ""), ("test", "f", "m"), ("validation", "x", "y")]
    df = spark.createDataFrame(rows, "split string, diff string, message string")
    assert {tuple(r) for r in split_overlap(df).collect()} == {("test", 3, 2), ("validation", 1, 0)}
    assert {tuple(r) for r in split_overlap(df, ("message",)).collect()} == {("test", 3, 3), ("validation", 1, 0)}
    assert {tuple(r) for r in reject_breakdown(df).collect()} == {(s, "diff_short", n) for s, n in (("train", 2), ("test", 3), ("validation", 1))}


def test_token_store_tokenises_new_contents_only(spark, tmp_path):
    from pairprep.sources.token_cache import stored_folders, update_token_store

    schema = "pair_id long, diff string, message string, split string"
    old = [(i, f"+{i} old", f"Message {i}", "train") for i in range(90)]
    new = [(i, f"+{i} new", None if i == 95 else "same", "test") for i in range(90, 100)]
    seen = []

    def tokenize(df):
        seen.append(sorted(r.diff for r in df.collect()))
        ids = F.array(F.length("diff"), F.coalesce(F.length("message"), F.lit(-1)))
        return df.select("content", ids.alias("input_ids"), ids.alias("attention_mask"), ids.alias("labels"))

    def update(rows, digest="a"):
        found = update_token_store(spark.createDataFrame(rows, schema), tokenize, str(tmp_path), digest)
        got = {r.pair_id: (r.split, r.input_ids) for r in found.collect()}
        assert got == {i: (s, [len(d), -1 if m is None else len(m)]) for i, d, m, s in rows}

    update(old)
    update(old + new)
    update([(i + 1000, d, m, "validation") for i, d, m, _ in old + new + old[:5]][:100])
    assert [len(s) for s in seen] == [90, 10, 0] and seen[1] == [f"+{i} new" for i in range(90, 100)]
    assert sorted(n for _, n in stored_folders(spark, str(tmp_path), "a")) == [10, 90]
    update(old[:3], "other settings")
    assert len(seen[-1]) == 3
    # A manifest that was never completed does not count.
    (tmp_path / "a" / "_manifest-000000000002").mkdir()
    update(new + [(200, "+one more", "x", "test")])
    assert len(seen[-1]) == 1
    update([])
    assert update_token_store(spark.createDataFrame([], schema), tokenize, str(tmp_path / "none"), "a").count() == 0
