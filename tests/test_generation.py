import pytest
from pairprep import constants as C
from pairprep.functions.text import build_training_text
from pairprep.operators.evaluation import eval_records, sample_count, sample_prompts
from pairprep.operators.generation import generate_batch, generation_results, split_diff_by_file
from pairprep.operators.tokenizing import tokenize_pairs
from pairprep.operators.vocabulary import build_vocab
from pyspark.sql import functions as F


def factory():
    def generate(prompts, mark="!"):
        return [p + f" \n{p.count('x')} x{mark} " for p in prompts]

    return generate


def test_generate_batch(spark):
    rows = [(i, "x " * i if i else "") for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, "pair_id int, diff string")
    got = {r.pair_id: r for r in generate_batch(df, factory, max_length=50, batch_size=7, mark="?").collect()}
    assert set(got) == set(range(1, 40))
    for i, row in got.items():
        assert row.prompt == "x " * i + C.SEPARATOR
        assert row.commit_message == f"{min(i, 25)} x?"
        assert row.generation_time >= 0
        assert row.truncated_diff == row.diff
    assert generation_results(generate_batch(df, factory)).columns == [
        "diff",
        "commit_message",
        "prompt",
        "generation_time",
        "truncated_diff",
    ]


def test_eval_records(spark):
    pairs = spark.createDataFrame(
        [(1, "test", "+ a b", "Add b now"), (2, "test", "q " * 40, "Never seen"), (3, "test", "+ c", "Add c")],
        "pair_id int, split string, diff string, message string",
    )
    vocab = build_vocab(pairs, 1000, build_training_text("diff", "message", eos=""))
    samples = tokenize_pairs(pairs, vocab, max_length=40)
    prompts = sample_prompts(samples, vocab)
    answers = prompts.where("pair_id <> 3").select("pair_id", F.concat("prompt", F.lit("  Said so\n")).alias("generated"))
    records = eval_records(prompts, answers)
    assert [tuple(r) for r in records.collect()] == [(1, "+ a b" + C.SEPARATOR, "Said so", "Add b now")]
    assert sample_count(records).first().n_samples == 1


def test_a_filter_sees_what_the_model_said(spark):
    """A model that answers differently every time is asked once per row."""

    def random_model():
        import random

        return lambda prompts: [p + f"{random.random():.4f}" for p in prompts]

    df = spark.createDataFrame([(i, f"x {i}") for i in range(300)], "pair_id int, diff string")
    high = generate_batch(df, random_model).where(F.col("commit_message") > "0.5")
    assert high._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    said = [r.commit_message for r in high.collect()]
    assert 80 < len(said) < 220 and min(said) > "0.5"


def test_split_diff_by_file(spark):
    one, two = "diff --git a/x b/x\n+1\n", "diff --git a/y b/y\n+ diff --git no header"
    rows = [(1, one + two), (2, "before\n" + one), (3, "plain"), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "pair_id int, diff string")
    got = sorted(tuple(r) for r in split_diff_by_file(df).collect())
    assert got == [(1, 0, one), (1, 1, two), (2, 0, "before\n"), (2, 1, one), (3, 0, "plain")]


def test_a_model_stage_of_its_own_says_the_same(spark):
    from pairprep.operators import generation as G
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    rows = [(i, f"+line {i}\n", [i], {"k": None}) for i in range(40)] + [(40, None, None, None), (41, "", [], {})]
    df = spark.createDataFrame(rows, "pair_id long, diff string, more array<int>, kept map<string,string>").repartition(3)

    def factory():
        return lambda prompts, ending="": [f"{p} said {len(p)} of {len(prompts) > 0}{ending}" for p in prompts]

    sent = df.where("diff <> ''").selectExpr("*", "concat(diff, '?') AS _sent")
    names = ["pair_id", "more", "kept", "_sent", "_answer.generated"]
    one = G._answered(sent, factory, 7, {"ending": "!"}).select(names).collect()
    other = G._answered_in_stage(sent, factory, 7, {"ending": "!"}, None).select(names).collect()
    assert sorted(map(str, one)) == sorted(map(str, other)) and len(one) == 40
    gpu = ExecutorResourceRequests().resource("gpu", 1)
    profile = ResourceProfileBuilder().require(gpu).require(TaskResourceRequests().resource("gpu", 1)).build
    with pytest.raises(ValueError, match="cluster"):
        G.generate_batch(df, factory, profile=profile)
