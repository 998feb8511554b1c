"""Registered queries: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairprep import constants as C
from pairprep.functions import metrics, rules, text, tokens
from pairprep.operators import batching, chat, cleaning, columns, evaluation, generation, runlog
from pairprep.operators.sampling import cap_splits, eval_sample
from pairprep.operators.subwords import decode_subwords, encode_subwords, tokenize_pairs_subwords
from pairprep.operators.tokenizing import token_stats, tokenize_pairs, tokenize_pairs_with
from pairprep.operators.vocabulary import build_vocab, decode, encode
from pairprep.plans import views
from pairprep.plans.prepare import get_splits
from pairprep.sources import pairs as pair_source
from pairprep.sources import patches, predictions, scratch, token_cache
from pairprep.streaming.cleaning import clean_pairs_stream, write_pairs_stream
from pairprep.streaming.runlog import early_stop_stream, latest_states

Query = Callable[[SparkSession, str], DataFrame]

CAPS = {"train": 100, "validation": 20, "test": 40}
VOCAB_SIZE = 2000
SAMPLED = 20
THIN_EVERY = 900
THRESHOLD = 0.25
SMALL_BLOCK = 40_000
PATCH_RANGE = 1000
SUBWORDS = "byte_bpe_50k.json"
WHOLE = 1 << 30


def _csv(col: Column | str) -> Column:
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


def _rows_csv(col: str) -> Column:
    lines = F.transform(col, lambda r: F.array_join(F.transform(r, lambda x: x.cast("string")), ","))
    return F.array_join(lines, ";")


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = views.clean(spark, sf_dir).where(F.col(C.SPLIT) == "train")
    whole = text.build_training_text(C.DIFF, C.MESSAGE, eos="")
    return scratch.stage(build_vocab(train, VOCAB_SIZE, whole), "vocabulary")


def _tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_pairs(views.clean(spark, sf_dir), _vocab(spark, sf_dir))


def _token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokenised pairs as a stored table, for what reads them more than once."""
    return scratch.stage(_tokenized(spark, sf_dir), "tokens")


def _printable(tokenized: DataFrame) -> DataFrame:
    return tokenized.select(
        C.KEY, C.SPLIT, *[_csv(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


def _on(table: Query, columns_of: Callable[[], dict[str, Column]], key: str = C.KEY) -> Query:
    """A projection of a whole table; Columns are made only once a session is there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir)
        return rows.select(key, *[c.alias(n) for n, c in columns_of().items()])

    return query


def _on_both_texts(function: Callable[[str], Column], name: str) -> Query:
    return _on(views.pairs, lambda: {name.format(c): function(c) for c in (C.DIFF, C.MESSAGE)})


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.preprocess_pair(views.pairs(spark, sf_dir))


# sources and sinks


def load_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "pairs")
    pair_source.save_pairs(views.pairs(spark, sf_dir), path)
    return pair_source.load_pairs(spark, path).select(C.KEY, C.DIFF, C.MESSAGE, C.SPLIT)


def split_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_source.split_inventory(views.pairs(spark, sf_dir))


def token_cache_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "token-cache")
    digest = token_cache.fingerprint(vocab_size=VOCAB_SIZE, max_length=C.MAX_LENGTH)
    token_cache.save_token_cache(_tokenized(spark, sf_dir), path, digest)
    cached = token_cache.load_token_cache(spark, path, digest)
    if cached is None:
        raise RuntimeError("the token cache just written was not accepted")
    return _printable(cached)


def token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train rows first, then all: the second update tokenises what the first has not."""
    path, vocab = scratch.fresh_path(spark, "token-store"), _vocab(spark, sf_dir)
    digest = token_cache.fingerprint(vocab_size=VOCAB_SIZE, max_length=C.MAX_LENGTH)
    pairs = views.clean(spark, sf_dir)
    tokenize = lambda rows: tokenize_pairs(rows, vocab, key="content")
    token_cache.update_token_store(pairs.where(F.col(C.SPLIT) == "train"), tokenize, path, digest)
    return _printable(token_cache.update_token_store(pairs, tokenize, path, digest))


def predictions_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "predictions-json")
    rows = views.predictions(spark, sf_dir).withColumn(
        "commit_message", text.extract_completion("generated", "prompt")
    )
    predictions.write_predictions_json(rows, path, with_diff=True)
    return spark.read.schema("commit_message string, generation_time double, diff string").json(path)


def predictions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole raw diffs as messages, since they bring every kind of line end."""
    path = scratch.fresh_path(spark, "predictions-text")
    rows = views.pairs(spark, sf_dir).select(text.text_or_empty(C.DIFF).alias("commit_message"))
    predictions.write_predictions_text(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# text scalars


def extract_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.predictions(spark, sf_dir)
    return rows.select(C.KEY, text.extract_completion("generated", "prompt").alias("commit_message"))


def strip_special_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.texts_with_specials(spark, sf_dir)
    return rows.select("doc_id", text.strip_special_tokens("text").alias("text"))


def diff_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.pairs(spark, sf_dir).select(C.KEY, text.diff_signals(C.DIFF).alias("s"))
    return rows.select(C.KEY, "s.*")


# filters


def clean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.clean(spark, sf_dir)


def has_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pairs(spark, sf_dir).where(rules.has_input(C.MESSAGE)).select(C.KEY, C.MESSAGE)


# schema inference


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pairs(spark, sf_dir).select(C.KEY, C.DIFF, C.MESSAGE)


def score_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = columns.score_text_columns(_candidates(spark, sf_dir))
    shown = F.transform(
        "scores", lambda s: F.concat_ws(":", s["name"], s["diff_score"], s["msg_score"])
    )
    return scored.select(C.KEY, F.array_join(shown, ",").alias("scores"))


def choose_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = columns.score_text_columns(_candidates(spark, sf_dir))
    return scored.select(C.KEY, columns.choose_columns("scores").alias("c")).select(C.KEY, "c.*")


def infer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.inferred_columns(views.pairs(spark, sf_dir))


def summed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.summed_columns(views.pairs(spark, sf_dir))


# aggregations


def reject_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.reject_breakdown(views.pairs(spark, sf_dir))


def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On messages, of which most are shared by very many rows."""
    return cleaning.split_overlap(views.pairs(spark, sf_dir), (C.MESSAGE,))


def token_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_stats(_tokenized(spark, sf_dir))


def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.retention_report(views.pairs(spark, sf_dir))


def clean_pairs_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the very pass that writes the cleaned pairs."""
    cleaned, counted = cleaning.clean_pairs_counted(views.pairs(spark, sf_dir))
    scratch.stage(cleaned, "cleaned")
    return cleaning.retention_of(spark, counted)


def total_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.total_size(views.clean(spark, sf_dir))


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = runlog.eval_summary(views.row_losses(spark, sf_dir))
    return summary.select(
        C.SPLIT, F.round("loss", 9).alias("loss"), F.round("perplexity", 6).alias("perplexity")
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = runlog.run_summary(views.run_log(spark, sf_dir))
    return summary.withColumn("samples_per_second", F.round("samples_per_second", 9))


def sample_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.sample_count(_tokenized(spark, sf_dir).where(tokens.has_target("labels")))


# sampling


def cap_splits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_splits(scratch.stage(views.clean(spark, sf_dir), "cleaned"), CAPS)


def get_splits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return get_splits(views.pairs(spark, sf_dir), CAPS)


def eval_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = _token_table(spark, sf_dir).where(F.col(C.SPLIT) == "test")
    return eval_sample(test, SAMPLED).select(C.KEY, C.SPLIT)


# token arrays


def split_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = views.documents(spark, sf_dir).withColumn("t", text.split_tokens("text"))
    return cut.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", "|").alias("tokens")
    )


def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = tokens.truncate(text.split_tokens("text"))
    return views.documents(spark, sf_dir).select("doc_id", F.array_join(first, "|").alias("tokens"))


def target_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokenized(spark, sf_dir).select(
        C.KEY,
        _csv(tokens.prompt_ids("input_ids", "labels")).alias("prompt_ids"),
        _csv(tokens.target_ids("labels")).alias("target_ids"),
    )


def encode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir)
    coded = encode(docs, _vocab(spark, sf_dir), "text", max_length=None)
    return coded.select("doc_id", _csv("ids").alias("ids"))


def decode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    rows = tokenize_pairs(views.clean(spark, sf_dir), vocab)
    return decode(rows, vocab, "input_ids").select(C.KEY, "text")


def tokenize_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printable(_tokenized(spark, sf_dir))


def _unicode_tokenizer() -> Callable[[list[str]], list[list[int]]]:
    """A stand-in for a plugged tokenizer: the code points."""
    return lambda texts: [[ord(c) for c in t] for t in texts]


def tokenize_pairs_with_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printable(tokenize_pairs_with(views.clean(spark, sf_dir), lambda: _unicode_tokenizer()))


def _subwords() -> str:
    import public_tokenizers

    return public_tokenizers.path(SUBWORDS)


def subword_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to sub-word ids and back."""
    coded = encode_subwords(views.documents(spark, sf_dir), _subwords(), "text", max_length=None)
    return decode_subwords(coded.drop("text"), _subwords(), "ids").select("doc_id", "text")


def subword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What prompt and target of every sub-word row say, nothing cut."""
    rows = tokenize_pairs_subwords(views.clean(spark, sf_dir), _subwords(), max_length=WHOLE)
    said = decode_subwords(rows.withColumn("p", tokens.prompt_ids("input_ids", "labels")), _subwords(), "p", "prompt")
    said = decode_subwords(said.withColumn("t", tokens.target_ids("labels")), _subwords(), "t", "target")
    return said.select(C.KEY, C.SPLIT, "prompt", "target")


def encode_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a vocabulary that takes several blocks."""
    docs = views.documents(spark, sf_dir)
    coded = encode(docs, _vocab(spark, sf_dir), "text", "text", max_length=None, block_bytes=SMALL_BLOCK)
    return coded.select("doc_id", _csv("text").alias("ids"))


def decode_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    rows = tokenize_pairs(views.clean(spark, sf_dir), vocab, block_bytes=SMALL_BLOCK)
    return decode(rows, vocab, "input_ids", block_bytes=SMALL_BLOCK).select(C.KEY, "text")


def length_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = batching.plan_batches(_token_table(spark, sf_dir))
    return planned.select(C.KEY, "megabatch", "batch_id", "batch_pos")


def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = batching.pad_batches(batching.length_batches(_token_table(spark, sf_dir)))
    return padded.select(
        "batch_id",
        "width",
        _csv("pair_ids").alias("pair_ids"),
        *[_rows_csv(c).alias(c) for c in ("input_ids", "attention_mask", "labels")],
    )


def padding_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.padding_waste(batching.pad_batches(batching.length_batches(_token_table(spark, sf_dir))))


def step_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = batching.step_plan(batching.plan_batches(_token_table(spark, sf_dir)))
    return planned.select(C.KEY, "micro_batch", "optimizer_step")


# metrics and run logs


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.run_log(spark, sf_dir).select(
        "run_id", "step", F.round(metrics.perplexity("eval_loss"), 9).alias("perplexity")
    )


def run_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runlog.run_perplexity(views.run_losses(spark, sf_dir))
    return rows.withColumns({c: F.round(c, 9) for c in ("val_perplexity", "test_perplexity")})


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.early_stop(views.run_log(spark, sf_dir))


def early_stop_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.early_stop(views.run_log(spark, sf_dir), threshold=THRESHOLD)


def early_stop_higher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.early_stop(views.run_log(spark, sf_dir), lower_is_better=False)


def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.best_checkpoint(views.run_log(spark, sf_dir))


def thin_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runlog.thin_log(views.run_log(spark, sf_dir), THIN_EVERY)
    return rows.select("run_id", "step", "eval_loss")


def format_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric a row has, one that lands on many rounding ties, and a very large perplexity."""
    large = F.pow(F.lit(2.0), F.col("step") / 300 % 40 + 50) * 3
    scaled = F.create_map(F.lit("scaled"), F.col("step") / F.lit(32768.0), F.lit("perplexity"), large)
    loss = F.create_map(F.lit("eval_loss"), F.col("eval_loss"))
    logs = F.when(F.col("eval_loss").isNull(), scaled).otherwise(F.map_concat(loss, scaled))
    rows = views.run_log(spark, sf_dir).withColumn("logs", logs)
    return runlog.log_lines(rows, THIN_EVERY).select("run_id", "step", "line")


# generation, review, chat


def split_diff_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation.split_diff_by_file(views.pairs(spark, sf_dir))


def read_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as a text file of its own and read back by its name."""
    path = scratch.fresh_path(spark, "patches")
    rows = views.documents(spark, sf_dir).where(rules.has_input("text"))
    doubled = F.replace("text", F.lit("\\"), F.lit("\\\\"))
    one_line = F.replace(doubled, F.lit("\n"), F.lit("\\n"))
    patches.write_patches(rows.withColumn("text", one_line), path, "doc_id", "text")
    found = pair_source.read_patches(spark, path)
    name = F.regexp_extract("path", patches.FILE_NAME, 1).cast("long")
    return found.select(name.alias("doc_id"), F.btrim(C.DIFF, F.lit("\n")).alias(C.DIFF))


def read_patch_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every diff written as a file of its own and read back in ranges that are shorter than most."""
    path = scratch.fresh_path(spark, "patch-files")
    rows = views.pairs(spark, sf_dir).where(rules.has_input(C.DIFF))
    patches.write_patches(rows, path)
    found = patches.read_patch_sections(spark, path, PATCH_RANGE)
    name = F.regexp_extract("path", patches.FILE_NAME, 1).cast("long")
    return found.select(name.alias(C.KEY), "position", C.DIFF)


def _factory() -> Callable[[], Callable[..., list[str]]]:
    """A stand-in model that answers from the whole prompt it was sent."""

    def factory() -> Callable[..., list[str]]:
        def generate(prompts: list[str], ending: str = "") -> list[str]:
            return [f"{p}  Update {len(p)} characters{ending}" for p in prompts]

        return generate

    return factory


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation.generate_batch(views.clean(spark, sf_dir), _factory(), ending="\n")


def generate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir).select(C.KEY, "prompt", "commit_message", "truncated_diff")


def generation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generation.generation_results(_generated(spark, sf_dir))
    return rows.withColumn("timed", F.col("generation_time") >= 0).drop("generation_time")


def eval_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    rows = tokenize_pairs(views.clean(spark, sf_dir), vocab)
    prompts = scratch.stage(evaluation.sample_prompts(scratch.stage(rows, "tokens"), vocab), "prompts")
    said = F.concat(F.lit("  Update "), F.length("prompt").cast("string"), F.lit(" characters\n"))
    return evaluation.eval_records(prompts, prompts.select(C.KEY, F.concat("prompt", said).alias("generated")))


def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(views.read(spark, sf_dir, "conversations"))


def render_chat_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(views.read(spark, sf_dir, "conversations"), add_generation_prompt=True)


def render_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chat(views.tool_conversations(spark, sf_dir), tools=views.TOOLS, calls="tool_calls")


# streaming


def clean_pairs_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "cleaned-stream")
    schema = views.read(spark, sf_dir, "documents").schema
    # A glob, since a streaming source takes a plain path for a folder and the table may be one file.
    documents = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{documents.parquet}}")
    cleaned = clean_pairs_stream(views.pairs_of(documents))
    write_pairs_stream(cleaned, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(path).select(*cleaned.columns)


def early_stop_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in three parts by step, each a trigger that continues the state of the one before."""
    source, path = scratch.fresh_path(spark, "run-log"), scratch.fresh_path(spark, "stops-stream")
    log = scratch.stage(views.run_log(spark, sf_dir).select("run_id", "step", "eval_loss"), "run-log")
    edge = log.agg(F.max("step")).first()[0] or 0
    for part in range(3):
        inside = (F.col("step") > edge * part // 3) & (F.col("step") <= edge * (part + 1) // 3)
        log.where(inside).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        early_stop_stream(stream, path, f"{path}-checkpoint").awaitTermination()
    return latest_states(spark, path).drop("last_step", "late_rows")


def queries() -> dict[str, Query]:
    message, diff = C.MESSAGE, C.DIFF
    return {
        "load_pairs": load_pairs,
        "split_inventory": split_inventory,
        "token_cache": token_cache_query,
        "token_store": token_store,
        "predictions_json": predictions_json,
        "predictions_text": predictions_text,
        "normalize_newlines": _on_both_texts(text.normalize_newlines, "{}"),
        "preprocess_pair": _normalized,
        "looks_like_diff": _on_both_texts(text.looks_like_diff, "{}_is_diff"),
        "diff_signals": diff_signals,
        "looks_like_message": _on_both_texts(text.looks_like_message, "{}_is_message"),
        "word_count": _on(views.documents, lambda: dict(n_words=text.word_count("text")), "doc_id"),
        "preview": _on(views.documents, lambda: dict(preview=text.preview("text")), "doc_id"),
        "build_prompt": _on(views.clean, lambda: dict(prompt=text.build_prompt(diff))),
        "build_training_text": _on(
            views.clean, lambda: dict(text=text.build_training_text(diff, message))
        ),
        "extract_completion": extract_completion,
        "strip_special_tokens": strip_special_tokens,
        "is_bad_message": _on(
            _normalized, lambda: dict(is_bad=rules.is_bad_message(message, normalized=True))
        ),
        "reject_reason": _on(
            _normalized,
            lambda: dict(split=F.col(C.SPLIT), reason=rules.reject_reason(diff, message, normalized=True)),
        ),
        "in_stoplist": _on(_normalized, lambda: dict(hit=rules.in_stoplist(message))),
        "too_few_chars": _on(_normalized, lambda: dict(hit=rules.too_few_chars(message))),
        "too_few_words": _on(_normalized, lambda: dict(hit=rules.too_few_words(message))),
        "is_reference_only": _on(_normalized, lambda: dict(hit=rules.is_reference_only(message))),
        "has_placeholder": _on(_normalized, lambda: dict(hit=rules.has_placeholder(message))),
        "diff_length_ok": _on(_normalized, lambda: dict(hit=rules.diff_length_ok(diff))),
        "keep_pair": _on(_normalized, lambda: dict(hit=rules.keep_pair(diff, message, normalized=True))),
        "clean_pairs": clean_pairs,
        "has_target": _on(_tokenized, lambda: dict(has_target=tokens.has_target("labels"))),
        "has_input": has_input,
        "score_text_columns": score_text_columns,
        "choose_columns": choose_columns,
        "infer_columns": infer_columns,
        "summed_columns": summed_columns,
        "retention_report": retention_report,
        "clean_pairs_counted": clean_pairs_counted,
        "reject_breakdown": reject_breakdown,
        "split_overlap": split_overlap,
        "token_stats": token_stats_query,
        "total_size": total_size,
        "eval_summary": eval_summary,
        "run_summary": run_summary,
        "sample_count": sample_count,
        "cap_splits": cap_splits_query,
        "get_splits": get_splits_query,
        "eval_sample": eval_sample_query,
        "split_tokens": split_tokens,
        "truncate": truncate,
        "build_vocab": _vocab,
        "encode": encode_query,
        "decode": decode_query,
        "subword_round_trip": subword_round_trip,
        "subword_pairs": subword_pairs,
        "encode_blocks": encode_blocks,
        "decode_blocks": decode_blocks,
        "attention_mask": _on(_tokenized, lambda: dict(attention_mask=_csv("attention_mask"))),
        "mask_labels": _on(_tokenized, lambda: dict(labels=_csv("labels"))),
        "prompt_len": _on(_tokenized, lambda: dict(prompt_len=tokens.prompt_len("labels"))),
        "target_ids": target_ids,
        "tokenize_pairs": tokenize_pairs_query,
        "tokenize_pairs_with": tokenize_pairs_with_query,
        "length_batches": length_batches,
        "pad_batches": pad_batches,
        "padding_waste": padding_waste,
        "step_plan": step_plan,
        "perplexity": perplexity,
        "run_perplexity": run_perplexity,
        "early_stop": early_stop,
        "early_stop_threshold": early_stop_threshold,
        "early_stop_higher": early_stop_higher,
        "best_checkpoint": best_checkpoint,
        "thin_log": thin_log,
        "format_log": format_log,
        "split_diff_by_file": split_diff_by_file,
        "read_patches": read_patches,
        "read_patch_sections": read_patch_sections,
        "generate_batch": generate_batch,
        "generation_results": generation_results,
        "eval_records": eval_records,
        "render_chat": render_chat,
        "render_chat_prompt": render_chat_prompt,
        "render_chat_tools": render_chat_tools,
        "clean_pairs_stream": clean_pairs_stream_query,
        "early_stop_stream": early_stop_stream_query,
    }
