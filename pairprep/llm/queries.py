"""Registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairprep.llm.batches import small_batches
from pairprep.llm.chat_schema import OP4_SQL, op4_chat_schema
from pairprep.llm.collocations import OP11_SQL, op11_collocations
from pairprep.llm.line_runs import OP12_SQL, op12_line_runs
from pairprep.llm.packing import op1_packing
from pairprep.llm.pii_boost import op9_pii_boost
from pairprep.llm.quality_fm import op2_quality_fm
from pairprep.llm.rule_cascade import OP6_SQL, op6_rule_cascade
from pairprep.llm.secret_dfa import op3_secret_dfa
from pairprep.llm.simhash_bytes import op10_simhash_bytes
from pairprep.llm.suffix_levels import op5_suffix_levels
from pairprep.llm.whitening import op13_whitening
from pairprep.llm.wu_manber import OP8_SQL, op8_wu_manber
from pairprep.llm.zip_warc import OP7_SQL, op7_zip_warc

Query = Callable[[SparkSession, str], DataFrame]

OPERATORS = (
    op1_packing,
    op2_quality_fm,
    op3_secret_dfa,
    op4_chat_schema,
    op5_suffix_levels,
    op6_rule_cascade,
    op7_zip_warc,
    op8_wu_manber,
    op9_pii_boost,
    op10_simhash_bytes,
    op11_collocations,
    op12_line_runs,
    op13_whitening,
)


def _in_small_batches(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {q.__name__: _in_small_batches(q) for q in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_chat_schema": OP4_SQL,
        "op6_rule_cascade": OP6_SQL,
        "op7_zip_warc": OP7_SQL,
        "op8_wu_manber": OP8_SQL,
        "op11_collocations": OP11_SQL,
        "op12_line_runs": OP12_SQL,
    }
