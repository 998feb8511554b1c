"""The stages on planted cases, and every query of the subpackage against its SQL."""

import pytest

import corpus_pipeline as P
from pairprep.llm import queries as registered
from tests.llm.tables import SMALL_DIR, needs_tables
from tests.oracle_check import compare, connect

NAMES = ["doc_id", "text", "lang", "source", "n_chars", "extra"]


def prose(n, seed):
    return " ".join(f"{'abcdefgh'[(i * seed) % 8]}word{(i * seed * 7919) % 9973}" for i in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, prose(120, i + 1)) for i in range(60)]
    rows += [(100 + i, "### $$$ %%% " * 60) for i in range(20)]
    rows += [(200, rows[3][1]), (201, rows[4][1].upper()), (300, rows[5][1][:60] + " " + prose(40, 999))]
    rows += [(301, prose(90, 500) + " write a.b@c.org"), (None, prose(100, 700)), (302, None), (303, "")]
    full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
    columns = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    spark.createDataFrame(full, columns).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(40, 999))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, function in P.STAGES[:-1]:
        docs = P.stage(function(spark, docs, folder), name)
        assert docs.columns == NAMES
        kept.append({r.doc_id: r.text for r in docs.collect()})
    quality, near, clean, private = kept
    assert not any(100 <= (i or 0) < 120 for i in quality) and set(range(60)) <= set(quality) and None in quality
    assert {200, 201} <= set(quality) and not {200, 201} & set(near) and set(range(60)) <= set(near)
    assert 300 in near and 300 not in clean and set(clean) == set(near) - {300}
    assert set(private) == set(clean) and private[301].endswith("write [EMAIL]")
    pieces = P.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in pieces.collect()} == set(private)


def test_run_reads_the_tables(spark, folder):
    rows = P.run(spark, folder).collect()
    assert sum(r.length for r in rows if r.start == 0) > 0 and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@needs_tables
@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SMALL_DIR), SMALL_DIR, registered.queries()[name], registered.oracle_sql()[name]) is None
