"""The registered queries and the pipeline's stages."""

import itertools
import os

import pytest

from tests.compare import compare, duck
from tests.llm.frames import documents, prose, rows
from tidemark.catalog import QUERIES as LIBRARY
from tidemark.llm.queries import QUERIES, SQL

import corpus_pipeline  # isort: skip

FOLDER = "/root/testdata/sf0.001"
HAS_TABLES = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    items = [(0, prose(901, 40)), (1, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_and_drop_what_they_should(spark, folder):
    leak = prose(901, 40)
    english = [(40 + k, prose(400 + k, 80), "aa") for k in range(30)]
    data = [*rows(), *english, (200, prose(1, 30) + ". " + leak + ". " + prose(2, 30), "aa"), (201, english[0][1], "aa")]
    docs = documents(spark, data).select(*corpus_pipeline.COLUMNS)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert not {4, 5, 6, 7} & set(kept["quality"]) and None in kept["quality"]
    assert {40 + k for k in range(30)} <= set(kept["language"])
    last = kept["near_duplicates"]
    assert 201 not in last and 2 not in last and last.count(8) == 1 and {1, 40, 41, 200} <= set(last)
    assert set(last) - set(kept["decontamination"]) == {200}
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert ids.count() == len(kept["decontamination"])


def test_language_stage_drops_only_texts_without_a_language(spark, folder):
    stage = dict(corpus_pipeline.STAGES)["language"]
    data = [(k, prose(k, 60), None) for k in range(5)] + [(6, "12 !!", None)]
    assert stage(spark, documents(spark, data).select(*corpus_pipeline.COLUMNS), folder).count() == 6
    # Many labels on one kind of text: no label gets a high score.
    data = [(k, prose(k, 60), "abcdef"[k % 6]) for k in range(60)] + [(100, "12 !!", "a")]
    kept = stage(spark, documents(spark, data).select(*corpus_pipeline.COLUMNS), folder).collect()
    assert {r["doc_id"] for r in kept} == set(range(60))


def test_stages_take_an_empty_table(spark, folder):
    docs = documents(spark, []).select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


@HAS_TABLES
@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, name):
    import tests.compare as side

    side.QUERIES, side.SQL = {**LIBRARY, **QUERIES}, {**side.SQL, **SQL}
    _, _, problem = compare(spark, duck(FOLDER), name, FOLDER)
    assert problem is None, problem


@HAS_TABLES
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert "doc_id" in found.columns
    if not name.startswith("op5_"):
        assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


@HAS_TABLES
def test_every_operator_has_one_query():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert all(a != b for a, b in itertools.pairwise(sorted(numbers)))
