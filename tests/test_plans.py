"""What the headline queries' physical plans must and must not hold."""

import os

import pytest

from tidemark.catalog import QUERIES
from tidemark.sources.tables import table

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the supplied tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str, name: str) -> int:
    return text.count(f"{name}.parquet")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["user_items"](spark, FOLDER))
    assert "PushedFilters" in text and "EqualTo(o_custkey,1)" in text
    line = next(x for x in text.split("\n") if "lineitem.parquet" in x)
    assert "l_comment" not in line and "l_shipdate" not in line


@pytest.mark.parametrize("name", ["rating_pred_join", "mse", "rmse_fixed_n", "baseline_rmse"])
def test_rating_family_joins_the_large_tables_once(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert scans(text, "lineitem") == 0 and scans(text, "orders") == 0  # read when the joined table was written


def test_running_state_reads_events_once(spark):
    text = plan(QUERIES["asof_running_state"](spark, FOLDER))
    assert scans(text, "events") == 0 and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["wordcount", "hashtag_top30", "mutual_friends", "tfidf", "visual_word_histogram"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "partial_" in text
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["sig_zero_crossings", "sig_rms", "wordcount", "topn_titles", "unrated_items"])
def test_no_python_where_built_ins_suffice(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text


def test_top_list_is_a_take_ordered(spark):
    items = table(spark, FOLDER, "part").orderBy("p_partkey").limit(5)
    assert "TakeOrderedAndProject" in plan(items)
