"""The physical plans keep to what the README says of them."""

import re

import pytest

from corpus_mt.plans import queries as q
from corpus_mt.operators import translate as tr

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["sentence_rows", "batch_csv_positions", "preprocess", "encode_ids", "binarize", "translate_distinct", "replace_documents", "corpus_bleu", "evaluation_run"],
)
def test_no_cross_join_row_udf_or_global_window(spark, name):
    text = plan(q.QUERIES[name](spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", text)
    if "Window" in text:
        assert "Exchange SinglePartition" not in text


def test_templating_is_narrow_and_prunes_the_scan(spark):
    text = plan(q.sentence_template(spark, FOLDER))
    assert text.count("split(") == 1  # the pieces are computed once, above the scan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text and "PushedFilters: [IsNotNull(text)" in text
    assert text.count("Exchange") == text.count("RoundRobinPartitioning") <= 1


def test_distinct_sentences_use_hash_aggregation(spark):
    text = plan(tr.distinct_sentences(q._sentences(spark, FOLDER)))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_small_vocabulary_needs_no_shuffle(spark):
    text = plan(q.encode_ids(spark, FOLDER))
    assert text.count("Exchange") == text.count("RoundRobinPartitioning")
