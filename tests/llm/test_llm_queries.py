"""The registered queries over whole tables, and the pipeline's stages in turn."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_mt.llm import mixing
from corpus_mt.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"
ROWS = {"op1": "pages", "op2": None, "op3": "pages", "op4": "documents", "op5": "documents", "op6": None, "op7": "documents", "op8": "documents", "op9": "documents", "op10": "documents", "op11": "documents"}


def test_thirteen_queries():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    assert (names, rows) == sql_rows(connect(FOLDER), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_every_row_of_the_table_is_in_the_result(spark, name):
    got = QUERIES[name](spark, FOLDER)
    if table := ROWS[name.split("_")[0]]:
        assert got.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    elif name.startswith("op2"):
        assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    else:
        queries = spark.read.parquet(f"{FOLDER}/embeddings.parquet").filter("vec_id % 20 = 0").count()
        assert got.count() == 20 * queries


@pytest.mark.parametrize("name", ["op5_quality_rules", "op8_source_mixing"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "source_mix", "best_fit_packing"]
    labels, sizes = spark.read.parquet(f"{FOLDER}/labels.parquet"), [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        sizes.append(docs.count())
        if name == "quality_rules":
            bad = labels.filter("quality = 0")  # so few that some look like the rest
            assert docs.join(bad, "doc_id", "left_semi").count() < bad.count()
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.run(spark, FOLDER)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_packed_sequences_follow_the_mix(spark, monkeypatch):
    """Every prefix of the sequences is near the target weights, though the hot source has the longest texts."""
    monkeypatch.setattr(corpus_pipeline, "WINDOW_SLOTS", 4)
    sizes = {"hot": 1800, "a": 700, "b": 500}
    rows = [(k, s, "word " * (90 if s == "hot" else 30)) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    packed = corpus_pipeline.packed(spark, docs, FOLDER).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len({r.doc_id for r in packed}) == len(packed) == 3000
    assert sorted({r.sequence_id for r in packed}) == list(range(max(r.sequence_id for r in packed) + 1))
    used, seen, total = {}, 0, sum(n**0.5 for n in sizes.values())
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset and r.offset + r.length <= 4096
        used[r.sequence_id] = r.offset + r.length
    for n, r in enumerate(sorted(packed, key=lambda r: (r.sequence_id, r.offset))[:1800], 1):
        seen += r.source == "hot"
        assert abs(seen - n * sizes["hot"] ** 0.5 / total) <= (4 + 1) * 32
    assert corpus_pipeline.packed(spark, docs.limit(0), FOLDER).count() == 0


def test_the_pipeline_mixes_every_one_of_many_sources_by_its_weight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 2)
    monkeypatch.setattr(corpus_pipeline, "MIX_POWER", 1.0)
    docs = spark.createDataFrame([(k, "aaaaaabbcd"[k % 10], f"t{k}") for k in range(3200)], "doc_id long, source string, text string")
    mixed = corpus_pipeline.source_mix(spark, docs, FOLDER).collect()
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, docs.collect()))
    blocks, seen = [r.source for r in mixed][::mixing.BLOCK_DOCS], Counter()
    for k, source in enumerate(blocks, 1):
        seen[source] += 1
        assert all(abs(seen[s] - k * w / 10) < 1 for s, w in (("a", 6), ("b", 2), ("c", 1), ("d", 1)))
