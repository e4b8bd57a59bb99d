"""Sources, sinks and streams on the local file system."""

import json

import pytest
from pyspark.sql import functions as F

from corpus_mt.operators import layout as ly
from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import template as tp
from corpus_mt.sources import readers, sinks
from corpus_mt.streaming import stream as stm


@pytest.fixture
def docs(spark):
    raw = spark.createDataFrame([(f"d{i}", f"One n{i}n. Two, \"{i}\"?") for i in range(10)], "id string, content string")
    return tp.template_documents(ly.number_rows(raw, ["id"]), id_col="id", keep=("row_idx",))


def test_tables_and_shards(spark, docs, tmp_path):
    sinks.save_table(docs, f"{tmp_path}/t", shards=3)
    assert readers.read_table(spark, f"{tmp_path}/t/*.parquet").count() == 10
    assert readers.list_shards(spark, f"{tmp_path}/t").filter("path like '%.parquet'").count() == 3
    sinks.save_shards(sn.explode_sentences(docs), f"{tmp_path}/s", 5)
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 4
    sinks.save_capped(docs.coalesce(1), f"{tmp_path}/c", 4)
    assert len(list((tmp_path / "c").glob("*.snappy.parquet"))) == 3


@pytest.mark.parametrize("style", ["doc", "batch"])
def test_csvs(spark, docs, tmp_path, style):
    tagged = sinks.save_csvs(docs, f"{tmp_path}/{style}", style, 10)
    rows = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/{style}/rows")
    assert rows.count() == 20 and {"doc_id", "sid", "substr"} <= set(rows.columns)
    assert rows.filter("substr = 'two, \"3\"?'").count() == 1
    manifest = spark.read.option("header", True).csv(f"{tmp_path}/{style}/paths.csv")
    assert manifest.count() == 10
    for row in manifest.distinct().collect():
        assert spark.read.option("header", True).csv(row.csv_path).count() == (2 if style == "doc" else 20)
    if style == "batch":
        spans = sorted((r.start_pos, r.end_pos) for r in tagged.collect())
        assert spans == [(1 + 2 * i, 3 + 2 * i) for i in range(10)]


def test_translations_table(spark, tmp_path):
    df = spark.createDataFrame([("a/x/s1", "A"), ("a/x/s2", None), (None, "C")], "tlt_file_loc string, translated string")
    status = sinks.save_translations(df, f"{tmp_path}/t", 4)
    assert [r.written for r in status.collect()] == [True, False, False]
    assert [tuple(r) for r in readers.read_translations(spark, f"{tmp_path}/t").select("path", "translated").collect()] == [("a/x/s1", "A")]


def test_text_file_translations(spark, tmp_path):
    (tmp_path / "x" / "d").mkdir(parents=True)
    (tmp_path / "x" / "d" / "s1").write_text("line 1\nline 2")
    rows = readers.read_translations(spark, f"{tmp_path}/x", "text").collect()
    assert rows[0].translated == "line 1\nline 2" and rows[0].path.endswith("x/d/s1")


def test_text_files_are_found_again(spark, tmp_path):
    base = tmp_path / "odd name+%"
    docs = spark.createDataFrame([("d", f"{base}/d", ["s1", "s2"], ["a", "b"])], "doc_id string, tlt_folder string, sids array<string>, sub_strs array<string>")
    (base / "d").mkdir(parents=True)
    for sid in ("s1", "s2"):
        (base / "d" / sid).write_text(sid.upper())
    stored = readers.read_translations(spark, str(tmp_path), "text")
    rows = rp.lookup_translations(docs, stored).collect()
    assert sorted((r.sub_str, r.translated) for r in rows) == [("a", "S1"), ("b", "S2")]


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "src.json").write_text(json.dumps({"<s>": 0, "<pad>": 1, "</s>": 2, "<unk>": 3, "▁a": 4}))
    (tmp_path / "tgt.json").write_text(json.dumps({"▁b": 9}))
    v = readers.read_vocabulary(spark, f"{tmp_path}/src.json", f"{tmp_path}/tgt.json")
    assert (v.size(True), v.size(False), v.special_ids()) == (5, 1, (3, 1, 2))


def test_partitioned_and_devices(spark, tmp_path):
    rows = spark.range(20).select((F.col("id") % 3).alias("rank"), "id")
    sinks.save_partitioned(rows, f"{tmp_path}/r", ["rank"])
    assert spark.read.parquet(f"{tmp_path}/r").where("rank = 1").count() == 7
    shards = spark.createDataFrame([(f"/s/{i}",) for i in range(5)], "path string")
    sinks.save_device_maps(ly.assign_devices(shards, (7, 2)), f"{tmp_path}/m")
    assert [r.value for r in spark.read.text(f"{tmp_path}/m/device=7").collect()] == ["/s/0", "/s/2", "/s/4"]


def test_aligned_lines(spark, tmp_path):
    rows = spark.range(200).select(
        "id", F.lit("eng_Latn").alias("src_lang"), F.lit("hin_Deva").alias("tgt_lang"),
        F.concat(F.lit("p\n"), "id").alias("prediction"), F.concat(F.lit("r"), "id").alias("reference"),
    ).repartition(7)
    sinks.save_aligned_text(rows, f"{tmp_path}/a")

    def lines(side):
        files = sorted((tmp_path / "a" / "pair=eng_Latn__hin_Deva" / f"side={side}").glob("part-*"))
        return [line for f in files for line in f.read_text().splitlines()]

    assert lines("pred") == [f"p\\n{i}" for i in range(200)] and lines("ref") == [f"r{i}" for i in range(200)]


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    raw = spark.createDataFrame([(f"d{i}", f"One n{i}n. Two.") for i in range(20)], "id string, content string")
    raw.write.parquet(f"{tmp_path}/in")

    def run():
        rows = stm.stream_sentences(readers.read_stream(spark, f"{tmp_path}/in", raw.schema), id_col="id")
        stm.write_stream(rows, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    batch = lambda: sorted(
        tuple(r) for r in sn.explode_sentences(tp.template_documents(spark.read.parquet(f"{tmp_path}/in"), id_col="id")).collect()
    )
    assert run() == batch()
    raw.withColumn("id", F.concat(F.lit("late"), "id")).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == batch() and len(batch()) == 80


def test_batches_step(spark, tmp_path):
    raw = spark.createDataFrame([(f"d{i}", f"One n{i}n. Two.") for i in range(5)], "id string, content string")
    raw.write.parquet(f"{tmp_path}/in")
    stream = readers.read_stream(spark, f"{tmp_path}/in", raw.schema)
    step = lambda df: sn.add_global_index(sn.explode_sentences(tp.template_documents(df, id_col="id")), ("doc_id", "pos"))
    stm.run_batches(stream, step, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    assert sorted(r.tlt_idx for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(10))
