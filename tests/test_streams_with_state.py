"""Numbering and replacing over streams give what a batch gives, in any order of arrival and after repeats."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import tokens as tk
from corpus_mt.sources import readers
from corpus_mt.plans import file_queries
from corpus_mt.streaming import numbering as nb
from corpus_mt.streaming import replacing as rs

@pytest.fixture
def files(spark, tmp_path):
    """A folder, and a way to add a file of rows to it."""

    def add(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    return add


def test_numbers_run_on(spark, tmp_path, files):
    schema, rng, n = "k long, t string", random.Random(1), 0
    stream = lambda: readers.read_stream(spark, f"{tmp_path}/in", schema, maxFilesPerTrigger="1")

    def run():
        nb.run_numbered(stream(), f"{tmp_path}/out", f"{tmp_path}/progress", ["k"]).awaitTermination()
        return sorted((r.tlt_idx, r.k) for r in nb.read_numbered(spark, f"{tmp_path}/out").select("tlt_idx", "k").collect())

    for size in (5, 0, 30, 1):
        files([(n + i, "x") for i in rng.sample(range(size), size)], schema)
        n += size
    assert run() == [(i, i) for i in range(n)]
    files([(n + i, "y") for i in range(9)], schema)
    assert run() == [(i, i) for i in range(n + 9)]


def test_a_repeated_epoch_keeps_its_numbers(spark, tmp_path):
    ledger = nb.Ledger(f"{tmp_path}/ledger")
    assert (ledger.next_number(0), ledger.waiting(0)) == (0, None)
    ledger.commit(0, next=10)
    ledger.commit(1, next=25, waiting="w1")
    ledger.commit(2, next=40)
    assert [ledger.next_number(e) for e in (0, 1, 2, 3, 9)] == [0, 10, 25, 40, 40]
    assert [ledger.waiting(e) for e in (1, 2, 3)] == [None, "w1", None]
    ledger.commit(1, next=25, waiting="w1")  # again, after a failure behind it
    assert ledger.next_number(2) == 25 and len(list((tmp_path / "ledger").glob("*.json"))) == 3


def test_steps_see_whole_batches(spark, tmp_path, files):
    schema, sizes = "k long, input_ids array<int>, attention_mask array<int>", (7, 2, 10, 1, 4)
    rows = [(k, [5] * (1 + k * 7 % 11), [1] * (1 + k * 7 % 11)) for k in range(sum(sizes))]
    at = 0
    for size in sizes:
        files(rows[at : at + size], schema)
        at += size
    step = lambda df: tk.repad_batch(df, 8)
    stream = readers.read_stream(spark, f"{tmp_path}/in", schema, maxFilesPerTrigger="1")
    nb.run_numbered(stream, f"{tmp_path}/out", f"{tmp_path}/p", ["k"], step=step, batch_rows=8).awaitTermination()
    plain = lambda df: sorted((r.tlt_idx, r.k, list(r.input_ids), list(r.attention_mask)) for r in df.select("tlt_idx", "k", "input_ids", "attention_mask").collect())
    want = plain(step(sn.add_global_index(spark.createDataFrame(rows, schema), ("k",))))
    assert plain(nb.read_numbered(spark, f"{tmp_path}/out")) == want[:24]
    assert nb.finish_numbered(spark, f"{tmp_path}/out", f"{tmp_path}/p", step) == 24
    files([(100 + k, [1, 2], [1, 1]) for k in range(3)], schema)
    nb.run_numbered(stream, f"{tmp_path}/out", f"{tmp_path}/p", ["k"], step=step, batch_rows=8).awaitTermination()
    assert nb.finish_numbered(spark, f"{tmp_path}/out", f"{tmp_path}/p", step) == 27
    assert [r[0] for r in plain(nb.read_numbered(spark, f"{tmp_path}/out"))] == list(range(27))


DOC = "doc_id string, text string, sub_strs array<string>"
TRANSLATION = "doc_id string, pos int, translated string"


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_go_out_when_their_last_translation_is_in(spark, tmp_path, seed):
    rng = random.Random(seed)
    docs = [(f"d{i}", " ".join(f"s{i}x{k}." for k in range(i % 5)), [f"s{i}x{k}." for k in range(i % 5)]) for i in range(25)]
    docs += [("empty", "", []), ("null", None, None)]
    translations = [(d, p, None if rng.random() < 0.2 else s.upper()) for d, _, subs in docs for p, s in enumerate(subs or [])]
    translations += rng.sample(translations, 5) + [("nobody", 0, "X"), (None, 0, "Y")]
    rng.shuffle(docs)
    rng.shuffle(translations)
    late = docs[0][0]
    for k in range(4):
        spark.createDataFrame(docs[k::4], DOC).coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs")
        spark.createDataFrame(translations[k::4], TRANSLATION).coalesce(1).write.mode("append").parquet(f"{tmp_path}/tr")
    read = lambda name, schema: readers.read_stream(spark, f"{tmp_path}/{name}", schema, maxFilesPerTrigger="1")
    out = rs.replace_stream(read("docs", DOC), read("tr", TRANSLATION))
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/p").outputMode("append").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    got = {r.doc_id: (r.translated, list(r.substr_tlt), r.complete) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    done = rp.replace_documents(spark.createDataFrame(docs, DOC).withColumn("sids", F.col("sub_strs")), spark.createDataFrame(translations, TRANSLATION))
    want = {r.doc_id: (r.translated, list(r.substr_tlt), True) for r in done.collect()}
    assert got == want and late in got


def test_waiting_ends(spark, tmp_path):
    spark.createDataFrame([("a", "x. y.", ["x.", "y."])], DOC).coalesce(1).write.parquet(f"{tmp_path}/docs")
    spark.createDataFrame([("a", 1, "Y!")], TRANSLATION).coalesce(1).write.parquet(f"{tmp_path}/tr")
    read = lambda name, schema: readers.read_stream(spark, f"{tmp_path}/{name}", schema)
    out = rs.replace_stream(read("docs", DOC), read("tr", TRANSLATION), wait_ms=1)
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/p").outputMode("append").trigger(processingTime="1 second").start(f"{tmp_path}/out")
    rows = []
    for _ in range(30):
        rows = spark.read.schema(rs.OUTPUT).parquet(f"{tmp_path}/out").collect() if list((tmp_path / "out").glob("*.parquet")) else []
        if rows:
            break
        query.awaitTermination(1)
    query.stop()
    assert [tuple(r) for r in rows] == [("a", "x. Y!", ["Y!"], False)]


def test_finishing_a_document():
    doc = {"text": "a b. a b c", "sub_strs": ["a b", "a b c", "b."]}
    assert rs.finish_document(doc, {0: "X", 1: None, 2: "Z"}) == ("X. X c", ["X", "Z"])
    assert rs.finish_document({"text": "a", "sub_strs": ["a"]}, {0: None}) == ("a", ["None"])
    assert rs.finish_document({"text": "", "sub_strs": []}, {}) == ("None", ["None"])
    assert json.loads(json.dumps(doc)) == doc


def test_parts_of_a_numbered_stream_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(file_queries, "_folder", lambda spark, name: str(tmp_path / name))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # the table is too small to have several files else
    try:
        out = file_queries.stream_numbers(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set(name, before)
    arrived = list((tmp_path / "numbers" / "in").glob("*.parquet"))
    assert len(arrived) > file_queries.PARTS
    assert len(list((tmp_path / "numbers" / "out").glob("epoch=*"))) == file_queries.PARTS
    numbers = sorted(r.tlt_idx for r in out.select("tlt_idx").collect())
    assert numbers == list(range(len(numbers)))


def test_packed_documents_come_back():
    docs = [
        {"text": "a b. a b c", "sub_strs": ["a b", "a b c", "b."]},  # one behind the other, and one before
        {"text": "é\ud800 x\x00", "sub_strs": ["é", "x\x00", "not there", ""]},
        {"text": "", "sub_strs": ["a"]},
        {"text": None, "sub_strs": ["a"]},
    ]
    assert [rs.unpack_document(rs.pack_document(d)) for d in docs] == docs
    assert rs.unpack_document(rs.pack_document({"text": None})) == {"text": None, "sub_strs": []}
    long = {"text": " ".join(f"word {i}." for i in range(2000)), "sub_strs": [f"word {i}." for i in range(2000)]}
    assert len(rs.pack_document(long)) < len(json.dumps(long)) / 4 and rs.unpack_document(rs.pack_document(long)) == long


def test_what_waits_is_on_disk(spark, tmp_path, monkeypatch):
    """The query's state is in RocksDB, not in the heap, and the session keeps its own settings."""
    monkeypatch.setattr(file_queries, "_folder", lambda spark, name: str(tmp_path / name))
    before = {name: spark.conf.get(name, None) for name in rs.STATE_CONF}
    out = file_queries.stream_replace(spark, "/root/testdata/sf0.001")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert {name: spark.conf.get(name, None) for name in rs.STATE_CONF} == before
    state = [p.name for p in (tmp_path / "replace" / "progress" / "state").rglob("*")]
    assert any(n.endswith(".sst") for n in state) and not any(n.endswith(".delta") for n in state)
    offsets = sorted(p for p in (tmp_path / "replace" / "progress" / "offsets").iterdir() if p.name.isdigit())
    assert len(offsets) == file_queries.PARTS
