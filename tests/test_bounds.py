"""What a batch, a shuffle or a plan may hold at most."""

import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from corpus_mt.operators import evaluate as ev
from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import tokens as tk
from corpus_mt.operators import translate as tr
from corpus_mt.plans import file_queries as fq
from corpus_mt.plans import queries as qs


def _peak_mb(run) -> float:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_ngrams_of_a_slice_are_those_of_its_rows():
    rng = random.Random(3)
    rows = [("".join(rng.choices("ab\U0001F600", k=rng.randrange(9))), "".join(rng.choices("abc", k=rng.randrange(9)))) for _ in range(300)]
    rows += [("", ""), ("", "a"), ("aaaa", "aa")]
    for kind in (pa.string(), pa.list_(pa.string())):
        pred, ref = ([t if kind == pa.string() else list(t) for t in side] for side in zip(*rows))
        found = ev._overlaps(pa.array(pred, kind), pa.array(ref, kind), 4)
        for (a, b), got in zip(rows, found.tolist(), strict=True):
            for n in range(1, 5):
                x, y = (Counter(t[i : i + n] for i in range(len(t) - n + 1)) for t in (a, b))
                assert got[3 * n - 3 : 3 * n] == [(x & y).total(), x.total(), y.total()]
    assert ev._overlaps(pa.array([], pa.string()), pa.array([], pa.string()), 2).shape == (0, 6)
    without_nulls = pa.list_(pa.field("element", pa.string(), nullable=False))
    assert ev._overlaps(pa.array([["a"]], without_nulls), pa.array([["a", "b"]], pa.list_(pa.string())), 1).tolist() == [[1, 1, 2]]


def test_replacing_holds_few_documents_as_objects():
    keys = [[f"{i} {k} {'x' * 60}" for k in range(20)] for i in range(3000)]
    text, kept, values = pa.array([". ".join(k) for k in keys]), pa.array(keys), pa.array([[v[::-1] for v in k] for k in keys])
    done = []
    assert _peak_mb(lambda: done.append(rp._replace_arrow.func(text, kept, values))) < 3
    assert done[0].to_pylist() == [". ".join(v[::-1] for v in k) for k in keys]
    assert rp._replace_arrow.func(pa.array([None], pa.string()), pa.array([None], kept.type), pa.array([None], kept.type)).to_pylist() == [None]


def test_lookups_hold_few_tokens_as_objects():
    keys, wanted = pa.array(["a", "b"]), pa.array([f"word {i} {'x' * 60}" for i in range(200_000)] + ["b"])
    found = []
    assert _peak_mb(lambda: found.append(tk._places("bounds", keys, wanted))) < 12
    assert found[0].null_count == 200_000 and found[0][-1].as_py() == 1
    assert len(tk._places("bounds", keys, wanted.slice(0, 0))) == 0


def test_joined_ids_share_a_number_with_their_place(spark):
    """Ids of either sign come back in place, and the lists that move hold numbers and no structs."""
    table = spark.createDataFrame([("<s>", 0), ("<pad>", 1), ("</s>", 2), ("<unk>", -(2**31)), ("a", 2**31 - 1), ("b", -1)], "token string, id int")
    vocab = tk.Vocabulary(table, table)
    rows = spark.createDataFrame([(1, ["b", "a", "?"]), (2, []), (3, None), (1, ["a"])], "k int, tokens array<string>")
    found = tk.encode_ids(rows, vocab, max_broadcast=0)
    assert sorted((r.k, r.input_ids or []) for r in found.collect()) == [(1, [-1, 2**31 - 1, -(2**31)]), (1, [2**31 - 1]), (2, []), (3, [])]
    assert [r.input_ids for r in found.filter("k = 3").collect()] == [None]
    assert not re.search(r"collect_list\((named_)?struct", found._jdf.queryExecution().optimizedPlan().toString())


def _documents(spark, folder) -> str:
    rows = [(i, f"First of {i}. Second one, a b? Third!\nfirst of {i}.") for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "first second third")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_joined_encoding_stages_what_is_asked_for(spark, tmp_path, monkeypatch):
    staged, stage = [], tk.stage_table
    monkeypatch.setattr(tk, "stage_table", lambda df, name="stage": (staged.append(df.columns), stage(df, name))[1])
    d = _documents(spark, tmp_path)
    joined, sent = (sorted(map(tuple, q(spark, d).collect())) for q in (qs.encode_ids_joined, qs.encode_ids))
    assert joined == sent and len(joined) == 60
    assert staged == [["doc_id", "pos", "tokens", "_row"]]


def test_documents_are_templated_once(spark, tmp_path):
    d = _documents(spark, tmp_path)
    found = fq.lookup_by_sid(spark, d)
    assert not any("documents.parquet" in f for f in found.inputFiles())
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, qs.replace_documents(spark, d).collect()))


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_ids_are_moved_short_and_come_back(spark):
    own, odd = "a" * 32 + "0" * 32, ["x", "", None, "A" * 64, "0" * 64 + "\n", "\x00" * 32, "é" * 16]
    rows = [(d, p, s, t) for p, d in enumerate([own, *odd]) for s, t in [("s1", "a"), (None, "a"), ("s2", None), (None, None), (own, "b")]]
    df = spark.createDataFrame(rows, "doc_id string, pos int, sid string, sub_str string").unionByName(
        spark.createDataFrame([(own, 9, "own text")], "doc_id string, pos int, sub_str string").withColumn("sid", F.sha2("sub_str", 256))
    )
    short = sn.shorten_ids(df)
    assert sorted(map(repr, sn.restore_ids(short).select(df.columns).collect())) == sorted(map(repr, df.collect()))
    assert {len(r[0]) for r in short.filter("doc_id.hash is not null").select("doc_id.hash").collect()} == {32}
    assert short.filter("sid.own").select("sid.other").distinct().collect() == [(None,)]
    numbered = spark.createDataFrame([(7, "s", "a")], "doc_id long, sid string, sub_str string")
    assert sn.restore_ids(sn.shorten_ids(numbered)).collect() == numbered.collect()
    counted = {(r.sid, r.sub_str): r.n_uses for r in tr.distinct_sentences(df).collect()}
    assert counted == Counter((r.sid, r.sub_str) for r in df.collect())


def test_translations_meet_their_uses_by_short_keys(spark, monkeypatch):
    staged, stage = [], tr.stage_table
    monkeypatch.setattr(tr, "stage_table", lambda df, *args: staged.append(stage(df, *args)) or staged[-1])
    rows = [("d", 0, "s1", "a"), ("d", 1, "s1", "a"), ("e", 0, None, "b"), ("e", 1, "s2", "c")]
    df = spark.createDataFrame(rows, "doc_id string, pos int, sid string, sub_str string").withColumn("sub_str", F.concat("sub_str", F.lit(".")))
    got = tr.translate_distinct(df, lambda d: d.withColumn("translated", F.upper("sub_str")))
    assert sorted((r.doc_id, r.pos, r.sid, r.translated) for r in got.collect()) == [("d", 0, "s1", "A."), ("d", 1, "s1", "A."), ("e", 0, None, None), ("e", 1, "s2", "C.")]
    assert "sid" not in staged[0].columns and {len(r[0]) for r in staged[0].filter("_meet is not null").select("_meet").collect()} == {16}


def test_translations_of_a_document_move_once(spark):
    rows = [("d", 1, "b"), ("d", 1, "a"), ("d", 0, "z"), ("d", 0, "z"), ("d", 1, None), ("e", 0, None), (None, 0, "x"), ("f", None, "n"), ("f", 0, "y"), ("f", 0, "x")]
    df = spark.createDataFrame(rows * 3, "doc_id string, pos int, translated string").repartition(4)
    found = rp.document_translations(df)
    assert _exchanges(found) == 1
    got = {r.doc_id: [(f.pos, f.translated) for f in r._found if f.pos is not None] for r in found.collect()}
    assert got == {"d": [(0, "z"), (1, "a")], None: [(0, "x")], "f": [(0, "x")]}


def test_lookups_meet_by_keys_of_paths_and_count_copies(spark):
    """The paths themselves, with two ids in hex, are not moved."""
    folder = "/base/" + "0" * 64
    docs = spark.createDataFrame([(folder[6:], folder, ["s1", "s2"], ["a", "b"])] * 3 + [("e", "/base/e", ["s1"], ["a"])], "doc_id string, tlt_folder string, sids array<string>, sub_strs array<string>")
    stored = spark.createDataFrame([(f"file://host{folder}/s1", "B"), (f"{folder}/s1", "A"), (f"{folder}/s2", None), ("/base/e/s1", "E"), (None, "X")], "path string, translated string")
    found = rp.lookup_translations(docs, stored)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "tlt_file_loc" not in "".join(re.findall(r"Exchange.*", text)) and len(re.findall(r"Exchange hashpartitioning\(_path#", text)) == 2
    assert sorted((r.doc_id, r.tlt_folder, r.pos, r.sid, r.sub_str, r.translated) for r in found.collect()) == [(folder[6:], folder, 0, "s1", "a", "A")] * 3 + [("e", "/base/e", 0, "s1", "a", "E")]
    counted = rp.count_copies(found.select("doc_id", "pos", "sid", "sub_str", "translated"))
    assert sorted(map(tuple, counted.collect())) == [(folder[6:], 0, "s1", "a", "A", 3), ("e", 0, "s1", "a", "E", 1)]


def test_joined_lookups_by_chunks(spark, monkeypatch):
    """Tokens with separators in them, empty and null ones, rows of any length, chunks of few rows, both directions."""
    monkeypatch.setattr(tk, "CHUNK_ELEMENTS", 16)
    rng, sep = random.Random(5), tk.SEPARATOR
    words = ["a", "b", "", sep, f"a{sep}b", "é", None, "nowhere"]
    table = spark.createDataFrame([("<s>", 0), ("<pad>", 1), ("</s>", 2), ("<unk>", 3), *((w, 10 + i) for i, w in enumerate(words[:6]))], "token string, id int")
    vocab, ids = tk.Vocabulary(table, table), {w: 10 + i for i, w in enumerate(words[:6])}
    rows = [(i % 7, rng.choices(words, k=rng.choice([0, 1, 2, 5, 40]))) for i in range(300)] + [(7, None)]
    df = spark.createDataFrame(rows, "k int, tokens array<string>").repartition(3)
    joined = tk.encode_ids(df, vocab, max_broadcast=0)
    want = sorted((k, repr(t), None if t is None else [ids.get(w, 3) for w in t]) for k, t in rows)
    assert sorted((r.k, repr(r.tokens), r.input_ids) for r in joined.collect()) == want
    back = tk.decode_tokens(joined.select("k", "input_ids"), vocab, "input_ids", max_broadcast=0)
    names = {v: k for k, v in ids.items()} | {3: "<unk>"}
    assert all(r.tokens == (None if r.input_ids is None else [names[i] for i in r.input_ids]) for r in back.collect())
    assert tk.encode_ids(df.limit(0), vocab, max_broadcast=0).count() == 0


def test_joined_encoding_moves_no_token_for_each_use(spark, tmp_path):
    """Only different tokens of a chunk are opened into rows."""
    text = qs.encode_ids_joined(spark, _documents(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and not re.search(r"posexplode\w*\(tokens", text)
