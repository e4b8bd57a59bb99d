"""Files of exact names, row ranges and listings."""

import csv
import hashlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpus_mt.operators import layout as ly
from corpus_mt.operators import template as tp
from corpus_mt.sources import named_files as nf
from corpus_mt.sources import ranges as rg


def tree(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")}


@pytest.fixture
def docs(spark):
    raw = spark.createDataFrame([(f"d{i}", f"One n{i}n. Two, \"{i}\"?") for i in range(10)] + [("e/../x", "Odd id. Yes.")], "id string, content string")
    numbered = ly.number_rows(raw.withColumnRenamed("id", "key"), ["key"], total="n")
    return tp.template_documents(numbered.withColumnRenamed("key", "id"), id_col="id", keep=("row_idx", "n"))


def test_rows_of_a_file_in_order(spark, tmp_path):
    rows = spark.range(1000).select(F.concat(F.lit("f/"), (F.col("id") % 7).cast("string")).alias("file"), F.col("id").alias("at"), F.col("id").cast("string").alias("body"))
    nf.save_named(rows.repartition(5), str(tmp_path), ["at"], separator=",")
    want = {f"f/{k}": ",".join(str(i) for i in range(1000) if i % 7 == k).encode() for k in range(7)}
    assert tree(tmp_path) == want
    nf.save_named(rows.repartition(3), str(tmp_path), ["at"], separator=",")
    assert tree(tmp_path) == want  # the same again, nothing doubled
    one = spark.createDataFrame([("f/0", 1, None), ("g", 1, "x"), ("g", 1, "x")], "file string, at int, body string")
    nf.save_named(one, str(tmp_path), ["at"])
    assert tree(tmp_path) == want | {"f/0": b"", "g": b"xx"}
    with pytest.raises(ValueError):
        nf.save_named(one, str(tmp_path), ["at"], mode="error")
    nf.save_named(one, str(tmp_path), ["at"], mode="overwrite")
    assert tree(tmp_path) == {"f/0": b"", "g": b"xx"}
    nf.save_named(one.limit(0), str(tmp_path / "none"), ["at"])
    assert not (tmp_path / "none").exists() or tree(tmp_path / "none") == {}


@pytest.mark.parametrize("name", ["../x", "a//b", "", "/a", "a/./b", "_pending-1/x"])
def test_names_stay_below_the_folder(name):
    with pytest.raises(ValueError):
        nf.check_name(name)


def test_a_failed_attempt_leaves_nothing(tmp_path):
    """Attempts of a task write apart; only the one that Spark accepted is moved into place."""
    batch = lambda names, bodies: pa.RecordBatch.from_arrays([pa.array(names), pa.array(bodies)], ["file", "body"])
    writer = nf.NamedFilesWriter(str(tmp_path), "text", "\n", False, "job")

    def broken():
        yield batch(["a", "a", "b"], ["1", "2", "3"])
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(broken())
    first = writer.write(iter([batch(["a", "a"], ["1", "2"]), batch(["a", "b"], ["3", "4"])]))
    writer.write(iter([batch(["a"], ["speculative"])]))  # finished, but not accepted
    with pytest.raises(ValueError):
        writer.write(iter([batch(["a", "b", "a"], ["1", "2", "3"])]))
    assert set(tree(tmp_path)) and not {"a", "b"} & set(tree(tmp_path))
    writer.commit([first, None])
    assert tree(tmp_path) == {"a": b"1\n2\n3", "b": b"4"}
    other = nf.NamedFilesWriter(str(tmp_path), "text", "", False, "other")
    other.abort([other.write(iter([batch(["c"], ["x"])]))])
    assert tree(tmp_path) == {"a": b"1\n2\n3", "b": b"4"}


def test_a_task_that_fails_fails_the_write(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("file"), F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).otherwise("x").cast("string").alias("body"))
    with pytest.raises(Exception, match="bad"):
        nf.save_named(rows, str(tmp_path), [])
    assert tree(tmp_path) == {}


@pytest.mark.parametrize("style", ["doc", "batch"])
def test_every_path_of_the_manifest_opens(docs, tmp_path, style):
    tagged = nf.save_csv_files(docs, str(tmp_path), style, F.col("n"), batch_rows=4)
    paths = [r["csv_path"] for r in csv.DictReader((tmp_path / "paths.csv").open())]
    rows = tagged.orderBy("row_idx").collect()
    assert paths == [r.csv_path for r in rows] and len(set(paths)) == (11 if style == "doc" else 3)
    for r in rows:
        with open(r.csv_path, newline="") as f:
            lines = list(csv.reader(f))
        assert lines[0] == ["doc_id", "sid", "substr"]
        own = [[r.doc_id, s, t] for s, t in zip(r.sids, r.sub_strs)]
        assert (lines[1:] if style == "doc" else lines[r.start_pos : r.end_pos]) == own
    names = [f"{list(range(a, min(a + 4, 11)))}".encode() for a in (0, 4, 8)]
    assert {p[len(str(tmp_path)) + 1 :].split("/")[0] for p in paths} == {hashlib.sha256(n).hexdigest() for n in names}


def test_pred_and_ref_are_one_file_each(spark, tmp_path):
    rows = spark.range(500).select(
        "id", F.lit("eng_Latn").alias("src_lang"), F.when(F.col("id") % 5 == 0, "tam_Taml").otherwise("hin_Deva").alias("tgt_lang"), F.lit("gen").alias("ds"),
        F.concat(F.lit("p\n"), "id").alias("prediction"), F.when(F.col("id") != 3, F.concat(F.lit("r"), "id")).alias("reference"),
    ).repartition(7)
    nf.save_pred_ref(rows, str(tmp_path), ("ds",))
    ids = [i for i in range(500) if i % 5]
    assert (tmp_path / "gen/eng_Latn__hin_Deva/pred.txt").read_text() == "\n".join(f"p\\n{i}" for i in ids)
    assert (tmp_path / "gen/eng_Latn__hin_Deva/ref.txt").read_text() == "\n".join("" if i == 3 else f"r{i}" for i in ids)
    assert len(tree(tmp_path)) == 4


def test_substring_and_device_files(spark, tmp_path):
    base = f"{tmp_path}/t"
    df = spark.createDataFrame([(f"{base}/b/s1", "A"), (f"{base}/b/s1", "A"), (f"{base}/b/s2", None), (None, "C"), ("/elsewhere/s", "D")], "tlt_file_loc string, translated string")
    status = nf.save_substring_files(df, base)
    assert sorted((r.tlt_file_loc or "", r.written) for r in status.collect()) == sorted([("", False), ("/elsewhere/s", False), (f"{base}/b/s1", True), (f"{base}/b/s1", True), (f"{base}/b/s2", False)])
    assert tree(tmp_path / "t") == {"b/s1": b"A"}
    for k in range(5):
        (tmp_path / "shards" / f"s{k}" / "deep").mkdir(parents=True)
    (tmp_path / "shards" / ".hidden").write_text("x")
    (tmp_path / "shards" / "file").write_text("x")
    shards = rg.list_entries(spark, f"{tmp_path}/shards", f"{tmp_path}/nowhere")
    assert sorted(tuple(r) for r in shards.collect()) == [(f"{tmp_path}/shards/file", False)] + [(f"{tmp_path}/shards/s{k}", True) for k in range(5)]
    nf.save_device_files(shards, f"{tmp_path}/m", (3, 1))
    lines = [f"{tmp_path}/shards/{n}\n" for n in ("file", "s0", "s1", "s2", "s3", "s4")]
    assert tree(tmp_path / "m") == {"device_map_3": "".join(lines[::2]).encode(), "device_map_1": "".join(lines[1::2]).encode()}


def test_capped_files_have_the_names_of_their_rows(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v"))
    for parts in (3, 5):
        nf.save_capped_files(df.repartition(parts), str(tmp_path), ("k",), 300)
        got = {p.name: pq.read_table(p).column("k").to_pylist() for p in tmp_path.glob("*.parquet")}
        want = {hashlib.sha256(f"{list(range(a, min(a + 300, 1000)))}".encode()).hexdigest() + ".parquet": list(range(a, min(a + 300, 1000))) for a in range(0, 1000, 300)}
        assert got == want
    assert spark.read.parquet(str(tmp_path)).columns == ["k", "v"]


def test_a_range_opens_only_its_row_groups(spark, tmp_path, monkeypatch):
    at = 0
    for name, sizes in (("a", [100, 50]), ("b", []), ("c/d", [70] * 4)):
        path = tmp_path / f"{name}.parquet"
        path.parent.mkdir(exist_ok=True, parents=True)
        schema = pa.schema([("i", pa.int64()), ("s", pa.string()), ("t", pa.timestamp("us", tz="UTC")), ("l", pa.list_(pa.int32()))])
        with pq.ParquetWriter(path, schema) as w:
            for n in sizes:
                ids = list(range(at, at + n))
                w.write_table(pa.table([ids, [f"s{i}" if i % 9 else None for i in ids], [i * 10**6 for i in ids], [[i, i] for i in ids]], schema=schema), row_group_size=n)
                at += n
    groups = rg.row_groups(spark, str(tmp_path)).orderBy("first").collect()
    assert [(r.n, r.first) for r in groups] == [(100, 0), (50, 100), (70, 150), (70, 220), (70, 290), (70, 360)]
    for split, (a, b) in {"train[10%:20%]": (43, 86), "x[95:155]": (95, 155), "x[:]": (0, 430), "train": (0, 430), "x[425:]": (425, 430), "x[100:100]": (100, 100), "x[9:3]": (0, 430)}.items():
        got = rg.read_range(spark, str(tmp_path), split)
        assert sorted(r.i for r in got.collect()) == list(range(a, b)), split
    row = rg.read_range(spark, str(tmp_path), "x[152:153]").first()
    assert (row.i, row.s, row.t.timestamp(), row.l) == (152, "s152", 152, [152, 152])
    assert rg.read_range(spark, str(tmp_path), "x[152:154]", ["s"]).columns == ["s"]
    # A tenth of the rows takes no other row group.
    damaged = bytearray((tmp_path / "c" / "d.parquet").read_bytes())
    meta = pq.ParquetFile(tmp_path / "c" / "d.parquet").metadata.row_group(3)
    start = meta.column(0).dictionary_page_offset or meta.column(0).data_page_offset
    damaged[start : start + meta.total_byte_size // 2] = b"\xff" * (meta.total_byte_size // 2)
    (tmp_path / "c" / "d.parquet").write_bytes(bytes(damaged))
    assert rg.read_range(spark, str(tmp_path), "x[150:200]").count() == 50


def test_named_files_are_read_many_to_a_task(spark, tmp_path):
    bodies = {f"c{k % 7}/{'deep/' * (k % 2)}t {k}+%.txt": f"é{k}\r\n".encode() * (k % 5) for k in range(400)}
    bodies |= {"top": b"x", "c1/bad": b"\xff\xfe", "_hidden/f": b"x", "c1/.h": b"x", "c1/_k=1": b"y", "c1/a.txt.b": b"z"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(body)
    for base in (str(tmp_path), f"file://{tmp_path}/"):
        for pattern in ("*", "*.txt", "t ?+%.txt"):
            got = nf.read_named(spark, base, pattern)
            want = spark.read.text(str(tmp_path), wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
            plain = lambda df, name: sorted((n, bytes(b)) for n, b in df.select(name, F.col(df.columns[-1]).cast("binary")).collect())
            place = want.select(F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), f"{tmp_path}/", -1).alias("file"), "value")
            assert plain(got, "file") == plain(place, "file") and got.columns == ["file", "body"]
    # Spark's reader takes at most 32 files of any size to a task.
    many = tmp_path / "many"
    many.mkdir()
    for k in range(2_000):
        (many / f"f{k}").write_text(str(k))
    assert nf.read_named(spark, str(many)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    (tmp_path / "none").mkdir()
    assert nf.read_named(spark, f"{tmp_path}/none").count() == 0


def test_an_attempt_makes_no_folder_for_each_of_its_files(tmp_path):
    writer = nf.NamedFilesWriter(str(tmp_path), "text", "", False, "job")
    wanted = {f"c{k // 3}/t{k}": f"x{k}".encode() for k in range(30)}
    halves = [dict(list(wanted.items())[i::2]) for i in (0, 1)]
    done = [writer.write(iter([pa.RecordBatch.from_arrays([pa.array(list(h)), pa.array([b.decode() for b in h.values()])], ["file", "body"])])) for h in halves]
    lost = writer.write(iter([pa.RecordBatch.from_arrays([pa.array(["c0/t0"]), pa.array(["lost"])], ["file", "body"])]))
    assert [p for p in (tmp_path / "_pending-job").glob("*/*") if p.is_dir()] == []
    assert lost.names == ["c0/t0"]
    writer.commit([*done, None])
    assert tree(tmp_path) == wanted and not (tmp_path / "_pending-job").exists()
