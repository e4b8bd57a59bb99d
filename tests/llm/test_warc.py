"""Archives: exact round trips, and what is salvaged from damaged ones."""

import gzip
import io

import pytest
from pyspark.sql import functions as F

from corpus_mt.llm import warc


def record(i, payload=b"<p>x</p>", refers=None):
    import hashlib

    return warc.build_record(i, f"http://h/{i}", None if refers is not None else payload, len(payload), hashlib.sha1(payload).hexdigest(), refers)


def salvage(data):
    return list(warc.salvage(io.BytesIO(data), len(data)))


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_sound_archives(pack):
    parts = [pack(record(i, b"y" * i)) for i in range(5)] + [pack(record(9, b"yyy", 3))]
    got = salvage(b"".join(parts))
    assert [g[2]["record_key"] for g in got] == ["0", "1", "2", "3", "4", "9"]
    assert [g[2]["payload_bytes"] for g in got] == [0, 1, 2, 3, 4, 3] and got[-1][2]["refers_to"] == "3" and got[-1][2]["payload"] is None
    assert (got[0][0], got[-1][1]) == (0, sum(map(len, parts))) and all(a[1] == b[0] for a, b in zip(got, got[1:]))


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
@pytest.mark.parametrize("harm", ["flip", "cut", "junk", "head"])
def test_records_behind_damage_are_recovered(pack, harm):
    body = b"".join(bytes([i * 37 % 251]) for i in range(3000))
    parts = [pack(record(i, body)) for i in range(4)]
    bad = bytearray(parts[1])
    if harm == "flip":
        bad[len(bad) // 2] ^= 0x55
    elif harm == "cut":
        bad = bad[: len(bad) // 2]
    elif harm == "head":
        bad[:2] = b"??"
    else:
        bad += b"\x1f\x8b\x08 WARC/1.1\r\nContent-Length: 99999999\r\n\r\n junk"
    got = salvage(parts[0] + bytes(bad) + b"".join(parts[2:]))
    keys = [g[2]["record_key"] for g in got if isinstance(g[2], dict)]
    assert keys == (["0", "1", "2", "3"] if harm == "junk" else ["0", "2", "3"])
    gaps = [(a, b) for a, b, what in got if isinstance(what, str)]
    start = len(parts[0]) + (len(parts[1]) if harm == "junk" else 0)
    assert gaps == [(start, len(parts[0]) + len(bad))]


def test_version_line_inside_a_payload():
    payload = b"before\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nafter \x1f\x8b\x08"
    for pack in (warc.gzip_member, bytes):
        got = salvage(pack(record(1, payload)) + pack(record(2)))
        assert [g[2]["record_key"] for g in got] == ["1", "2"] and got[0][2]["payload"] == payload


def test_one_member_of_several_records_and_empty_archives():
    data = gzip.compress(record(1) + record(2))
    assert [g[2]["record_key"] for g in salvage(data)] == ["1", "2"]
    assert salvage(b"") == [] and [g[:2] for g in salvage(b"nothing here")] == [(0, 12)]
    broken = bytearray(gzip.compress(record(1) + record(2)))
    broken[-5] ^= 1  # the check sum of the member
    assert [g[:2] for g in salvage(bytes(broken))] == [(0, len(broken))]


def test_pages_with_copies_nulls_and_odd_urls(spark):
    long, other = "é" * 600, "b" * 999
    rows = [
        (1, "http://a/\r\nX: y", long), (5, None, long), (3, "u", long), (7, "u", other), (8, "u", other),
        (9, "u", None), (10, "u", ""), (None, "u", long), (11, "u", "z" * 2000), (11, "u", "z" * 2000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"key": F.lit(1), "payload": F.lit("x"), "kept": F.lit(2)})
    got = warc.records_of(warc.read_archives(warc.archive_pages(pages.repartition(3)))).collect()
    found = sorted((str(r.record_key), r.record_type, r.payload_bytes, r.refers_to) for r in got)
    assert found == sorted(
        [("1", "revisit", 1200, "5"), ("5", "response", 1200, None), ("3", "revisit", 1200, "5"), ("None", "revisit", 1200, "5")]
        + [("7", "response", 999, None), ("8", "response", 999, None), ("9", "response", 0, None), ("10", "response", 0, None)]
        + [("11", "response", 2000, None)] * 2
    )
    assert {r.payload_digest for r in got if r.payload_bytes == 1200} == {__import__("hashlib").sha1(long.encode()).hexdigest()}
    assert warc.records_of(warc.read_archives(warc.archive_pages(pages.limit(0)))).count() == 0


def test_gaps_are_logged(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(b"\0" * 700_000 + warc.gzip_member(record(1)) + b"tail")
    read = warc.read_archives(spark.createDataFrame([(str(tmp_path / "x.warc.gz"),), (None,)], "archive string"))
    gaps = [(r.start, r.end) for r in warc.gaps_of(read).orderBy("start").collect()]
    size = (tmp_path / "x.warc.gz").stat().st_size
    assert gaps == [(0, 700_000), (size - 4, size)] and warc.records_of(read).first().payload == b"<p>x</p>"


def test_archives_are_cut_by_size(spark):
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html")).coalesce(1)
    records = warc.plan_records(pages)
    from corpus_mt.session import shared_dir

    made = warc.write_archives(records, f"{shared_dir(spark)}/cut", archive_bytes=2000).collect()
    assert len(made) > 3 and sum(r.records for r in made) == 40


@pytest.mark.parametrize("pack", [warc.gzip_member, bytes])
def test_headers_of_a_megabyte(pack):
    import random

    draw = random.Random(3)
    url = "http://h/" + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=1_000_000))
    long = record(1).replace(b"http://h/1", url.encode(), 1)
    got = salvage(pack(record(0)) + pack(long) + pack(record(2)))
    assert [g[2]["record_key"] for g in got] == ["0", "1", "2"] and got[1][2]["target_uri"] == url


def test_pages_with_very_long_urls(spark):
    df = spark.range(3).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.repeat(F.md5(F.col("id").cast("string")), 40_000)).alias("url"), F.lit("<p>").alias("html"))
    got = warc.records_of(warc.read_archives(warc.archive_pages(df), payloads=False))
    assert sorted(r.record_key for r in got.collect()) == ["0", "1", "2"]
