"""Searches and replacements in one pass do what the plain steps do, in time proportional to the text."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpus_mt.functions import sentences as st


def values(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    return [r.o for r in sorted(df.select("i", make(F.col("t")).alias("o")).collect())]


@pytest.mark.parametrize("alphabet", ["ab-. /", "a-.-/:h_#", "é-a. ?=&%-", ["a", "-", "--", ".", "http://", "ftp://", "/", " ", "b"], ["x-", "-y", ".z", "//", "https://", "-"]])
def test_urls_like_the_plain_pattern(spark, alphabet):
    rng = random.Random(str(alphabet))
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 18))) for _ in range(12_000)]
    texts += ["x-" + t for t in texts[:300]] + ["\x03-" + t for t in texts[:300]] + [None, ""]
    assert values(spark, texts, st.url_spans) == values(spark, texts, lambda c: F.regexp_extract_all(c, F.lit(st.URL), 0))


@pytest.mark.parametrize("text", ["a-" * 20_000, "a--" * 20_000, "/a-" * 20_000, "x/" + "a-" * 20_000 + "/b.c", "-" * 40_000, "a" + "-" * 40_000, "a-" * 20_000 + "http"])
def test_long_hyphenated_runs(spark, text):
    values(spark, ["warm-up a-b.c"], st.url_spans)
    start = time.monotonic()
    values(spark, [text + " x.y"], st.url_spans)
    assert time.monotonic() - start < 5


def one_by_one(text, entities):
    for serial, entity in entities:
        for before, after in st.placeholder_forms():
            text = text.replace(f"{before}{serial}{after}", entity)
    return text


def test_restoring_like_one_by_one(spark):
    rng, rows = random.Random(6), []
    forms = st.placeholder_forms()
    for _ in range(1500):
        entities = [(k + 1, rng.choice(("a@b.com", "10.5%", "#tag", "x.org/[1]", "12/10/2023", "$1\\1"))) for k in range(rng.randrange(0, 13))]
        parts = []
        for _ in range(rng.randrange(0, 8)):
            a, b = rng.choice(forms)
            parts.append(rng.choice((f"{a}{rng.randrange(0, 14)}{b}", f"{a}0{rng.randrange(9)}{b}", a, b, " x ", "<", "<ID", "3>", "]")))
        rows.append(("".join(parts), entities))
    df = spark.createDataFrame(rows, "t string, e array<struct<serial:int,entity:string>>")
    got = [r.o for r in df.select("t", st.restore_entities(F.col("t"), F.col("e")).alias("o")).collect()]
    assert got == [one_by_one(t, e) for t, e in rows]


def test_a_thousand_entities(spark):
    n = 1000
    text = " ".join(f"<ID{k}> < आयडी {k} >" for k in range(1, n + 1))
    df = spark.createDataFrame([("<ID1>", [(1, "a")])] + [(text, [(k, f"e{k}") for k in range(1, n + 1)])], "t string, e array<struct<serial:int,entity:string>>")
    run = lambda rows: [r.o for r in rows.select(st.restore_entities(F.col("t"), F.col("e")).alias("o")).collect()]
    run(df.filter("size(e) = 1"))
    start = time.monotonic()
    (got,) = run(df.filter("size(e) > 1"))
    assert time.monotonic() - start < 5
    assert got == " ".join(f"e{k} e{k}" for k in range(1, n + 1))
