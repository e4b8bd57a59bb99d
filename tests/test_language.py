"""Normal forms of scripts, and the full tokenisers, on literal text and by property."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import normalize as nz
from corpus_mt.functions import sentences as st
from corpus_mt.functions import tokenize as tz

CODES = ("hi", "mr", "bn", "as", "pa", "gu", "or", "ta", "te", "kn", "ml", "ur", "none")


def values(spark, texts, body):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2).select("i", body(F.col("t")).alias("v")).collect()
    return [r.v for r in sorted(rows)]


@pytest.mark.parametrize(
    "code, text, want",
    [
        ("hi", "क़‍ ऩ|", "क़ ऩ।"),
        ("hi", "क: क‌:: a:", "कः कः: a:"),
        ("mr", "ॲ—‘’", 'ए - "'),
        ("bn", "ো ৌ ড় ৷ |৥", "ো ৌ ড় । ।॥"),
        ("pa", "ੲਿ ਅਾ ਲ਼ ੤", "ਇ ਆ ਲ਼ ।"),
        ("gu", "ક:૤ x", "કઃ। x"),
        ("or", "ୈ ୋ ଵ ଏୗ ଡ଼", "ୈ ୋ ବ ଐ ଡ଼"),
        ("ta", "ொ ோ ஔ |", "ொ ோ ஔ |"),
        ("te", "ై క…", "ై క..."),
        ("kn", "ೋ ೊ ೋ ೀ", "ೋ ೊ ೋ ೀ"),
        ("ml", "ന്‍ ന് ൌ ൗ െ‍ാ", "ൻ ന് ൌ ൌ ൊ"),
        ("ur", "كي آ ٣ ﻮ ﷲ", "کی آ ۳ و اللہ"),
        ("none", "“a”﻿ |क़", '"a" |क़'),
    ],
)
def test_normal_forms(spark, code, text, want):
    assert values(spark, [text, None, ""], lambda c: nz.normalize_script(c, code)) == [want, None, ""]


@pytest.mark.parametrize("code", CODES)
def test_a_normal_form_stays(spark, code):
    rng, (single, *longer) = random.Random(code), nz.rules(code)
    runs = {k: v for table in longer for k, v in table.items()}
    start = lang.BLOCK_START.get(nz._SCRIPT_OF.get(code, code), 0x0640)
    chars = [*single, *"".join([*runs, *runs.values()]), *map(chr, range(start, start + 0x80)), ":", "|", "'", "´", " ", "a"]
    texts = ["".join(rng.choices(chars, k=rng.randrange(1, 12))) for _ in range(3000)] + list(runs) + list(single)
    once = values(spark, texts, lambda c: nz.normalize_script(c, code))
    assert values(spark, once, lambda c: nz.normalize_script(c, code)) == once
    assert not any(c in t for t in once for c in nz.DROPPED)
    if code == "hi":
        assert values(spark, texts[:50], lambda c: nz.normalize_indic(c, F.lit("san_Deva"))) == once[:50]
        assert values(spark, texts[:50], lambda c: nz.normalize_indic(c, "eng_Latn")) == texts[:50]


ENGLISH = [
    ("Mr. Smith paid $5,300.50, i.e. a lot... didn't he?", "Mr. Smith paid $ 5,300.50 , i.e. a lot ... didn 't he ?"),
    ("It's the U.S. army. The end.", "It 's the U.S. army . The end ."),
    ("See No. 5 or No. Five on pp. 3", "See No. 5 or No . Five on pp. 3"),
    ("the boys' toys, 5's \"x\" end.. ", "the boys ' toys , 5 's \" x \" end .."),
    ("a.b. C. d etc. next 1,", "a.b. C. d etc. next 1 ,"),
    ("he said 'no.'", "he said ' no . '"),
    (".", "."),
    ("....a", ".... a"),
    ("tab\there\x07  x", "tab here x"),
    (None, None),
    ("", ""),
]


def test_english_tokens(spark):
    assert values(spark, [t for t, _ in ENGLISH], tz.tokenize_english) == [w for _, w in ENGLISH]


CLEAN = [
    'He said "it\'s fine" (really) and paid $5,300.50 to Mr. Smith.',
    "Don't stop; the boys' house isn't far... is it?",
    "Dr. A. B. Jones [sic] owns 50% of Corp. Inc. today!",
    "One 'two three' four: 'five', \"six 'seven' eight\".",
]


def test_joining_tokens_gives_the_text_again(spark):
    assert values(spark, CLEAN, lambda c: tz.detokenize_english(tz.tokenize_english(c))) == CLEAN
    indic = ["क \"ख ग\" (घ), 12.5/3-ङ।", "'क' #ख: 10:30, ग?", "क `ख` 1/2/2020॥"]
    assert values(spark, indic, lambda c: tz.detokenize_indic(tz.tokenize_indic(c))) == indic


def test_joining_english_tokens(spark):
    cases = {
        "£ 5 [ x ] &quot; a &amp;amp; b &quot; a @-@ b": '£5 [x] "a &amp; b" a-b',
        "the boys ' house ' is ' big": "the boys' house 'is' big",
        " ' tis \" x": "'tis \"x",
        "'s first": "'s first",
        "": "",
        "  ": "",
    }
    assert values(spark, [*cases, None], tz.detokenize_english) == [*cases.values(), None]


def test_urdu_marks_stand_alone(spark):
    assert values(spark, ["ا،ب۔ x\\y 1.5"], tz.tokenize_urdu) == ["ا ، ب ۔ x\\y 1 . 5"]


def test_full_sentences_by_language(spark):
    rows = [("eng_Latn", "Mr. X can't pay 10.5% ..."), ("hin_Deva", "क़‍: 'x'|"), ("urd_Arab", "ك،"), ("sat_Olck", "a,b"), ("eng_Latn", None)]
    df = spark.createDataFrame(rows, "tag string, t string")
    got = [r.s.text for r in df.select(st.preprocess_sentence(F.col("t"), F.col("tag"), full=True).alias("s")).collect()]
    assert got == ["Mr. X can 't pay < ID1 > ...", "क़ः ' x ' ।", "ک ،", "a , b", None]


def test_long_lines_take_time_in_proportion(spark):
    text = "He's Mr. “X”, \"no\" one's e.g. fool... (5) " * 4_000
    start = time.perf_counter()
    (back,) = values(spark, [text], lambda c: tz.detokenize_english(tz.tokenize_english(c)))
    assert back.startswith("He's Mr. ") and time.perf_counter() - start < 60
