"""Text functions against literal cases and against plain Python."""

import random
import re
import time
import unicodedata
from hashlib import sha256

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import sentences as st
from corpus_mt.functions import text as tx
from corpus_mt.functions import url as ur
from corpus_mt.functions.unicode import needs_nfkc
from corpus_mt.operators.template import template_documents

MIX = hs.text(alphabet=list("ab1.?!|\n -*#<>/()\"',:%@éİﬁ²  ।۔००²ßकि़́À̀"), max_size=40)
SLOW = settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", make(F.col("t")).alias("o")).orderBy("i").select("o").collect()]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("### What is templating?\n\n< The Answer is present here >", ["what is templating?", "the answer is present here"]),
        ("in 1999. next.", ["in 1999. next."]),
        ("a e.g. x", ["a e.", "g.", "x"]),
        ("a|b", ["a", "b"]),
        ("1. item one.", ["item one."]),
        ("...", ["."]),
    ],
)
def test_sentence_cases(spark, text, want):
    assert values(spark, [text], lambda c: tx.sentence_substrings(tx.canonical_text(c))) == [want]


def plain_sentences(text):
    """Cut behind every delimiter but dots next to a digit; edge symbols, then white space, then a bullet go."""
    marked = re.sub(r"(?<!\d)\.(?!\d)|[?!।|॥؟۔\n]\n*", lambda m: m[0] + "\x01", text)
    bare = [p.strip(tx.EDGE_SYMBOLS).strip() for p in marked.split("\x01")]
    return list(dict.fromkeys(s for s in (re.sub(r"^([•○*-]|[0-9]+\.)", "", p).strip() for p in bare) if s))


@SLOW
@given(hs.lists(MIX, min_size=20, max_size=40))
def test_sentences_are_clean_distinct_parts_of_the_text(spark, texts):
    texts = [*texts, " #1", "# 1.x", "*- a. -b"]
    plain = [unicodedata.normalize("NFKC", t).lower() for t in texts]
    for text, got in zip(plain, values(spark, texts, lambda c: tx.sentence_substrings(tx.canonical_text(c))), strict=True):
        assert got == plain_sentences(text)
        # Every letter of the text is in some sentence.
        assert {c for c in text if c.isalpha()} <= set("".join(got))


@SLOW
@given(hs.lists(hs.text(alphabet=hs.characters(exclude_categories=["Cs"]), max_size=8), min_size=30, max_size=60))
def test_nfkc_test_never_misses(spark, texts):
    flags = values(spark, texts, needs_nfkc)
    assert all(unicodedata.normalize("NFKC", t) == t for t, flag in zip(texts, flags) if not flag)


@SLOW
@given(hs.lists(MIX, min_size=20, max_size=40))
def test_pieces_join_to_the_text(spark, texts):
    assert values(spark, texts, lambda c: F.array_join(tx.split_keeping_delimiters(c), "")) == texts


def test_chunks_may_keep_one_empty_string(spark):
    assert values(spark, ["##\nx\n\n--\nx"], tx.chunk_substrings) == [["", "x"]]


def test_unknown_mode_is_an_error():
    with pytest.raises(ValueError):
        tx.substrings(None, "word")


def test_terminal_lines(spark):
    assert values(spark, ["ok.\nmore...\nnone\n\nso:", ""], tx.keep_terminal_lines) == ["ok.\nso:", ""]


@pytest.mark.parametrize(
    ("url", "host", "source"),
    [
        ("https://wikipedia.org/x", "ikipedia.org", "ikipedia"),
        ("localhost", "localhost", "localhost"),
        ("http://www.a.b.co.uk/p?q#f", "a.b.co.uk", "a_b_co"),
        ("https://u@h.com:80", "u@h.com:80", "u@h"),
        ("", None, None),
    ],
)
def test_sources(spark, url, host, source):
    assert values(spark, [url], ur.source_name) == [source]
    if host:
        assert values(spark, [url], ur.host) == [host]


def test_template_drops_and_hashes(spark):
    df = spark.createDataFrame(
        [(0, "A b", "http://x.com"), (7, "c", None), (8, None, None), (9, "", None), (10, "None", None)],
        "id int, content string, u string",
    )
    rows = {r.text: r for r in template_documents(df, id_col="id", url_col="u", source_type="web").collect()}
    assert set(rows) == {"a b", "c"}
    assert rows["a b"].doc_id == sha256(b"http://x.comNonea bweb").hexdigest()
    assert rows["c"].doc_id == "7" and rows["c"].timestamp == "None" and rows["a b"].source == "x"
    assert rows["c"].sids == [sha256(b"c").hexdigest()]


def test_timestamps(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05' a, timestamp_ntz'2024-01-02 03:04:05.5' b")
    row = df.select(tx.timestamp_text(F.col("a")), tx.plain_timestamp(F.col("a")), tx.plain_timestamp(F.col("b"))).first()
    assert tuple(row) == ("01/02/2024, 03:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:05.500000")


def py_punct(t):
    for a, b in st.PUNCTUATION:
        t = t.replace(a, b)
    t = re.sub("[ ]{2,}", " ", t)
    t = re.sub(r"\) ([\.!:?;,])", r")\1", t)
    t = re.sub(r"(\d) %", r"\1%", t)
    t = re.sub(r'"([,\.]+)', r'\1"', t)
    return re.sub("(\\d)\u00a0(\\d)", r"\1.\2", t).strip()


@SLOW
@given(hs.lists(hs.text(alphabet=list("a1 .,:;()%!?'\"`\u00a0«»„“”–—´‘‚’…ºn\r"), max_size=30), min_size=20, max_size=40))
def test_punctuation_like_python(spark, texts):
    assert values(spark, texts, st.normalize_punctuation) == [py_punct(t) for t in texts]


def test_numerals(spark):
    assert values(spark, ["९౦౧٠١"], st.normalize_numerals) == ["9౦1" + "0١"]


WORDS = (
    "a@b.com x.y.co/p?q=1 http://e.org. e.g. 12/10/2023 10.5% 3-4 99:99:99 9.5 #tag @me a|b word é.fr ~5% 1,234,567".split()
    + [" ", "  ", ".", ",", "\t"]
)


@SLOW
@given(hs.lists(hs.lists(hs.sampled_from(WORDS), max_size=12).map(" ".join), min_size=20, max_size=40))
def test_entities_are_numbered_in_turn_and_put_back(spark, texts):
    spaced = [" ".join(t.split()) for t in texts]
    wrapped = values(spark, texts, st.wrap_entities)
    for text, got in zip(spaced, wrapped, strict=True):
        entities = [e.entity for e in got.entities]
        assert [e.serial for e in got.entities] == list(range(1, len(entities) + 1)) and len(set(entities)) == len(entities)
        back = got.text
        for e in got.entities:
            back = back.replace(f"<ID{e.serial}>", e.entity)
        assert back.split() == text.split() and not re.search("@b|e[.]org", got.text)


@pytest.mark.parametrize(
    ("text", "want", "entities"),
    [
        ("mail a@b.com or a@b.com", "mail <ID1> or <ID1>", ["a@b.com"]),
        ("see x.y.co/p?q=1, 12/10/2023", "see <ID1>, <ID2>", ["x.y.co/p?q=1", "12/10/2023"]),
        ("9.5 or 10.5% of #tag", "9.5 or <ID1> of <ID2>", ["10.5%", "#tag"]),
        ("a.b has too few", "a.b has too few", []),
    ],
)
def test_entity_cases(spark, text, want, entities):
    got = values(spark, [text], st.wrap_entities)[0]
    assert (got.text, [e.entity for e in got.entities]) == (want, entities)


@pytest.mark.parametrize(
    ("name", "alphabet"),
    [("EMAIL", "ab.@-_Z|%1"), ("URL", "ab.-/:?h_é#%t ps."), ("NUMERAL", "1234.5%~- :,/+'९."), ("HANDLE", "aB1#|@é_ ")],
)
def test_searched_patterns_match_what_the_plain_ones_match(spark, name, alphabet):
    rng = random.Random(5)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 16))) for _ in range(4000)]
    texts += ["http://" + t for t in texts[:500]] + [t + " https://" + t for t in texts[:500]]
    find = lambda p: lambda c: F.regexp_extract_all(c, F.lit(p), 0)
    assert values(spark, texts, find(getattr(st, f"_{name}_SEARCH"))) == values(spark, texts, find(getattr(st, name)))


@pytest.mark.parametrize("text", ["9" * 100_000, "a." * 50_000, "a" * 100_000 + "@", "." + "a" * 100_000, "1." * 50_000, "a@" * 50_000])
def test_entity_search_of_long_runs_ends(spark, text):
    start = time.monotonic()
    values(spark, [text], lambda c: F.struct(st.email_spans(c), st.url_spans(c), st.numeral_spans(c), st.handle_spans(c)))
    assert time.monotonic() - start < 20  # a run cut in every way would take hours


def test_entity_restore_round_trip(spark):
    texts = ["mail a@b.com or see http://www.x.org/a?b on 12/10/2023, 99.5% #tag"]
    back = lambda c: st.restore_entities(st.wrap_entities(c)["text"], st.wrap_entities(c)["entities"])
    assert values(spark, texts, back) == texts


def test_translated_placeholders_are_restored(spark):
    df = spark.sql("select 'x < ID1 > [आयडी 2] <आईडी1>' t, array(struct(1 serial, 'A' entity), struct(2 serial, 'B' entity)) e")
    assert df.select(st.restore_entities(F.col("t"), F.col("e"))).first()[0] == "x A B A"
    assert len(df.select(st.entity_map(F.col("e")).alias("m")).first().m) == 200


@pytest.mark.parametrize("tag", [t for t in lang.LANGUAGE_CODES if lang.language_code(t) in ("bn", "gu", "kn", "te", "ml", "pa", "or")])
def test_script_round_trip(spark, tag):
    start = lang.BLOCK_START[lang.language_code(tag)]
    word = "".join(chr(start + o) for o in (0x15, 0x3E, 0x2E, 0x32))
    there = values(spark, [word], lambda c: lang.to_devanagari(c, tag))
    if lang.script_of(tag) not in lang.UNCONVERTED_SCRIPTS:
        assert there == ["".join(chr(0x0900 + o) for o in (0x15, 0x3E, 0x2E, 0x32))]
        assert values(spark, there, lambda c: lang.from_devanagari(c, tag)) == [word]


def test_unknown_language():
    with pytest.raises(ValueError):
        lang.language_code("xxx_Latn")


def test_pairs():
    assert [len(lang.language_pairs(d)) for d in ("en-indic", "indic-en", "indic-indic")] == [22, 22, 462]


def test_plain_text_takes_the_short_way_to_the_same_words(spark):
    rng = random.Random(3)
    plain = ["", "a.", ",", ",,", "a,b", "a,.", ", a", "l'été, œuvre-là.", "'a'", " a b "]
    plain += ["".join(rng.choice(["a", "B", "é", "ŏ", " ", ",", "'", "-"]) for _ in range(9)) for _ in range(300)]
    plain = [t for t in plain if "  " not in t and "''" not in t]
    other = ["a  b", "it''s", "a.b", "a. b.", "1", "a;", "x×y", "(a)", "a\tb", "क", "a.\n", "²"]
    assert values(spark, plain, st._is_plain) == [True] * len(plain)
    assert values(spark, other, st._is_plain) == [False] * len(other)

    def words(t: str) -> str:
        t = re.sub(r"([^\d]),", r"\1 , ", t)
        t = re.sub(r"([^\W\d_])'([^\W\d_])", r"\1 '\2", re.sub(r",([^\d])", r" , \1", t))
        t = re.sub(r"\.\Z", " .", t) if re.search(r"[^.]\.\Z", t) else t
        return re.sub(" {2,}", " ", t).strip()

    got = values(spark, plain, lambda c: st.preprocess_sentence(c, lang.ENGLISH))
    assert [(r.text, r.entities) for r in got] == [(words(t.strip()), []) for t in plain]


def test_texts_without_stops_beyond_ascii_are_cut_by_a_smaller_class(spark):
    texts = ["a. b! c|d\n\ne 3.5 f.", "a۔b. c؟ d॥", "é. ü! x", "a।\nb"]
    assert tx._ASCII_STOPS == "?!|"
    assert values(spark, texts, tx.split_keeping_delimiters) == values(spark, texts, lambda c: F.split(c, tx._cut_after(tx.HARD_STOPS)))
