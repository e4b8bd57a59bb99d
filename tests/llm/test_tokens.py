"""Token counts and packing, against the library itself and by properties."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from tokenizers import Tokenizer

from corpus_mt.llm import packing
from corpus_mt.llm.token_count import WordTokens, count_tokens

WORDS = P.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n", "Don't we'll it's '''s", "<|endoftext|> x<|startoftext|>y <|", "naïve ÀÖß×÷ÿ ªº µ ²¼",
    "İstanbul ΣΟΦΟΣ ﬁne e\u0301 ", "\x85a\x1cb\u00a0c\u2003d", "日本語 हिन्दी العربية 🙂🙂", "1234567 3.14", "a" * 5000, "é" * 300 + " " + "!" * 300, "x\ty\rz\x00w",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def frame(spark, texts):
    rows = [(i, t, i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, key string")


def test_counts_of_odd_texts(spark, library):
    texts = [*ODD, " ".join(t or "" for t in ODD) * 40]
    got = {r.doc_id: r for r in count_tokens(frame(spark, texts), WORDS).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 2048)


@settings(max_examples=300, deadline=None)
@given(hs.text(alphabet=hs.characters(exclude_categories=["Cs"]), max_size=60) | hs.text(alphabet="aB'sé .!9<|\n\t", max_size=60))
def test_ids_like_the_library(text):
    own = test_ids_like_the_library.own = getattr(test_ids_like_the_library, "own", None) or WordTokens(WORDS)
    want = np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert list(own.ids([text, text])) == [want] * 2


def test_ids_outlive_a_full_cache(monkeypatch, library):
    monkeypatch.setattr("corpus_mt.llm.token_count.CHUNKS", 3)
    monkeypatch.setattr("corpus_mt.llm.token_count.PIECES", 3)
    own, texts = WordTokens(WORDS), [f"word{i} and more{i % 3} text" for i in range(50)]
    assert [len(b) // 4 for b in own.ids(texts)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_by_other_tokenizers(spark):
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = [r.n_tokens for r in count_tokens(frame(spark, ["a  b\n c", None]), P.path("piece_bpe_32k.model")).orderBy("doc_id").collect()]
    assert got == [len(piece.encode("a  b\n c")), 0]
    byte = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = [r.n_tokens for r in count_tokens(frame(spark, ["a  b\n c", ""]), P.path("byte_bpe_50k.json")).orderBy("doc_id").collect()]
    assert got == [len(byte.encode("a  b\n c").ids), 0]


def test_no_rows(spark):
    assert count_tokens(frame(spark, []), WORDS).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(frame(spark, []), WORDS).count() == packing.pack_documents(frame(spark, []), WORDS).count() == 0


def placed(histogram, capacity):
    """Every item of a plan as (bin, offset, length)."""
    runs, bins = packing.plan_bins(histogram, capacity)
    used, items = defaultdict(int), []
    for length, first, per_bin, first_bin, offset in runs.tolist():
        end = min([r[1] for r in runs.tolist() if r[0] == length and r[1] > first], default=histogram[length])
        for rank in range(first, end):
            b, k = divmod(rank - first, per_bin)
            items.append((first_bin + b, offset + k * length, length))
            used[length] += 1
    return items, bins, used


@settings(max_examples=200, deadline=None)
@given(hs.integers(3, 40).flatmap(lambda c: hs.tuples(hs.just(c), hs.dictionaries(hs.integers(1, c), hs.integers(0, 60), max_size=12))))
def test_plans_place_everything_without_gaps(case):
    capacity, histogram = case
    items, bins, used = placed(histogram, capacity)
    assert {k: v for k, v in used.items() if v} == {k: v for k, v in histogram.items() if v}
    by_bin = defaultdict(list)
    for b, offset, length in items:
        by_bin[b].append((offset, length))
    assert sorted(by_bin) == list(range(bins))
    for content in by_bin.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity and sum(3 * n > capacity for _, n in content) <= 2
    gaps = []  # first fit, largest first
    for length in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True):
        at = next((i for i, gap in enumerate(gaps) if gap >= length), len(gaps))
        gaps[at:] = [gaps[at] - length, *gaps[at + 1 :]] if at < len(gaps) else [capacity - length]
    assert bins <= len(gaps) * 1.1 + 1


def test_plan_size_does_not_follow_the_counts():
    rng = random.Random(1)
    small = {n: rng.randint(1, 9) for n in range(1, 4097)}
    a, _ = packing.plan_bins(small, 4096)
    b, _ = packing.plan_bins({n: c * 1_000_003 for n, c in small.items()}, 4096)
    assert len(a) < 60_000 and len(b) < 60_000


def test_lengths_out_of_range():
    with pytest.raises(ValueError):
        packing.plan_bins({9: 1}, 8)


def test_packed_ids_come_back(spark, library):
    texts = [*ODD, "the cat sat " * 3000, "the cat sat " * 3000, "b " * 4095, "b " * 4096] + ["same text"] * 200
    rows = packing.pack_documents(frame(spark, texts).repartition(5), WORDS).collect()
    assert rows[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.start for p in pieces] == list(range(0, len(ids), 4096))
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(ids[a : a + 4096].tobytes()) for a in range(0, len(ids), 4096)]
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    for content in ends.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 4096


def test_null_and_repeated_keys_are_packed(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, None), (3, "b")], "doc_id long, text string")
    rows = packing.pack_documents(df, WORDS).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 1), (False, 2), (True, 2), (True, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4
