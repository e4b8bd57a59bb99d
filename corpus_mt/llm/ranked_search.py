"""Ranked lexical search: best-first over intervals of documents, bounded by range maxima.

Documents are cut into chunks.  In a chunk every query term has a posting list in document order and a
sparse table over the impacts of its postings, which tells the greatest one of any range and its
document in two lookups.  An interval of documents is bounded by the sum of its terms' weighted
maxima.  The best interval is split at the document with the greatest share of the sum; that document is scored
in full, and both halves get bounds of their own.  Intervals below the worst of an item's best documents
are never opened.

Chunks are searched where their documents are, and only an item's best documents of a task move.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.llm.common import line_pieces, small_batches, text_slices
from corpus_mt.session import stage_table

TOP = 50
# Weights and impacts are whole numbers: a weight in thousandths, an impact from 0 to a million.
WEIGHT_UNIT, IMPACT_UNIT, TF_UNIT, LENGTH_UNIT = 1_000, 1_000_000_000, 1_000, 20
# Share of the mean length, in hundredths, that a document's length counts with.
LENGTH_SHARE = 50
# Terms of the items that are searched for at once, about, postings and documents of a chunk, intervals opened at once.
ITEM_TERMS, CHUNK_POSTINGS, CHUNK_DOCS, OPENED = 500_000, 1 << 19, 1 << 15, 64
# Parts in which the tasks' results for an item are first ranked.
MERGE_PARTS = 32
SLICE_BYTES, BATCH_ROWS = 1 << 20, 500
_DOC_BITS = 20  # a chunk has fewer documents
_NO_ID = np.iinfo(np.int64).max

# ASCII letters and digits and all other characters make up terms; A-Z are lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, with repeats, in pieces."""
    for piece in line_pieces(text.translate(_FOLD), SLICE_BYTES):
        yield piece.split()


def _bodies(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    texts = column.fill_null("")
    for a, b in text_slices(texts, 8 * SLICE_BYTES):
        yield a, texts.slice(a, b - a).cast(pa.large_string()).cast(pa.large_binary())


def item_terms(items: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """Distinct ``item, term`` of the items, a term as its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, bodies in _bodies(batch.column(1)):
                for k, body in enumerate(bodies):
                    found = sorted({t for terms in terms_of(body.as_py()) for t in terms})
                    item = batch.column(0).slice(at + k, 1).take(pa.array(np.zeros(len(found), np.int64)))
                    yield pa.RecordBatch.from_arrays([item, pa.array(found, pa.binary())], ["item", "term"])

    kind = items.schema[key].dataType.simpleString()
    return items.select(F.col(key).alias("item"), F.col(text).alias("text")).mapInArrow(run, f"item {kind}, term binary").distinct()


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``id, n, terms, tfs`` of every row: all its terms counted, and those of the vocabulary one by one."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            for at, bodies in _bodies(batch.column(1)):
                sizes, terms, tfs = [], [], []
                for body in bodies:
                    n, seen = 0, Counter()
                    for words in terms_of(body.as_py()):
                        n += len(words)
                        seen.update(map(known, words))
                    seen.pop(None, None)
                    sizes.append(n)
                    terms.append(list(seen))
                    tfs.append(list(seen.values()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(bodies)), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                    ["id", "n", "terms", "tfs"],
                )

    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<bigint>")


class Chunk:
    """Posting lists of some documents, sorted by id, with a sparse table of range maxima.

    A posting is its impact and, in the low bits, its document counted from the end, so that of equal
    impacts the first document's is the greatest.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, total: int, mean: tuple[int, int]):
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.ids, self.n = ids[order], len(ids)
        doc = np.repeat(place, sizes)
        docs, all_terms = mean
        m = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * docs // all_terms
        impact = IMPACT_UNIT * tfs // (TF_UNIT * tfs + LENGTH_UNIT * np.repeat(m, sizes))
        self.keys = terms.astype(np.int64) * self.n + doc
        by_term = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[by_term]
        self.starts = np.searchsorted(self.keys, np.arange(total + 1, dtype=np.int64) * self.n)
        level = (impact << _DOC_BITS | ((1 << _DOC_BITS) - 1 - doc))[by_term]
        longest = int(np.diff(self.starts).max(initial=0))
        self.levels = np.zeros((max(1, longest.bit_length()), len(level) + 1), np.int64)
        self.levels[0, :-1] = level
        for j in range(1, len(self.levels)):
            step, below = 1 << (j - 1), self.levels[j - 1]
            self.levels[j] = below
            np.maximum(below[:-step], below[step:], out=self.levels[j, :-step])
        self.log = np.zeros(longest + 1, np.int64)
        self.log[1:] = np.frexp(np.arange(1, longest + 1))[1] - 1

    def bounds(self, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of posting ranges, one per term: the sum of weighted maxima, and the document with the largest share."""
        size = high - low
        j = self.log[size]
        top = np.maximum(self.levels[j, low], self.levels[j, np.maximum(high - (1 << j), 0)])
        share = np.where(size > 0, weights * (top >> _DOC_BITS), 0)
        first = top[np.arange(len(top)), share.argmax(1)]
        return share.sum(1), (1 << _DOC_BITS) - 1 - (first & ((1 << _DOC_BITS) - 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores and ids, ranked) with the documents of the chunk that belong there."""
        low, high = self.starts[terms][None], self.starts[terms + 1][None]
        from_doc = np.zeros(1, np.int64)
        bound, split = self.bounds(low, high, weights)
        while True:
            # What cannot get in: less than the last of the best, or as much and with no smaller id.
            least, last = (best[0][-1], best[1][-1]) if len(best[0]) == top else (1, _NO_ID)
            open_ = (bound > least) | ((bound == least) & (self.ids[np.minimum(from_doc, self.n - 1)] <= last))
            if not open_.all():
                low, high, from_doc, bound, split = (x[open_] for x in (low, high, from_doc, bound, split))
            if not len(bound):
                return best
            # The best intervals; of equal ones those with the smallest ids.
            order = np.lexsort((from_doc, -bound))
            now, later = order[:OPENED], order[OPENED:]
            a, b, at = low[now], high[now], split[now]
            target = terms * self.n + at[:, None]
            cut = np.searchsorted(self.keys, target)
            held = (cut < b) & (self.keys[np.minimum(cut, len(self.keys) - 1)] == target)
            score = (np.where(held, self.levels[0, cut] >> _DOC_BITS, 0) * weights).sum(1)
            found = (np.concatenate([best[0], score[score > 0]]), np.concatenate([best[1], self.ids[at[score > 0]]]))
            rank = np.lexsort((found[1], -found[0]))[:top]
            best = found[0][rank], found[1][rank]
            halves = np.concatenate([a, cut + held]), np.concatenate([cut, b])
            new_bound, new_split = self.bounds(*halves, weights)
            low, high = np.concatenate([low[later], halves[0]]), np.concatenate([high[later], halves[1]])
            from_doc = np.concatenate([from_doc[later], from_doc[now], at + 1])
            bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


def _chunks(batches: Iterator[pa.RecordBatch], total: int, mean: tuple[int, int]) -> Iterator[Chunk]:
    """Chunks of documents that have terms; a document is never cut."""
    held, docs, postings = [], 0, 0

    def build() -> Chunk:
        return Chunk(*(np.concatenate(c) for c in zip(*held, strict=True)), total, mean)

    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy().astype(np.int64)
        ids = batch.column(0).fill_null(_NO_ID).to_numpy()
        lengths, terms, tfs = batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        a = 0
        while a < len(ids):
            room = int(np.searchsorted(ends, ends[a] + CHUNK_POSTINGS - postings, "right")) - 1
            b = min(max(room, a + (not held)), a + CHUNK_DOCS - docs, len(ids))
            if b > a:
                held.append((ids[a:b], lengths[a:b], sizes[a:b], terms[ends[a] : ends[b]], tfs[ends[a] : ends[b]]))
                docs, postings, a = docs + b - a, postings + int(ends[b] - ends[a]), b
            if a < len(ids):
                yield build()
                held, docs, postings = [], 0, 0
    if held:
        yield build()


def _ranked(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """``item_key, rank, key, score``: the ``top`` highest-scoring rows of ``docs`` with a score above 0 for every item.

    Equal scores rank by ascending key, a null key last.  Repeated rows each count and are each ranked; rows of ``items`` with
    one key are one item with the terms of all.  Null and empty texts have no terms: such documents are
    never found, such items give no rows.  Texts are taken whole, in pieces.  Items are searched in groups of
    about ``ITEM_TERMS`` terms, which bounds what is broadcast; a single item is not divided.  An empty table on either
    side gives no rows; other columns play no part.
    """
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType.simpleString()
    wanted = stage_table(item_terms(items, item_text, item_key), "item_terms")
    groups = -(-wanted.count() // ITEM_TERMS)
    found = [_search_group(docs, wanted.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g), top, text, key, kind) for g in range(groups)]
    found = [f for f in found if f is not None]
    named = [F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score"]
    if not found:
        return spark.createDataFrame([], f"item {kind}, rank int, doc bigint, score bigint").select(*named)
    return reduce(DataFrame.unionByName, found).select(*named)


def _search_group(docs: DataFrame, wanted: DataFrame, top: int, text: str, key: str, kind: str) -> DataFrame | None:
    spark = docs.sparkSession
    listed = wanted.collect()  # about ITEM_TERMS rows
    vocabulary = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in listed}))}
    by_item: dict = {}
    for r in listed:
        by_item.setdefault(r["item"], []).append(vocabulary[bytes(r["term"])])
    if not by_item:
        return None
    names = list(by_item)
    with small_batches(spark, BATCH_ROWS):
        counted = stage_table(count_terms(docs, vocabulary, text, key), "term_counts")
    n, total = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    if not n:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    held = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toPandas()
    df[held["t"].to_numpy(np.int64)] = held["df"].to_numpy()
    weights = np.array([math.floor(WEIGHT_UNIT * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    asked = []
    for name in names:
        terms = np.array(sorted(by_item[name]), np.int64)
        terms = terms[(df[terms] > 0) & (weights[terms] > 0)]
        asked.append((terms, weights[terms]))
    shared = spark.sparkContext.broadcast((asked, len(vocabulary), (int(n), int(total))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, size, mean = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(searches)
        for chunk in _chunks(batches, size, mean):
            for k, (terms, weight) in enumerate(searches):
                if len(terms):
                    best[k] = chunk.search(terms, weight, best[k], top)
        for k, (score, ids) in enumerate(best):
            doc = pa.array(ids, mask=ids == _NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), k, np.int32)), doc, pa.array(score)], ["no", "doc", "score"])

    rows = counted.filter(F.size("terms") > 0).mapInArrow(run, "no int, doc bigint, score bigint")
    part = F.pmod(F.xxhash64("doc", "score"), F.lit(MERGE_PARTS)).alias("part")
    rows = _ranked(rows.select("*", part), ["no", "part"], top).drop("rank", "part")
    table = spark.createDataFrame(list(enumerate(names)), f"no int, item {kind}")
    return _ranked(rows, ["no"], top).join(F.broadcast(table), "no").select("item", "rank", "doc", "score")
