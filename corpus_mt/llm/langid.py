"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is fitted on a bounded sample of labelled rows and is one matrix of
log-probabilities (buckets by languages), sent to every task.  Texts are scored whole, a
few megabytes at a time: numpy hashes the n-grams that occur, gathers their rows of the
matrix and sums them per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.llm.common import text_slices, worker_state

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
BUCKET_BITS = 15
# Labelled rows the model is fitted on, at most.
SAMPLE_ROWS = 20_000
# Numbers of the matrix, about: beyond a thousand languages there are fewer buckets, down to LEAST_BITS.
MATRIX, LEAST_BITS = 1_000 << BUCKET_BITS, 10
SMOOTHING = 0.5
# Text scored at once.
SLICE_BYTES = 1 << 19

_SPACE = 32


def _folding() -> np.ndarray:
    """For every code point its lower case if it is a letter, else a space."""

    def make() -> np.ndarray:
        table = np.full(0x110000, _SPACE, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        return table

    return worker_state("letters", make)


def _fold(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of a slice of texts, each behind one space, and the n + 1 offsets.

    Whatever isn't a letter is a space, and a run of spaces counts once.
    """
    joined = "\0".join([t or "" for t in texts.to_pylist()])
    codes = np.frombuffer(("\0" + joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _folding()[codes]
    # A text's own NULs must not look like ends: count code points instead.
    sizes = np.fromiter((0 if t is None else len(t) for t in texts.to_pylist()), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    keep = folded != _SPACE
    keep[1:] |= folded[:-1] != _SPACE
    keep[starts[:-1]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    return folded[keep], places[starts]


def bucket_bits(languages: int) -> int:
    """Bits of a bucket, so that the matrix of so many languages keeps to its size."""
    bits = BUCKET_BITS
    while bits > LEAST_BITS and languages << bits > MATRIX:
        bits -= 1
    return bits


def _buckets(folded: np.ndarray, n: int, bits: int = BUCKET_BITS) -> np.ndarray:
    """Bucket of the n-gram that ends at each code point."""
    h = np.full(len(folded), n, np.uint32)
    for back in range(n):
        shifted = folded if not back else np.concatenate([np.full(back, _SPACE, np.uint32), folded[:-back]])[: len(folded)]
        h = (h ^ shifted) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def _grams(folded: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Per order the bucket at each code point, or one past the last where no letter is or the n-gram would leave the text."""
    index = np.arange(len(folded)) - np.repeat(offsets[:-1], np.diff(offsets))
    for n in ORDERS:
        inside = index >= n - 1
        if n == 1:
            inside &= folded != _SPACE
        yield np.where(inside, _buckets(folded, n, bits).astype(np.int64), 1 << bits)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


class Model(NamedTuple):
    """Languages in order and the log-probabilities; the last row, of zeros, stands for no n-gram.

    The matrix is stored by columns, which is how scoring reads it.
    """

    languages: list[str]
    matrix: np.ndarray


def from_counts(languages: list[str], counts: np.ndarray) -> Model:
    smooth = counts + SMOOTHING
    return Model(languages, np.asfortranarray(np.vstack([np.log(smooth) - np.log(smooth.sum(0, keepdims=True)), np.zeros((1, len(languages)))])))


def score_texts(texts: pa.Array, languages: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its posterior probability, all languages being as likely before."""
    if not languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    names: list[str] = []
    scores = [np.zeros(0)]
    columns, bits = np.ascontiguousarray(matrix.T), (len(matrix) - 1).bit_length() - 1
    for a, b in text_slices(texts, SLICE_BYTES):
        folded, offsets = _fold(texts.slice(a, b - a))
        letters = np.add.reduceat(folded != _SPACE, offsets[:-1])
        totals = np.zeros((b - a, len(languages)))
        for buckets in _grams(folded, offsets, bits):
            for k in range(len(languages)):
                totals[:, k] += np.add.reduceat(np.take(columns[k], buckets), offsets[:-1])
        p = 1.0 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
        names += [languages[k] if n else UNDETERMINED for k, n in zip(totals.argmax(1), letters, strict=True)]
        scores.append(np.where(letters > 0, p, 0.0))
    return names, np.concatenate(scores)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the matrix on up to about ``sample_rows`` labelled rows, the same number from each language.

    Rows are chosen by a hash of ``key``, so the same table gives the same model.  A
    language with fewer rows gives all of them.  Only counts per bucket and language
    come back to the driver.  However many languages there are, the matrix keeps to about
    ``MATRIX`` numbers, by fewer buckets.
    """
    known = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("at"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    bits = bucket_bits(len(languages))
    if not languages:
        return from_counts([], np.zeros((1 << bits, 0)))
    share = sample_rows / len(languages)
    # A hash below this is drawn.
    bars = {k: min(1.0, share / sizes[k]) * 2.0**64 - 2.0**63 for k in languages}
    spark = labelled.sparkSession
    table = spark.createDataFrame([(k, i, bars[k]) for i, k in enumerate(languages)], "lang string, i int, bar double")
    chosen = known.join(F.broadcast(table), "lang").filter(F.col("at").cast("double") <= F.col("bar")).select("i", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << bits), np.int64)
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1)
            for a, b in text_slices(texts, SLICE_BYTES):
                folded, offsets = _fold(texts.slice(a, b - a))
                owner = np.repeat(ids[a:b], np.diff(offsets)).astype(np.int64) << bits
                for buckets in _grams(folded, offsets, bits):
                    inside = buckets < 1 << bits
                    total += np.bincount(owner[inside] + buckets[inside], minlength=total.size).reshape(total.shape)
        i, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[i, bucket])], ["i", "bucket", "n"])

    counted = chosen.mapInArrow(count, "i int, bucket int, n bigint").groupBy("i", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # languages by buckets at most
    counts = np.zeros((1 << bits, len(languages)))
    counts[found["bucket"].to_numpy(), found["i"].to_numpy()] = found["n"].to_numpy()
    return from_counts(languages, counts)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; nothing but the text is looked at.

    Null, empty and letterless texts are ``und`` with score 0, and so is every text when no
    language was learned.  A tie goes to the language first in order.  Columns of ``docs``
    named like the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("lang_pred string, score double")
    def judge(texts: pa.Array) -> pa.Array:
        names, scores = score_texts(texts, *shared.value)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    judged = docs.withColumn("_judged", judge(F.col(text)))
    return judged.withColumns({"lang_pred": F.col("_judged.lang_pred"), "score": F.col("_judged.score")}).drop("_judged")


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept out of the fit: the CRC of its key as text leaves 1 by 3; a null key doesn't."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
