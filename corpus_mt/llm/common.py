"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from corpus_mt.worker import worker_state

__all__ = ["SPACES", "line_pieces", "mix64", "small_batches", "text_slices", "worker_state"]

# --- fixed values: the white space of word rules, as in [\x20\x09-\x0D] ---------------
SPACES = " \t\n\x0b\f\r"
# ---------------------------------------------------------------------------------------


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hands at most ``rows`` rows at once to the Python functions of jobs run inside.

    Whole texts are long: a batch of the usual size can take more memory than the work on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most_bytes`` of text each; a longer text is alone."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, ends[start] + most_bytes, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def line_pieces(line: bytes, most_bytes: int) -> Iterator[bytes]:
    """A text whose words are parted by spaces, in pieces of about ``most_bytes``; no word is cut."""
    at = 0
    while at < len(line):
        stop = len(line)
        if stop - at > most_bytes:
            stop = line.rfind(b" ", at, at + most_bytes) + 1
            if stop <= at:  # a word longer than a piece
                stop = line.find(b" ", at + most_bytes)
                stop = len(line) if stop < 0 else stop
        yield line[at:stop]
        at = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all their bits (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
