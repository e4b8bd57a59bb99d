"""Best-fit packing of token sequences, with large items matched first.

An item above a third of the capacity shares a bin with one other such item at most, so
these are matched greedily, largest first, each with the largest partner that fits.  The
smaller ones then go, largest first, to the smallest gap that holds them.

Items of the same length are alike.  The plan is therefore made on the histogram of
lengths, whose size is the capacity and not the number of rows, and says which ranks of a
length go where; every row finds its place from its length and its rank in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.llm.token_count import load_tokens
from corpus_mt.session import stage_table

CAPACITY = 4096
END_ID = 1
_RANK_BITS = 48
# Windows whose sequences are numbered together.
SPAN_WINDOWS = 4096


def plan_bins(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Runs ``(length, first rank, items per bin, first bin, offset)`` and the number of bins.

    Runs are few whatever the counts: matching makes two per pair of lengths met, a gap
    shrinks to less than half whenever a length fills it, and each length leaves at most
    two new kinds of gap.
    """
    if any(n and not 0 < length <= capacity for length, n in histogram.items()):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    left = [0] * (capacity + 1)
    for length, n in histogram.items():
        left[length] = n
    handed = [0] * (capacity + 1)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: first bin, bins
    runs: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(length: int, per_bin: int, first: int, n: int, gap: int) -> int:
        runs.append((length, handed[length], per_bin, first, capacity - gap))
        handed[length] += per_bin * n
        left[length] -= per_bin * n
        return gap - per_bin * length

    third = capacity // 3
    for a in range(capacity, third, -1):
        while left[a]:
            b = min(a, capacity - a)
            while b > third and left[b] - (a == b) <= 0:
                b -= 1
            pair = b > third
            n = left[a] // 2 if a == b else min(left[a], left[b]) if pair else left[a]
            gap = put(a, 1, bins, n, capacity)
            if pair:
                gap = put(b, 1, bins, n, gap)
            gaps[gap].append((bins, n))
            bins += n
    for s in range(third, 0, -1):
        for gap in range(s, capacity + 1):
            while left[s] and (gaps[gap] or gap == capacity):
                per_bin = gap // s
                if gaps[gap]:
                    first, n = gaps[gap].pop()
                else:  # no gap holds it: new bins
                    first, n = bins, -(-left[s] // per_bin)
                    bins += n
                full = min(n, left[s] // per_bin)
                if full:
                    gaps[put(s, per_bin, first, full, gap)].append((first, full))
                if full < n and left[s]:
                    gaps[put(s, left[s], first + full, 1, gap)].append((first + full, 1))
                    full += 1
                if full < n:
                    gaps[gap].append((first + full, n - full))
            if not left[s]:
                break
    return np.array(sorted(runs), np.int64).reshape(-1, 5), bins


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row per piece: ``key, piece, start, length, ids_crc32, _part, _rank``.

    A document's ids and the end id are cut every ``capacity`` ids.  ``_rank`` counts the
    pieces of the same length in the partition ``_part`` so far.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = load_tokens(path), TaskContext.get().partitionId()
        end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity
        seen = [0] * (capacity + 1)
        for batch in batches:
            row, place, length, crc, rank = [], [], [], [], []
            for i, ids in enumerate(tokens.ids(s.as_py() or "" for s in batch.column(1))):
                ids += end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    n = len(piece) // 4
                    row.append(i)
                    place.append(at // step)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    rank.append(seen[n])
                    seen[n] += 1
            place = np.array(place, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(place),
                    pa.array(place.astype(np.int64) * capacity),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(len(row), part, np.int64)),
                    pa.array(rank, pa.int64()),
                ],
                ["key", "piece", "start", "length", "ids_crc32", "_part", "_rank"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _part bigint, _rank bigint"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id, offset`` to staged rows of ``length, _part, _rank``.

    Ranks run on from partition to partition through one row per partition and length; no
    length, however common, meets in one task.
    """
    counts = pieces.groupBy("_part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan_bins(histogram, capacity)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    starts = (runs[:, 0] << _RANK_BITS) + runs[:, 1]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        run = runs[np.searchsorted(starts, (length.to_numpy() << _RANK_BITS) + rank.to_numpy(), "right") - 1]
        bin_, in_bin = np.divmod(rank.to_numpy() - run[:, 1], run[:, 2])
        return pd.DataFrame({"sequence_id": run[:, 3] + bin_, "offset": run[:, 4] + in_bin * length.to_numpy()})

    ranked = pieces.join(bases, ["_part", "length"])
    placed = ranked.withColumn("_at", place("length", F.col("_base") + F.col("_rank")))
    return placed.select(*[c for c in pieces.columns if c not in ("_part", "_rank")], "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``: every piece and its place.

    Null and empty texts are a single end id.  Null and repeated keys are packed like any
    other row; other columns play no part.  An empty table gives no rows.
    """
    pieces = stage_table(token_pieces(docs, path, capacity, text, key), "pieces")
    return place_pieces(pieces, capacity).withColumnRenamed("key", key)


def pack_windows(docs: DataFrame, path: str, window: str, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Like ``pack_documents``, but only documents of one window share a sequence, and sequences are numbered in window order.

    ``window`` numbers windows from 0; each is planned in one task that holds no texts, so they should be of bounded size.
    """
    boxed = docs.select(F.struct(F.col(key).alias("k"), F.col(window).cast("bigint").alias("w")).alias("_key"), F.col(text).alias("_text"))
    pieces = token_pieces(boxed, path, capacity, "_text", "_key").drop("_part", "_rank")
    pieces = stage_table(pieces.select(F.col("key.k").alias("key"), F.col("key.w").alias("_window"), "piece", "start", "length", "ids_crc32"), "pieces")

    def place(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        runs, _ = plan_bins(dict(zip(*(x.tolist() for x in np.unique(length, return_counts=True)), strict=True)), capacity)
        rank = pd.Series(length).groupby(length).cumcount().to_numpy()
        run = runs[np.searchsorted((runs[:, 0] << _RANK_BITS) + runs[:, 1], (length << _RANK_BITS) + rank, "right") - 1]
        bin_, in_bin = np.divmod(rank - run[:, 1], run[:, 2])
        return table.append_column("_bin", pa.array(run[:, 3] + bin_)).append_column("offset", pa.array(run[:, 4] + in_bin * length))

    kind = pieces.schema["key"].dataType.simpleString()
    schema = f"key {kind}, _window bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _bin bigint, offset bigint"
    placed = stage_table(pieces.groupBy("_window").applyInArrow(place, schema), "placed")
    bins = placed.groupBy("_window").agg((F.max("_bin") + 1).alias("n")).withColumn("_span", F.floor(F.col("_window") / SPAN_WINDOWS))
    offsets, end = [], 0
    for span, n in sorted(tuple(r) for r in bins.groupBy("_span").agg(F.sum("n")).collect()):  # one row for SPAN_WINDOWS windows
        offsets.append((span, end))
        end += n
    spans = F.broadcast(docs.sparkSession.createDataFrame(offsets, "_span bigint, _from bigint"))
    before = Window.partitionBy("_span").orderBy("_window").rowsBetween(Window.unboundedPreceding, -1)
    firsts = bins.withColumn("_first", F.coalesce(F.sum("n").over(before), F.lit(0))).join(spans, "_span")
    numbered = placed.join(firsts.select("_window", (F.col("_from") + F.col("_first")).alias("_first")), "_window")
    return numbered.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_bin")).alias("sequence_id"), "offset")
