"""Hard negatives by table lookups: exact integer inner products without a multiplication.

Stored vectors are kept as bit planes: for every group of eight dimensions a byte per plane, which holds one
bit of each dimension's number in two's complement.  An anchor has a table per group with the sum of its
components over each of the 256 subsets of the group.  A plane's byte looks up what that plane adds, and
the planes, shifted and added from the highest on, give the whole inner product.

Anchors and stored rows meet in blocks, so every pair is scored once per pass and nothing larger than
two blocks is in a task.  The first pass finds an anchor's positives, the second the negatives whose
scores lie within a share of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.session import stage_table

SCALE, GROUP = 256, 8
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
# Rows of a block of anchors and of stored rows, about, and how many of either are scored at once.
ANCHOR_ROWS, STORED_ROWS = 2_048, 8_192
_TILE_ANCHORS, _TILE_STORED = 256, 1_024


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``id, label, v`` of the rows that take part, components as whole numbers ``floor(SCALE * x)``.

    Left out are rows with a null key, label or vector, or with a null or non-finite component.
    A number beyond 64 bits becomes the nearest one within.  Rows that repeat all three count once.
    """
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    there = F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x))
    return vectors.filter(there).select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("v")).distinct()


def _matrix(column: pa.Array, groups: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``GROUP * groups``; what a shorter list lacks is 0."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy()
    out = np.zeros((len(column), GROUP * groups), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def bit_planes(v: np.ndarray, planes: int) -> np.ndarray:
    """A byte for each row, plane and group; the last plane holds the signs."""
    bits = [np.packbits(((v >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(planes)]
    return np.stack(bits, 1)


def subset_sums(v: np.ndarray, planes: int) -> np.ndarray:
    """Group by subset by row: the sum of the row's components in each subset of each group."""
    reach = int(np.abs(v.astype(np.float64)).sum(1).max(initial=0.0)) << planes
    v = v.astype(np.int32 if reach < 1 << 30 else np.int64)
    out = np.zeros((v.shape[1] // GROUP, 1 << GROUP, len(v)), v.dtype)
    for k in range(GROUP):
        out[:, 1 << k : 2 << k] = out[:, : 1 << k] + v[:, k::GROUP].T[:, None]
    return out


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, a row for each stored one and a column for each anchor (64-bit arithmetic wraps around)."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    found = np.empty_like(total)
    for b in reversed(range(planes.shape[1])):
        total <<= 1
        for g in range(len(sums)):
            np.take(sums[g], planes[:, b, g], axis=0, out=found)
            if b == planes.shape[1] - 1:
                total -= found
            else:
                total += found
    return total


def _best(score: np.ndarray, fit: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of the ``top`` greatest fitting scores of each row, the first of equal ones first."""
    least = np.iinfo(score.dtype).min
    held, fit = np.where(fit, score, least), fit.copy()
    rows = np.arange(len(score))
    for _ in range(min(top, score.shape[1])):
        at = held.argmax(1)
        # The least number of all may itself be a score.
        at = np.where(held[rows, at] == least, fit.argmax(1), at)
        there = np.flatnonzero(fit[rows, at])
        if not len(there):
            return
        yield there, at[there]
        held[there, at[there]], fit[there, at[there]] = least, False


def _tiles(anchors: pa.Table, stored: pa.Table, groups: int, planes: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors of a tile, and by anchor and stored row: score, whether the labels agree; ids and labels of the stored rows."""
    stored = stored.sort_by("id")
    ids, labels = stored["id"].to_numpy(), stored["label"].to_numpy()
    body = np.frombuffer(b"".join(stored["planes"].to_pylist()), np.uint8).reshape(len(ids), planes, groups)
    v, own = _matrix(anchors["v"].combine_chunks(), groups), anchors["label"].to_numpy()
    for a in range(0, len(v), _TILE_ANCHORS):
        sums = subset_sums(v[a : a + _TILE_ANCHORS], planes)
        for s in range(0, len(ids), _TILE_STORED):
            part = slice(s, s + _TILE_STORED)
            score = np.ascontiguousarray(scores(sums, body[part]).T)
            yield slice(a, a + _TILE_ANCHORS), score, own[a : a + _TILE_ANCHORS, None] == labels[None, part], ids[part], labels[part]


_POSITIVE = pa.schema([("no", pa.int64()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("no", pa.int64()), ("place", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _table(parts: list[list[np.ndarray]], schema: pa.Schema) -> pa.Table:
    columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * len(schema)
    return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _find_positives(groups: int, planes: int, top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, stored: pa.Table) -> pa.Table:
        no, key, parts = anchors["no"].to_numpy(), anchors["id"].to_numpy(), []
        if anchors.num_rows and stored.num_rows:
            for part, score, alike, ids, _ in _tiles(anchors, stored, groups, planes):
                for row, at in _best(score, alike & (key[part, None] != ids[None]), top):
                    parts.append([no[part][row], key[part][row], ids[at], score[row, at].astype(np.int64)])
        return _table(parts, _POSITIVE)

    return run


def _hundredths(score: np.ndarray, share: int) -> np.ndarray:
    """``share * score / 100`` rounded down, without leaving 64 bits."""
    return score // 100 * share + score % 100 * share // 100


def _find_negatives(groups: int, planes: int, top: int, lowest: int, highest: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, stored: pa.Table) -> pa.Table:
        no, key, parts = anchors["no"].to_numpy(), anchors["id"].to_numpy(), []
        if anchors.num_rows and stored.num_rows:
            found = anchors["positives"].to_pylist()
            for part, score, alike, ids, _ in _tiles(anchors, stored, groups, planes):
                for k in range(max(map(len, found[part]))):
                    have = np.array([len(p) > k for p in found[part]])
                    positive = np.array([p[k]["score"] if len(p) > k else 0 for p in found[part]], np.int64)
                    positive_id = np.array([p[k]["id"] if len(p) > k else 0 for p in found[part]], np.int64)
                    low, high = -_hundredths(-positive, lowest), _hundredths(positive, highest)
                    fit = have[:, None] & ~alike & (score >= low[:, None]) & (score <= high[:, None])
                    for row, at in _best(score, fit, top):
                        place = np.full(len(row), k + 1)
                        parts.append([no[part][row], place, key[part][row], positive_id[row], positive[row], ids[at], score[row, at].astype(np.int64)])
        return _table(parts, _NEGATIVE)

    return run


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'bigint'}" for f in schema)


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def mine(
    vectors: DataFrame,
    every: int,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose key ``every`` divides.  An anchor's positives are its ``positives`` best other rows of
    its label; for each of them the ``negatives`` best rows of other labels are returned whose score is from ``lowest`` to
    ``highest`` hundredths of the positive's.  Ties go to the smaller key.  Rows that take no part are named at ``usable``.
    Vectors of different sizes meet as if the shorter had zeros.  Rows of one key and different vectors or
    labels each take part; none is a positive of another.  Scores beyond 64 bits wrap around.  An anchor without positives or
    a positive without negatives gives no row, an empty table none at all.  Other columns play no part.
    """
    spark = vectors.sparkSession
    rows = stage_table(usable(vectors, key, embedding, label), "whole")
    reach = F.greatest(F.array_max("v"), -(F.array_min("v") + 1))  # what two's complement has to hold
    n, size, most, n_anchors = rows.agg(F.count("*"), F.max(F.size("v")), F.max(reach), F.count(F.when(F.col("id") % every == 0, 1))).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    groups, planes = max(1, -(-size // GROUP)), int(most or 0).bit_length() + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = bit_planes(_matrix(batch.column(2), groups), planes).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in body], pa.binary())], ["id", "label", "planes"])

    stored = stage_table(rows.mapInArrow(pack, "id bigint, label bigint, planes binary"), "planes")
    anchors = stage_table(rows.filter(F.col("id") % every == 0).withColumn("no", F.monotonically_increasing_id()), "anchors")
    anchor_blocks, stored_blocks = -(-n_anchors // ANCHOR_ROWS), -(-n // STORED_ROWS)
    block = lambda name, blocks: F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def meet(asking: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: pa.Schema) -> DataFrame:
        x = asking.withColumns({"i": block("no", anchor_blocks), "j": all_of(stored_blocks)})
        y = stored.withColumn("j", block("id", stored_blocks)).withColumn("i", all_of(anchor_blocks))
        return x.groupBy("i", "j").cogroup(y.groupBy("i", "j")).applyInArrow(run, _ddl(schema))

    best = _first(meet(anchors, _find_positives(groups, planes, positives), _POSITIVE), ["no"], positives)
    listed = best.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    asking = stage_table(anchors.join(listed, "no"), "asking")
    found = meet(asking, _find_negatives(groups, planes, negatives, lowest, highest), _NEGATIVE)
    return _first(found, ["no", "place"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
