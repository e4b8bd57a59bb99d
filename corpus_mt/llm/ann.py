"""Approximate nearest neighbours over balanced posting lists.

Vectors are filed under centroids.  One near a border is filed under several, so a search need
not visit every list around it.  Stored vectors and queries find their centroids by walking an in-memory
graph of them.  A query visits all lists up to a ratio of the nearest one's distance, its walk being widened
until it has gone past that; a bounded set of queries that are also compared with every vector says what
ratio finds enough.  The lists' vectors then
meet their queries block by block, and exact inner products pick the best.

Inner product becomes distance by one more dimension, which gives every vector the length of
the longest (queries get 0 there).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.session import stage_table

TOP = 20
# Vectors the centroids are fitted on, at most; vectors per list aimed at; most lists.
SAMPLE_ROWS, LIST_ROWS, LISTS = 40_000, 500, 16_384
# Lists a vector is filed under at most, and how much farther than the nearest they may be.
REPLICAS, CLOSURE = 4, 1.06
# Lists a query visits in any case, if they are no farther than so many times the nearest.
PROBES, PRUNE = 32, 1.2
# Share of the nearest vectors that the lists visited shall hold, and queries it is measured on, about, at most.
RECALL, TRIALS = 0.95, 256
# Centroid graph: neighbours of a node, nodes a walk keeps at first, and the share of them it opens at once.
DEGREE, BEAM, AT_ONCE = 16, 48, 12
# Nodes a walk may begin at: so many times the root of their number, or it would not find into clusters far apart.
STARTS = 4
# Vectors of a list that one task compares with the list's queries.
BLOCK_ROWS = 4_000
ROUNDS, SEED = 12, 7


class Index(NamedTuple):
    """Centroids (with the added dimension), their graph, the nodes that walks begin at, and the longest length."""

    centroids: np.ndarray
    graph: np.ndarray
    starts: np.ndarray
    longest: float


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Stored vectors with the dimension that makes all lengths equal, as 32-bit numbers."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0.0))
    return np.concatenate([vectors, rest[:, None]], 1).astype(np.float32)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2.0 * (a @ b.T), 0.0)


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """k-means in which a list over its even share looks farther away, so that lists fill alike."""
    random = np.random.default_rng(SEED)
    centroids = sample[random.choice(len(sample), lists, replace=False)].copy()
    penalty = np.zeros(lists, np.float32)
    for _ in range(ROUNDS):
        nearest, scale = np.empty(len(sample), np.int64), 0.0
        for at in range(0, len(sample), 4096):
            d = _distances(sample[at : at + 4096], centroids)
            scale += d.min(1).sum()
            nearest[at : at + 4096] = (d + penalty).argmin(1)
        sizes = np.bincount(nearest, minlength=lists)
        penalty += np.float32(0.1 * scale / len(sample)) * np.clip(sizes / (len(sample) / lists) - 1.0, -1.0, 2.0).astype(np.float32)
        penalty -= penalty.min()
        order = np.argsort(nearest, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        filled = np.flatnonzero(sizes)
        centroids[filled] = np.add.reduceat(sample[order], starts[filled]) / sizes[filled, None]
        empty = np.flatnonzero(sizes == 0)
        centroids[empty] = sample[random.choice(len(sample), len(empty))]
    return centroids


def centroid_graph(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node's nearest others and one far link, which keeps the graph connected; and the nodes that walks begin at."""
    n = len(centroids)
    degree = min(DEGREE, n - 1)
    graph = np.zeros((n, degree + 1), np.int64)
    for at in range(0, n, 1024):
        d = _distances(centroids[at : at + 1024], centroids)
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        graph[at : at + 1024, :degree] = np.argsort(d, 1, kind="stable")[:, :degree]
    ring = np.random.default_rng(SEED).permutation(n)
    graph[ring, degree] = np.roll(ring, 1)
    return graph, ring[: int(np.ceil(STARTS * np.sqrt(n)))]


def walk(index: Index, points: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` centroids found nearest to each point, and their distances, nearest first.

    All points walk at once: each begins at the nearest of the starts, opens its nearest unopened
    nodes, looks at their neighbours and keeps the best, until all it keeps are open.  Missing ones are -1.
    """
    n = len(points)
    beam = max(min(BEAM, len(index.centroids)), min(keep, len(index.centroids)))
    wide = max(1, beam // AT_ONCE)
    ids = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    opened = np.zeros((n, beam), bool)
    first = _distances(points, index.centroids[index.starts])
    best = np.argsort(first, 1, kind="stable")[:, :beam]
    ids[:, : best.shape[1]] = index.starts[best]
    far[:, : best.shape[1]] = np.take_along_axis(first, best, 1)
    going = np.arange(n)
    while len(going):
        wait = np.where(opened[going] | (ids[going] < 0), np.inf, far[going])
        pick = np.argsort(wait, 1, kind="stable")[:, :wide]
        real = np.isfinite(np.take_along_axis(wait, pick, 1))
        alive = real[:, 0]
        going, pick, real = going[alive], pick[alive], real[alive]
        if not len(going):
            break
        row, place = np.nonzero(real)
        opened[going[row], pick[row, place]] = True
        near = index.graph[np.where(real, np.take_along_axis(ids[going], pick, 1), 0)]
        near = np.where(real[:, :, None], near, -1).reshape(len(going), -1)
        d = ((points[going, None] - index.centroids[near]) ** 2).sum(2)
        # One entry per node: the kept one wins, so that it stays open.
        all_ids = np.concatenate([ids[going], near], 1)
        all_far = np.concatenate([far[going], d], 1)
        all_open = np.concatenate([opened[going], np.zeros_like(near, bool)], 1)
        by_id = np.argsort(all_ids, 1, kind="stable")
        sorted_ids = np.take_along_axis(all_ids, by_id, 1)
        again = np.zeros_like(all_open)
        np.put_along_axis(again, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], 1)
        all_far[again | (all_ids < 0)] = np.inf
        best = np.argsort(all_far, 1, kind="stable")[:, :beam]
        far[going] = np.take_along_axis(all_far, best, 1)
        opened[going] = np.take_along_axis(all_open, best, 1)
        ids[going] = np.where(np.isfinite(far[going]), np.take_along_axis(all_ids, best, 1), -1)
    return ids[:, :keep], np.sqrt(far[:, :keep])


def lists_to_visit(index: Index, points: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """``(point, list)`` of the lists that queries visit.

    These are the ``PROBES`` nearest of up to ``PRUNE`` times the nearest one's distance, and all up to
    ``ratio`` times it.  A walk that ends before that distance is repeated with four times the nodes.
    """
    rows, lists = [], []
    going, keep = np.arange(len(points)), BEAM
    while len(going):
        keep = min(keep, len(index.centroids))
        short = []
        step = max(1, 1024 * BEAM // keep)
        for at in range(0, len(going), step):
            some = going[at : at + step]
            ids, far = walk(index, points[some], keep)
            nearest = far[:, :1]
            limit = np.maximum(np.minimum(far[:, min(PROBES, keep) - 1 : min(PROBES, keep)], PRUNE * nearest), ratio * nearest) + 1e-6
            done = (far[:, -1:] > limit)[:, 0] | (keep == len(index.centroids))
            row, place = np.nonzero((ids >= 0) & (far <= limit) & done[:, None])
            rows.append(some[row])
            lists.append(ids[row, place])
            short.append(some[~done])
        going, keep = np.concatenate(short), 4 * keep
    return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(lists or [np.zeros(0, np.int64)])


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id, v`` of the rows that take part.

    Left out are null keys, vectors null, empty or zero, those with null or non-finite
    components, and those whose size isn't the table's most frequent one (the larger of two as frequent).
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    return rows.filter(F.size("v") == sizes.agg(F.max(F.struct("n", "d"))["d"]).scalar())


def build_index(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS) -> Index | None:
    """Fits the centroids on a bounded sample, chosen by a hash of the id."""
    n, longest = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    if not n:
        return None
    share = min(1.0, sample_rows / n)
    sample = rows.filter(F.xxhash64("id", "v").cast("double") <= share * 2.0**64 - 2.0**63).select("v").toPandas()["v"]
    if not len(sample):
        sample = rows.limit(1).select("v").toPandas()["v"]
    points = np.unique(lift(np.stack(sample.to_list()), longest), axis=0)
    lists = int(max(1, min(n // list_rows, LISTS, len(points))))
    centroids = balanced_centroids(points, lists)
    return Index(centroids, *centroid_graph(centroids), float(longest))


_FILED = "id bigint, v array<double>, list int"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _asked_points(v: np.ndarray, index: Index) -> np.ndarray:
    """Queries among the lifted vectors; these lie on a sphere, and a query is compared at its radius."""
    scaled = v * (index.longest / np.sqrt((v**2).sum(1, keepdims=True)))
    return np.pad(scaled, ((0, 0), (0, 1))).astype(np.float32)


def _file(rows: DataFrame, index: Index, ratio: float, most: int | None = None) -> DataFrame:
    """Rows once for each list: those at most ``ratio`` times as far as the nearest.

    Stored vectors go to the ``most`` nearest that a walk finds; without ``most`` rows are queries, and
    all lists up to that distance are theirs.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tuple(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Index(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                v = _matrix(batch.column(1))
                if most:
                    ids, far = walk(known, lift(v, known.longest), most)
                    row, place = np.nonzero((ids >= 0) & (far <= ratio * far[:, :1] + 1e-6))
                    lists = ids[row, place]
                else:
                    row, lists = lists_to_visit(known, _asked_points(v, known), ratio)
                for a in range(0, len(row), 8192):
                    picked = pa.array(row[a : a + 8192])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(lists[a : a + 8192].astype(np.int32))], ["id", "v", "list"]
                    )

    return rows.select("id", "v").mapInArrow(run, _FILED)


def _nearest_of_all(rows: DataFrame, trials: pd.DataFrame, top: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of every batch for a few queries, compared with all its vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(trials)
    best = _best_of_block(top)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = None
        for stored in batches:
            new = best(None, stored, shared.value)
            found = new if found is None else pd.concat([found, new])
            found = found.drop_duplicates().sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(top)
        if found is not None:
            yield found

    return rows.select("id", "v").mapInPandas(run, "query_id bigint, vec_id bigint, score double")


def needed_ratio(rows: DataFrame, stored: DataFrame, asked: DataFrame, index: Index, top: int, recall: float = RECALL, trials: int = TRIALS) -> float:
    """How many times as far as the nearest list others must be visited to find a share ``recall`` of the nearest vectors.

    About ``trials`` queries, chosen by their hash, are compared with all rows.  A neighbour
    is found from the ratio on at which the first of the lists that it is filed under is visited.
    """
    share = min(1.0, trials / max(asked.count(), 1))
    chosen = asked.filter(F.xxhash64("id", "v").cast("double") <= share * 2.0**64 - 2.0**63).select("id", "v").toPandas()
    if not len(chosen):
        chosen = asked.select("id", "v").limit(1).toPandas()
    chosen = chosen.drop_duplicates("id")
    if not len(chosen):
        return 1.0
    wanted = _rank(_nearest_of_all(rows, chosen, top), top).select("query_id", "vec_id").toPandas()  # trials * top rows, about
    if not len(wanted):
        return 1.0
    ids = rows.sparkSession.createDataFrame(wanted[["vec_id"]].drop_duplicates().rename(columns={"vec_id": "id"}), "id bigint")
    filed = stored.select("id", "list").join(F.broadcast(ids), "id").distinct().toPandas()
    far = np.sqrt(_distances(_asked_points(np.stack(chosen["v"].to_list()), index), index.centroids))
    ratios = far / np.maximum(far.min(1, keepdims=True), 1e-6)
    met = wanted.merge(filed, left_on="vec_id", right_on="id")
    at = pd.Series(np.arange(len(chosen)), chosen["id"].to_numpy())
    met["ratio"] = ratios[at[met["query_id"]].to_numpy(), met["list"].to_numpy()]
    first = np.sort(met.groupby(["query_id", "vec_id"])["ratio"].min().to_numpy())
    return float(first[min(int(np.ceil(recall * len(first))), len(first)) - 1])


def _best_of_block(top: int):
    """Scores a block of a list against the queries of that list."""

    def run(key, stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(stored) and len(asked):
            v, q = np.stack(stored["v"].to_list()), np.stack(asked["v"].to_list())
            ids, query_ids = stored["id"].to_numpy(), asked["id"].to_numpy()
            # Of equal vectors only the smallest ids can be among the best, one of them being the query's own.
            order = np.lexsort((ids, *v.T))
            v, ids = v[order], ids[order]
            new = np.concatenate([[True], (v[1:] != v[:-1]).any(1)])
            first = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
            fit = np.arange(len(v)) - first <= top
            v, ids = v[fit], ids[fit]
            for at in range(0, len(q), 256):
                rough = q[at : at + 256] @ v.T
                n = min(top + 1, len(v))
                least = np.partition(rough, len(v) - n, 1)[:, len(v) - n]
                row, col = np.nonzero(rough >= (least - 1e-9 * (1.0 + np.abs(least)))[:, None])
                score = (q[at + row] * v[col]).sum(1)
                found = pd.DataFrame({"query_id": query_ids[at + row], "vec_id": ids[col], "score": score})
                found = found[found["query_id"] != found["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                out.append(found.groupby("query_id").head(top))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    return run


def _compare(stored: DataFrame, asked: DataFrame, lists: int, top: int) -> DataFrame:
    """Best of every (query, list), the lists being cut into blocks of even size."""
    counts = stored.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    counts = F.broadcast(counts)  # a row per list, of which there are LISTS at most
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    filed = stored.join(counts, "list").withColumn("block", block).drop("blocks")
    sought = asked.join(counts, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    pairs = filed.groupBy("list", "block").cogroup(sought.groupBy("list", "block"))
    return pairs.applyInPandas(_best_of_block(top), "query_id bigint, vec_id bigint, score double")


def search(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    key: str = "vec_id",
    embedding: str = "embedding",
    recall: float = RECALL,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``top`` nearest other rows by inner product.

    Scores are exact, in double precision; a tie goes to the smaller id.  Rows that take no
    part are named at ``usable``; a query among them gets no result.  A row that repeats
    another (id and vector) counts once.  Queries whose lists hold too few rows search
    all of them.  The lists visited are as many as hold a share ``recall`` of the nearest vectors, by
    trial, whatever the size of the table.  An empty table gives no rows; other columns play no part.
    """
    spark = vectors.sparkSession
    rows = stage_table(usable(vectors, key, embedding), "vectors")
    index = build_index(rows, list_rows=list_rows)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = usable(queries, key, embedding).filter(F.size("v") == index.centroids.shape[1] - 1)
    stored = stage_table(_file(rows, index, CLOSURE, REPLICAS), "lists")
    lists = len(index.centroids)
    ratio = needed_ratio(rows, stored, asked, index, top, recall)
    best = stage_table(_rank(_compare(stored, _file(asked, index, ratio), lists, top), top), "nearest")
    # Whoever found fewer than there are looks everywhere.
    n = rows.select("id").distinct().count()
    few = best.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min(top, n - 1)).select(F.col("query_id").alias("id"))
    lacking = asked.join(few, "id", "left_anti")
    if n > 1 and not lacking.isEmpty():
        every = F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list")
        rest = _rank(_compare(stored, lacking.select("id", "v", every), lists, top), top)
        best = best.join(lacking.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(rest)
    return best


def _rank(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(by))
    return ranked.filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
