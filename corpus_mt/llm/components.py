"""Connected components of a graph over 64-bit node numbers, with hubs of any size.

Large-star and small-star rounds over written tables: every node hands its neighbours on to the least
of them, until nothing changes.  What a node needs to know of its neighbours is their least one, an
aggregate that is combined before it moves.  A node with more edges than an even share of one
task is joined with its least neighbour by broadcast; there are fewer such nodes than tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.session import stage_table


def spanning_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges ``a, b`` and the least node that each is linked to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label, new)  # a tree's root follows its members
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star per tree of each batch: as many edges as it has nodes, at most."""
    for batch in batches:
        nodes, roots = spanning_labels(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        far = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["a", "b"])


def _with_least(pairs: DataFrame, share: int) -> DataFrame:
    """Adds ``m``, the least ``b`` of every ``a``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    hubs = F.broadcast(least.filter(F.col("n") > share).select("a", F.col("m").alias("_m")))
    marked = pairs.join(hubs, "a", "left")
    others = marked.filter("_m IS NULL").drop("_m").join(least.filter(F.col("n") <= share).select("a", "m"), "a")
    return marked.filter("_m IS NOT NULL").withColumnRenamed("_m", "m").unionByName(others)


def components(edges: DataFrame, thin: bool = False) -> DataFrame:
    """``node, root`` of every node of ``a, b`` (bigint): the least node that it is linked to.

    Edges may repeat and point either way; loops are left out, and so are edges with a null end.
    With ``thin`` the edges of one batch are first reduced to stars, which pays where they are dense.  An empty
    table gives no rows.  Rounds grow with the logarithm of the nodes.
    """
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if thin:
        down = down.mapInArrow(_thin, "a bigint, b bigint")
    down = stage_table(down.distinct(), "edges")

    def rows_to_go() -> int:
        """How many edges there are, or 0 once every node has one edge down and its lower end has none."""
        ends = down.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("low"))
        ends = ends.unionByName(down.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("low")))
        state = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
        n, open_ = state.agg(F.sum("up"), F.count(F.when(F.col("up") + F.col("low") > 1, 1))).first()
        return n if open_ else 0

    while n := rows_to_go():
        share = max(1, 2 * n // parts)
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, share).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        small = _with_least(large, share)
        ends = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        down = stage_table(small.select(ends).select("e.a", "e.b").filter("a != b").distinct(), "edges")
    roots = down.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return down.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
