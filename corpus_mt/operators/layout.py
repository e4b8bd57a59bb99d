"""Row numbers, batches, partition plans and the paths derived from them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.session import stage_table

DOCS_PER_PARTITION = 2056
SENTENCES_PER_SHARD = 10_000
BATCH_ROWS = 256

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in these


def sort_rows(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Globally ordered rows, range-partitioned and sorted within partitions.

    Content breaks ties, then the place of a row, so a key shared by very many rows (or
    very many equal rows) still spreads over partitions.
    """
    ties = df.withColumns({"_tie": F.xxhash64(*df.columns), "_spread": F.monotonically_increasing_id()})
    keys = [*order_by, "_tie", "_spread"]
    return ties.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie", "_spread")


def number_rows(
    df: DataFrame, order_by: Sequence[str] = (), name: str = "row_idx", start: int = 0, total: str | None = None
) -> DataFrame:
    """Contiguous row numbers ``start .. start + n - 1`` over the whole table.

    No global window: sorted rows are staged with their partition and place.  Row counts per
    partition then give the offsets, and those are one small row per partition.  Without
    ``order_by`` the rows are numbered where they lie and nothing shuffles; that also
    follows the order of rows that went through ``sort_rows`` and narrow steps only, and is
    the cheaper way when the rows to number are costly to compute.  ``total`` names a column
    for the number of rows, which is known by then.
    """
    if order_by:
        df = sort_rows(df, order_by)
    placed = stage_table(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    place = placed.select(
        "*",
        F.shiftright("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    ).drop("_at")
    counts = place.groupBy("_part").agg((F.max("_row") + 1).alias("n"))
    offsets, end = [], start
    for part, n in sorted(tuple(r) for r in counts.collect()):  # one row per partition
        offsets.append((part, end))
        end += n
    if total:
        place = place.withColumn(total, F.lit(end - start).cast("bigint"))
    if not offsets:
        return place.drop("_part", "_row").withColumn(name, F.lit(start).cast("bigint"))
    table = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    return (
        place.join(F.broadcast(table), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_offset")
    )


def batch_of(index: Column, batch_rows: int = BATCH_ROWS) -> Column:
    """Batch a row index falls in."""
    return F.floor(index / batch_rows).cast("bigint")


def batch_name(batch: Column, total: int | Column, batch_rows: int = BATCH_ROWS) -> Column:
    """Hash of the list of row indexes in a batch, written ``[0, 1, ..., 255]``."""
    first = batch * batch_rows
    last = F.least(first + batch_rows, total if isinstance(total, Column) else F.lit(total)) - 1
    listed = F.concat(F.lit("["), F.array_join(F.sequence(first, last).cast("array<string>"), ", "), F.lit("]"))
    return F.sha2(listed, 256)


def add_translation_folder(
    docs: DataFrame,
    base: str,
    total: int | Column,
    index: str = "row_idx",
    batch_rows: int = BATCH_ROWS,
    name: str = "tlt_folder",
) -> DataFrame:
    """``base / batch name / doc_id`` for each numbered document.

    The batch name is worked out per row: hashing two kilobytes costs far less than moving
    the document to meet its batch.  ``total`` is the count of the numbering that gave the
    indexes, so the last batch has the same name wherever it is worked out.
    """
    batch = batch_name(batch_of(F.col(index), batch_rows), total, batch_rows)
    return docs.withColumn(name, F.concat_ws("/", F.lit(base.rstrip("/")), batch, "doc_id"))


def reroot_path(path: Column, base: str) -> Column:
    """The last two parts of a path under another base."""
    parts = F.split(path, "/")
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2))


def batch_positions(
    docs: DataFrame, count: Column, index: str = "row_idx", batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """First and one-past-last line of each document in the file of its batch, from 1."""
    batch = batch_of(F.col(index), batch_rows)
    w = Window.partitionBy("_batch").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    numbered = docs.withColumns({"_batch": batch, "_n": count.cast("bigint")})
    ends = numbered.withColumn("end_pos", F.sum("_n").over(w) + 1)
    return ends.withColumn("start_pos", F.col("end_pos") - F.col("_n")).drop("_batch", "_n")


def plan_partitions(rows: int, rows_per_partition: int = DOCS_PER_PARTITION) -> int:
    """How many partitions hold ``rows`` at the given size."""
    return max(1, math.ceil(rows / rows_per_partition))


def partitions_for(rows: Column, rows_per_partition: int = DOCS_PER_PARTITION) -> Column:
    """The same for a column of row counts."""
    return F.greatest(F.ceil(rows / rows_per_partition), F.lit(1)).cast("bigint")


def salt_partitions(df: DataFrame, n: int) -> DataFrame:
    """Spread rows evenly over ``n`` partitions, whatever their keys.

    Round robin, so no key can make a hot partition; Spark orders rows before dealing
    them out, which makes a retried task deal them the same way.
    """
    return df.repartition(n)


def split_and_salt(df: DataFrame, rows_per_partition: int = DOCS_PER_PARTITION) -> tuple[DataFrame, int, int]:
    """Salted table, its row count and partition count."""
    rows = df.count()
    n = plan_partitions(rows, rows_per_partition)
    return salt_partitions(df, n), rows, n


def assign_rank(df: DataFrame, world_size: int, total: int, index: str = "tlt_idx", name: str = "rank") -> DataFrame:
    """Contiguous slice of rows for each worker; the first ``total % world_size`` get one more."""
    size, extra = divmod(total, world_size)
    i, edge = F.col(index), extra * (size + 1)
    rank = F.when(i < edge, F.floor(i / (size + 1))).otherwise(extra + F.floor((i - edge) / max(size, 1)))
    return df.withColumn(name, rank.cast("int"))


def assign_devices(shards: DataFrame, devices: Sequence[int], path: str = "path") -> DataFrame:
    """Deal shard paths, in path order, to devices in turn."""
    numbered = number_rows(shards, [path], "shard_idx")
    ids = F.array(*[F.lit(d) for d in devices])
    return numbered.withColumn("device", F.get(ids, F.pmod("shard_idx", F.lit(len(devices))).cast("int")))
