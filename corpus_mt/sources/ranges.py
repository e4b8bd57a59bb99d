"""Row ranges of Parquet tables from their footers, and listings of folders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpus_mt.operators.sentences import parse_split
from corpus_mt.sources.named_files import open_store

_GROUPS = "path string, grp int, n bigint"


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """``path, grp, n, first``: every row group of the files, the rows that it holds, and the number of the first.

    Files count in the order of their paths.  Tasks read footers only.  Numbers are summed within files, then over
    files, of which one row each meets in one place.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                store, place = open_store(uri)
                with store.open_input_file(place) as f:
                    meta = pq.ParquetFile(f).metadata
                    rows += [(uri, g, meta.row_group(g).num_rows) for g in range(meta.num_row_groups)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())], ["path", "grp", "n"])

    groups = files.mapInArrow(footers, _GROUPS)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = groups.withColumn("_in", before(Window.partitionBy("path").orderBy("grp")))
    totals = groups.groupBy("path").agg(F.sum("n").alias("n")).withColumn("_from", before(Window.orderBy("path"))).drop("n")
    return within.join(totals, "path").select("path", "grp", "n", (F.col("_from") + F.col("_in")).alias("first"))


def read_range(spark: SparkSession, path: str, split: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a contiguous range such as ``train[10%:20%]``, in the order of paths and of rows within files.

    Only row groups that hold rows of the range are opened, and of these only ``columns``; nothing is staged or
    sorted.  What a range means is said at ``parse_split``; one that is no range gives the whole table.
    """
    schema = spark.read.parquet(path).schema
    if columns is not None:
        schema = type(schema)([schema[c] for c in columns])
    groups = row_groups(spark, path)
    total = groups.agg(F.sum("n")).first()[0] or 0
    first, last = (parse_split(split, total) if "[" in split else None) or (0, total)
    skip, stop = F.greatest(F.lit(first) - F.col("first"), F.lit(0)), F.least(F.lit(last) - F.col("first"), F.col("n"))
    wanted = groups.select("path", "grp", skip.alias("skip"), stop.alias("stop")).filter("stop > skip")
    fields, target = schema.fieldNames(), to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, group, skip, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, place = open_store(uri)
                with store.open_input_file(place) as f:
                    at = 0
                    for rows in pq.ParquetFile(f).iter_batches(row_groups=[group], columns=fields):
                        a, b = max(skip - at, 0), min(stop - at, rows.num_rows)
                        if a < b:
                            part = pa.Table.from_batches([rows.slice(a, b - a)]).select(fields).cast(target)
                            yield from part.to_batches()
                        at += rows.num_rows
                        if at >= stop:
                            break

    return wanted.repartition("path", "grp").mapInArrow(read, schema)


def list_entries(spark: SparkSession, *roots: str) -> DataFrame:
    """``path, is_folder``: what lies directly in each folder, by name, without opening any of it.

    Hidden entries are left out.  A task lists one folder; entries never pass the driver.  A folder that does not
    exist has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root in batch.column(0).to_pylist():
                store, place = open_store(root)
                found = store.get_file_info(pafs.FileSelector(place, allow_not_found=True))
                seen = sorted((f.base_name, f.type == pafs.FileType.Directory) for f in found if not f.base_name.startswith("."))
                base = root.rstrip("/")
                yield pa.RecordBatch.from_arrays([pa.array([f"{base}/{n}" for n, _ in seen], pa.string()), pa.array([d for _, d in seen], pa.bool_())], ["path", "is_folder"])

    table = spark.createDataFrame([(r,) for r in roots], "root string").repartition(max(1, len(roots)))
    return table.mapInArrow(run, "path string, is_folder boolean")
