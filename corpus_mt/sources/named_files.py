"""Files under exact names: a data source whose commit moves what the tasks wrote to its place.

A row is a file's name, relative to the folder, and a piece of its content, or a row of a Parquet file.  Rows of one file
come together and in order; a task writes them as they come, so a file may be larger than memory.  Every attempt of a
task writes to a folder of its own, and only files of attempts that Spark accepted are moved, so a failed
and repeated task leaves no trace.  A name says what is in a file: writing again replaces it.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from corpus_mt.operators.layout import BATCH_ROWS, assign_devices, batch_name, batch_of, batch_positions, number_rows
from corpus_mt.session import stage_table
from corpus_mt.sources.sinks import ROWS_PER_FILE, document_folder, one_line, with_written

FORMAT = "corpus_mt_named_files"
# Moves that the commit makes at once.
COMMIT_THREADS = 16
# Files, folders or bytes that a task reads or lists at least, once all cores have some; entries of a folder and bytes of bodies that it hands on at once.
READ_ROWS, READ_BYTES = 2_000, 64 << 20
LISTED_ROWS, HELD_BYTES = 10_000, 8 << 20


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def check_name(name: str) -> str:
    """A relative name that stays below its folder."""
    parts = name.split("/")
    if not name or "" in parts or "." in parts or ".." in parts or name.startswith("_pending"):
        raise ValueError(f"not a file name below the folder: {name!r}")
    return name


@dataclass
class Written(WriterCommitMessage):
    """What one accepted attempt wrote: its folder, and the names of the files in it, which lie there by their numbers."""

    folder: str
    names: list[str]


class _TextFile:
    def __init__(self, store: pafs.FileSystem, path: str, separator: bytes):
        self.out, self.separator, self.begun = store.open_output_stream(path), separator, False

    def write(self, body: pa.RecordBatch) -> None:
        for piece in body.column(0).to_pylist():
            if self.begun:
                self.out.write(self.separator)
            self.out.write((piece or "").encode("utf-8", "surrogatepass"))
            self.begun = True

    def close(self) -> None:
        self.out.close()


class _ParquetFile:
    def __init__(self, store: pafs.FileSystem, path: str, schema: pa.Schema):
        self.out = pq.ParquetWriter(path, schema, filesystem=store, compression="snappy")

    def write(self, body: pa.RecordBatch) -> None:
        self.out.write_batch(body)

    def close(self) -> None:
        self.out.close()


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, kind: str, separator: str, overwrite: bool, job: str):
        self.folder, self.kind, self.separator, self.overwrite, self.job = folder, kind, separator, overwrite, job

    def _pending(self) -> str:
        return f"{self.folder.rstrip('/')}/_pending-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = open_store(self._pending())
        base = f"{base}/{uuid.uuid4().hex}"
        store.create_dir(base, recursive=True)
        names: list[str] = []
        last, file = None, None
        try:
            for batch in iterator:
                files, body = batch.column(0), batch.select(range(1, batch.num_columns))
                runs = files.to_pylist()
                at = 0
                while at < len(runs):
                    stop = at + 1
                    while stop < len(runs) and runs[stop] == runs[at]:
                        stop += 1
                    if runs[at] != last:
                        if file:
                            file.close()
                        last = runs[at]
                        check_name(last)
                        path = f"{base}/{len(names)}"
                        file = _TextFile(store, path, self.separator.encode()) if self.kind == "text" else _ParquetFile(store, path, body.schema)
                        names.append(last)
                    file.write(body.slice(at, stop - at))
                    at = stop
        finally:
            if file:
                file.close()
        if len(set(names)) < len(names):
            raise ValueError("the rows of a file have to come together")
        return Written(base, names)

    def commit(self, messages: list[Written | None]) -> None:
        store, target = open_store(self.folder)
        done = [m for m in messages if m]
        if self.overwrite:
            for old in store.get_file_info(pafs.FileSelector(target, allow_not_found=True)):
                if not old.base_name.startswith("_pending-"):
                    (store.delete_dir if old.type == pafs.FileType.Directory else store.delete_file)(old.path)
        moves = [(f"{m.folder}/{k}", f"{target.rstrip('/')}/{name}") for m in done for k, name in enumerate(m.names)]
        with ThreadPoolExecutor(COMMIT_THREADS) as pool:
            list(pool.map(store.create_dir, {to.rsplit("/", 1)[0] for _, to in moves}))
            list(pool.map(lambda move: store.move(*move), moves))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, pending = open_store(self._pending())
        if store.get_file_info(pending).type == pafs.FileType.Directory:
            store.delete_dir(pending)


class NamedFiles(DataSource):
    """Options: ``path``; ``kind``, text or parquet; ``separator``, what stands between the pieces of a text file."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        kind = self.options.get("kind", "text")
        if kind not in ("text", "parquet"):
            raise ValueError("kind must be 'text' or 'parquet'")
        return NamedFilesWriter(self.options["path"], kind, self.options.get("separator", ""), overwrite, uuid.uuid4().hex)


def save_named(rows: DataFrame, path: str, order: list[str], file: str = "file", kind: str = "text", separator: str = "", mode: str = "append") -> None:
    """Write every file of ``rows`` under ``path`` by its name.

    Rows have ``file``, the columns of ``order``, by which a file's rows follow each other, and its content: one
    string for text (null is empty), any columns for Parquet.  Order columns are not written unless they are content too (Parquet).  Mode
    ``append`` replaces files of the same names and leaves others, ``overwrite`` leaves no others, ``error`` writes only
    to an empty folder.  A null name is an error.  No rows give no files.
    """
    spark = rows.sparkSession
    if mode not in ("append", "overwrite", "error"):
        raise ValueError("mode must be 'append', 'overwrite' or 'error'")
    if mode == "error":
        store, target = open_store(path)
        if any(not f.base_name.startswith("_pending-") for f in store.get_file_info(pafs.FileSelector(target, allow_not_found=True))):
            raise ValueError(f"{path} is not empty")
    spark.dataSource.register(NamedFiles)
    named = rows.withColumn(file, F.coalesce(F.col(file), F.raise_error(F.lit("a file without a name")).cast("string")))
    placed = named.repartition(file).sortWithinPartitions(file, *order)
    content = [c for c in rows.columns if c != file and (kind == "parquet" or c not in order)]
    out = placed.select(F.col(file).cast("string").alias("file"), *[F.col(f"`{c}`") for c in content])
    if kind == "text" and (len(content) != 1):
        raise ValueError("a text file has one column of content")
    writer = out.write.format(FORMAT).option("kind", kind).option("separator", separator).option("path", path)
    writer.mode("overwrite" if mode == "overwrite" else "append").save()


# --- sentence CSVs ------------------------------------------------------------------------------


def csv_field(col: Column) -> Column:
    """A field as CSV writes it: in quotes if it holds a comma, a quote or a line end; null is empty."""
    text = F.coalesce(col, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def csv_line(*cols: Column) -> Column:
    return F.concat(F.concat_ws(",", *map(csv_field, cols)), F.lit("\r\n"))


def with_csv_files(docs: DataFrame, base: str, style: str, total: int | Column, index: str = "row_idx", batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Adds ``csv_path``, the very file: per batch its name, per document that of its batch as a folder and its id.

    Style ``batch`` adds ``start_pos`` and ``end_pos``, the lines that a document takes in the file.
    """
    name = batch_name(batch_of(F.col(index), batch_rows), total, batch_rows)
    if style == "doc":
        return docs.withColumn("csv_path", F.concat_ws("/", F.lit(base.rstrip("/")), name, document_folder(F.col("doc_id"))))
    if style != "batch":
        raise ValueError("style must be 'doc' or 'batch'")
    placed = batch_positions(docs, F.size("sids"), index, batch_rows)
    return placed.withColumn("csv_path", F.concat_ws("/", F.lit(base.rstrip("/")), name))


def save_csv_files(
    docs: DataFrame, base: str, style: str, total: int | Column, index: str = "row_idx", mode: str = "append", batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """One CSV per batch or document and ``paths.csv``, which lists them; gives the tagged documents.

    Every file begins with its column names, so a document without substrings has a file as well.
    """
    tagged = with_csv_files(docs, base, style, total, index, batch_rows)
    below = F.substring("csv_path", len(base.rstrip("/")) + 2, 1 << 20)
    lines = F.transform(F.arrays_zip("sids", "sub_strs"), lambda s: csv_line(F.col("doc_id"), s["sids"], s["sub_strs"]))
    body = tagged.select(below.alias("file"), F.col(index).alias("_at"), F.array_join(lines, "").alias("body"))
    heads = body.groupBy("file").agg(F.lit(-1).cast("bigint").alias("_at"), F.lit("doc_id,sid,substr\r\n").alias("body"))
    manifest = tagged.select(F.lit("paths.csv").alias("file"), F.col(index).alias("_at"), F.concat(csv_field(F.col("csv_path")), F.lit("\n")).alias("body"))
    first = docs.sparkSession.createDataFrame([("paths.csv", -1, "csv_path\n")], "file string, _at bigint, body string")
    every = body.unionByName(heads).unionByName(manifest).unionByName(first)
    save_named(every.withColumn("_at", F.col("_at").cast("bigint")), base, ["_at"], mode=mode)
    return tagged


# --- other files ------------------------------------------------------------------------------------


def save_substring_files(translations: DataFrame, base: str, mode: str = "append") -> DataFrame:
    """The translation of every substring as a file at its place below ``base``; gives every row with ``written``.

    A place that lies elsewhere is not written.  Copies of a document share their places, each of which is written once.
    """
    root = base.rstrip("/") + "/"
    status = with_written(translations).withColumn("written", F.col("written") & F.startswith("tlt_file_loc", F.lit(root)))
    stored = status.filter("written").select(F.substring("tlt_file_loc", len(root) + 1, 1 << 20).alias("file"), "translated")
    save_named(stored.groupBy("file").agg(F.min("translated").alias("translated")), base, [], mode=mode)
    return status


def save_pred_ref(scored: DataFrame, base: str, by: tuple[str, ...] = (), order: str = "id", mode: str = "append") -> None:
    """``pred.txt`` and ``ref.txt`` of every pair in ``base/<by...>/<src>__<tgt>``: a line per row, in order.

    Lines are joined by line ends with none behind the last.  Line ends within a text are escaped, so line k of one file
    answers line k of the other.
    """
    folder = F.concat_ws("/", *by, F.concat_ws("__", "src_lang", "tgt_lang"))
    sides = F.array(*[F.struct(F.lit(f"{side}.txt").alias("side"), one_line(F.col(col)).alias("body")) for side, col in (("pred", "prediction"), ("ref", "reference"))])
    rows = scored.select(folder.alias("_folder"), F.col(order).alias("_at"), F.xxhash64("prediction", "reference").alias("_tie"), F.inline(sides))
    rows = rows.select(F.concat_ws("/", "_folder", "side").alias("file"), "_at", "_tie", "body")
    save_named(rows, base, ["_at", "_tie"], separator="\n", mode=mode)


def save_device_files(shards: DataFrame, base: str, devices: tuple[int, ...], path: str = "path", mode: str = "append") -> None:
    """``device_map_<device>`` files: the shards dealt to each device in turn, a line each."""
    assigned = assign_devices(shards, devices, path)
    rows = assigned.select(F.concat(F.lit("device_map_"), F.col("device").cast("string")).alias("file"), "shard_idx", F.concat(F.col(path), F.lit("\n")).alias("body"))
    save_named(rows, base, ["shard_idx"], mode=mode)


def capped_file(index: Column, total: int | Column, rows_per_file: int = ROWS_PER_FILE) -> Column:
    """Name of the file that a row falls in: the hash of the list of its row numbers."""
    return F.concat(batch_name(batch_of(index, rows_per_file), total, rows_per_file), F.lit(".parquet"))


def save_capped_files(df: DataFrame, base: str, order_by: tuple[str, ...] = (), rows_per_file: int = ROWS_PER_FILE, index: str | None = None, total: int | None = None, mode: str = "append") -> None:
    """Snappy Parquet files of exactly ``rows_per_file`` rows, the last but, named by the row numbers that they hold.

    ``index`` names an existing number from 0; otherwise rows are numbered by ``order_by``.  The names are fixed before
    anything is written, so writing the same rows again replaces every file and adds none.
    """
    if index is None:
        df = number_rows(df, order_by, "_row_number", total="_total")
        count: int | Column = F.col("_total")
    else:
        count = df.count() if total is None else total
    number = index or "_row_number"
    named = df.withColumn("_file", capped_file(F.col(number), count, rows_per_file))
    named = named.drop("_total") if index is None else named
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    placed = named.repartition("_file").sortWithinPartitions("_file", number)
    content = [c for c in df.columns if c not in ("_row_number", "_total")]
    save = placed.select("_file", *[F.col(f"`{c}`") for c in content]).write.format(FORMAT).option("kind", "parquet").option("path", base)
    save.mode("overwrite" if mode == "overwrite" else "append").save()


def _hidden(name: str) -> bool:
    """As Spark's readers see it."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _spread(rows: DataFrame, n: int, n_bytes: int = 0) -> DataFrame:
    """``n`` rows over as many tasks as they are worth, at least those that run at once."""
    least = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / READ_ROWS), math.ceil(n_bytes / READ_BYTES))
    return rows.repartition(max(1, min(n, least)))


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """``file, size`` of all files below a folder but hidden ones; the name is relative to the folder.

    A level of folders is listed by one job whose tasks list some folders each, and is staged, so no names pass the driver.
    """
    root = base.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                below = f"{folder}/" if folder else ""
                found = [f for f in store.get_file_info(pafs.FileSelector(f"{place}/{folder}".rstrip("/"))) if not _hidden(f.base_name)]
                for at in range(0, len(found), LISTED_ROWS):
                    part = found[at : at + LISTED_ROWS]
                    names, folders = [f"{below}{f.base_name}" for f in part], [f.type == pafs.FileType.Directory for f in part]
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([f.size or 0 for f in part], pa.int64()), pa.array(folders, pa.bool_())], ["file", "size", "is_folder"])

    files = None
    folders, n = spark.range(0, 1, 1, 1).select(F.lit("").alias("file")), 1
    while n:
        listed = stage_table(_spread(folders, n).mapInArrow(run, "file string, size bigint, is_folder boolean"), "listed")
        here = listed.filter(~F.col("is_folder")).select("file", "size")
        files = here if files is None else files.unionByName(here)
        folders = listed.filter("is_folder").select("file")
        n = folders.count()
    return files


def read_named(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """``file, body`` of the text files below a folder whose last name fits a pattern of ``*`` and ``?``.

    Hidden and empty files are left out.  Files are opened by the tasks, many to a task, and by name alone: as
    inputs of Spark's own reader each would cost a split and some milliseconds.
    """
    files = list_files(spark, base).filter("size > 0")
    if pattern != "*":
        marks = {"*": "[^/]*", "?": "[^/]"}
        files = files.filter(F.col("file").rlike("(^|/)" + "".join(marks.get(c, re.escape(c)) for c in pattern) + "$"))
    n, n_bytes = files.agg(F.count("*"), F.sum("size")).first()
    root = base.rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(root)
        for batch in batches:
            names: list[str] = []
            bodies: list[bytes] = []
            held = 0
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{place}/{name}") as f:
                    bodies.append(f.readall())
                names.append(name)
                held += len(bodies[-1])
                if held >= HELD_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], ["file", "body"])
                    names, bodies, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], ["file", "body"])

    rows = _spread(files.select("file"), n, n_bytes or 0).mapInArrow(read, "file string, body binary")
    return rows.select("file", F.col("body").cast("string").alias("body"))
