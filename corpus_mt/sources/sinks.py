"""Writing stage outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.operators.layout import BATCH_ROWS, batch_name, batch_of, batch_positions, plan_partitions, SENTENCES_PER_SHARD
from corpus_mt.session import stage_table

ROWS_PER_FILE = 100_000


def save_table(df: DataFrame, path: str, shards: int | None = None, mode: str = "error", fmt: str = "parquet") -> None:
    """Write a stage; ``shards`` fixes the number of files."""
    (df.repartition(shards) if shards else df).write.format(fmt).mode(mode).save(path)


def save_shards(df: DataFrame, path: str, rows_per_shard: int = SENTENCES_PER_SHARD, mode: str = "overwrite") -> None:
    """As many evenly filled files as the row count asks for."""
    save_table(df, path, plan_partitions(df.count(), rows_per_shard), mode)


def save_capped(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, mode: str = "error") -> None:
    """Snappy parquet with a limit on rows per file; nothing is moved."""
    df.write.mode(mode).option("compression", "snappy").option("maxRecordsPerFile", rows_per_file).parquet(path)


def save_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "error") -> None:
    """One folder per rank, device or ``ds_type/direction/pair``.

    Rows are rebalanced by folder: small folders get few files, and adaptive execution
    splits a folder that holds much of the table over many writers.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def batch_folder(base: str, total: int | Column, index: str = "row_idx", batch_rows: int = BATCH_ROWS) -> Column:
    """Where ``save_csvs`` puts a batch."""
    name = batch_name(batch_of(F.col(index), batch_rows), total, batch_rows)
    return F.concat(F.lit(f"{base.rstrip('/')}/rows/batch="), name)


def document_folder(doc_id: Column) -> Column:
    """An id as a folder name: its hash where it holds more than letters, digits, dots, dashes and underscores."""
    return F.when(doc_id.rlike(r"^[A-Za-z0-9_-][A-Za-z0-9._-]*$"), doc_id).otherwise(F.sha2(doc_id, 256))


def with_document_csv_paths(docs: DataFrame, base: str, total: int | Column, index: str = "row_idx") -> DataFrame:
    """Adds ``csv_path``: a folder per batch, in it one per document."""
    document = F.concat(F.lit("document="), document_folder(F.col("doc_id")))
    return docs.withColumn("csv_path", F.concat_ws("/", batch_folder(base, total, index), document))


def with_batch_csv_paths(docs: DataFrame, base: str, total: int | Column, index: str = "row_idx") -> DataFrame:
    """Adds ``csv_path`` of the batch and the lines a document takes in it."""
    placed = batch_positions(docs, F.size("sids"), index)
    return placed.withColumn("csv_path", batch_folder(base, total, index))


def csv_rows(tagged: DataFrame, index: str = "row_idx") -> DataFrame:
    """The lines of the CSVs: ``csv_path``, where they stand, ``doc_id, sid, substr``."""
    lines = F.posexplode(F.arrays_zip("sids", "sub_strs")).alias("pos", "_s")
    rows = tagged.select("csv_path", index, "doc_id", lines)
    return rows.select("csv_path", index, "pos", "doc_id", F.col("_s.sids").alias("sid"), F.col("_s.sub_strs").alias("substr"))


def save_csvs(docs: DataFrame, base: str, style: str, total: int | Column, index: str = "row_idx", mode: str = "error") -> DataFrame:
    """Sentence CSVs under ``base/rows`` and a manifest ``base/paths.csv``; gives the tagged documents.

    Style ``doc`` makes a folder per batch and document, ``batch`` one per batch with its
    lines in document order.  The manifest lists these folders; Spark names the files inside.
    """
    if style not in ("doc", "batch"):
        raise ValueError("style must be 'doc' or 'batch'")
    tagged = with_document_csv_paths(docs, base, total, index) if style == "doc" else with_batch_csv_paths(docs, base, total, index)
    folders = ["batch", "document"] if style == "doc" else ["batch"]
    named = lambda kind: F.regexp_extract("csv_path", f"/{kind}=([^/]+)", 1).alias(kind)
    rows = csv_rows(tagged, index).select(*map(named, folders), index, "pos", "doc_id", "sid", "substr")
    ordered = rows.repartition("batch").sortWithinPartitions(*folders, index, "pos")
    (
        ordered.select(*folders, "doc_id", "sid", "substr")
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .partitionBy(*folders)
        .csv(f"{base.rstrip('/')}/rows")
    )
    save_manifest(tagged, f"{base.rstrip('/')}/paths.csv", mode)
    return tagged


def save_manifest(tagged: DataFrame, path: str, mode: str = "error") -> None:
    """The ``csv_path`` column as CSV."""
    tagged.select("csv_path").write.mode(mode).option("header", True).csv(path)


def with_written(translations: DataFrame, key: str = "tlt_file_loc", text: str = "translated") -> DataFrame:
    """Adds ``written``: whether a row has both a place and a text to store."""
    return translations.withColumn("written", F.col(key).isNotNull() & F.col(text).isNotNull())


def save_translations(translations: DataFrame, path: str, buckets: int = 64, mode: str = "error") -> DataFrame:
    """Store translations keyed by place, in hash buckets; gives every row with its ``written`` status.

    Replaces a file per sentence: the place is a column, and a lookup is a join.  A place
    written more than once, as copies of a document do, is stored once.
    """
    status = with_written(translations)
    bucket = F.pmod(F.xxhash64("tlt_file_loc"), F.lit(buckets)).cast("int")
    stored = status.filter("written").select(F.col("tlt_file_loc").alias("path"), "translated", bucket.alias("bucket"))
    stored = stored.groupBy("bucket", "path").agg(F.min("translated").alias("translated"))
    stored.hint("rebalance", "bucket").write.mode(mode).partitionBy("bucket").parquet(path)
    return status


def one_line(text: Column) -> Column:
    """Text with its line ends (and backslashes) escaped; null is an empty line."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.coalesce(text, F.lit(""))


def save_aligned_text(scored: DataFrame, path: str, mode: str = "error") -> None:
    """Aligned ``pred`` and ``ref`` lines per pair, in id order.

    Both files of a pair are cut from the same range-partitioned rows, so line ``k`` of one
    answers line ``k`` of the other; a pair with very many lines spans several files.  Rows
    are sorted the way the writer needs them, so that it adds no sort of its own.
    """
    pair = F.concat_ws("__", "src_lang", "tgt_lang")
    lines = scored.select(pair.alias("pair"), "id", one_line(F.col("prediction")).alias("pred"), one_line(F.col("reference")).alias("ref"))
    lines = stage_table(lines, "aligned")  # range bounds read the rows as well: predictions are made once
    sides = F.explode(F.create_map(F.lit("pred"), F.col("pred"), F.lit("ref"), F.col("ref"))).alias("side", "value")
    both = lines.repartitionByRange("pair", "id").select("pair", "id", sides).sortWithinPartitions("pair", "side", "id")
    both.select("pair", "side", "value").write.mode(mode).partitionBy("pair", "side").text(path)


def save_device_maps(assigned: DataFrame, path: str, mode: str = "error") -> None:
    """The paths of each device as text lines, a folder per device, in shard order over its files."""
    ordered = assigned.repartitionByRange("device", "shard_idx").sortWithinPartitions("device", "shard_idx")
    ordered.select("device", F.col("path").alias("value")).write.mode(mode).partitionBy("device").text(path)
