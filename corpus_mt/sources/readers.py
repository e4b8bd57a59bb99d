"""Reading tables, vocabularies, translations and shard lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpus_mt.operators.tokens import Vocabulary


def read_table(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """Files, folders or globs, on any file system Spark can reach (object stores by URI)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The same files read lazily, as they arrive."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def read_vocabulary(spark: SparkSession, source: str, target: str, fmt: str = "json") -> Vocabulary:
    """Both sides of a vocabulary.

    ``json`` is one object of token to id per file; any other format is a table with
    columns ``token, id``.
    """

    def one(path: str) -> DataFrame:
        if fmt != "json":
            return spark.read.format(fmt).load(path).select("token", F.col("id").cast("int").alias("id"))
        whole = spark.read.text(path, wholetext=True)
        pairs = whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
        return pairs

    return Vocabulary(one(source), one(target)).require_specials()


def read_translations(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored translation table; text files named by path and sid are read with ``fmt='text'``."""
    if fmt != "text":
        return spark.read.format(fmt).load(path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    # The reader gives URIs, with odd characters as percent codes.
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return files.select(place.alias("path"), F.col("value").alias("translated"))


def read_parallel(spark: SparkSession, folders: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Parallel evaluation tables by data set: ``ds_type``, ``id`` and one ``sentence_<lang>`` column per language."""
    out = None
    for ds_type, path in folders.items():
        table = spark.read.format(fmt).load(path)
        if not any(c.startswith("sentence_") for c in table.columns):
            raise ValueError("a parallel table needs sentence_<lang> columns")
        table = table.withColumn("ds_type", F.lit(ds_type))
        out = table if out is None else out.unionByName(table)
    return out


def list_shards(spark: SparkSession, root: str) -> DataFrame:
    """Paths of the files under a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
