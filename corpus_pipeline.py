"""From raw documents to packed sequences, in stages that each read what the one before kept.

Language identification drops what has no language or an unsure one, quality rules drop what fails
them, near duplicates leave one document per class, the rest is mixed to the target weights of its
sources, and the mixed documents are packed in the order of the mix.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_mt.llm import langid, mixing, neardup, packing, quality
from corpus_mt.llm.queries import MIX_POWER, TOKENIZER
from corpus_mt.session import shared_dir

LEAST_SCORE = 0.5
# Slots of the mix, of a block each, whose documents are packed together.
WINDOW_SLOTS = 32


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language, told with a probability of at least ``LEAST_SCORE``."""
    model = langid.fit(docs.filter(~langid.held_out() & F.col("doc_id").isNotNull()))
    boxed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    judged = langid.predict(boxed, model)
    return judged.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIX_POWER)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed within windows of the mix, which is worked out again: a table that is read back has no order."""
    mixed = mixing.schedule(docs, MIX_POWER).withColumn("_window", F.floor(F.col("slot") / WINDOW_SLOTS))
    return packing.pack_windows(mixed, public_tokenizers.path(TOKENIZER), "_window")


STAGES = [
    ("language_id", by_language),
    ("quality_rules", by_quality),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("best_fit_packing", packed),
]

# Models and similarity search are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
