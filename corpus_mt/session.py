"""Session helpers and the shared scratch area for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "corpus_mt", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; pass ``conf`` to override."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, which every executor can reach.

    Only a local session may fall back to a temporary folder of this machine.
    """
    existing = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpus_mt-"))
    return spark.sparkContext.getCheckpointDir()


def staged_dir(spark: SparkSession) -> str:
    """The folder of this application's staged tables."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def stage_table(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so an executor lost later costs a re-read and not a recomputation,
    and fixes the rows: later passes see the same values whatever is retried.  All tables of an
    application are in ``staged_dir``, which its owner removes when no result is read any more.  ``compression``
    names a codec other than the session's, for tables of much text.
    """
    spark = df.sparkSession
    path = f"{staged_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
