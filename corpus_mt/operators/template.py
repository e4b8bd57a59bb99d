"""Raw documents to templated documents: one row each, with its substrings and their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from corpus_mt.functions import text as tx
from corpus_mt.functions.url import source_name

TEMPLATED_COLUMNS = ("doc_id", "source", "url", "timestamp", "text", "sub_strs", "sids")


def filter_terminal_lines(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Keep only the well-ended lines of each raw document."""
    return df.withColumn(text_col, tx.keep_terminal_lines(F.col(text_col)))


def _given_id(df: DataFrame, id_col: str | None) -> Column | None:
    """The id column as a string, null where it is empty or zero."""
    if id_col is None:
        return None
    col = F.col(id_col)
    if isinstance(df.schema[id_col].dataType, NumericType):
        return F.when(col != 0, col.cast("string"))
    return F.when(col.cast("string") != "", col.cast("string"))


def template_documents(
    df: DataFrame,
    text_col: str = "content",
    id_col: str | None = None,
    url_col: str | None = None,
    timestamp_col: str | None = None,
    source_type: str | None = None,
    mode: str = "sentence",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Template every document that has text; the others are dropped.

    A narrow plan: the row filter sits on the scan and nothing shuffles.  ``keep`` names
    input columns to carry along.
    """
    url = F.col(url_col) if url_col else None
    ts_type = df.schema[timestamp_col].dataType.typeName() if timestamp_col else "string"
    ts = F.col(timestamp_col) if timestamp_col else F.lit(None).cast("string")
    with_text = df.filter(tx.has_text(F.col(text_col))).select(
        *keep,
        (_given_id(df, id_col) if id_col else F.lit(None).cast("string")).alias("_given"),
        (url if url_col else F.lit(None).cast(StringType())).alias("url"),
        tx.timestamp_text(ts, ts_type).alias("timestamp"),
        tx.plain_timestamp(ts, ts_type).alias("_plain_ts"),
        tx.canonical_text(F.col(text_col)).alias("text"),
    )
    split = with_text.select(
        *keep,
        tx.document_id(
            F.col("text"), F.col("_given"), F.col("url"), F.col("_plain_ts"), source_type
        ).alias("doc_id"),
        source_name(F.col("url")).alias("source"),
        "url",
        "timestamp",
        "text",
        tx.substrings(F.col("text"), mode).alias("sub_strs"),
    )
    return split.select("*", tx.substring_ids(F.col("sub_strs")).alias("sids")).select(*keep, *TEMPLATED_COLUMNS)


def drop_missing_documents(df: DataFrame) -> DataFrame:
    """Drop templated rows without a document id."""
    return df.filter(F.col("doc_id").isNotNull() & (F.col("doc_id") != tx.MISSING))


def arrays_to_json(df: DataFrame, *cols: str) -> DataFrame:
    """Arrays as JSON text, for readers that keep them in strings."""
    return df.withColumns({c: F.to_json(c) for c in cols})


def arrays_from_json(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.from_json(c, "array<string>") for c in cols})
