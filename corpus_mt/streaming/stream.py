"""The stages over files that keep arriving.

Templating, exploding and text processing have no state, so the batch column functions run
unchanged in a stream.  Steps that number or gather rows run per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpus_mt.operators.sentences import explode_sentences
from corpus_mt.operators.template import template_documents


def stream_sentences(raw: DataFrame, mode: str = "sentence", **columns) -> DataFrame:
    """Sentence rows of a streaming table of raw documents."""
    return explode_sentences(template_documents(raw, mode=mode, **columns))


def write_stream(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = True, conf: Mapping[str, str] | None = None, **options: str
) -> StreamingQuery:
    """Append to parquet, exactly once; by default stop when all present files are done.

    ``conf`` holds settings for this query: it takes those of its session as it starts, and these are put back then.
    """
    writer = df.writeStream.format("parquet").options(**options).option("checkpointLocation", checkpoint).outputMode("append")
    settings = df.sparkSession.conf
    before = {name: settings.get(name, None) for name in conf or ()}
    try:
        for name, value in (conf or {}).items():
            settings.set(name, value)
        return (writer.trigger(availableNow=True) if available_now else writer).start(path)
    finally:
        for name, value in before.items():
            settings.unset(name) if value is None else settings.set(name, value)


def run_batches(
    df: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Run a batch operator on every micro-batch, each into its own folder ``epoch=<n>``.

    A micro-batch that is retried overwrites its own folder, so no row is written twice.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
