"""Row numbers that run on from one micro-batch to the next.

Every micro-batch leaves an entry in a ledger: the number after its last row.  The next one starts there.  An
entry is written after the rows it stands for, so a micro-batch that is repeated finds the same start, numbers the same
rows alike and replaces its own folder.  Steps that work on batches of consecutive numbers get whole batches only: the rows of
an unfinished one wait in the ledger for the rows that follow.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpus_mt.operators.layout import number_rows
from corpus_mt.sources.named_files import open_store


class Ledger:
    """One small file per micro-batch, in a folder of its own."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.store, self.place = open_store(self.folder)

    def _file(self, epoch: int) -> str:
        return f"{self.place}/epoch={epoch:012d}.json"

    def next_number(self, epoch: int) -> int:
        """Where micro-batch ``epoch`` starts: behind the latest one before it."""
        return self._before(epoch).get("next", 0)

    def waiting(self, epoch: int) -> str | None:
        """The folder of the rows that micro-batch ``epoch`` begins with, if any wait."""
        return self._before(epoch).get("waiting")

    def _before(self, epoch: int) -> dict:
        names = [f.base_name for f in self.store.get_file_info(pafs.FileSelector(self.place, allow_not_found=True)) if f.base_name.endswith(".json")]
        known = [e for e in (int(n.removeprefix("epoch=").removesuffix(".json")) for n in names) if e < epoch]
        if not known:
            return {}
        with self.store.open_input_file(self._file(max(known))) as f:
            return json.loads(f.read())

    def commit(self, epoch: int, **entry) -> None:
        """Written aside and moved into place, so an entry is there whole or not at all."""
        self.store.create_dir(self.place, recursive=True)
        aside = f"{self.place}/.epoch={epoch}"
        with self.store.open_output_stream(aside) as f:
            f.write(json.dumps(entry).encode())
        self.store.move(aside, self._file(epoch))


def _apply(rows: DataFrame, step: Callable[[DataFrame], DataFrame] | None, path: str) -> None:
    (step(rows) if step else rows).write.mode("overwrite").parquet(path)


def run_numbered(
    df: DataFrame,
    path: str,
    checkpoint: str,
    order_by: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    step: Callable[[DataFrame], DataFrame] | None = None,
    batch_rows: int | None = None,
    index: str = "tlt_idx",
    available_now: bool = True,
) -> StreamingQuery:
    """Number the rows of a stream, each micro-batch into its own folder ``epoch=<n>`` below ``path``.

    ``prepare`` makes the rows of a micro-batch, ``order_by`` orders them within it, and ``step`` works on the
    numbered rows; with ``batch_rows`` it sees whole batches of so many consecutive numbers only, and what is left in
    the end is written by ``finish_numbered``.  Numbers have no gaps and no repeats, whatever is repeated.
    """
    ledger = Ledger(f"{checkpoint.rstrip('/')}/ledger")

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = prepare(batch) if prepare else batch
        start = ledger.next_number(epoch)
        numbered = number_rows(rows, order_by, index, start, "_n")
        n = numbered.agg(F.max("_n")).first()[0] or 0
        numbered, end, entry = numbered.drop("_n"), start + n, {}
        if batch_rows:
            held = ledger.waiting(epoch)
            if held:
                numbered = batch.sparkSession.read.schema(numbered.schema).parquet(held).unionByName(numbered)
            whole = end // batch_rows * batch_rows
            if end > whole:
                entry["waiting"] = f"{ledger.folder}/waiting/epoch={epoch}"
                numbered.filter(F.col(index) >= whole).write.mode("overwrite").parquet(entry["waiting"])
            numbered = numbered.filter(F.col(index) < whole)
        _apply(numbered, step, f"{path.rstrip('/')}/epoch={epoch}")
        ledger.commit(epoch, next=end, **entry)

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def finish_numbered(spark: SparkSession, path: str, checkpoint: str, step: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write the rows that still wait for a whole batch, once the stream has ended; gives the number of all rows.

    They go to ``epoch=last``, which a stream that is started again has to remove first.
    """
    ledger = Ledger(f"{checkpoint.rstrip('/')}/ledger")
    held = ledger.waiting(1 << 40)
    if held:
        _apply(spark.read.parquet(held), step, f"{path.rstrip('/')}/epoch=last")
    return ledger.next_number(1 << 40)


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all micro-batches."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)
