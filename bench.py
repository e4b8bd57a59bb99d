"""Times the headline queries end to end and prints one JSON line.

Every query runs whole, into a sink that discards the rows.  BENCH_SF_DIR names the input
folder, BENCH_CPUS the number of cores.  The given tables are single files of one row group, which
a scan can't split; before timing they are dealt once into as many files as a larger table would have.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from corpus_mt.plans.queries import QUERIES  # noqa: E402
from corpus_mt.session import build_session  # noqa: E402

HEADLINE = (
    "terminal_line_filter",
    "doc_ids",
    "url_source",
    "timestamp_text",
    "chunk_template",
    "sentence_template",
    "sentence_rows",
    "stream_sentences",
    "global_index",
    "batch_csv_positions",
    "punct_norm",
    "entity_spans",
    "entity_wrap",
    "entity_restore",
    "preprocess",
    "encode_ids",
    "binarize",
    "pad_longest",
    "model_output",
    "decode",
    "postprocess",
    "translate_distinct",
    "translation_lookup",
    "replace_documents",
    "round_trip",
    "evaluation_run",
    "corpus_bleu",
    "corpus_chrf",
)


def deal(spark: SparkSession, folder: str, parts: int) -> str:
    """The folder's tables, each in ``parts`` files of a new folder."""
    out = tempfile.mkdtemp(prefix="bench-")
    for table in sorted(os.listdir(folder)):
        if table.endswith(".parquet"):
            spark.read.parquet(f"{folder}/{table}").repartition(parts).write.parquet(f"{out}/{table}")
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus) if cpus.isdigit() else 16),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small run starts the Python workers and warms the JVM; it is not counted.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        QUERIES["round_trip"](spark, small).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    dealt = deal(spark, folder, 2 * int(cpus) if cpus.isdigit() else 16)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, dealt).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
