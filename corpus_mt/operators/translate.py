"""Running a caller's translator over token arrays or sentences."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from corpus_mt.functions.text import meeting_key
from corpus_mt.operators.sentences import restore_ids, shorten_ids
from corpus_mt.operators.skew import spread_join
from corpus_mt.session import stage_table

# Takes padded ids and masks as two-dimensional arrays, gives one id sequence per row.
BatchTranslator = Callable[[np.ndarray, np.ndarray], Sequence[Sequence[int]]]

MODEL_OUTPUT_COLUMNS = (
    "doc_id",
    "input_ids",
    "sid",
    "sub_str",
    "tlt_idx",
    "placeholder_entity_map",
    "translated_input_ids",
    "tlt_file_loc",
)


def _pad_left(lists: pa.ListArray, fill: int) -> np.ndarray:
    """Rows of a list array as one matrix, filled up on the left."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width).copy()
    out = np.full((len(lists), width), fill, dtype="int32")
    out[np.arange(width) >= width - sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def translate_ids(
    df: DataFrame,
    make_translator: Callable[[], BatchTranslator],
    batch_rows: int = 64,
    pad_id: int = 1,
    keep_mask: bool = False,
) -> DataFrame:
    """Adds ``translated_input_ids``; the attention mask is used up unless it is to be kept.

    ``make_translator`` runs once per task (a model is loaded there) and its result is
    called with batches of at most ``batch_rows`` rows, each padded to its own longest row.
    Rows stay where they are: no shuffle, and only ids and masks go to Python.
    """

    @F.arrow_udf(ArrayType(IntegerType()))
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        translator = None
        for ids, masks in batches:
            translator = translator or make_translator()
            outputs: list[np.ndarray] = []
            for at in range(0, len(ids), batch_rows):
                part = _pad_left(ids.slice(at, batch_rows), pad_id), _pad_left(masks.slice(at, batch_rows), 0)
                outputs += (np.asarray(o, dtype="int32") for o in translator(*part))
            ends = np.cumsum([0, *map(len, outputs)]).astype("int32")
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "int32"), *outputs])))

    # Not deterministic as far as Spark is concerned: a model is run once for every row, wherever its output is used.
    done = df.withColumn("translated_input_ids", run.asNondeterministic()("input_ids", "attention_mask"))
    return done if keep_mask else done.drop("attention_mask")


def model_output(df: DataFrame, entities: str = "entities") -> DataFrame:
    """The columns kept from a model run, entities spelled out as a JSON map."""
    from corpus_mt.functions.sentences import entity_map

    spelled = F.when(F.size(entities) == 0, F.lit("{}")).otherwise(F.to_json(entity_map(F.col(entities))))
    return df.withColumn("placeholder_entity_map", spelled).select(*MODEL_OUTPUT_COLUMNS)


def distinct_sentences(sentences: DataFrame) -> DataFrame:
    """Each sentence once: ``sid``, ``sub_str`` and how often it occurs.

    Counts are combined before the shuffle, so a sentence repeated everywhere costs one
    row per task.  Grouping by the text as well changes nothing (the id is its hash) and
    leaves a plain count, which hash aggregation can do; a text buffer would force a sort.
    An id that is the text's hash is not moved but worked out again.
    """
    short = shorten_ids(sentences.select("sid", "sub_str"))
    return restore_ids(short.groupBy("sid", "sub_str").agg(F.count(F.lit(1)).alias("n_uses")))


def fan_out(sentences: DataFrame, translations: DataFrame, how: str = "left", key: str = "sid") -> DataFrame:
    """Join translations of distinct sentences (``key``, ``n_uses``, ...) back to every use.

    Uses of a frequent sentence are dealt over several tasks and its translation copied to each.
    """
    counts = translations.select(key, F.col("n_uses").alias("n"))
    return spread_join(sentences, translations.drop("n_uses"), key, counts, how)


def translate_distinct(sentences: DataFrame, translate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Translate every distinct sentence once and give the result to all its uses.

    ``translate`` gets ``sid, sub_str, n_uses`` and must keep ``sid`` and ``n_uses`` and add
    ``translated``.  Its result is staged: the model never runs twice for a lost executor.
    Uses meet translations by a key that is shorter than the id.
    """
    key = meeting_key(F.col("sid")).alias("_meet")
    done = stage_table(translate(distinct_sentences(sentences)).select(key, "n_uses", "translated"), "translated", "zstd")
    return fan_out(sentences.select("*", key), done, key="_meet").drop("_meet")
