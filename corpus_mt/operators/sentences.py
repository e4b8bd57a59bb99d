"""Documents to sentences, and row-range splits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpus_mt.functions.text import content_id, strip
from corpus_mt.operators.layout import number_rows


def open_list(df: DataFrame, keep: Sequence[str], values: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """One row per element of an array column, with its position; empty lists give none.

    The outer form, because the inner one makes the optimizer add a not-empty filter, which
    it then pushes to the scan together with the whole computation of the array.
    """
    rows = df.select(*keep, F.posexplode_outer(values).alias(pos, value))
    return rows.filter(F.col(pos).isNotNull())


def explode_sentences(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per non-blank substring: kept columns, ``pos``, ``sid``, ``sub_str``.

    With ``tlt_folder`` present, each row also gets the place of its translation.  The
    document text is not carried along.
    """
    has_folder = "tlt_folder" in docs.columns
    carried = [*dict.fromkeys([*keep, *(["tlt_folder"] if has_folder else [])])]
    zipped = docs.select(*carried, F.arrays_zip("sids", "sub_strs").alias("_zip"))
    rows = open_list(zipped, carried, "_zip", value="_s").select(
        *carried, "pos", F.col("_s.sids").alias("sid"), F.col("_s.sub_strs").alias("sub_str")
    )
    rows = rows.filter(strip(F.col("sub_str")) != "")
    if has_folder:
        rows = rows.withColumn("tlt_file_loc", F.concat_ws("/", "tlt_folder", "sid"))
        rows = rows if "tlt_folder" in keep else rows.drop("tlt_folder")
    return rows


def shorten_ids(rows: DataFrame) -> DataFrame:
    """Sentence rows as they are best moved; ``restore_ids`` undoes it, whatever the ids are.

    A substring's id that is the hash of its text is left out, to be worked out again, and a document's id that
    is a hash in hex becomes its bytes, half as many.
    """
    own = F.col("sid").eqNullSafe(content_id(F.col("sub_str")))
    short = {"sid": F.struct(own.alias("own"), F.when(~own, F.col("sid")).alias("other"))}
    if "doc_id" in rows.columns and rows.schema["doc_id"].dataType == StringType():
        hashed = F.col("doc_id").rlike(r"\A[0-9a-f]{64}\z")
        short["doc_id"] = F.struct(F.when(hashed, F.unhex("doc_id")).alias("hash"), F.when(~hashed, F.col("doc_id")).alias("other"))
    return rows.withColumns(short)


def restore_ids(rows: DataFrame) -> DataFrame:
    """Rows of ``shorten_ids`` with their ids as they were."""
    plain = {"sid": F.when(F.col("sid.own"), content_id(F.col("sub_str"))).otherwise(F.col("sid.other"))}
    if "doc_id" in rows.columns and rows.schema["doc_id"].dataType.typeName() == "struct":
        plain["doc_id"] = F.coalesce(F.lower(F.hex("doc_id.hash")), F.col("doc_id.other"))
    return rows.withColumns(plain)


def add_global_index(sentences: DataFrame, order_by: tuple[str, ...] = (), name: str = "tlt_idx") -> DataFrame:
    """Contiguous ``tlt_idx``; without ``order_by`` rows keep the order of their files."""
    return number_rows(sentences, order_by, name)


def parse_split(split: str, total: int) -> tuple[int, int] | None:
    """Row range of ``name[a:b]`` in counts or percent; None stands for the whole table.

    One percent sign is enough when the other side is open.  A range that is reversed or
    ends past the table also gives the whole table.
    """
    found = re.search(r"\[(.*?)\]", split)
    if not found or not found.group(1):
        return None
    lo, _, hi = found.group(1).partition(":")
    if not lo and not hi:
        return None
    if all("%" in side for side in (lo, hi) if side):
        first = int(total * (float(lo.rstrip("%") or 0) / 100))
        last = int(total * (float(hi.rstrip("%") or 100) / 100))
    else:
        first, last = int(lo or 0), int(hi or total)
    return (first, last) if first <= last <= total else None


def split_slice(df: DataFrame, split: str, order_by: tuple[str, ...] = (), index: str | None = None) -> DataFrame:
    """Rows of a contiguous range such as ``train[10%:20%]``.

    ``index`` names an existing row number column; otherwise rows are numbered first.
    """
    bounds = parse_split(split, df.count()) if "[" in split else None
    if bounds is None:
        return df
    numbered = df if index else number_rows(df, order_by, "_row_number")
    i = F.col(index or "_row_number")
    picked = numbered.filter((i >= bounds[0]) & (i < bounds[1]))
    return picked if index else picked.drop("_row_number")


def head_sample(df: DataFrame, n: int, order_by: tuple[str, ...] = ()) -> DataFrame:
    """The first ``n`` rows (a top-n per partition, then a merge)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
