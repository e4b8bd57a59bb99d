"""Translations back into their documents."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpus_mt.functions.text import MISSING, meeting_key
from corpus_mt.operators.layout import reroot_path
from corpus_mt.operators.sentences import explode_sentences, open_list, restore_ids, shorten_ids

# Documents of a batch that are Python objects at one time.
SLICE_ROWS = 64


def _replace_by_automaton(text: str, keys: list, values: list) -> str:
    """Time linear in the text: at each place the earliest listed key that starts there wins."""
    automaton = ahocorasick.Automaton()
    for rank, key in enumerate(keys):
        automaton.add_word(key, (rank, len(key)))
    automaton.make_automaton()
    best: dict = {}
    for end, (rank, size) in automaton.iter(text):
        start = end - size + 1
        if start not in best or rank < best[start][0]:
            best[start] = (rank, size)
    done, out = 0, []
    for start in sorted(best):
        if start >= done:
            rank, size = best[start]
            out += (text[done:start], values[rank])
            done = start + size
    return "".join([*out, text[done:]])


@F.arrow_udf(StringType())
def _replace_arrow(text: pa.Array, keys: pa.Array, values: pa.Array) -> pa.Array:
    done = []
    for at in range(0, len(text), SLICE_ROWS):
        rows = zip(*(column.slice(at, SLICE_ROWS).to_pylist() for column in (text, keys, values)), strict=True)
        done.append(pa.array([None if t is None else _replace_by_automaton(t, k, v) for t, k, v in rows], pa.string()))
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def replace_substrings(text: Column, keys: Column, values: Column) -> Column:
    """One left-to-right pass that replaces each key by its value.

    At each place the first listed key wins, and replaced text is not searched again.
    Keys must be distinct and not empty.  Rows without keys do not go to Python.  A built-in
    alternation pattern per row would do the same, but its cost grows with text times keys.
    """
    worth = F.size(keys) > 0
    sent = F.when(worth, text)
    return F.coalesce(_replace_arrow(sent, F.when(worth, keys), F.when(worth, values)), text)


def plain_path(path: Column) -> Column:
    """A path or URI without scheme and host, with one slash at its start."""
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "^/*", "/")


def lookup_translations(
    docs: DataFrame, translations: DataFrame, decode_base: str | None = None
) -> DataFrame:
    """One row per substring whose translation exists: document key columns, ``pos``, ``sub_str``, ``translated``.

    ``docs`` has ``doc_id, sids, sub_strs, tlt_folder``; ``translations`` has ``path,
    translated``, where the path is that of the substring, re-rooted when a base is given.
    Paths meet without their scheme and host, so a table may hold URIs or plain paths.  Copies of a
    document share their paths: a path counts once, however often it was written, and a path
    that very many documents ask for is split by adaptive execution.  What moves is a key of a path, and ids as short as they get.
    """
    rows = explode_sentences(docs, ("doc_id", "tlt_folder"))
    if decode_base:
        rows = rows.withColumn("tlt_file_loc", reroot_path(F.col("tlt_file_loc"), decode_base))
    rows = shorten_ids(rows.withColumn("_path", meeting_key(plain_path(F.col("tlt_file_loc")))).drop("tlt_file_loc"))
    stored = translations.select(meeting_key(plain_path(F.col("path"))).alias("_path"), "translated").filter("translated IS NOT NULL")
    once = stored.groupBy("_path").agg(F.min("translated").alias("translated"))
    return restore_ids(rows.join(once, "_path").drop("_path"))


def count_copies(found: DataFrame, name: str = "n_copies") -> DataFrame:
    """Each different row of substrings once, with the number of rows that are equal to it."""
    short = shorten_ids(found)
    return restore_ids(short.groupBy(*short.columns).agg(F.count(F.lit(1)).alias(name)))


def with_positions(docs: DataFrame, translations: DataFrame) -> DataFrame:
    """``doc_id, pos, translated`` from translations keyed by ``doc_id`` and ``sid``.

    The two meet by the 32 bytes of a substring id's hash, half of what the id itself takes in a shuffle.
    """
    hashed = F.unhex(F.sha2("sid", 256)).alias("_sid")
    ids = open_list(docs, ["doc_id"], "sids", value="sid").select("doc_id", "pos", hashed)
    places = ids.groupBy("doc_id", "_sid").agg(F.min("pos").alias("pos"))
    return places.join(translations.select("doc_id", hashed, "translated"), ["doc_id", "_sid"]).drop("_sid")


def document_translations(translations: DataFrame) -> DataFrame:
    """All translations of a document in one row: ``doc_id`` and a list sorted by position.

    Copies of a document bring the same translations; they are merged before the shuffle,
    so a document copied a million times is no larger than one.  Of several translations of one place the least counts.
    """
    known = translations.filter(F.col("translated").isNotNull())
    found = known.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("pos", "translated"))).alias("_found"))
    first = lambda f, i: (i == 0) | ~f["pos"].eqNullSafe(F.get("_found", i - 1)["pos"])
    return found.withColumn("_found", F.filter("_found", first))


def replace_documents(docs: DataFrame, translations: DataFrame) -> DataFrame:
    """Adds ``translated`` and ``substr_tlt`` to templated documents.

    ``translations`` has ``doc_id, pos, translated``, or ``sid`` in place of ``pos``; a
    substring without one is left as it is.  Documents meet their translations in one join
    on ``doc_id``; adaptive execution splits the document side when one id has very many
    copies.
    """
    if "pos" not in translations.columns:
        translations = with_positions(docs, translations)
    joined = docs.join(document_translations(translations), "doc_id", "left")
    nothing = F.array().cast("array<struct<pos:int,translated:string>>")
    found = F.filter(F.coalesce("_found", nothing), lambda f: F.get("sub_strs", f["pos"]) != "")
    joined = joined.withColumn("_found", found)
    values = F.col("_found")["translated"]
    keys = F.transform("_found", lambda f: F.get("sub_strs", f["pos"]))
    empty = F.col("text").isNull() | (F.col("text") == "")
    return joined.withColumns(
        {
            "translated": F.when(empty, MISSING).otherwise(replace_substrings(F.col("text"), keys, values)),
            "substr_tlt": F.when(empty | (F.size("_found") == 0), F.array(F.lit(MISSING))).otherwise(values),
        }
    ).drop("_found")
