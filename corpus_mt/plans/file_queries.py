"""Queries that write files under exact names or run streams with state, and read back what came of it.

Their SQL states the rows that the files have to hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import text as tx
from corpus_mt.operators import evaluate as ev
from corpus_mt.operators import layout as ly
from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import template as tp
from corpus_mt.plans import oracles as sql
from corpus_mt.plans.language_queries import _marks
from corpus_mt.plans.queries import DEVICES, _docs, _ordered_docs, _read, _scored, _shards, _translated
from corpus_mt.session import shared_dir, stage_table
from corpus_mt.sources import named_files as nf
from corpus_mt.sources import ranges as rg
from corpus_mt.sources.readers import read_stream, read_table
from corpus_mt.streaming import numbering as nb
from corpus_mt.streaming import replacing as rs
from corpus_mt.streaming import stream as stm

CAP, PARTS = 150, 3


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_name():
    return F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "/", -1)


def csv_files(spark, d):
    """The sentence CSVs of every batch, found by the paths of the manifest."""
    base = _folder(spark, "csv")
    docs = _ordered_docs(read_table(spark, f"{d}/documents.parquet"))
    nf.save_csv_files(docs, base, "batch", F.col("n_docs"))
    listed = spark.read.option("header", True).csv(f"{base}/paths.csv").select(F.substring_index("csv_path", "/", -1).alias("file")).distinct()
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("pathGlobFilter", "[0-9a-f]*[0-9a-f]").csv(base)
    return rows.select(_file_name().alias("file"), "doc_id", "sid", "substr").join(listed, "file")


def substring_files(spark, d):
    """Turns of a conversation as substrings of a document, one file each."""
    base = _folder(spark, "substr")
    place = F.concat_ws("/", F.lit(base), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    rows = _read(spark, d, "conversations").select(place.alias("tlt_file_loc"), F.when(F.col("turn") % 5 != 4, F.reverse("text")).alias("translated"))
    nf.save_substring_files(rows, base)
    return nf.read_named(spark, base).select(F.col("file").alias("path"), F.col("body").alias("translated"))


def _with_targets(rows: DataFrame) -> DataFrame:
    """The language of a turn by its number: English, Hindi, Tamil, Urdu."""
    tags = F.array(*[F.lit(t) for t in TARGETS])
    return rows.withColumn("tgt_lang", F.get(tags, F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(TARGETS))).cast("int")))


TARGETS = (lang.ENGLISH, "hin_Deva", "tam_Taml", "urd_Arab")


def pred_ref_files(spark, d):
    """The two files of each pair, line by line."""
    base = _folder(spark, "pairs")
    rows = _with_targets(_scored(spark, d)).withColumns({"src_lang": F.lit("kan_Knda"), "id": F.col("conv_id") * 1000 + F.col("turn")})
    nf.save_pred_ref(rows, base)
    return nf.read_named(spark, base, "*.txt").select("file", F.posexplode(F.split("body", "\n", -1)).alias("line", "text"))


def capped_files(spark, d):
    """Written twice from rows that lie differently; every file is there once, under the name of its rows."""
    base = _folder(spark, "capped")
    docs = read_table(spark, f"{d}/documents.parquet").select("doc_id", "lang", "n_chars")
    for parts in (3, 5):
        nf.save_capped_files(docs.repartition(parts), base, ("doc_id",), CAP)
    return spark.read.parquet(base).select(_file_name().alias("file"), "doc_id", "lang", "n_chars")


def device_files(spark, d):
    """Shard folders that are there, listed and dealt to devices."""
    base = _folder(spark, "devices")
    shards = _shards(spark, d).select(F.regexp_replace("path", ".*/", "").alias("shard"))
    nf.save_named(shards.select(F.concat_ws("/", F.lit("in"), "shard", F.lit("rows")).alias("file"), F.lit("x").alias("body")), base, [])
    nf.save_device_files(rg.list_entries(spark, f"{base}/in").filter("is_folder"), f"{base}/out", DEVICES)
    lines = nf.read_named(spark, f"{base}/out").select("file", F.posexplode(F.split(F.rtrim("body", F.lit("\n")), "\n")).alias("line", "path"))
    return lines.select("file", "line", F.substring_index("path", "/", -1).alias("shard"))


def split_range(spark, d):
    """A range of rows by the footers."""
    return rg.read_range(spark, f"{d}/documents.parquet", "train[10%:35%]", ["doc_id", "lang", "n_chars"])


def stream_numbers(spark, d):
    """Sentences of documents that arrive in several parts, numbered on from part to part."""
    base = _folder(spark, "numbers")
    raw = ly.number_rows(read_table(spark, f"{d}/documents.parquet").select("doc_id", "text"), ["doc_id"], total="n")
    raw = raw.withColumn("part", F.floor(F.col("row_idx") * PARTS / F.col("n")))

    def sentences(batch: DataFrame) -> DataFrame:
        docs = tp.template_documents(batch, "text", "doc_id", source_type="web", keep=("row_idx",))
        return sn.explode_sentences(docs, ("doc_id", "row_idx"))

    for k in range(PARTS):  # one after the other, as folders that arrive: each of as many files as tasks write
        raw.filter(F.col("part") == k).select("doc_id", "text", "row_idx").write.mode("append").parquet(f"{base}/in")
        stream = read_stream(spark, f"{base}/in", "doc_id bigint, text string, row_idx bigint")
        nb.run_numbered(stream, f"{base}/out", f"{base}/progress", ("row_idx", "pos"), prepare=sentences).awaitTermination()
    return nb.read_numbered(spark, f"{base}/out").select("doc_id", "pos", "sid", "tlt_idx")


def stream_replace(spark, d):
    """Documents and their translations as two streams of several files; all documents go out whole."""
    base = _folder(spark, "replace")
    docs = _docs(spark, d).select("doc_id", "text", "sub_strs", "sids")
    tasks = docs.rdd.getNumPartitions()
    parts = PARTS * -(-tasks // PARTS)
    arriving = docs.select("doc_id", "text", "sub_strs")
    (arriving if tasks >= PARTS else arriving.repartition(PARTS)).write.parquet(f"{base}/docs", compression="zstd")
    translated = _translated(sn.explode_sentences(docs, ("doc_id",)))
    translated.select("doc_id", "pos", "translated").repartition(parts, "pos", "doc_id").write.parquet(f"{base}/tr", compression="zstd")

    def read(name: str, schema: str) -> DataFrame:
        files = len(spark.read.schema(schema).parquet(f"{base}/{name}").inputFiles())
        return read_stream(spark, f"{base}/{name}", schema, maxFilesPerTrigger=str(max(1, -(-files // PARTS))))

    out = rs.replace_stream(read("docs", "doc_id string, text string, sub_strs array<string>"), read("tr", "doc_id string, pos int, translated string"))
    stm.write_stream(out, f"{base}/out", f"{base}/progress", conf=rs.STATE_CONF, compression="zstd").awaitTermination()
    return read_table(spark, f"{base}/out").select("doc_id", "translated")


def lookup_by_sid(spark, d):
    """Translations that know their substring by its id alone, in place of its position."""
    # Staged, as three sides read them; the ids are hashes of the substrings and need not be stored.
    docs = stage_table(_docs(spark, d).select("doc_id", "text", "sub_strs"), "docs").withColumn("sids", tx.substring_ids(F.col("sub_strs")))
    rows = _translated(sn.explode_sentences(docs)).select("doc_id", "sid", "translated")
    return rp.replace_documents(docs, rows).select("doc_id", "translated")


def target_scores(spark, d):
    """Scores by target language, each on its own words."""
    rows = _with_targets(_scored(spark, d))
    scores = ev.target_scores(rows, ["tgt_lang"])
    return scores.select("tgt_lang", F.round("bleu", 6).alias("bleu"), F.round("chrf", 6).alias("chrf"))


QUERIES: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (csv_files, substring_files, pred_ref_files, capped_files, device_files, split_range, stream_numbers, stream_replace, lookup_by_sid, target_scores)
}

# --- the same in SQL ------------------------------------------------------------------------------

_TAG = "[" + ", ".join(f"'{t}'" for t in TARGETS) + "][(conv_id + turn) % 4 + 1]"
_ONE_LINE = "replace(replace(replace({x}, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r')"
_TAGGED = f"SELECT conv_id, turn, {_TAG} AS tgt_lang, lower(text) AS ref, {sql._WORSE} AS pred FROM conversations"


def _words_13a(x: str) -> str:
    x = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for escape, c in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, '{escape}', '{c}')"
    x = f"' ' || {x} || ' '"
    for pattern, new in ((r"([{-~\[-` -&(-+:-@/])", r" \1 "), (r"([^0-9])([.,])", r"\1 \2 "), (r"([.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _words_urdu(x: str) -> str:
    marks = "[!-/:-@\\[\\]-`{-~\\x{609}\\x{60a}\\x{60c}\\x{61e}\\x{66a}-\\x{66d}\\x{6d4}]"
    return f"trim(regexp_replace(regexp_replace(replace({x}, chr(9), ' '), '({marks})', ' \\1 ', 'g'), ' {{2,}}', ' ', 'g'))"


def _side(x: str, english: str) -> str:
    indic = f"CASE WHEN tgt_lang = 'urd_Arab' THEN {_words_urdu(x)} ELSE {_marks(x)} END"
    return f"CASE WHEN tgt_lang = '{lang.ENGLISH}' THEN {english} ELSE trim(regexp_replace({indic}, '\\s+', ' ', 'g')) END"


_EDGE = "[!-/:-@\\[-`{-~]"
_CHRF_WORDS = (
    "flatten(list_transform(" + sql._SPLIT_WORDS.replace("lambda w:", "lambda v:").replace("w <> ''", "v <> ''") + ", lambda w: CASE WHEN length(w) = 1 THEN [w] "
    f"WHEN regexp_matches(w, '{_EDGE}$') THEN [w[:-2], w[-1:]] WHEN regexp_matches(w, '^{_EDGE}') THEN [w[1:1], w[2:]] ELSE [w] END))"
).replace(_EDGE, _EDGE.replace("{", "{{"))

_SCORES = f"""
WITH tagged AS ({_TAGGED}),
scored AS (SELECT conv_id, turn, tgt_lang, {_side('ref', _words_13a('ref'))} AS ref, {_side('pred', _words_13a('pred'))} AS pred FROM tagged)
""" + sql._gram_counts(4, sql._SPLIT_WORDS, " ", "", "conv_id, turn", "tgt_lang", "_w").replace(",\nsides_w", ", sides_w", 1) + f"""
, shown AS (SELECT conv_id, turn, tgt_lang, {_side('ref', 'ref')} AS ref, {_side('pred', 'pred')} AS pred FROM tagged)
""" + sql._gram_counts(6, sql._SPLIT_CHARS, "", "", "conv_id, turn", "tgt_lang", "_c").replace("FROM scored", "FROM shown") + sql._gram_counts(
    2, _CHRF_WORDS, " ", "", "conv_id, turn", "tgt_lang", "_v"
).replace("FROM scored", "FROM shown") + """
, ranked AS (SELECT *, count(*) FILTER (m = 0) OVER (PARTITION BY tgt_lang ORDER BY n) AS missed FROM stats_w),
b AS (
  SELECT tgt_lang, round(CASE WHEN count(*) < 4 OR max(m) = 0 OR min(tp) = 0 THEN 0.0 ELSE
    100 * CASE WHEN sum(tp) FILTER (n = 1) >= sum(tr) FILTER (n = 1) THEN 1.0 ELSE exp(1 - (sum(tr) FILTER (n = 1)) / (sum(tp) FILTER (n = 1))) END
    * exp(sum(ln(CASE WHEN m > 0 THEN m ELSE pow(2, -missed) END / tp)) / 4) END, 6) AS bleu
  FROM ranked GROUP BY tgt_lang
),
every AS (SELECT tgt_lang, n, m, tp, tr FROM stats_c UNION ALL SELECT tgt_lang, n + 6, m, tp, tr FROM stats_v),
pr AS (SELECT tgt_lang, avg(m / tp) AS p, avg(m / tr) AS r FROM every WHERE tp > 0 AND tr > 0 GROUP BY tgt_lang)
SELECT tgt_lang, bleu, """ + sql._CHRF + " FROM b JOIN pr USING (tgt_lang)"

ORACLES: dict[str, str] = {
    "csv_files": f"WITH {sql.LOCATED} SELECT name AS file, doc_id, sid, sub_str AS substr FROM sentences JOIN folders USING (raw_id)",
    "substring_files": "SELECT conv_id::VARCHAR || '/' || turn::VARCHAR AS path, reverse(text) AS translated FROM conversations WHERE turn % 5 <> 4",
    "pred_ref_files": f"""
        WITH t AS ({_TAGGED}), s AS (
          SELECT *, 'pred.txt' AS side, {_ONE_LINE.format(x="pred")} AS text FROM t UNION ALL SELECT *, 'ref.txt', {_ONE_LINE.format(x="ref")} FROM t)
        SELECT 'kan_Knda__' || tgt_lang || '/' || side AS file, (row_number() OVER (PARTITION BY tgt_lang, side ORDER BY conv_id, turn) - 1)::INTEGER AS line, text FROM s""",
    "capped_files": f"""
        WITH r AS (SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
        SELECT sha256('[' || string_agg(i::VARCHAR, ', ') OVER (PARTITION BY i // {CAP} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) || ']') || '.parquet' AS file,
          doc_id, lang, n_chars FROM r""",
    "device_files": """
        WITH p AS (SELECT DISTINCT ((row_number() OVER (ORDER BY doc_id) - 1) // 16)::VARCHAR AS shard FROM documents),
        r AS (SELECT shard, row_number() OVER (ORDER BY shard) - 1 AS i FROM p)
        SELECT 'device_map_' || [3, 1, 4][i % 3 + 1]::VARCHAR AS file, (i // 3)::INTEGER AS line, shard FROM r""",
    "split_range": sql.ORACLES["split_slice"],
    "stream_numbers": sql.ORACLES["global_index"],
    "stream_replace": sql.ORACLES["replace_documents"],
    "lookup_by_sid": sql.ORACLES["replace_documents"],
    "target_scores": _SCORES,
}
