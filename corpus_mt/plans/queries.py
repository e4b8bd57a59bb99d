"""One query per operator over the given tables.

Each takes ``(spark, folder)`` and gives a DataFrame.  Arrays are joined to strings so that
results compare by value.  ``oracles.py`` states the same results in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import sentences as st
from corpus_mt.functions import text as tx
from corpus_mt.functions import url as ur
from corpus_mt.operators import evaluate as ev
from corpus_mt.operators import layout as ly
from corpus_mt.operators import replace as rp
from corpus_mt.operators import sentences as sn
from corpus_mt.operators import template as tp
from corpus_mt.operators import tokens as tk
from corpus_mt.operators import translate as tr
from corpus_mt.sources import sinks
from corpus_mt.session import shared_dir, stage_table
from corpus_mt.sources.readers import read_stream, read_table
from corpus_mt.streaming import stream as stm

SRC, TGT = "eng_Latn", "hin_Deva"
BASE = "/corpus/translated"
SHARD_BASE = "/corpus/shards"
BATCH_ROWS = 64
WORLD = 8
DEVICES = (3, 1, 4)


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A given table."""
    return read_table(spark, f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str, mode: str = "sentence") -> DataFrame:
    """Templated documents."""
    return tp.template_documents(_read(spark, d, "documents"), "text", "doc_id", source_type="web", mode=mode)


def _kept(raw: DataFrame) -> DataFrame:
    """Raw documents that templating keeps, numbered in id order next to their count."""
    return ly.number_rows(raw.select("doc_id", "text").filter(tx.has_text(F.col("text"))), ["doc_id"], total="n_docs")


def _ordered_docs(raw: DataFrame) -> DataFrame:
    """Templated documents with their numbers; numbering comes first only because it is the cheaper order."""
    docs = tp.template_documents(_kept(raw), "text", "doc_id", source_type="web", keep=("row_idx", "n_docs"))
    return tp.drop_missing_documents(docs)


def _located_docs(spark: SparkSession, d: str) -> DataFrame:
    return ly.add_translation_folder(_ordered_docs(read_table(spark, f"{d}/documents.parquet")), BASE, F.col("n_docs"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return sn.explode_sentences(_docs(spark, d))


def _indexed(spark: SparkSession, d: str) -> DataFrame:
    """Numbered sentences of all documents, in (raw id, position) order.

    Raw documents are sorted; templating and opening keep their order, so the sentences are
    numbered where they lie.
    """
    raw = read_table(spark, f"{d}/documents.parquet").select("doc_id", "text")
    docs = tp.template_documents(ly.sort_rows(raw, ["doc_id"]), "text", "doc_id", source_type="web")
    return sn.add_global_index(sn.explode_sentences(docs))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as numbered sentences; ``tlt_idx`` is the rank of (conversation, turn)."""
    turns = _read(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("sub_str"))
    return sn.add_global_index(turns, ("conv_id", "turn"))


def _is_translated(sid: Column) -> Column:
    """The stand-in translator leaves a quarter of the sentences without a translation."""
    return F.substring(sid, 1, 1) < "c"


def _translated(sentences: DataFrame) -> DataFrame:
    return sentences.withColumn("translated", F.when(_is_translated(F.col("sid")), F.reverse("sub_str")))


def _vocabulary(spark: SparkSession, d: str) -> tk.Vocabulary:
    """Specials, language tags, then the words of ``benchmark`` in order."""
    fixed = [tk.BOS, tk.PAD, tk.EOS, tk.UNK, *sorted(lang.LANGUAGE_CODES)]
    special = spark.createDataFrame([(t, i) for i, t in enumerate(fixed)], "token string, id bigint")
    words = (
        _read(spark, d, "benchmark")
        .select(F.explode(F.split(tx.canonical_text(F.col("text")), r"\s+")).alias("word"))
        .filter("word != ''")
        .select(F.concat(F.lit(tk.WORD_START), "word").alias("token"))
        .distinct()
    )
    table = special.unionByName(ly.number_rows(words, ["token"], "id", start=len(fixed)))
    return tk.Vocabulary(table, table).require_specials()


def _joined(col: str | Column, sep: str = " ") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.array_join(col.cast("array<string>"), sep)


def _entity_list(col: str) -> Column:
    return F.array_join(F.transform(col, lambda e: F.concat_ws("=", e["serial"].cast("string"), e["entity"])), "\n")


# --- sources, filters, templating -------------------------------------------------


def split_slice(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return sn.split_slice(docs, "train[10%:35%]", ("doc_id",))


def sample_head(spark, d):
    docs = read_table(spark, f"{d}/documents.parquet").select("doc_id", "lang", "n_chars")
    return sn.head_sample(docs, 100, ("doc_id",))


def terminal_line_filter(spark, d):
    return tp.filter_terminal_lines(_read(spark, d, "documents").select("doc_id", "text"), "text")


def doc_ids(spark, d):
    seen = F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(cast(page_id as int))")
    pages = _read(spark, d, "pages").withColumn("seen", seen)
    out = tp.template_documents(pages, "html", None, "url", "seen", "crawl", "chunk", keep=("page_id",))
    return out.select("page_id", "doc_id", "source", "url", "timestamp")


def url_source(spark, d):
    url = F.col("url")
    return _read(spark, d, "pages").select(
        "page_id", "url", ur.host(url).alias("host"), ur.source_name(url).alias("source")
    )


def timestamp_text(spark, d):
    return _read(spark, d, "events").select(
        "event_id", tx.timestamp_text(F.col("ts")).alias("shown"), tx.plain_timestamp(F.col("ts")).alias("hashed")
    )


def chunk_template(spark, d):
    turns = _read(spark, d, "conversations").withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    docs = tp.template_documents(turns, "text", "key", mode="chunk")
    return sn.open_list(docs, ["doc_id"], "sub_strs", value="sub_str")


def sentence_template(spark, d):
    return sn.open_list(_docs(spark, d), ["doc_id"], "sub_strs", value="sub_str")


def sentence_ids(spark, d):
    return sn.open_list(_docs(spark, d), ["doc_id"], "sids", value="sid")


def sentence_rows(spark, d):
    return sn.explode_sentences(_located_docs(spark, d))


def stream_sentences(spark, d):
    """The same sentences from a stream over the files, run until all are read."""
    path = f"{d}/documents.parquet"
    raw = read_stream(spark, f"{d}/documents*.parquet", spark.read.parquet(path).schema)
    out = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = stm.stream_sentences(raw, text_col="text", id_col="doc_id", source_type="web")
    stm.write_stream(rows, f"{out}/rows", f"{out}/progress").awaitTermination()
    return read_table(spark, f"{out}/rows").select("doc_id", "pos", "sid", "sub_str")


def json_roundtrip(spark, d):
    text = tp.arrays_to_json(_docs(spark, d).select("doc_id", "sub_strs", "sids"), "sub_strs", "sids")
    back = tp.arrays_from_json(text.withColumns({"sub_json": F.col("sub_strs"), "sid_json": F.col("sids")}), "sub_strs", "sids")
    return back.select("doc_id", "sub_json", "sid_json", F.size("sub_strs").alias("n"), _joined("sub_strs", "|").alias("joined"))


# --- ids, layout, sinks -----------------------------------------------------------


def global_index(spark, d):
    return _indexed(spark, d).select("doc_id", "pos", "sid", "tlt_idx")


def tlt_folder(spark, d):
    return _located_docs(spark, d).select("doc_id", "row_idx", "tlt_folder")


def tlt_folder_filtered(spark, d):
    """Next to every document one without text, which is dropped and must not be counted."""
    raw = read_table(spark, f"{d}/documents.parquet").select("doc_id", "text")
    empty = raw.select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("").alias("text"))
    docs = _ordered_docs(raw.unionByName(empty))
    tagged = sinks.with_document_csv_paths(ly.add_translation_folder(docs, BASE, F.col("n_docs")), BASE, F.col("n_docs"))
    return tagged.select("doc_id", "row_idx", "tlt_folder", "csv_path")


def doc_csv_rows(spark, d):
    docs = _ordered_docs(read_table(spark, f"{d}/documents.parquet"))
    rows = sinks.csv_rows(sinks.with_document_csv_paths(docs, BASE, F.col("n_docs")))
    return rows.select("doc_id", "csv_path", "sid", "substr")


def batch_csv_positions(spark, d):
    docs = _ordered_docs(read_table(spark, f"{d}/documents.parquet"))
    tagged = sinks.with_batch_csv_paths(docs, BASE, F.col("n_docs"))
    return tagged.select("doc_id", "csv_path", "start_pos", "end_pos")


def written_status(spark, d):
    return sinks.with_written(_translated(sn.explode_sentences(_located_docs(spark, d)))).select(
        "doc_id", "pos", "tlt_file_loc", "written"
    )


def reroot_path(spark, d):
    rows = sn.explode_sentences(_located_docs(spark, d))
    return rows.select("doc_id", "pos", ly.reroot_path(F.col("tlt_file_loc"), "/moved/root").alias("path"))


def partition_plan(spark, d):
    docs = read_table(spark, f"{d}/documents.parquet")
    rows = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("n_partitions", ly.partitions_for(F.col("n_rows")))


def shard_plan(spark, d):
    rows = _sentences(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("n_shards", ly.partitions_for(F.col("n_rows"), ly.SENTENCES_PER_SHARD))


def salt_balance(spark, d):
    """Rows per partition after salting, against an even share."""
    salted, rows, n = ly.split_and_salt(read_table(spark, f"{d}/documents.parquet"), 128)
    sizes = salted.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("size"))
    even = rows / n
    return sizes.agg(
        F.sum("size").alias("n_rows"),
        F.count(F.lit(1)).alias("n_partitions"),
        (F.max("size") <= 1.25 * even + 8).alias("is_even"),
    )


def rank_assign(spark, d):
    indexed = _indexed(spark, d)
    return ly.assign_rank(indexed.select("tlt_idx", "sid"), WORLD, indexed.count())


def _shards(spark, d):
    """A shard path per batch of documents."""
    docs = ly.number_rows(read_table(spark, f"{d}/documents.parquet").select("doc_id"), ["doc_id"])
    return docs.select(F.concat_ws("/", F.lit(SHARD_BASE), ly.batch_of(F.col("row_idx"), 16).cast("string")).alias("path")).distinct()


def shard_round_robin(spark, d):
    return ly.assign_devices(_shards(spark, d), DEVICES).select("path", "shard_idx", "device")


# --- sentence text ----------------------------------------------------------------


def punct_norm(spark, d):
    # Some of the ordinary spacing becomes no-break spacing and guillemets, to meet every rule.
    odd = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(",\u00a0")), F.lit(". "), F.lit("\u00a0»\u00a0; («\u00a0"))
    return _read(spark, d, "documents").select("doc_id", st.normalize_punctuation(odd).alias("text"))


def numeral_norm(spark, d):
    native = F.translate(F.col("text"), "0123456789", "०১૨೩۴୫੬᱗౮꯹")
    return _read(spark, d, "documents").select("doc_id", st.normalize_numerals(native).alias("text"))


def entity_spans(spark, d):
    t = F.col("text")
    return _read(spark, d, "documents").select(
        "doc_id",
        _joined(st.email_spans(t), "\n").alias("emails"),
        _joined(st.url_spans(t), "\n").alias("urls"),
        _joined(st.numeral_spans(t), "\n").alias("numerals"),
        _joined(st.handle_spans(t), "\n").alias("handles"),
    )


def entity_wrap(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", st.normalize_sentence(F.col("text")).alias("s"))
    return docs.select("doc_id", "s.text", _entity_list("s.entities").alias("entities"))


def entity_restore(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", st.normalize_sentence(F.col("text")).alias("s"))
    return docs.select("doc_id", st.restore_entities(F.col("s.text"), F.col("s.entities")).alias("text"))


def _as_indic(col: Column, block: int) -> Column:
    """Latin letters written as consonants of an Indic block."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.lower(col), letters, "".join(chr(block + 0x15 + i) for i in range(len(letters))))


def script_convert(spark, d):
    text = _as_indic(F.col("text"), lang.BLOCK_START["bn"])
    docs = _read(spark, d, "documents").select("doc_id", lang.to_devanagari(text, "ben_Beng").alias("deva"))
    return docs.select("doc_id", "deva", lang.from_devanagari(F.col("deva"), "tel_Telu").alias("telu"))


def lang_tags(spark, d):
    tags = st.add_language_tags(F.col("text"), SRC, TGT)
    return _read(spark, d, "conversations").select("conv_id", "turn", tags.alias("line"))


def preprocess(spark, d):
    lines = tk.preprocess(_sentences(spark, d), SRC, TGT)
    return lines.select("doc_id", "pos", "line", _entity_list("entities").alias("entities"))


def preprocess_indic(spark, d):
    turns = _read(spark, d, "conversations").withColumn("sub_str", _as_indic(F.col("text"), lang.BLOCK_START["kn"]))
    lines = tk.preprocess(turns, "kan_Knda", SRC)
    return lines.select("conv_id", "turn", "line", _entity_list("entities").alias("entities"))


def entity_maps(spark, d):
    """Every spelling of every placeholder, with what it stands for."""
    lines = tk.preprocess(_read(spark, d, "conversations").withColumn("sub_str", F.lower("text")), SRC, TGT)
    spelled = lines.select("conv_id", "turn", F.explode(st.entity_map(F.col("entities"))).alias("holder", "entity"))
    return spelled.select("conv_id", "turn", "holder", "entity")


def _as_arabic(col: Column) -> Column:
    """Latin letters written as Arabic ones, with punctuation set apart the way translators do."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(F.lower(col), letters, "".join(chr(0x0628 + i) for i in range(19)) + "".join(chr(0x0641 + i) for i in range(7)))
    for mark, apart in ((".", " ۔"), (",", " ،"), ("?", " ؟"), ("-", "\u066e\u06ea")):
        text = F.replace(text, F.lit(mark), F.lit(apart))
    return text


def _finished(spark, d, tgt: str, text: Column) -> DataFrame:
    """Turns as if a translator had just given ``text``."""
    turns = _read(spark, d, "conversations").select("conv_id", "turn", text.alias("decoded"), F.array().cast(st.ENTITY_TYPE).alias("entities"))
    return tk.postprocess(turns, tgt).select("conv_id", "turn", F.lit(tgt).alias("tgt_lang"), "translated")


def postprocess_scripts(spark, d):
    """Output in Arabic, Odia, Telugu and English letters."""
    deva = _as_indic(F.col("text"), lang.BLOCK_START["hi"])
    arabic = _finished(spark, d, "urd_Arab", _as_arabic(F.col("text")))
    odia = _finished(spark, d, "ory_Orya", F.replace(deva, F.lit("."), F.lit("\u0b2f\u0b3c .")))
    telugu = _finished(spark, d, "tel_Telu", F.replace(deva, F.lit("."), F.lit(" ।")))
    english = _finished(spark, d, lang.ENGLISH, F.replace(F.replace(F.col("text"), F.lit("."), F.lit(" .")), F.lit(","), F.lit(" ,")))
    return arabic.unionByName(odia).unionByName(telugu).unionByName(english)


def replace_string(spark, d):
    return _read(spark, d, "conversations").select("conv_id", "turn", tx.replace_string(F.col("text"), "the", F.upper("role")).alias("text"))


def postprocess(spark, d):
    lines = tk.preprocess(_sentences(spark, d), SRC, TGT, is_target=True)
    done = tk.postprocess(lines, TGT, "line")
    return done.select("doc_id", "pos", "translated")


# --- token arrays -----------------------------------------------------------------


def encode_ids(spark, d):
    rows = _sentences(spark, d).withColumn("tokens", tk.word_pieces(F.col("sub_str")))
    out = tk.encode_ids(rows, _vocabulary(spark, d))
    return out.select("doc_id", "pos", _joined("input_ids").alias("ids"))


def encode_ids_joined(spark, d):
    """The same ids with the vocabulary joined, as one too large to send around is."""
    rows = _sentences(spark, d).select("doc_id", "pos", tk.word_pieces(F.col("sub_str")).alias("tokens"))  # all columns are staged
    out = tk.encode_ids(rows, _vocabulary(spark, d), max_broadcast=0)
    return out.select("doc_id", "pos", _joined("input_ids").alias("ids"))


def _tagged_turns(spark, d):
    return _turns(spark, d).withColumn("line", st.add_language_tags(F.lower("sub_str"), SRC, TGT))


def _padded(spark, d, padding, truncation=False):
    out = tk.tokenize_batch(
        _tagged_turns(spark, d), _vocabulary(spark, d), "line", padding=padding, truncation=truncation,
        batch_rows=BATCH_ROWS, with_length=True,
    )
    return out.select(
        "tlt_idx", "lengths", _joined("input_ids").alias("ids"), _joined("attention_mask").alias("mask")
    )


def pad_longest(spark, d):
    return _padded(spark, d, "longest")


def pad_max_length(spark, d):
    return _padded(spark, d, "max_length", truncation=True)


def _unpadded(spark, d):
    """Encoded rows of uneven length with their masks."""
    rows = _tagged_turns(spark, d).withColumn("tokens", tk.tokenize(F.col("line")))
    rows = rows.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("tokens")))
    return tk.encode_ids(rows, _vocabulary(spark, d))


def repad_batches(spark, d):
    out = tk.repad_batch(_unpadded(spark, d), BATCH_ROWS)
    return out.select("tlt_idx", _joined("input_ids").alias("ids"), _joined("attention_mask").alias("mask"))


def drop_last(spark, d):
    out = tk.repad_batch(_unpadded(spark, d), BATCH_ROWS, drop_last=True)
    return out.select("tlt_idx", _joined("input_ids").alias("ids"))


def decode_text(spark, d):
    vocab = _vocabulary(spark, d)
    out = tk.decode_text(_unpadded(spark, d), vocab, "input_ids", "decoded", src=True)
    return out.select("tlt_idx", "decoded")


def binarize(spark, d):
    out = tk.binarize(_indexed(spark, d), _vocabulary(spark, d), SRC, TGT, batch_rows=BATCH_ROWS)
    return out.select(
        "tlt_idx", "sid", _joined("input_ids").alias("ids"), _joined("attention_mask").alias("mask"),
        _entity_list("entities").alias("entities"),
    )


def reverse_words():
    """Stand-in batch translator: the words of a line in reverse, tags dropped."""
    eos = 2

    def run(ids, masks):
        # A row holds padding, two tags, words and an end of sentence.
        words = np.maximum((masks == 1).sum(1) - 3, 0)
        out = np.roll(ids[:, ::-1], -1, axis=1)
        out[np.arange(len(ids)), words] = eos
        return [row[: n + 1] for row, n in zip(out, words.tolist())]

    return run


def _model_run(spark, d, vocab):
    # Documents are numbered and sorted first, so their sentences are numbered in place.
    docs = ly.sort_rows(_kept(read_table(spark, f"{d}/documents.parquet")), ["row_idx"])
    docs = tp.template_documents(docs, "text", "doc_id", source_type="web", keep=("row_idx", "n_docs"))
    rows = sn.add_global_index(sn.explode_sentences(ly.add_translation_folder(docs, BASE, F.col("n_docs"))))
    ready = tk.binarize(rows, vocab, SRC, TGT, padding="max_length")
    return tr.translate_ids(ready, reverse_words)


def model_output(spark, d):
    out = tr.model_output(_model_run(spark, d, _vocabulary(spark, d)))
    return out.select(
        "doc_id", "sid", "sub_str", "tlt_idx", "tlt_file_loc", _joined("translated_input_ids").alias("translated_ids"),
        F.size(F.map_keys(F.from_json("placeholder_entity_map", "map<string,string>"))).alias("n_placeholders"),
    )


def decode(spark, d):
    vocab = _vocabulary(spark, d)
    out = tk.decode(_model_run(spark, d, vocab), vocab, TGT)
    return out.select("doc_id", "pos", "translated")


# --- translations back into documents ---------------------------------------------


def translate_distinct(spark, d):
    def translate(distinct: DataFrame) -> DataFrame:
        return _translated(distinct)

    out = tr.translate_distinct(_sentences(spark, d), translate)
    return out.select("doc_id", "pos", "sid", "translated")


def translation_lookup(spark, d):
    docs = _located_docs(spark, d)
    stored = _translated(sn.explode_sentences(docs)).filter("translated is not null")
    table = stored.select(F.col("tlt_file_loc").alias("path"), "translated")
    return rp.lookup_translations(docs, table).select("doc_id", "pos", "sid", "sub_str", "translated")


def translation_lookup_copies(spark, d):
    """Documents known by their content alone, so that copies share id, folder and paths."""
    raw = _read(spark, d, "documents").select("text")
    docs = tp.template_documents(raw, "text", source_type="web").withColumn("tlt_folder", F.concat_ws("/", F.lit(BASE), "doc_id"))
    stored = _translated(sn.explode_sentences(docs)).select(F.col("tlt_file_loc").alias("path"), "translated")
    found = rp.lookup_translations(docs, stored).select("doc_id", "pos", "sid", "sub_str", "translated")
    return rp.count_copies(found)


def _replaced(spark, d):
    docs = _docs(spark, d)
    sentences = _translated(sn.explode_sentences(docs))
    return rp.replace_documents(docs, sentences)


def replace_documents(spark, d):
    return _replaced(spark, d).select("doc_id", "translated")


def substr_tlt(spark, d):
    return _replaced(spark, d).select("doc_id", _joined("substr_tlt", "|").alias("substr_tlt"))


# --- evaluation -------------------------------------------------------------------


DATA_SETS = ("gen", "conv")
DIRECTIONS = ("en-indic", "indic-en", "indic-indic")


def _parallel(spark, d) -> DataFrame:
    """Parallel tables of both data sets, which share their ids: ``benchmark`` next to stand-in
    sentences of the other languages; in the second set every sentence ends in a question."""
    texts = _read(spark, d, "benchmark").select(
        F.col("item_id").alias("id"), F.lower("text").alias("text"), F.explode(F.array(*map(F.lit, DATA_SETS))).alias("ds_type")
    )
    text = F.when(F.col("ds_type") == "conv", F.concat("text", F.lit(" on 12/10/2023?"))).otherwise(F.col("text"))
    others = {f"sentence_{t}": F.concat_ws(" ", F.lit(t), F.reverse(text)) for t in lang.EVALUATED_LANGUAGES}
    return texts.select("id", "ds_type", text.alias(f"sentence_{lang.ENGLISH}"), *[c.alias(n) for n, c in others.items()])


def _pairs(spark, d) -> DataFrame:
    """Sentence pairs of all directions, which share no pair, in one pass over the parallel table."""
    pairs = [pair for direction in DIRECTIONS for pair in lang.language_pairs(direction)]
    # A row opens into hundreds, so rows are dealt over all tasks while they are few.
    wide = ly.salt_partitions(_parallel(spark, d), int(spark.conf.get("spark.sql.shuffle.partitions")))
    paired = ev.pair_sentences(wide, pairs, keep=["ds_type"])
    from_english, to_english = F.col("src_lang") == lang.ENGLISH, F.col("tgt_lang") == lang.ENGLISH
    return paired.withColumn("direction", F.when(from_english, DIRECTIONS[0]).when(to_english, DIRECTIONS[1]).otherwise(DIRECTIONS[2]))


def language_pairs(spark, d):
    """Sentence pairs to evaluate, by data set, direction and pair."""
    return _pairs(spark, d).groupBy("ds_type", "direction", "src_lang", "tgt_lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("source")).alias("source_chars")
    )


def _evaluated(spark, d):
    """All pairs of all directions in both data sets, in one run."""
    run = lambda ready: tr.translate_ids(ready, reverse_words)
    return ev.run_evaluation(_pairs(spark, d), _vocabulary(spark, d), run)


def evaluation_run(spark, d):
    return _evaluated(spark, d).select("id", "ds_type", "direction", "src_lang", "tgt_lang", "source", "reference", "prediction")


def pred_ref_pairs(spark, d):
    """Aligned lines of each pair: the line number says where a row stands in both files."""
    order = ["ds_type", "src_lang", "tgt_lang", "id"]
    place = ly.number_rows(_evaluated(spark, d).select(*order, "prediction", "reference"), order, "line")
    pair = F.concat_ws("__", "src_lang", "tgt_lang").alias("pair")
    return place.select("ds_type", pair, "line", sinks.one_line(F.col("prediction")).alias("prediction"), sinks.one_line(F.col("reference")).alias("reference"))


def pair_scores(spark, d):
    """Scores of the evaluation's output by data set, direction and pair."""
    by = ["ds_type", "direction", "src_lang", "tgt_lang"]
    rows = stage_table(_evaluated(spark, d).select(*by, "prediction", "reference"), "evaluated")
    scores = ev.corpus_bleu(rows, by).join(ev.corpus_chrf(rows, by), by)
    return scores.select(*by, F.round("bleu", 6).alias("bleu"), F.round("chrf", 6).alias("chrf"))


def pair_parse(spark, d):
    out = _pairs(spark, d)
    path = F.concat_ws("/", F.lit("/out"), "ds_type", F.concat_ws("__", "src_lang", "tgt_lang"))
    src, tgt, ds = ev.parse_pair(F.col("path"))
    return out.select("id", path.alias("path")).select("id", "path", src.alias("src"), tgt.alias("tgt"), ds.alias("ds_type"))


def _scored(spark, d):
    """Each conversation turn against a damaged copy of itself."""
    text = F.lower("text")
    worse = F.replace(F.replace(text, F.lit(" the "), F.lit(" a ")), F.lit("er"), F.lit("re"))
    return _read(spark, d, "conversations").select(
        "conv_id", "turn", "role", text.alias("reference"), worse.alias("prediction")
    )


def corpus_bleu(spark, d):
    return ev.corpus_bleu(_scored(spark, d), ["role"]).withColumn("bleu", F.round("bleu", 6))


def corpus_chrf(spark, d):
    return ev.corpus_chrf(_scored(spark, d), ["role"]).withColumn("chrf", F.round("chrf", 6))


def round_trip(spark, d):
    """Template, translate each distinct sentence once, put the translations back."""
    docs = _docs(spark, d)
    done = tr.translate_distinct(sn.explode_sentences(docs), _translated)
    out = rp.replace_documents(docs, done.select("doc_id", "pos", "translated"))
    return out.select("doc_id", F.size("sub_strs").alias("n_sentences"), "translated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        split_slice, sample_head, terminal_line_filter, doc_ids, url_source, timestamp_text, chunk_template,
        sentence_template, sentence_ids, sentence_rows, stream_sentences, json_roundtrip, global_index, tlt_folder, tlt_folder_filtered, doc_csv_rows,
        batch_csv_positions, written_status, reroot_path, partition_plan, shard_plan, salt_balance, rank_assign,
        shard_round_robin, punct_norm, numeral_norm, entity_spans, entity_wrap, entity_restore, script_convert,
        lang_tags, preprocess, preprocess_indic, entity_maps, postprocess, postprocess_scripts, replace_string, encode_ids, encode_ids_joined, pad_longest, pad_max_length, repad_batches,
        drop_last, decode_text, binarize, model_output, decode, translate_distinct, translation_lookup, translation_lookup_copies,
        replace_documents, substr_tlt, language_pairs, evaluation_run, pred_ref_pairs, pair_scores, pair_parse, corpus_bleu,
        corpus_chrf, round_trip,
    )
}
