"""Sentences to padded token arrays and back."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from corpus_mt.functions import languages as lang
from corpus_mt.functions import sentences as st
from corpus_mt.operators.layout import batch_of
from corpus_mt.session import stage_table
from corpus_mt.worker import worker_state

# --- fixed values ---------------------------------------------------------------
BOS, PAD, EOS, UNK = "<s>", "<pad>", "</s>", "<unk>"
PAD_ID = 1
WORD_START = "▁"
MODEL_MAX_LENGTH = 256
# --------------------------------------------------------------------------------

SPECIAL_TOKENS = (BOS, PAD, EOS)
# A vocabulary up to this many entries and bytes is sent to every executor.
BROADCAST_ENTRIES = 1_000_000
BROADCAST_BYTES = 64 << 20
# Elements of a batch that are Python objects at one time.
SLICE_ELEMENTS = 1 << 14
# Elements of the rows that share a list of different ones when a large table is joined, about.
CHUNK_ELEMENTS = 1 << 17
SEPARATOR = "\x1f"


def word_pieces(text: Column) -> Column:
    """Words with the word-start mark: the default when no subword model is given."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    return F.transform(words, lambda w: F.concat(F.lit(WORD_START), w))


def _tagged_pieces(line: Column) -> Column:
    """The two tags and the ``word_pieces`` of a line: every further word gets its mark along with the space in front of it."""
    tags, text = split_tags(line)
    head = F.substring_index(line, " ", 2)
    rest = F.substring(line, F.char_length(head) + 1, F.char_length(line))
    marked = F.split(F.concat(head, F.replace(rest, F.lit(" "), F.lit(f" {WORD_START}"))), " ")
    return F.when(rest.contains("  ") | rest.endswith(" "), F.concat(tags, word_pieces(text))).otherwise(marked)


def subword_pieces(model_file: str) -> Callable[[Column], Column]:
    """Pieces from a SentencePiece model file, loaded once per task."""
    loaded: dict = {}

    @F.pandas_udf(ArrayType(StringType()))
    def pieces(text: pd.Series) -> pd.Series:
        if model_file not in loaded:
            from sentencepiece import SentencePieceProcessor

            loaded[model_file] = SentencePieceProcessor(model_file=model_file)
        return pd.Series(loaded[model_file].encode(text.fillna("").tolist(), out_type=str))

    return pieces


def split_tags(line: Column) -> tuple[Column, Column]:
    """The two language tags of a line, and its text."""
    words = F.split(line, " ")
    rest = F.array_join(F.slice(words, 3, F.greatest(F.size(words), F.lit(1))), " ")
    return F.slice(words, 1, 2), rest


def tokenize(line: Column, src: bool = True, pieces: Callable[[Column], Column] = word_pieces) -> Column:
    """Tokens of a line; a source line keeps its two language tags whole."""
    if not src:
        return pieces(line)
    if pieces is word_pieces:
        return _tagged_pieces(line)
    tags, text = split_tags(line)
    return F.concat(tags, pieces(text))


def truncate(tokens: Column, max_length: int | None = None) -> Column:
    """At most ``max_length`` tokens (one less than the model holds, to leave room for EOS)."""
    return F.slice(tokens, 1, max_length or MODEL_MAX_LENGTH - 1)


def pad_tokens(tokens: Column, width: Column | int, pad: str | int = PAD, eos: str | int = EOS) -> Column:
    """Left-padded to ``width``, then end of sentence: ``width + 1`` tokens (or ids)."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(F.array_repeat(F.lit(pad), width - F.size(tokens)), tokens, F.array(F.lit(eos)))


def attention_mask(length: Column, width: Column | int) -> Column:
    """Zeros under the padding, ones under the tokens and the end of sentence."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(F.array_repeat(F.lit(0), width - length), F.array_repeat(F.lit(1), length + 1))


def strip_special_tokens(tokens: Column) -> Column:
    """Without begin, end and padding; unknown tokens stay."""
    return F.filter(tokens, lambda t: ~t.isin(*SPECIAL_TOKENS))


def tokens_to_text(tokens: Column, src: bool = False) -> Column:
    """Readable text; leading language tags of a source line are dropped."""
    if src:
        known = list(lang.LANGUAGE_CODES)
        tagged = F.get(tokens, 0).isin(known) & F.get(tokens, 1).isin(known)
        tokens = F.when(tagged, F.slice(tokens, 3, F.greatest(F.size(tokens), F.lit(1)))).otherwise(tokens)
    joined = F.replace(F.array_join(tokens, ""), F.lit(" "), F.lit(""))
    return st.strip(F.replace(joined, F.lit(WORD_START), F.lit(" ")))


class Vocabulary:
    """Source and target vocabularies: tables ``token string, id int``.

    A token listed more than once has its least id; of tokens that share an id the first in
    order stands for it.  What the driver needs of a side (its size and three special ids) is
    looked up once.
    """

    def __init__(self, source: DataFrame, target: DataFrame) -> None:
        named = lambda t: t.filter(F.col("token").isNotNull() & F.col("id").isNotNull())
        narrow = lambda t: named(t).groupBy("token").agg(F.min(F.col("id").cast("int")).alias("id"))
        self.source = narrow(source)
        self.target = self.source if target is source else narrow(target)
        self._facts: dict = {}
        self._small: dict = {}

    def side(self, src: bool) -> DataFrame:
        return self.source if src else self.target

    def _about(self, src: bool):
        table = self.side(src)
        if id(table) not in self._facts:
            special = lambda t: F.max(F.when(F.col("token") == t, F.col("id")))
            self._facts[id(table)] = table.agg(
                F.count(F.lit(1)).alias("entries"),
                F.coalesce(F.sum(F.octet_length("token") + 8), F.lit(0)).alias("bytes"),
                special(UNK).alias("unk"),
                special(PAD).alias("pad"),
                special(EOS).alias("eos"),
            ).first()
        return self._facts[id(table)]

    def size(self, src: bool) -> int:
        return self._about(src).entries

    def require_specials(self) -> Vocabulary:
        """Fail early when the source side lacks the tokens encoding depends on."""
        about = self._about(True)
        if missing := [t for t, found in ((UNK, about.unk), (PAD, about.pad)) if found is None]:
            raise KeyError(f"{', '.join(missing)} must be in the source vocabulary")
        return self

    def special_ids(self) -> tuple[int, int, int]:
        """Ids of unknown, padding and end of sentence; unknown tokens of either side take the source id."""
        about = self.require_specials()._about(True)
        return about.unk, about.pad, about.unk if about.eos is None else about.eos

    def fits_broadcast(self, src: bool, max_entries: int = BROADCAST_ENTRIES) -> bool:
        about = self._about(src)
        return about.entries <= max_entries and about.bytes <= BROADCAST_BYTES

    def lookup_table(self, src: bool, to_ids: bool) -> DataFrame:
        """``_key, _value`` with distinct keys: token to id, or id to token."""
        if to_ids:
            return self.side(src).select(F.col("token").alias("_key"), F.col("id").alias("_value"))
        return self.side(src).groupBy(F.col("id").alias("_key")).agg(F.min("token").alias("_value"))

    def small_table(self, src: bool, to_ids: bool) -> tuple[str, pa.Array, pa.Array]:
        """A name for the lookup table of a side that fits, its keys and values."""
        at = (id(self.side(src)), to_ids)
        if at not in self._small:
            arrow = self.lookup_table(src, to_ids).toArrow()
            self._small[at] = (uuid.uuid4().hex, arrow["_key"].combine_chunks(), arrow["_value"].combine_chunks())
        return self._small[at]


def _offsets(lists: pa.Array) -> pa.Array:
    """Where each list of a batch starts in its flattened values."""
    ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
    return pa.array(np.concatenate([[0], ends]).astype("int32"))


def _places(name: str, keys: pa.Array, wanted: pa.Array) -> pa.Array:
    """Where each wanted value stands among the keys, null if nowhere; the hash is built once per worker."""
    index = worker_state(f"lookup-{keys.type}", lambda: pd.Index(keys.to_numpy(zero_copy_only=False)), name)
    at = np.empty(len(wanted), dtype="int64")
    for start in range(0, len(wanted), SLICE_ELEMENTS):
        part = wanted.slice(start, SLICE_ELEMENTS)
        at[start : start + len(part)] = index.get_indexer(part.to_numpy(zero_copy_only=False))
    return pa.array(at, mask=at < 0)


def _list_lookup(name: str, keys: pa.Array, values: pa.Array, default, value_type, df: DataFrame):
    """An Arrow function mapping every element of a list column through a small table."""
    shared = df.sparkSession.sparkContext.broadcast((keys, values))
    fallback = pa.scalar(default, values.type)

    @F.arrow_udf(ArrayType(value_type))
    def look_up(lists: pa.Array) -> pa.Array:
        table_keys, table_values = shared.value
        hit = _places(name, table_keys, lists.flatten())
        out = pc.fill_null(pc.take(table_values, hit), fallback)
        return pa.ListArray.from_arrays(_offsets(lists), out)

    return look_up


def _joined_lists(rows: DataFrame, col: str, table: DataFrame, default, value_type) -> DataFrame:
    """``_row, _list``: the lists of staged rows with every element looked up in a table that is joined; empty ones are left out.

    Rows that lie next to each other are a chunk, whose different elements move to the table once each, and meet its rows
    again with what was found.  An element is thus in the join no more often than there are chunks, so none fills a task.
    """
    kept = rows.filter(F.size(col) > 0).select("_row", F.col(col).alias("_keys"))
    mean = kept.agg(F.avg(F.size("_keys"))).first()[0] or 1.0
    bits = max(0, math.floor(math.log2(max(1.0, CHUNK_ELEMENTS / mean))))
    chunk = F.shiftright("_row", bits).alias("_chunk")
    key_type = kept.schema["_keys"].dataType.elementType.simpleString()
    # Strings run together take a third of what an array of them does in the shuffle.
    run = F.array_join("_keys", SEPARATOR) if key_type == "string" else F.lit(None).cast("string")
    parted = F.length(run) - F.length(F.replace(run, F.lit(SEPARATOR), F.lit(""))) == F.size("_keys") - 1
    whole = F.coalesce(parted & ~F.exists("_keys", lambda k: k.isNull()), F.lit(False))
    moved = kept.select(chunk, "_row", F.when(whole, run).alias("_run"), F.when(~whole, F.col("_keys")).alias("_keys"))

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            keys = lists.flatten().dictionary_encode()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            chunks, chunk = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            codes = pc.fill_null(keys.indices, -1).to_numpy(zero_copy_only=False).astype("int64")
            pairs = np.unique((np.repeat(chunk, sizes) * (len(keys.dictionary) + 1) + codes)[codes >= 0])
            of, code = np.divmod(pairs, len(keys.dictionary) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(chunks[of]), keys.dictionary.take(pa.array(code))], ["_chunk", "_key"])

    def fill(part: pa.Table, found: pa.Table) -> pa.Table:
        keys, values = found["_key"].combine_chunks(), found["_value"].combine_chunks()
        run, other = part.filter(pc.is_valid(part["_run"])), part.filter(pc.is_null(part["_run"]))
        done = []
        for row, lists in ((run["_row"], pc.split_pattern(run["_run"].combine_chunks(), SEPARATOR)), (other["_row"], other["_keys"].combine_chunks())):
            elements = lists.flatten().cast(keys.type) if len(row) else keys.slice(0, 0)  # without rows a side may be of another type
            out = pc.fill_null(pc.take(values, pc.index_in(elements, value_set=keys)), pa.scalar(default, values.type))
            done.append(pa.table([row, pa.ListArray.from_arrays(_offsets(lists), out)], ["_row", "_list"]))
        return pa.concat_tables(done)

    keys = kept.select(chunk, "_keys").mapInArrow(different, f"_chunk bigint, _key {key_type}")
    found = keys.join(table, "_key").select("_chunk", "_key", "_value")
    schema = f"_row bigint, _list array<{value_type.simpleString()}>"
    return moved.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(fill, schema)


def _map_list(df: DataFrame, col: str, out: str, vocab: Vocabulary, src: bool, to_ids: bool, max_broadcast: int) -> DataFrame:
    default = vocab.special_ids()[0] if to_ids else UNK
    value_type = IntegerType() if to_ids else StringType()
    if vocab.fits_broadcast(src, max_broadcast):
        udf = _list_lookup(*vocab.small_table(src, to_ids), default, value_type, df)
        return df.withColumn(out, F.when(F.col(col).isNotNull(), udf(F.coalesce(F.col(col), F.array().cast(df.schema[col].dataType)))))
    # A large table is joined.  Rows are told apart by a number given while they are staged, never by a key of
    # theirs, which may repeat.
    rows = stage_table(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    lists = _joined_lists(rows, col, vocab.lookup_table(src, to_ids), default, value_type)
    empty = F.array().cast(ArrayType(value_type))
    rows = rows.withColumn("_given", F.col(col).isNotNull())  # the lists themselves move only if they are asked for
    joined = rows.join(lists, "_row", "left").withColumn(out, F.when(F.col("_given"), F.coalesce("_list", empty)))
    return joined.drop("_list", "_row", "_given")


def encode_ids(
    df: DataFrame,
    vocab: Vocabulary,
    tokens: str = "tokens",
    out: str = "input_ids",
    src: bool = True,
    max_broadcast: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Token arrays to id arrays.

    A vocabulary whose size is checked to be small goes to the executors and is looked up
    in Arrow batches, with no shuffle; a larger one is joined.  Both give the same.
    """
    return _map_list(df, tokens, out, vocab, src, True, max_broadcast)


def decode_tokens(
    df: DataFrame,
    vocab: Vocabulary,
    ids: str = "translated_input_ids",
    out: str = "tokens",
    src: bool = False,
    max_broadcast: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Id arrays to token arrays; an unknown id gives the unknown token."""
    return _map_list(df, ids, out, vocab, src, False, max_broadcast)


def _joined_lookup(name: str, keys: pa.Array, values: pa.Array, df: DataFrame):
    """An Arrow function from id lists to their tokens run together, special tokens left out."""
    shared = df.sparkSession.sparkContext.broadcast((keys, pc.fill_null(values, UNK)))

    @F.arrow_udf(StringType())
    def join(lists: pa.Array) -> pa.Array:
        table_keys, table_values = shared.value
        hit = _places(name, table_keys, lists.flatten())
        tokens = pc.fill_null(pc.take(table_values, hit), UNK)
        tokens = pc.if_else(pc.is_in(tokens, value_set=pa.array(SPECIAL_TOKENS, tokens.type)), "", tokens)
        return pc.binary_join(pa.ListArray.from_arrays(_offsets(lists), tokens), "")

    return join


def decode_text(
    df: DataFrame, vocab: Vocabulary, ids: str, out: str, src: bool = False, max_broadcast: int = BROADCAST_ENTRIES, **lookup
) -> DataFrame:
    """Id arrays to text."""
    if not src and vocab.fits_broadcast(src, max_broadcast):
        join = _joined_lookup(*vocab.small_table(src, False), df)
        lists = F.coalesce(F.col(ids), F.array().cast("array<int>"))
        return df.withColumn(out, tokens_to_text(F.array(join(lists))))
    decoded = decode_tokens(df, vocab, ids, "_tokens", src, max_broadcast=max_broadcast, **lookup)
    return decoded.withColumn(out, tokens_to_text(strip_special_tokens(F.col("_tokens")), src)).drop("_tokens")


def pad_batch(
    df: DataFrame,
    tokens: str = "tokens",
    padding: str = "longest",
    max_length: int | None = None,
    batch_rows: int = 512,
    index: str = "tlt_idx",
    mask: str = "attention_mask",
    pad: str | int = PAD,
    eos: str | int = EOS,
) -> DataFrame:
    """Pad token (or id) arrays and add their masks.

    ``longest`` pads to the longest row of each run of ``batch_rows`` indexes, so a window
    never holds more than one batch; ``max_length`` pads every row alike and needs none.
    """
    size = F.size(tokens)
    if padding == "longest":
        w = Window.partitionBy(batch_of(F.col(index), batch_rows))
        df, width = df.withColumn("_width", F.max(size).over(w)), F.col("_width")
    elif padding == "max_length":
        width = F.lit(max_length or MODEL_MAX_LENGTH - 1)
    else:
        raise ValueError("padding must be 'longest' or 'max_length'")
    return df.withColumns({mask: attention_mask(size, width), tokens: pad_tokens(F.col(tokens), width, pad, eos)}).drop("_width")


def tokenize_batch(
    df: DataFrame,
    vocab: Vocabulary,
    text: str,
    src: bool = True,
    truncation: bool = False,
    padding: str = "longest",
    max_length: int | None = None,
    batch_rows: int = 512,
    index: str = "tlt_idx",
    with_mask: bool = True,
    with_length: bool = False,
    pieces: Callable[[Column], Column] = word_pieces,
    **lookup,
) -> DataFrame:
    """Lines to ``input_ids`` (and ``attention_mask``, ``lengths``): split, cut, look up, pad."""
    if padding == "max_length" and not max_length:
        max_length = MODEL_MAX_LENGTH - 1
    tokens = tokenize(F.col(text), src, pieces)
    if truncation and max_length:
        tokens = truncate(tokens, max_length)
    out = df.withColumn("_tokens", tokens)
    if with_length:
        out = out.withColumn("lengths", F.size("_tokens"))
    # Padding is added to the ids: only real tokens are looked up.
    _, pad, eos = vocab.special_ids()
    out = encode_ids(out, vocab, "_tokens", "input_ids", src, **lookup).drop("_tokens")
    out = pad_batch(out, "input_ids", padding, max_length, batch_rows, index, pad=pad, eos=eos)
    return out if with_mask else out.drop("attention_mask")


def repad_batch(
    df: DataFrame,
    batch_rows: int,
    index: str = "tlt_idx",
    columns: Sequence[tuple[str, int]] = (("input_ids", PAD_ID), ("attention_mask", 0)),
    drop_last: bool = False,
) -> DataFrame:
    """Left-pad array columns to the longest of each batch; optionally drop a short last batch."""
    w = Window.partitionBy(batch_of(F.col(index), batch_rows))
    widths = {f"_w_{c}": F.max(F.size(c)).over(w) for c, _ in columns}
    if drop_last:
        widths["_rows"] = F.count(F.lit(1)).over(w)
    out = df.withColumns(widths)
    if drop_last:
        out = out.filter(F.col("_rows") == batch_rows)
    padded = {
        c: F.concat(F.array_repeat(F.lit(fill).cast(df.schema[c].dataType.elementType), F.col(f"_w_{c}") - F.size(c)), F.col(c))
        for c, fill in columns
    }
    return out.withColumns(padded).drop(*widths)


def drop_last_batch(df: DataFrame, batch_rows: int, index: str = "tlt_idx") -> DataFrame:
    """Without the rows of a batch that is not full."""
    w = Window.partitionBy(batch_of(F.col(index), batch_rows))
    return df.withColumn("_rows", F.count(F.lit(1)).over(w)).filter(F.col("_rows") == batch_rows).drop("_rows")


def preprocess(
    df: DataFrame,
    src_lang: str | Column,
    tgt_lang: str | Column,
    text: str = "sub_str",
    out: str = "line",
    is_target: bool = False,
    placeholders: bool = True,
    full: bool = False,
) -> DataFrame:
    """Adds the tagged line and its ``entities``; target lines get no tags.  For ``full`` see ``preprocess_sentence``.

    A language is a tag, or a column of tags when it differs by row.
    """
    if isinstance(tgt_lang, str):
        lang.language_code(tgt_lang)
    done = df.withColumn("_pre", st.preprocess_sentence(F.col(text), src_lang, placeholders, full))
    line = F.col("_pre.text") if is_target else st.add_language_tags(F.col("_pre.text"), src_lang, tgt_lang)
    return done.withColumns({out: line, "entities": F.col("_pre.entities")}).drop("_pre")


def postprocess(
    df: DataFrame, tgt_lang: str | Column, text: str = "decoded", out: str = "translated", entities: str = "entities", full: bool = False
) -> DataFrame:
    return df.withColumn(out, st.postprocess_sentence(F.col(text), F.col(entities), tgt_lang, full))


def binarize(
    df: DataFrame,
    vocab: Vocabulary,
    src_lang: str | Column,
    tgt_lang: str | Column,
    text: str = "sub_str",
    padding: str = "longest",
    batch_rows: int = 512,
    index: str = "tlt_idx",
    placeholders: bool = True,
    pieces: Callable[[Column], Column] = word_pieces,
    full: bool = False,
    **lookup,
) -> DataFrame:
    """Sentences to model input: pre-process, tokenise, pad, look up.

    Adds ``entities``, ``attention_mask`` and ``input_ids``; only ``max_length`` padding
    cuts long sentences.
    """
    lines = preprocess(df, src_lang, tgt_lang, text, "_line", placeholders=placeholders, full=full)
    return tokenize_batch(
        lines, vocab, "_line", True, padding == "max_length", padding, None, batch_rows, index, pieces=pieces, **lookup
    ).drop("_line")


def decode(
    df: DataFrame,
    vocab: Vocabulary,
    tgt_lang: str | Column,
    ids: str = "translated_input_ids",
    out: str = "translated",
    entities: str = "entities",
    full: bool = False,
    **lookup,
) -> DataFrame:
    """Model output ids to finished translations."""
    decoded = decode_text(df, vocab, ids, "_decoded", src=False, **lookup)
    return postprocess(decoded, tgt_lang, "_decoded", out, entities, full).drop("_decoded")
