"""Evaluation: language pairs, a translated run over all of them, corpus scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import tokenize as tz
from corpus_mt.operators.tokens import Vocabulary, binarize, decode

BLEU_ORDER = 4
CHRF_ORDER = 6
CHRF_BETA = 2
# Rows whose n-grams are counted at one time.
SLICE_ROWS = 256


def long_form(wide: DataFrame, id_col: str = "id", prefix: str = "sentence_") -> DataFrame:
    """``id, lang, sentence`` from one column per language."""
    cols = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot(id_col, cols, "lang", "sentence")
    return long.withColumn("lang", F.substring("lang", len(prefix) + 1, 64))


def wide_form(
    long: DataFrame, pairs: Sequence[tuple[str, str]], value: str = "prediction", prefix: str = "tlt-"
) -> DataFrame:
    """``id`` and one column ``prefix + src__tgt`` per listed pair."""
    names = [f"{s}__{t}" for s, t in pairs]
    table = long.withColumn("_pair", F.concat_ws("__", "src_lang", "tgt_lang")).groupBy("id").pivot("_pair", names)
    return table.agg(F.first(value)).select("id", *[F.col(f"`{n}`").alias(prefix + n) for n in names])


def pair_sentences(
    wide: DataFrame, pairs: Sequence[tuple[str, str]], id_col: str = "id", keep: Sequence[str] = (), prefix: str = "sentence_"
) -> DataFrame:
    """One row per sentence and language pair: source next to reference.

    Each row of the parallel table is opened over the fixed list of pairs, so nothing is
    joined or shuffled.  Pairs of a language with itself are left out.
    """
    pairs = [(s, t) for s, t in pairs if s != t]
    langs = sorted({tag for pair in pairs for tag in pair})
    by_lang = F.create_map(*[c for tag in langs for c in (F.lit(tag), F.col(f"{prefix}{tag}"))])
    listed = F.array(*[F.lit(f"{s} {t}") for s, t in pairs])

    def opened(pair: Column) -> Column:
        src, tgt = F.substring_index(pair, " ", 1), F.substring_index(pair, " ", -1)
        return F.struct(
            src.alias("src_lang"),
            tgt.alias("tgt_lang"),
            F.element_at("_langs", src).alias("source"),
            F.element_at("_langs", tgt).alias("reference"),
        )

    rows = wide.select(F.col(id_col).alias("id"), *keep, by_lang.alias("_langs"))
    return rows.select("id", *keep, F.inline(F.transform(listed, opened)))


def run_evaluation(
    paired: DataFrame,
    vocab: Vocabulary,
    translate: Callable[[DataFrame], DataFrame],
    placeholders: bool = True,
) -> DataFrame:
    """Adds ``translated_input_ids`` and ``prediction``: binarize, translate and decode every
    pair and data set in one job.

    The languages of a row choose its branch inside the expressions, so the plan does not
    grow with the number of pairs.
    """
    ready = binarize(
        paired, vocab, F.col("src_lang"), F.col("tgt_lang"), "source", "max_length",
        index="id", placeholders=placeholders,
    )
    done = decode(translate(ready), vocab, F.col("tgt_lang"), out="prediction")
    return done.select(*paired.columns, "translated_input_ids", "prediction")


def parse_pair(path: Column) -> tuple[Column, Column, Column]:
    """Source, target and data set of an output folder named ``.../src__tgt``."""
    pair = F.split(F.regexp_extract(path, r"([^/]+)/*\z", 1), "__")
    kind = F.when(path.contains("conv"), "conv").otherwise("gen")
    return F.get(pair, 0), F.get(pair, 1), kind


def word_tokens(col: Column) -> Column:
    return F.filter(F.split(col, r"\s+"), lambda w: w != "")


# --- fixed values: punctuation that international scoring sets apart, and around words ---------
_SCORED_SYMBOLS = r"[{-~\[-` -&(-+:-@/]"
_EDGE_PUNCTUATION = r"[!-/:-@\[-`{-~]"
# ---------------------------------------------------------------------------------------------


def scored_words(col: Column, tgt_lang: Column) -> Column:
    """Words of a text as its language is scored, joined by spaces: English by the usual tokeniser of shared tasks, any
    other language by the Indic tokeniser (its Urdu form for Arabic letters).  Null is empty."""
    text = F.coalesce(col, F.lit(""))
    plain = F.replace(F.replace(F.replace(text, F.lit("<skipped>"), F.lit("")), F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    for escape, c in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        plain = F.replace(plain, F.lit(escape), F.lit(c))
    english = F.concat(F.lit(" "), plain, F.lit(" "))
    for pattern, new in ((f"({_SCORED_SYMBOLS})", " $1 "), (r"([^0-9])([.,])", "$1 $2 "), (r"([.,])([^0-9])", " $1 $2"), (r"([0-9])(-)", "$1 $2 ")):
        english = F.regexp_replace(english, pattern, new)

    def alike(tag: str):
        return "en" if tag == lang.ENGLISH else lang.language_code(tag) == "ur"

    def words(tag: str) -> Column:
        kind = alike(tag)
        return english if kind == "en" else tz.tokenize_urdu(text) if kind else tz.tokenize_indic(text)

    return F.btrim(F.regexp_replace(lang.by_language(tgt_lang, words, alike), r"\s+", " "))


def chrf_words(col: Column) -> Column:
    """Words with one punctuation mark parted from their end, else from their start."""
    return F.flatten(F.transform(word_tokens(col), _part_word))


def _part_word(word: Column) -> Column:
    last, first = F.right(word, F.lit(1)), F.left(word, F.lit(1))
    one = F.length(word) == 1
    return (
        F.when(one, F.array(word))
        .when(last.rlike(_EDGE_PUNCTUATION), F.array(F.left(word, F.length(word) - 1), last))
        .when(first.rlike(_EDGE_PUNCTUATION), F.array(first, F.right(word, F.length(word) - 1)))
        .otherwise(F.array(word))
    )


def _overlaps(pred: pa.Array, ref: pa.Array, order: int) -> np.ndarray:
    """``3 * order`` numbers per row of two arrays of texts, counted over all rows at once.

    An n-gram is the number of its first n - 1 items next to its last item, and these pairs are numbered anew for every
    n; the numbers of the empty n-gram are the rows, so n-grams of different rows never meet.
    """
    rows = len(pred)
    if pa.types.is_string(pred.type):
        texts = pred.to_pylist() + ref.to_pylist()
        sizes = np.array([len(t) for t in texts], dtype="int64")
        items = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype("int64")
    else:
        # The lists themselves may differ in type, as those of a constant hold no nulls.
        sizes = np.concatenate([side.value_lengths().to_numpy(zero_copy_only=False) for side in (pred, ref)]).astype("int64")
        words = pa.concat_arrays([pred.flatten(), ref.flatten()])
        items = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype("int64")
    out = np.zeros((rows, 3 * order), dtype="int64")
    text = np.repeat(np.arange(2 * rows), sizes)
    ahead = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(items))  # items up to the end of the text
    at, gram, span = np.arange(len(items)), text % max(rows, 1), int(items.max(initial=0)) + 1
    for n in range(1, order + 1):
        long_enough = ahead[at] >= n
        at, gram = at[long_enough], gram[long_enough]
        if not len(at):
            break
        known, gram = np.unique(gram * span + items[at + n - 1], return_inverse=True)
        row, is_ref = text[at] % rows, text[at] >= rows
        of = np.empty(len(known), dtype="int64")
        of[gram] = row
        left, right = (np.bincount(gram[side], minlength=len(known)) for side in (~is_ref, is_ref))
        out[:, 3 * n - 3] = np.bincount(of, np.minimum(left, right), rows)
        out[:, 3 * n - 2], out[:, 3 * n - 1] = (np.bincount(row[side], minlength=rows) for side in (~is_ref, is_ref))
    return out


def _overlap(order: int):
    """An Arrow function from two texts to ``3 * order`` numbers: per n the n-grams they share
    (each as often as both have it), and those of either side.

    Texts are lists of words, or strings of characters.  Everything is counted inside the batch:
    no n-gram leaves it.
    """

    @F.arrow_udf("array<bigint>")
    def overlap(pred: pa.Array, ref: pa.Array) -> pa.Array:
        counted = [_overlaps(pred.slice(at, SLICE_ROWS), ref.slice(at, SLICE_ROWS), order) for at in range(0, len(pred), SLICE_ROWS)]
        flat = np.concatenate([np.empty((0, 3 * order), dtype="int64"), *counted]).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(pred) + 1, dtype="int32") * (3 * order)), pa.array(flat))

    return overlap


def _matches(df: DataFrame, group: Sequence[str], pred: Column, ref: Column, order: int) -> DataFrame:
    """Per group ``m1, t1, r1, m2, ...``: clipped matches and n-gram totals of both sides, in one aggregate."""
    return _matches_of(df, group, [(pred, ref, order)])


def _matches_of(df: DataFrame, group: Sequence[str], parts: Sequence[tuple[Column, Column, int]]) -> DataFrame:
    """The same for several kinds of n-grams, whose orders are numbered on."""
    rows = df.select(*group, F.concat(*[_overlap(order)(pred, ref) for pred, ref, order in parts]).alias("_o"))
    names = [f"{c}{n}" for n in range(1, sum(order for *_, order in parts) + 1) for c in "mtr"]
    return rows.groupBy(*group).agg(*[F.coalesce(F.sum(F.get("_o", F.lit(i))), F.lit(0)).alias(c) for i, c in enumerate(names)])


def corpus_bleu(df: DataFrame, group: Sequence[str] = (), pred: str = "prediction", ref: str = "reference", smooth: bool = False) -> DataFrame:
    """Corpus BLEU per group: up to 4-grams, clipped counts, brevity penalty; missing text is empty.

    Without ``smooth`` a group that misses all n-grams of an order scores 0; with it the k-th such order counts as
    half the share of the one before, ``1 / (2^k t)``.  A group without any n-gram of an order scores 0.
    """
    words = lambda c: F.coalesce(word_tokens(F.col(c)), F.array().cast("array<string>"))
    flat = _matches(df, group, words(pred), words(ref), BLEU_ORDER)
    orders = range(1, BLEU_ORDER + 1)
    logs, missed = F.lit(0.0), F.lit(0)
    for n in orders:
        missed = missed + (F.col(f"m{n}") == 0).cast("int")
        share = F.when(F.col(f"m{n}") > 0, F.col(f"m{n}")).otherwise(F.pow(F.lit(2.0), -missed)) if smooth else F.col(f"m{n}")
        logs = logs + F.when((F.col(f"t{n}") > 0) & (share > 0), F.log(share / F.nullif(F.col(f"t{n}"), F.lit(0)))).otherwise(0.0)
    logs = logs / BLEU_ORDER
    some = F.greatest(*[F.col(f"m{n}") for n in orders]) > 0
    every = F.least(*[F.col(f"m{n}") for n in orders]) > 0
    possible = (some & (F.least(*[F.col(f"t{n}") for n in orders]) > 0)) if smooth else every
    brevity = F.when(F.col("t1") >= F.col("r1"), 1.0).otherwise(F.exp(1 - F.col("r1") / F.col("t1")))
    return flat.select(*group, F.when(possible, 100 * brevity * F.exp(logs)).otherwise(0.0).alias("bleu"))


def corpus_chrf(df: DataFrame, group: Sequence[str] = (), pred: str = "prediction", ref: str = "reference", word_order: int = 0) -> DataFrame:
    """Corpus chrF per group: character 1- to 6-grams without white space, beta 2; missing text is empty.

    With ``word_order`` word n-grams up to that order count beside them, punctuation at the edge of a word being one.  Orders that either side of the group has no n-gram of are left out of the mean.
    """
    chars = lambda c: F.coalesce(F.regexp_replace(F.col(c), r"\s+", ""), F.lit(""))
    parts = [(chars(pred), chars(ref), CHRF_ORDER)]
    if word_order:
        words = lambda c: chrf_words(F.coalesce(F.col(c), F.lit("")))
        parts.append((words(pred), words(ref), word_order))
    stats = _matches_of(df, group, parts)
    orders = range(1, CHRF_ORDER + word_order + 1)
    both = lambda n: (F.col(f"t{n}") > 0) & (F.col(f"r{n}") > 0)
    share = lambda c: sum(F.when(both(n), F.col(f"m{n}") / F.col(f"{c}{n}")).otherwise(0.0) for n in orders)
    used = F.greatest(sum(both(n).cast("int") for n in orders), F.lit(1))
    scored = stats.select(*group, (share("t") / used).alias("p"), (share("r") / used).alias("r"))
    b2 = CHRF_BETA**2
    f = (1 + b2) * F.col("p") * F.col("r") / (b2 * F.col("p") + F.col("r"))
    return scored.select(*group, F.when(F.col("p") + F.col("r") > 0, 100 * f).otherwise(0.0).alias("chrf"))


def target_scores(df: DataFrame, group: Sequence[str] = (), tgt_lang: str = "tgt_lang", pred: str = "prediction", ref: str = "reference") -> DataFrame:
    """``bleu`` and ``chrf`` per group, on words as the target language is scored; ``tgt_lang`` names a column of tags.

    BLEU is smoothed; chrF takes in word 1- and 2-grams.  English is split by BLEU's own tokeniser and chrF sees its
    text as it is; other languages are tokenised for both.
    """
    indic = lambda c: F.when(F.col(tgt_lang) == lang.ENGLISH, F.col(c)).otherwise(scored_words(F.col(c), F.col(tgt_lang)))
    rows = df.select(
        *group,
        scored_words(F.col(pred), F.col(tgt_lang)).alias("_pw"), scored_words(F.col(ref), F.col(tgt_lang)).alias("_rw"),
        indic(pred).alias("_pt"), indic(ref).alias("_rt"),
    )
    keys = list(group)
    bleu = corpus_bleu(rows, keys, "_pw", "_rw", smooth=True)
    chrf = corpus_chrf(rows, keys, "_pt", "_rt", word_order=2)
    return bleu.join(chrf, keys) if keys else bleu.crossJoin(chrf)
