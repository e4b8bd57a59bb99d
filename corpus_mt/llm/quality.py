"""Quality rules by a hashed n-gram likelihood ratio, in DataFrame functions only.

Unigrams and bigrams of words are hashed to buckets.  Two multinomials over the buckets,
one of trusted documents and one of the whole corpus, give every bucket a log-ratio; a
document's score is the mean over its n-grams.  How far scores reach depends on how many n-grams the
target has, so the bar below which a document is rejected comes from the labelled rows' own scores.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_mt.llm.common import SPACES
from corpus_mt.session import stage_table

BUCKETS = 1 << 16
# The target multinomial starts from that of the corpus, as if this many n-grams per bucket had been seen.
PRIOR = 10.0
# Mean log-ratio below which a document is rejected where labels do not tell.
BAR = -0.12
# Bits, in words of 64, that tell most unlabelled documents before any text is moved; they are sent to the executors.
KEY_BITS = 1 << 24
# Share of the good documents that the bar may reject.
GOOD_LOST = 0.05
# Scores are compared in these decimals, and cumulated by bins of the coarser ones.
SCORE_DECIMALS, BIN_DECIMALS = 6, 3
LEAST_WORDS, REPEAT_PERCENT = 50, 50

_SYMBOLS = r"[#*$%&|<>]"
_SPLIT = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Runs of characters other than the ASCII spaces; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPLIT))


def add_base(docs: DataFrame, text: str, words: str) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    ``words`` names the column of ``words_of``.  Windows of three words are compared by their
    64-bit hash, sorted within the row, so a text of n words takes n log n steps.
    """
    w, body = F.col(words), F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    hashed = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    step = docs.withColumns(
        {
            "n_words": F.size(w).cast("bigint"),
            "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
            "n_symbols": F.regexp_count(body, F.lit(_SYMBOLS)).cast("bigint"),
            "_lines": lines,
            "_windows": F.slice(hashed, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        }
    )
    step = step.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            # Most texts hold no window twice and need no sort.
            "_sorted": F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"),
                F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ),
        }
    ).drop("_lines", "_windows")
    at = lambda k: F.get("_sorted", k)["h"]
    again = F.filter("_sorted", lambda x, k: (x["h"] == at(k - 1)) | (x["h"] == at(k + 1)))
    step = step.withColumn("_starts", F.sort_array(again["i"])).drop("_sorted")
    # A window covers three words less those that the one before it has covered.
    covered = F.transform("_starts", lambda p, k: F.least(F.lit(3), p - F.coalesce(F.get("_starts", k - 1), F.lit(-3))))
    step = step.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return step.withColumn("base_failed", failed).drop("_starts")


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def trusted_keys(labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """All distinct keys labelled as good."""
    return labels.filter((F.col(quality) == 1) & F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()


def _half(key: str) -> Column:
    """0 or 1, each for about half of the trusted keys; a target is fitted on either half."""
    return F.pmod(F.xxhash64(key, F.lit("half")), F.lit(2)).cast("int")


def _marks(labels: DataFrame, key: str, quality: str) -> DataFrame:
    """``_key, _mark, _half`` of every labelled key: the mark is 1 for good ones and 0 for those that only bad labels have."""
    good = trusted_keys(labels, key, quality).select("_key", F.lit(1).alias("_mark"), _half("_key").alias("_half"))
    bad = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(quality).alias("_q")).filter("_q = 0")
    return good.unionByName(bad.select("_key", F.lit(0).alias("_mark"), F.lit(-1).alias("_half")))


def labelled_texts(docs: DataFrame, marks: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``_key, _text`` and the marks of all documents whose key is in ``marks``.

    Labels grow with the documents, so the two are joined by a shuffle, of hardly any but labelled documents: a bit
    for each labelled key's hash, in a table of bounded size, first turns the others away.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    if rows.schema["_key"].dataType == marks.schema["_key"].dataType:  # else equal keys may have other hashes
        place = F.pmod(F.xxhash64("_key", F.lit("bit")), F.lit(KEY_BITS))
        word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
        words = F.broadcast(marks.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")))
        rows = rows.withColumn("_word", word).join(words, "_word").filter(F.col("_bits").bitwiseAND(bit) != 0).select("_key", "_text")
    return rows.join(marks.hint("merge"), "_key")


def _opened(rows: DataFrame, text: str, *kept: str) -> DataFrame:
    """A row with ``bucket`` for every unigram and bigram of the texts."""
    listed = rows.select(*kept, words_of(F.col(text)).alias("w"))
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("b"))
    opened = listed.select(*kept, F.explode(pairs).alias("p"))
    grams = F.array(_bucket(F.col("p.a")), F.when(F.col("p.b").isNotNull(), _bucket(F.col("p.a"), F.col("p.b"))))
    return opened.select(*kept, F.explode(grams).alias("bucket")).filter("bucket IS NOT NULL")


def log_ratios(docs: DataFrame, marked: DataFrame, text: str = "text") -> tuple[DataFrame, list[float]]:
    """One row with the log-ratio of every bucket, in bucket order, and the same with the target fitted on either half
    of the good documents in ``marked``; and how much farther the first reach than each of these, 0 where the target has nothing.

    The counts cover all of ``docs`` and all good documents, and are summed per bucket before they move.  With no
    good document all ratios are 0.  The row is a written table; only four totals come to the driver.
    """
    raw = _opened(docs, text).groupBy("bucket").agg(F.count("*").alias("raw"))
    good = _opened(marked.filter("_mark = 1"), "_text", "_half").groupBy("bucket").agg(F.count("*").alias("full"), F.sum("_half").alias("half1"))
    counts = raw.join(good, "bucket", "left").na.fill(0, ["full", "half1"])
    counts = stage_table(counts.withColumn("half0", F.col("full") - F.col("half1")), "grams")
    names = ("full", "half0", "half1")
    *totals, raw = (x or 0 for x in counts.agg(*(F.sum(n) for n in names), F.sum("raw")).first())
    prior = PRIOR * BUCKETS

    def ratio(c: str, total: int) -> Column:
        """Log of a bucket's share in a target over its share in the corpus."""
        share = F.log((F.col(c) * float(raw) / F.col("raw") + prior) / (total + prior))
        return (F.when(F.col("raw") > 0, share).otherwise(0.0) if total else F.lit(0.0)).cast("float").alias(c)

    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    rows = every.join(counts, "bucket", "left").select(F.struct("bucket", *map(ratio, names, totals)).alias("r"))
    one = rows.agg(F.sort_array(F.collect_list("r")).alias("r"))  # BUCKETS members
    lists = [F.col("r")[n].alias(f"_{n}") for n in names]
    farther = [math.log1p(totals[0] / prior) / math.log1p(n / prior) if n else 0.0 for n in totals[1:]]
    return stage_table(one.select(F.lit(0).cast("bigint").alias("_one"), *lists), "ratios"), farther


def _beside(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Every row next to the columns of the one row of ``table``, which is sent to the executors."""
    keyed = rows.withColumn("_one", F.pmod(F.xxhash64("_text"), F.lit(1)))  # 0
    return keyed.join(F.broadcast(table.select("_one", *columns)), "_one").drop("_one")


def _pinned(verdict: Column) -> Column:
    """The same verdict, which the optimizer leaves where it is.

    A filter on it would else be moved below the steps it rests on and repeat each of them as often as
    it is mentioned.
    """
    return verdict & (F.monotonically_increasing_id() >= 0)


def mean_ratio(words: Column, ratios: Column) -> Column:
    """Mean log-ratio of the unigrams and bigrams of a text; 0 without words."""
    gram = lambda w, i: F.get(ratios, _bucket(w)) + F.when(
        F.get(words, i + 1).isNotNull(), F.get(ratios, _bucket(w, F.get(words, i + 1)))
    ).otherwise(0.0)
    total = F.aggregate(F.transform(words, gram), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(words) > 0, total / (2 * F.size(words) - 1)).otherwise(0.0)


def bar_between(good: list[float], bad: list[float]) -> float:
    """The bar that rejects fewest good and keeps fewest bad, by shares, and rejects ``GOOD_LOST`` of the good at most.

    It lies halfway between the two scores around it.
    """
    good, scores = sorted(good), sorted({*good, *bad})
    bad = sorted(bad)
    bars = [scores[0], *((a + b) / 2 for a, b in zip(scores, scores[1:]))]
    gaps = [0.0, *(b - a for a, b in zip(scores, scores[1:]))]
    lost = [bisect.bisect_left(good, t) / len(good) for t in bars]
    errors = [(x + 1 - bisect.bisect_left(bad, t) / len(bad), -g, t) for t, g, x in zip(bars, gaps, lost) if x <= GOOD_LOST]
    return min(errors)[2]


def find_bar(rated: DataFrame) -> float | None:
    """``bar_between`` over a table of rows ``score, _mark`` (1 for good ones); none without rows of both kinds.

    Rows are summed by score.  Of scores that differ in ``BIN_DECIMALS`` decimals there are some ten thousand at
    most, since a score is a mean of log-ratios, and these are cumulated in one window; those of a bin in one of its own.
    """
    mark = lambda k: F.count(F.when(F.col("_mark") == k, 1))
    points = rated.groupBy("score").agg(mark(1).alias("g"), mark(0).alias("b"))
    points = stage_table(points.withColumn("_bin", F.floor(F.col("score") * 10**BIN_DECIMALS)), "scores")
    bins = points.groupBy("_bin").agg(F.sum("g").alias("_g"), F.sum("b").alias("_b"), F.max("score").alias("_most"))
    bins = stage_table(bins, "bins")
    n_good, n_bad = bins.agg(F.sum("_g"), F.sum("_b")).first()
    if not n_good or not n_bad:
        return None
    order = Window.orderBy("_bin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.select("_bin", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_g", "_b")), F.lag("_most").over(order).alias("_most"))
    inside = Window.partitionBy("_bin").orderBy("score")
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    below = lambda c: F.col(f"_{c}") + F.coalesce(F.sum(c).over(above), F.lit(0))
    bars = points.join(F.broadcast(starts), "_bin").select(
        "score", F.coalesce(F.lag("score").over(inside), "_most", "score").alias("prev"), (below("g") / n_good).alias("lost"), (below("b") / n_bad).alias("gone")
    )
    error = (F.col("lost") + 1 - F.col("gone")).alias("error")
    best = bars.filter(F.col("lost") <= GOOD_LOST).agg(F.min(F.struct(error, (F.col("prev") - F.col("score")).alias("gap"), ((F.col("prev") + F.col("score")) / 2).alias("t"))))
    return best.first()[0]["t"]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", quality: str = "quality") -> tuple[DataFrame, float]:
    """The table of log-ratios and the bar, from all documents and all labels.

    Good documents that the target is fitted on score higher than others like them, so for the bar each is
    scored by the target fitted on the half it is not in.  Without labels of both
    kinds that pass the base the bar is ``BAR``.  Of rows with one key and score one counts.
    """
    marked = stage_table(labelled_texts(docs, stage_table(_marks(labels, key, quality), "marks"), text, key), "marked")
    table, farther = log_ratios(docs, marked, text)
    marked = _beside(marked.withColumn("_words", words_of(F.col("_text"))), table, "_full", "_half0", "_half1")
    mean = lambda c: mean_ratio(F.col("_words"), F.col(c))
    # Without a target on the other half a good document has no score.
    unseen = [F.when(F.col("_half") == k, farther[1 - k] * mean(f"_half{1 - k}") if farther[1 - k] else F.lit(None)) for k in (0, 1)]
    score = F.when(F.col("_mark") == 0, mean("_full")).otherwise(F.coalesce(*unseen))
    judged = add_base(marked.withColumn("score", score).drop("_full", "_half0", "_half1"), "_text", "_words")
    rated = stage_table(judged.groupBy("_key", "_mark", "base_failed", F.round("score", SCORE_DECIMALS).alias("score")).count(), "rated")
    found = find_bar(rated.filter(~F.col("base_failed") & F.col("score").isNotNull()))
    return table, BAR if found is None else found


def _judged(docs: DataFrame, table: DataFrame, bar: float, kept: Column, text: str) -> DataFrame:
    """``kept``, the base columns, ``score`` and ``_good`` of every row."""
    rows = docs.select(kept, F.col(text).alias("_text")).withColumn("_words", words_of(F.col("_text")))
    # The score comes first, so that the ratios are not carried on.
    scored = _beside(rows, table, "_full").withColumn("score", mean_ratio(F.col("_words"), F.col("_full"))).drop("_full")
    judged = add_base(scored, "_text", "_words")
    return judged.withColumn("_good", _pinned(~F.col("base_failed") & (F.col("score") >= bar)))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", bar: float | None = None) -> DataFrame:
    """``key``, the base columns, ``score`` and ``kept``, for every row, without moving any text.

    Null and empty texts have no words and fail the base.  Null keys are never trusted;
    repeated rows each count and are each judged; a key labelled twice is good if any label
    says so.  Equal scores have equal verdicts.  Other columns play no part.  An empty table gives no rows.  Texts are
    taken whole, however long.
    """
    table, found = fit(docs, labels, text, key)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = _judged(docs, table, found if bar is None else bar, F.col(key).alias("_key"), text)
    return judged.select(F.col("_key").alias(key), *columns, F.col("_good").alias("kept"), "score")


def keep(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", bar: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns."""
    table, found = fit(docs, labels, text, key)
    judged = _judged(docs, table, found if bar is None else bar, F.struct(*docs.columns).alias("_row"), text)
    return judged.select("_row", "_good").filter("_good").select("_row.*")
