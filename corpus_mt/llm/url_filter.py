"""URL filters: curated rules first, a learned classifier for the rest.

Host names run words together.  A unigram model of words, counted over a corpus, splits them by
Viterbi: every name is matched with the words that it holds, and the likeliest cut wins.  Multinomial
naive Bayes over hashed tokens (host words and path tokens) then judges the url.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.operators.skew import spread_join
from corpus_mt.session import stage_table

ALLOW, BLOCK = "allow", "block"
# Longest word looked for in a name, and letters of a name that are cut at once; a longer one, which no
# domain label is, is parted after every NAME_CHARS letters first, so that what one row holds is bounded.
WORD_CHARS, NAME_CHARS = 20, 2_048
BUCKETS = 1 << 18
SMOOTHING = 1.0
# A list of rules is part of the plan; longer ones belong in a table.
RULES = 1_000


class Rule(NamedTuple):
    """Blocks or allows a host and its subdomains, where the path starts like the rule's."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def add_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return urls.withColumns({"host": F.translate(part(1), upper, upper.lower()), "path": part(2)})


def rule_of(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of rule and verdict, else null."""
    if len(rules) > RULES:
        raise ValueError(f"more than {RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        host, path = F.col("host"), F.col("path")
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def count_words(texts: DataFrame, text: str) -> DataFrame:
    """``word, n`` over all rows: lower-case runs of 2 to ``WORD_CHARS`` letters, tags left out."""
    bare = F.regexp_replace(F.col(text), "<[^>]*>", " ")
    words = texts.select(F.explode(F.split(F.lower(bare), r"[^\p{L}]+")).alias("word"))
    return words.filter(F.length("word").between(2, WORD_CHARS)).groupBy("word").agg(F.count("*").alias("n"))


def best_cut(name: str, edges: Sequence[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of a name.  ``edges`` are words in it: start, length, count of ``total``.

    A character outside any word counts as a word seen once, so it is a last resort; a run of such
    characters is one piece.
    """
    best = [0.0] + [-math.inf] * len(name)
    back = [0] * (len(name) + 1)
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, length, n in edges:
        ending.setdefault(start + length, []).append((start, math.log(n / total)))
    alone = -math.log(total + 1)
    for end in range(1, len(name) + 1):
        for start, p in [(end - 1, alone), *sorted(ending.get(end, []))]:
            if best[start] + p > best[end]:
                best[end], back[end] = best[start] + p, start
    words: list[str] = []
    end, before = len(name), False
    while end:
        alone_here = end - back[end] == 1
        if alone_here and before:
            words[-1] = name[back[end]] + words[-1]
        else:
            words.append(name[back[end] : end])
        end, before = back[end], alone_here
    return words[::-1]


def segment(names: DataFrame, words: DataFrame) -> DataFrame:
    """``name, words`` of distinct names.

    Substrings of names meet the counted words in a join, so no word list is sent around; a
    name gathers at most ``WORD_CHARS`` matches a letter.  Names shorter than two characters stay whole.
    """
    fit = F.length("name") > 1
    starts = names.filter(fit).select("name", F.explode(F.sequence(F.lit(1), F.length("name") - 1)).alias("at"))
    longest = F.least(F.lit(WORD_CHARS), F.length("name") - F.col("at") + 1)
    subs = starts.select("name", "at", F.explode(F.sequence(F.lit(2), longest)).alias("size"))
    subs = subs.withColumn("word", F.col("name").substr(F.col("at"), F.col("size")))
    edges = subs.join(words, "word").groupBy("name").agg(F.collect_list(F.struct((F.col("at") - 1).alias("at"), "size", "n")).alias("edges"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("n")).scalar()

    @F.pandas_udf("array<string>")
    def cut(name: pd.Series, edges: pd.Series, total: pd.Series) -> pd.Series:
        rows = zip(name, edges, total, strict=True)
        return pd.Series([best_cut(x, [(e["at"], e["size"], e["n"]) for e in es], n) for x, es, n in rows])

    lattice = names.filter(fit).join(edges, "name", "left")
    none = F.array().cast("array<struct<at:int,size:int,n:bigint>>")
    split = lattice.select("name", cut("name", F.coalesce("edges", none), total).alias("words"))
    return split.unionByName(names.filter(~fit).select("name", F.array("name").alias("words")))


def _runs(text: Column) -> Column:
    """Runs of letters, and of digits written as 0."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), r"\p{N}+", " 0 "), r"[^\p{L}\p{N}]+", " ")
    trimmed = F.trim(bare)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " +"))


def _pieces(name: Column) -> Column:
    """A name as pieces of ``NAME_CHARS`` letters, the last one shorter."""
    starts = F.sequence(F.lit(1), F.length(name), F.lit(NAME_CHARS))
    return F.transform(starts, lambda at: name.substr(at, F.lit(NAME_CHARS)))


def host_tokens(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """``host, host_words``: each host's names, cut into words, in order."""
    named = hosts.select("host", F.posexplode(F.flatten(F.transform(_runs(F.col("host")), _pieces))).alias("pos", "name"))
    cut = segment(named.select("name").distinct(), words)
    joined = spread_join(named, cut, "name")
    ordered = joined.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("pos", "words"))).alias("parts"))
    return ordered.select("host", F.flatten(F.col("parts.words")).alias("host_words"))


def _buckets() -> Column:
    mark = lambda kind, tokens: F.transform(tokens, lambda t: F.pmod(F.xxhash64(F.lit(kind), t), F.lit(BUCKETS)).cast("int"))
    return F.concat(mark("host", F.coalesce("host_words", F.array().cast("array<string>"))), mark("path", _runs(F.col("path"))))


def add_tokens(parts: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``host_words`` and the hashed ``tokens`` of host and path.

    Hosts are cut once each; a host that holds much of the table is dealt over many tasks.
    """
    counts = parts.groupBy("host").agg(F.count("*").alias("n"))
    cut = host_tokens(counts.select("host"), words)
    return spread_join(parts, cut, "host", counts).withColumn("tokens", _buckets())


def fit(labelled: DataFrame, tokens: str = "tokens", label: str = "label") -> np.ndarray:
    """Log-odds of ``block`` by bucket, from rows labelled block or allow.

    Counts are summed per bucket before they move; the result is ``BUCKETS`` numbers.
    Without rows of both labels all odds are even.
    """
    opened = labelled.select(F.col(label).alias("label"), F.explode(tokens).alias("bucket"))
    sums = [F.sum((F.col("label") == v).cast("bigint")).alias(v) for v in (BLOCK, ALLOW)]
    counts = np.zeros((2, BUCKETS))
    for r in opened.filter(F.col("label").isin(BLOCK, ALLOW)).groupBy("bucket").agg(*sums).toLocalIterator():
        counts[:, r["bucket"]] = r[BLOCK], r[ALLOW]
    if not counts.sum(1).all():
        return np.zeros(BUCKETS)
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    return logs[0] - logs[1]


def blocked_share(tokens: Column, odds: np.ndarray, spark) -> Column:
    """Probability that a url is to be blocked, both verdicts being as likely before; even without tokens."""
    shared = spark.sparkContext.broadcast(odds)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tokens in batches:
            sizes = tokens.map(len).to_numpy()
            flat = shared.value[np.concatenate([np.zeros(0, np.int64), *tokens]).astype(np.int64)]
            totals = np.bincount(np.repeat(np.arange(len(sizes)), sizes), flat, len(sizes))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(totals, -700, 700))))

    return score(tokens)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    words: DataFrame,
    url: str = "url",
    labels: DataFrame | None = None,
    key: str = "page_id",
) -> DataFrame:
    """``key, host, path, rule, verdict, score, host_words`` for every row.

    The classifier learns from ``labels`` (``key, label``) or, without them, from all the
    urls that a rule decides, and judges the others.  Null urls and those without ``://`` have no
    host, path or tokens: no rule fits and they are allowed, as even odds never block.  Null and
    repeated keys are kept, one row out for each row in; other columns play no part; an empty
    table gives no rows.  Urls and names of any length are read whole.  Of rules of one length the last by
    its text decides.
    """
    parts = add_parts(pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")), "_url").drop("_url")
    # Staged: the fit and the scores both read them.
    tokens = stage_table(add_tokens(parts.withColumn("_rule", rule_of(rules)), words), "url-tokens")
    if labels is None:
        known = tokens.withColumn("label", F.col("_rule.verdict"))
    else:
        known = tokens.join(labels.select(F.col(key).alias("_key"), "label"), "_key")
    score = blocked_share(F.col("tokens"), fit(known), pages.sparkSession)
    learned = F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)
    return tokens.withColumn("score", score).select(
        F.col("_key").alias(key), "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", learned).alias("verdict"), "score", "host_words"
    )
