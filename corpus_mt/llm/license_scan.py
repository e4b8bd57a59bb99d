"""Fuzzy search for short license notices.

A notice with at most k edits, cut into k + 1 pieces, holds one piece unchanged.  These
exact pieces are looked for first; where one stands, a window around it goes to the regex
library, whose bounded-error matching verifies the edits and gives the span.

Texts are read as words: A-Z lower-cased, every other ASCII character but letters and digits
a separator, all others part of a word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.llm.common import worker_state


class Notice(NamedTuple):
    """A label, the notice's words, and the edits (of characters) that it may have."""

    label: str
    words: str
    edits: int


# --- fixed values: phrases that count only as they are, and notices that may have edits -----
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
NOTICES = (
    Notice("all-rights-reserved", "all rights reserved", 2),
    Notice("apache-2", "licensed under the apache license version 2 0", 4),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by", "creative commons attribution license", 3),
    Notice("cc-by-nc", "creative commons attribution noncommercial", 4),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("cc-by-sa", "creative commons attribution sharealike", 4),
    Notice("gpl", "gnu general public license", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("mit", "licensed under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge", 4),
    Notice("mpl-2", "mozilla public license version 2", 3),
    Notice("public-domain", "dedicated to the public domain", 3),
)
# ----------------------------------------------------------------------------------------------

_SPAN = "label string, start_word bigint, end_word bigint, edits int, similarity double, found string"
_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789") | frozenset(range(128, 256))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))


def fold_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def pieces(words: str, edits: int) -> list[bytes]:
    """The notice cut into ``edits + 1`` pieces of about the same length."""
    n = edits + 1
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [words[a:b].encode() for a, b in zip(cuts, cuts[1:], strict=False)]


def seed_windows(line: bytes, notice: Notice) -> list[tuple[int, int]]:
    """Byte ranges in which the notice may stand.

    A seed at place p of the notice and q of the text allows starts from q - p - k on and
    ends up to q - p + length + k.  Ranges that begin close to each other are merged, but not so far
    that two places of the notice would fit into one.
    """
    size, k, found, place = len(notice.words), notice.edits, [], 0
    for piece in pieces(notice.words, k):
        at = line.find(piece)
        while at >= 0:
            found.append((max(0, at - place - k), min(len(line), at - place + size + k)))
            at = line.find(piece, at + 1)
        place += len(piece)
    merged: list[tuple[int, int]] = []
    shift = max(0, min(2 * k, size - 4 * k))
    for a, b in sorted(found):
        if merged and a - merged[-1][0] <= shift:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _spaces(line: bytes) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(line, np.uint8) == 32)


class Scanner:
    """Phrases and notices made ready for one worker."""

    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
        self.phrases = [(label, b" " + words.encode() + b" ", len(words.split())) for label, words in phrases]
        # A space on both sides; the best match of a range.
        self.notices = [(n, regex.compile(rb"(?be)(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(n.words.encode()), n.edits))) for n in notices]

    def base(self, line: bytes) -> list[tuple[str, int, int]]:
        """Label, first word and one past the last of every place of a phrase; places may overlap."""
        out, spaces = [], None
        for label, phrase, words in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                spaces = _spaces(line) if spaces is None else spaces
                start = int(np.searchsorted(spaces, at))
                out.append((label, start, start + words))
                at = line.find(phrase, at + 1)
        return out

    def matches(self, line: bytes, notice: Notice, pattern: regex.Pattern) -> list[tuple[int, int, int]]:
        """Start, end and edits of the places of a notice: of those that overlap the one with the fewest edits, then the first."""
        found, least = set(), len(notice.words) - notice.edits
        for window in seed_windows(line, notice):
            # The spaces beside a match are to be seen.
            todo = [(max(0, window[0] - 1), min(len(line), window[1] + 1))]
            while todo:
                a, b = todo.pop()
                if b - a < least or not (m := pattern.search(line, a, b)):
                    continue
                # An edit may have taken in the separators at either end.
                if text := m.group().strip():
                    start = m.start() + len(m.group()) - len(m.group().lstrip())
                    found.add((start, start + len(text), sum(m.fuzzy_counts)))
                if m.end() > m.start():
                    todo += [(a, m.start()), (m.end(), b)]
        starts: list[int] = []
        kept: list[tuple[int, int, int]] = []
        for start, end, edits in sorted(found, key=lambda f: (f[2], f[0], f[1])):
            i = bisect_left(starts, start)
            if (i and kept[i - 1][1] > start) or (i < len(starts) and starts[i] < end):
                continue
            starts.insert(i, start)
            kept.insert(i, (start, end, edits))
        return kept

    def fuzzy(self, line: bytes) -> list[dict]:
        """Spans of the notices, with their edits; those of one notice don't overlap."""
        out, spaces = [], None
        for notice, pattern in self.notices:
            for a, b, edits in self.matches(line, notice, pattern):
                spaces = _spaces(line) if spaces is None else spaces
                found, start = line[a:b], int(np.searchsorted(spaces, a)) - 1
                out.append(
                    {
                        "label": notice.label,
                        "start_word": start,
                        "end_word": start + found.count(b" ") + 1,
                        "edits": edits,
                        "similarity": 1.0 - edits / len(notice.words),
                        "found": found.decode("utf-8", "replace"),
                    }
                )
        return out


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[Notice] = NOTICES,
) -> DataFrame:
    """``key, n_words, base, spans`` for every row, without moving any.

    ``base`` lists the exact phrases (label, start_word, end_word), ``spans`` the notices
    found with edits.  Null and empty texts have no words and no spans.  Null and repeated
    keys are kept, one row out for each row in; other columns play no part; an empty table
    gives no rows.  A text of any length is searched whole, in time that grows with it.  Places of a phrase may
    overlap, those of one notice don't; a repeated notice is found at each of its places.
    """
    phrases, notices = tuple(phrases), tuple(notices)
    base_type = pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64())]))
    span_type = pa.list_(
        pa.struct(
            [("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64()), ("found", pa.string())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_state(f"licenses:{phrases}:{notices}", lambda: Scanner(phrases, notices))
        for batch in batches:
            n_words, base, spans = [], [], []
            for s in batch.column(1):
                words = fold_words(s.as_py())
                line = b" %s " % b" ".join(words) if words else b""
                n_words.append(len(words))
                base.append([{"label": x, "start_word": a, "end_word": b} for x, a, b in scanner.base(line)])
                spans.append(scanner.fuzzy(line))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(base, base_type), pa.array(spans, span_type)], ["key", "n_words", "base", "spans"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_words bigint, base array<struct<label:string,start_word:bigint,end_word:bigint>>, spans array<struct<{_SPAN.replace(' ', ':').replace(',:', ',')}>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def license_digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score`` of scanned rows.

    The score is the best similarity of any span, 1 where an exact phrase stands, else 0.
    """
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.col("base.start_word")
    return scanned.select(
        key,
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "spans.label")).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.similarity"), F.lit(0.0))).alias("score"),
    )
