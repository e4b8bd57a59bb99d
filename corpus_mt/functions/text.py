"""Document text as column expressions: canonical form, splitting, cleaning, ids.

Everything here is ``Column -> Column`` and stays inside the JVM (but for NFKC, see
``unicode.py``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpus_mt.functions.unicode import nfkc

# --- fixed values ---------------------------------------------------------------
# Characters stripped from both ends of a substring.
EDGE_SYMBOLS = "@#$^&*-_+=[]{}|\\<>/\n"
# A list marker at the start of a substring.
BULLET = r"\A(?:[•○*\-]|[0-9]+\.)"
# Characters that always end a substring; a dot ends one only away from digits.
HARD_STOPS = "?!।|॥؟۔"
# Line endings kept by the terminal-line filter, and the one it still rejects.
TERMINAL_CHARS = ".!?:,;)\"'"
ELLIPSIS = "..."
# White space as str.strip() sees it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# What a missing value is written as.
MISSING = "None"
# --------------------------------------------------------------------------------

# A zero-width cut right after each delimiter: a dot with no digit on either side, or a
# hard stop or newline together with the newlines that follow it.  The leading
# look-behind keeps ordinary characters on the one-test path.
def _cut_after(stops: str) -> str:
    return (
        rf"(?<=[.{stops}\n])(?:"
        rf"(?<=(?<!\p{{Nd}})\.)(?!\p{{Nd}})"
        rf"|(?<=[{stops}])(?!\n)"
        rf"|(?<=\n)(?!\n))"
    )


# Most texts hold no stop beyond ASCII; a class without them is looked up at once, each of them would be tested at every character.
_ASCII_STOPS = "".join(c for c in HARD_STOPS if c.isascii())
_MAY_STOP_BEYOND_ASCII = f"[{min(set(HARD_STOPS) - set(_ASCII_STOPS))}-\U0010ffff]"


def strip(col: Column, chars: str = WHITE_SPACE) -> Column:
    """Remove any of ``chars`` from both ends."""
    return F.btrim(col, F.lit(chars))


def canonical_text(col: Column) -> Column:
    """NFKC, then lower case."""
    return F.lower(nfkc(col))


def has_text(col: Column) -> Column:
    """True for text worth templating: not null, not empty, not the word for missing."""
    return col.isNotNull() & (col != "") & (col != MISSING)


def keep_terminal_lines(col: Column) -> Column:
    """Keep only the lines that end a sentence or clause; a line ending in dots goes."""

    def ends_well(line: Column) -> Column:
        return F.lit(TERMINAL_CHARS).contains(F.right(line, F.lit(1))) & (line != "") & ~line.endswith(ELLIPSIS)

    return F.array_join(F.filter(F.split(col, "\n"), ends_well), "\n")


def clean_substring(col: Column) -> Column:
    """Strip edge symbols, then white space, then one list marker, then white space."""
    bare = strip(strip(col, EDGE_SYMBOLS))
    return strip(F.regexp_replace(bare, BULLET, ""))


def split_keeping_delimiters(text: Column) -> Column:
    """Pieces of the text, each with the delimiter that ended it; joined they give the text."""
    every, ascii_only = F.lit(_cut_after(HARD_STOPS)), F.lit(_cut_after(_ASCII_STOPS))
    return F.split(text, F.when(text.rlike(_MAY_STOP_BEYOND_ASCII), every).otherwise(ascii_only))


def sentence_substrings(text: Column) -> Column:
    """Distinct clean sentences of canonical text, in order of first appearance."""
    cleaned = F.transform(split_keeping_delimiters(text), clean_substring)
    return F.array_distinct(F.filter(cleaned, lambda s: s != ""))


def chunk_substrings(text: Column) -> Column:
    """Distinct clean lines of canonical text; a line of symbols alone gives one ``""``."""
    lines = F.filter(F.split(text, "\n"), lambda s: s != "")
    return F.array_distinct(F.transform(lines, clean_substring))


def substrings(text: Column, mode: str = "sentence") -> Column:
    """Substrings of canonical text in the given mode, ``sentence`` or ``chunk``."""
    if mode == "sentence":
        return sentence_substrings(text)
    if mode == "chunk":
        return chunk_substrings(text)
    raise ValueError(f"mode must be 'sentence' or 'chunk', not {mode!r}")


def content_id(col: Column) -> Column:
    """SHA-256 of a string, in hex: equal text has an equal id everywhere."""
    return F.sha2(col, 256)


def meeting_key(col: Column) -> Column:
    """Sixteen bytes of a string's SHA-256: equal strings meet by them in a quarter of the room that an id in hex takes."""
    return F.substring(F.unhex(content_id(col)), 1, 16)


def substring_ids(sub_strs: Column) -> Column:
    """Content id of each substring, in place."""
    return F.transform(sub_strs, content_id)


def replace_string(text: Column, original: Column | str, translated: Column | str) -> Column:
    """Replace every literal occurrence of one string."""
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.replace(text, as_col(original), as_col(translated))


def timestamp_text(col: Column, data_type: str = "timestamp") -> Column:
    """Display form of a timestamp; strings pass through, missing values are spelled out."""
    if data_type == "string":
        return F.when(col.isNull() | (col == ""), MISSING).otherwise(col)
    return F.coalesce(F.date_format(col, "MM/dd/yyyy, HH:mm:ss"), F.lit(MISSING))


def plain_timestamp(col: Column, data_type: str = "timestamp") -> Column:
    """Timestamp as it enters a document id: six fraction digits, or none at all."""
    if data_type == "string":
        return F.coalesce(col, F.lit(MISSING))
    whole = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    exact = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.coalesce(F.when(exact.endswith(".000000"), whole).otherwise(exact), F.lit(MISSING))


def document_id(
    text: Column,
    given: Column | None = None,
    url: Column | None = None,
    timestamp: Column | None = None,
    source_type: str | None = None,
) -> Column:
    """The given id, else a hash of address, time, canonical text and source type.

    ``given`` must be a string column; ``""`` and ``"0"`` of a numeric id count as absent
    (cast and blank them before the call, see ``template_documents``).
    """
    spelled = lambda c: F.coalesce(c, F.lit(MISSING)) if c is not None else F.lit(MISSING)
    source = F.lit(MISSING if source_type is None else source_type)
    hashed = F.sha2(F.concat(spelled(url), spelled(timestamp), text, source), 256)
    return hashed if given is None else F.coalesce(given, hashed)
