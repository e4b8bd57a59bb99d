"""Unicode NFKC as a column expression.

Spark has no normalisation function, so the work itself is one Arrow UDF.  Most
text is already in NFKC form, and two native pattern tests prove that for a row
without leaving the JVM: only the remaining rows carry their text to Python.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code point blocks in which stable characters are looked for.  Text made only of
# stable characters from these blocks is its own NFKC form.
_STABLE_BLOCKS = ((0x0000, 0x0530), (0x0600, 0x0E80), (0x1C50, 0x1C80), (0x2010, 0x2060), (0xABC0, 0xAC00))


@lru_cache(maxsize=1)
def _joining_code_points() -> frozenset[int]:
    """Code points that can merge with the character before them."""
    seconds = set(range(0x1161, 0x1200))
    for cp in range(0x30000):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(int(parts[1], 16))
    return frozenset(seconds)


def _is_stable(cp: int) -> bool:
    c = chr(cp)
    return (
        unicodedata.normalize("NFKC", c) == c
        and unicodedata.combining(c) == 0
        and cp not in _joining_code_points()
    )


@lru_cache(maxsize=1)
def _patterns() -> tuple[str, str]:
    """Two tests a row must both pass before it may need normalising.

    The first is cheap: a character above U+00FF, or one of the few unstable Latin-1
    characters.  The second, run only on rows that pass the first, is exact up to
    combining marks: a character outside the stable ranges.
    """
    latin = "".join(f"\\x{{{cp:X}}}" for cp in range(0x100) if not _is_stable(cp))
    quick = f"[{latin}\\x{{100}}-\\x{{10FFFF}}]"
    ranges: list[list[int]] = []
    for lo, hi in _STABLE_BLOCKS:
        for cp in range(lo, hi):
            if _is_stable(cp):
                if ranges and ranges[-1][1] == cp - 1:
                    ranges[-1][1] = cp
                else:
                    ranges.append([cp, cp])
    spans = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return quick, f"[^{spans}]"


@F.pandas_udf(StringType())
def _nfkc_arrow(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def needs_nfkc(col: Column) -> Column:
    """False only where NFKC provably leaves the text unchanged."""
    quick, exact = _patterns()
    return (F.octet_length(col) != F.char_length(col)) & col.rlike(quick) & col.rlike(exact)


def nfkc(col: Column) -> Column:
    """NFKC form of a string column; rows already in that form never reach Python."""
    return F.coalesce(_nfkc_arrow(F.when(needs_nfkc(col), col)), col)
