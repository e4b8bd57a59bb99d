"""Source names from addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Host part of an address, with ``w`` and ``.`` characters stripped from both ends.

    User and port stay, and an address without a scheme is read as if it had one.
    """
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("http://"), url))
    return F.btrim(F.regexp_extract(full, r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), F.lit("w."))


def source_name(url: Column) -> Column:
    """Host without its last label, joined by underscores; a host without a dot gives the address."""
    name = host(url)
    joined = F.regexp_replace(F.regexp_replace(name, r"\.[^.]*\z", ""), r"[./\\]", "_")
    return F.when(url.isNull() | (url == ""), F.lit(None)).when(~name.contains("."), url).otherwise(joined)
