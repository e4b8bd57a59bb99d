"""One normal form of text in the Indic and Urdu scripts, as column expressions.

Every script has an ordered list of rewrite rules: zero-width characters go, plain quotes and spaces take the
place of others, letters with a nukta are written as letter and sign, vowels of several signs as one, the verse
bar and the visarga by their own characters.  The rules are compiled: those that change one character become one
``translate``, all others one alternation whose hits are looked up; no rule's result feeds another one of them.
Which letters are composed is read from the Unicode data and not listed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang

# --- fixed values ---------------------------------------------------------------
# What every script drops, and what becomes a plain character.
DROPPED = "\ufeff\ufffe\u2060\u00ad\u200c\u200d"
PLAIN = {"\u200b": " ", "\u00a0": " ", "„": '"', "“": '"', "”": '"', "–": "-", "´": "'", "‘": "'", "‚": "'", "’": "'"}
# Longer rewrites of every script.
PLAIN_RUNS = {"—": " - ", "''": '"', "…": "..."}
DANDA, DOUBLE_DANDA = "।", "॥"
NUKTA, VISARGA = 0x3C, 0x03  # places in a block
# Scripts in which an upright bar stands for the danda.
BAR_IS_DANDA = ("hi", "bn", "pa", "or")
# Single letters of a block: chandra a, the currency mark that looks like a danda, va.
LETTERS = {
    "hi": {"ॲ": "ए"},
    "bn": {"৷": DANDA},
    "or": {"ଵ": "ବ"},
}
# Vowels written as a base or another vowel with a sign, and the sole au sign.
VOWELS = {
    "pa": {
        "ਅਾ": "ਆ", "ੲਿ": "ਇ", "ੲੀ": "ਈ", "ੳੁ": "ਉ", "ੳੂ": "ਊ",
        "ੲੇ": "ਏ", "ਅੈ": "ਐ", "ੳੋ": "ਓ", "ਅੌ": "ਔ",
    },
    "or": {"ଅା": "ଆ", "ଏୗ": "ଐ", "ଓୗ": "ଔ"},
    "ml": {"ൗ": "ൌ"},
}
# Final consonants of Malayalam that were once written with a joiner.
CHILLUS = {"ണ": "ൺ", "ന": "ൻ", "ര": "ർ", "ല": "ൽ", "ള": "ൾ", "ക": "ൿ"}
# Arabic letters that Urdu writes otherwise; digits have the same order in both.
URDU_LETTERS = {"ك": "ک", "ي": "ی", "ى": "ی", "ه": "ہ", "ة": "ۃ"}
URDU_COMPOSED = ("آ", "أ", "ؤ", "ئ", "ۂ", "ۓ")
URDU_FORMS = ((0xFB50, 0xFDFF), (0xFE80, 0xFEFC))
# --------------------------------------------------------------------------------

_JOINER, _VIRAMA_PLACE = "\u200d", 0x4D
# Languages that share the rules of another one.
_SCRIPT_OF = {"mr": "hi", "ne": "hi", "kK": "hi", "as": "bn"}


def _composed(start: int) -> tuple[dict[str, str], dict[str, str]]:
    """Of a block: letters with a nukta to what they consist of, and parted vowels to their whole."""
    apart, whole = {}, {}
    for c in map(chr, range(start, start + 0x80)):
        pair = unicodedata.decomposition(c)
        if pair and not pair.startswith("<"):
            parts = "".join(chr(int(x, 16)) for x in pair.split())
            if parts.endswith(chr(start + NUKTA)):
                apart[c] = parts
            else:
                whole |= {parts: c, unicodedata.normalize("NFD", c): c}
    return apart, whole


def _urdu() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Single letters of Urdu, ligatures to the letters that they show, and letters with a mark to the composed ones."""
    plain = lambda text: "".join(URDU_LETTERS.get(c, c) for c in text)
    single = dict(URDU_LETTERS) | {chr(0x0660 + i): chr(0x06F0 + i) for i in range(10)}
    ligatures, composed = {}, {}
    for c in URDU_COMPOSED:
        parts = unicodedata.normalize("NFD", c)
        composed |= {parts: c, plain(parts): c}
    for first, last in URDU_FORMS:
        for c in map(chr, range(first, last + 1)):
            shown = unicodedata.normalize("NFKC", c)
            if shown != c and not shown.startswith((" ", "\u0640")):
                (single if len(shown) == 1 else ligatures)[c] = plain(shown)
    return single, ligatures, composed


@lru_cache(maxsize=None)
def rules(code: str) -> tuple[dict[str, str], ...]:
    """Of a language: what becomes of single characters ('' drops them), and the tables of longer rewrites that follow in turn."""
    code = _SCRIPT_OF.get(code, code)
    single, runs = dict.fromkeys(DROPPED, "") | PLAIN, dict(PLAIN_RUNS)
    if code == "ur":
        more, ligatures, composed = _urdu()
        return single | more, ligatures, runs | composed
    start = lang.BLOCK_START.get(code)
    if start is None:
        return single, runs
    if code in BAR_IS_DANDA:
        single["|"] = DANDA
    if code != "hi":
        single |= {chr(start + 0x64): DANDA, chr(start + 0x65): DOUBLE_DANDA}
    apart, whole = _composed(start)
    return single | LETTERS.get(code, {}), runs | apart | whole | VOWELS.get(code, {})


def rewrite(col: Column, table: dict[str, str]) -> Column:
    """Every hit of a key by its value, from left to right, the longest key first, in one pass."""
    pattern = "|".join(re.escape(k) for k in sorted(table, key=lambda k: (-len(k), k)))
    found = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    new = F.transform(F.regexp_extract_all(col, F.lit(pattern), 0), lambda hit: F.element_at(found, hit))
    parts = F.zip_with(F.split(col, pattern, -1), new, lambda text, hit: F.concat(text, F.coalesce(hit, F.lit(""))))
    return F.when(col.rlike(pattern), F.array_join(parts, "")).otherwise(col)


def _with(table: dict[str, str]) -> Callable[[Column], Column]:
    return lambda col: rewrite(col, table)


def _translate(col: Column, table: dict[str, str]) -> Column:
    kept = {k: v for k, v in table.items() if v}
    dropped = "".join(k for k, v in table.items() if not v)
    return F.translate(col, "".join(kept) + dropped, "".join(kept.values()))


def normalize_script(col: Column, code: str) -> Column:
    """Text of one language in its normal form; doing it again changes nothing.

    A colon right after a character of the script is its visarga, unless that character is one already.  Null
    stays null.
    """
    single, *longer = rules(code)
    if code == "ml":
        joined = {base + chr(lang.BLOCK_START["ml"] + _VIRAMA_PLACE) + _JOINER: chillu for base, chillu in CHILLUS.items()}
        old = col
        col = F.when(old.contains(_JOINER), rewrite(old, joined)).otherwise(old)
    bind = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    col = _translate(col, single)
    for table in longer:
        col = bind(col, _with(table))
    start = lang.BLOCK_START.get(code)
    if start is None:
        return col
    visarga = chr(start + VISARGA)
    block = f"[\\x{{{start:x}}}-\\x{{{start + 0x7F:x}}}&&[^{visarga}]]"
    return F.regexp_replace(col, f"(?<={block}):", visarga)


def normalize_indic(col: Column, tag: Column | str) -> Column:
    """Text in the normal form of its language; English and other Latin text stays as it is.

    The language may differ by row.  Scripts without rules of their own get those that all have.
    """

    def alike(known: str):
        code = lang.language_code(known)
        return "en" if lang.script_of(known) == "Latn" else _SCRIPT_OF.get(code, code)

    return lang.by_language(tag, lambda t: col if alike(t) == "en" else normalize_script(col, alike(t)), alike)
