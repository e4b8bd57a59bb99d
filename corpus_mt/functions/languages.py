"""Languages, their codes, and conversion between the parallel Indic scripts."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
# Language tag -> short code.
LANGUAGE_CODES = {
    "asm_Beng": "as", "awa_Deva": "hi", "ben_Beng": "bn", "bho_Deva": "hi", "brx_Deva": "hi",
    "doi_Deva": "hi", "eng_Latn": "en", "gom_Deva": "kK", "gon_Deva": "hi", "guj_Gujr": "gu",
    "hin_Deva": "hi", "hne_Deva": "hi", "kan_Knda": "kn", "kas_Arab": "ur", "kas_Deva": "hi",
    "kha_Latn": "en", "lus_Latn": "en", "mag_Deva": "hi", "mai_Deva": "hi", "mal_Mlym": "ml",
    "mar_Deva": "mr", "mni_Beng": "bn", "mni_Mtei": "hi", "npi_Deva": "ne", "ory_Orya": "or",
    "pan_Guru": "pa", "san_Deva": "hi", "sat_Olck": "or", "snd_Arab": "ur", "snd_Deva": "hi",
    "tam_Taml": "ta", "tel_Telu": "te", "urd_Arab": "ur", "unr_Deva": "hi",
}
# Languages of the evaluation sets, besides English.
EVALUATED_LANGUAGES = (
    "asm_Beng", "ben_Beng", "brx_Deva", "doi_Deva", "gom_Deva", "guj_Gujr", "hin_Deva", "kan_Knda",
    "kas_Arab", "mai_Deva", "mal_Mlym", "mar_Deva", "mni_Mtei", "npi_Deva", "ory_Orya", "pan_Guru",
    "san_Deva", "sat_Olck", "snd_Deva", "tam_Taml", "tel_Telu", "urd_Arab",
)
ENGLISH = "eng_Latn"
# Scripts that are never converted to Devanagari.
UNCONVERTED_SCRIPTS = ("Arab", "Aran", "Olck", "Mtei", "Latn")
# First code point of the Unicode block each short code is written in.
BLOCK_START = {
    "hi": 0x0900, "mr": 0x0900, "ne": 0x0900, "kK": 0x0900, "bn": 0x0980, "as": 0x0980,
    "pa": 0x0A00, "gu": 0x0A80, "or": 0x0B00, "ta": 0x0B80, "te": 0x0C00, "kn": 0x0C80, "ml": 0x0D00,
}
VIRAMA = "\u094d"
# --------------------------------------------------------------------------------

_PARALLEL_OFFSETS = [o for o in range(0x70) if o not in (0x64, 0x65)]  # both dandas are shared


def language_code(tag: str) -> str:
    """Short code of a language tag; an unknown tag is an error."""
    if tag not in LANGUAGE_CODES:
        raise ValueError(f"unknown language tag {tag!r}")
    return LANGUAGE_CODES[tag]


def script_of(tag: str) -> str:
    language_code(tag)
    return tag.split("_")[1]


def _tamil_offset(offset: int) -> int:
    """Tamil writes each row of stops with its first letter and nasal only, except ja."""
    if 0x15 <= offset <= 0x28 and offset != 0x1C and (offset - 0x15) % 5 in (1, 2, 3):
        return 0x15 + (offset - 0x15) // 5 * 5
    if offset in (0x2B, 0x2C, 0x2D):
        return 0x2A
    return 0x37 if offset == 0x36 else offset


def convert_script(col: Column, from_code: str, to_code: str) -> Column:
    """Move text between two parallel Indic blocks by code point offset.

    Codes without a parallel block (and equal blocks) leave the text alone.
    """
    a, b = BLOCK_START.get(from_code), BLOCK_START.get(to_code)
    if a is None or b is None or a == b:
        return col
    target = _tamil_offset if to_code == "ta" else (lambda o: o)
    return F.translate(
        col,
        "".join(chr(a + o) for o in _PARALLEL_OFFSETS),
        "".join(chr(b + target(o)) for o in _PARALLEL_OFFSETS),
    )


def to_devanagari(col: Column, tag: str) -> Column:
    """Source text in Devanagari, unless its script is one that is kept; viramas are joined."""
    if script_of(tag) in UNCONVERTED_SCRIPTS:
        return col
    converted = convert_script(col, language_code(tag), "hi")
    return F.replace(converted, F.lit(f" {VIRAMA} "), F.lit(VIRAMA))


def from_devanagari(col: Column, tag: str) -> Column:
    """Model output in the script of the target language."""
    return convert_script(col, "hi", language_code(tag))


def by_language(tag: str | Column, make: Callable[[str], Column], alike: Callable[[str], Hashable]) -> Column:
    """``make(tag)``, chosen per row when the tag is a column.

    Languages for which ``alike`` gives the same value share one branch.
    """
    if isinstance(tag, str):
        language_code(tag)
        return make(tag)
    groups: dict = {}
    for known in LANGUAGE_CODES:
        groups.setdefault(alike(known), []).append(known)
    out = F
    for tags in groups.values():
        out = out.when(tag.isin(tags), make(tags[0]))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown language tag "), F.coalesce(tag, F.lit("null")))))


def language_pairs(direction: str) -> list[tuple[str, str]]:
    """(source, target) pairs evaluated in a direction; a language is never paired with itself."""
    if direction == "en-indic":
        return [(ENGLISH, t) for t in EVALUATED_LANGUAGES]
    if direction == "indic-en":
        return [(s, ENGLISH) for s in EVALUATED_LANGUAGES]
    if direction == "indic-indic":
        return [(s, t) for s in EVALUATED_LANGUAGES for t in EVALUATED_LANGUAGES if s != t]
    raise ValueError(f"unknown direction {direction!r}")
