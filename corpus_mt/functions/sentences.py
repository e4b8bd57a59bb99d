"""Sentence pre- and post-processing around the translator, as column expressions.

Punctuation and digits are normalised, entities hidden behind placeholders, text spaced
into tokens and, for Indic scripts, written in Devanagari; the inverse restores them.
The two tokenisers here are a documented subset, built from punctuation classes; ``full`` takes those of
``tokenize``, which look at the tokens around, and the normal form of ``normalize``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import normalize as nz
from corpus_mt.functions import tokenize as tz
from corpus_mt.functions.text import strip

# --- fixed values ---------------------------------------------------------------
# Literal punctuation replacements, applied in this order.
PUNCTUATION = (
    ("\r", ""),
    ("(", " ("),
    (")", ") "),
    ("( ", "("),
    (" )", ")"),
    (" :", ":"),
    (" ;", ";"),
    ("`", "'"),
    ("„", '"'),
    ("“", '"'),
    ("”", '"'),
    ("–", "-"),
    ("—", " - "),
    ("´", "'"),
    ("‘", "'"),
    ("‚", "'"),
    ("’", "'"),
    ("''", '"'),
    ("´´", '"'),
    ("…", "..."),
    ("\u00a0«\u00a0", ' "'),
    ("«\u00a0", '"'),
    ("«", '"'),
    ("\u00a0»\u00a0", '" '),
    ("\u00a0»", '"'),
    ("»", '"'),
    ("\u00a0%", "%"),
    ("nº\u00a0", "nº "),
    ("\u00a0:", ":"),
    ("\u00a0ºC", " ºC"),
    ("\u00a0cm", " cm"),
    ("\u00a0?", "?"),
    ("\u00a0!", "!"),
    ("\u00a0;", ";"),
    (",\u00a0", ", "),
)
# Pattern replacements that follow them, in this order.
PUNCTUATION_PATTERNS = (
    (r"[ ]{2,}", " "),
    (r"\) ([\.!:?;,])", r")$1"),
    (r"(\p{Nd}) %", r"$1%"),
    (r"\"([,\.]+)", r'$1"'),
    ("(\\p{Nd})\u00a0(\\p{Nd})", r"$1.$2"),
)
# First code point of each native digit block, and how many of its digits are left out
# or taken: Telugu zero is left out, of the Arabic-Indic digits only zero is taken.
DIGIT_BLOCKS = (
    (0x0660, 0, 1), (0x06F0, 0, 10), (0x0966, 0, 10), (0x09E6, 0, 10), (0x0A66, 0, 10), (0x0AE6, 0, 10),
    (0x0B66, 0, 10), (0x0C66, 1, 10), (0x0CE6, 0, 10), (0x1C50, 0, 10), (0xABF0, 0, 10),
)
# Entity patterns, in the order they are applied.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
URL = r"(?U)\b(?<![\w/.])(?:(?:https?|ftp)://)?(?:(?:[\w-]+\.)+(?!\.))[\w/\-?#&=%.]+(?!\.\w+)\b"
NUMERAL = (
    r"(?U)(~?\d+\.?\d*\s?%?\s?-?\s?~?\d+\.?\d*\s?%|~?\d+%"
    r"|\d+[-\/.,:']\d+[-\/.,:'+]\d+(?:\.\d+)?|\d+[-\/.:'+]\d+(?:\.\d+)?)"
)
HANDLE = r"(?U)[A-Za-z0-9]*[#|@]\w+"
# Shortest URL (dots aside) and numeral (spaces, dots and colons aside) that is hidden.
SHORTEST_ENTITY = 4
# Spellings of "ID" that translators are known to produce.
ID_SPELLINGS = (
    "آی ڈی ",
    "ꯑꯥꯏꯗꯤ",
    "आईडी",
    "आई . डी . ",
    "आई . डी .",
    "आई. डी. ",
    "आई. डी.",
    "ऐटि",
    "آئی ڈی ",
    "ᱟᱭᱰᱤ ᱾",
    "आयडी",
    "ऐडि",
    "आइडि",
    "ᱟᱭᱰᱤ",
)
# What surrounds "ID" and its serial number, then each spelling and the number.
ID_FORMS = (("<", "]"), ("< ", " ]"), ("<", ">"), ("< ", " >"))
SPELLING_FORMS = (
    ("<", "", ">"), ("< ", "", " >"), ("< ", " ", " >"), ("<", " ", "]"),
    ("< ", " ", " ]"), ("[", " ", "]"), ("[ ", " ", " ]"),
)
# Repairs of Perso-Arabic and Odia model output.
PERSO_ARABIC_FIXES = (
    (" ؟", "؟"),
    (" ۔", "۔"),
    (" ،", "،"),
    ("\u066e\u06ea", "\u0620"),
)
ODIA_FIX = ("\u0b2f\u0b3c", "\u0b5f")
# Punctuation the Indic tokeniser sets apart.
INDIC_PUNCTUATION = r"[!-/:-@\[-`{-~\x{964}\x{965}\x{AAF0}\x{AAF1}\x{ABEB}-\x{ABEF}\x{1C7E}\x{1C7F}]"
# --------------------------------------------------------------------------------

# The entity patterns as they are searched for: the same matches, but every run of characters is
# read once (possessive) and entered at its start, or where the last match ended.  A run of n digits would
# otherwise be cut in n^3 ways, and a repeated group overflows the stack.
_EMAIL_SEARCH = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
# What follows the first label may hold further labels, so one is enough to ask for.
_URL_SEARCH = r"(?U)\b(?<![\w/.])(?:(?:https?|ftp)://)?[\w-]++\.(?!\.)[\w/\-?#&=%.]+(?!\.\w+)\b"
# Two numbers with something between them, or run together; then the shorter forms.
_NUMBER = r"\d++(?:\.\d*+)?+"
_NUMERAL_SEARCH = (
    rf"(?U)(~?(?<!\d){_NUMBER}\s?%?\s?-?\s?~?{_NUMBER}\s?%"
    r"|~?(?<!\d)(?:\d{2,}+\.?+|\d++\.\d++(?:\.\d*+)?+)\s?%|~?(?<!\d)\d++%"
    r"|(?<!\d)\d++[-\/.,:']\d++[-\/.,:'+]\d++(?:\.\d++)?+|(?<!\d)\d++[-\/.:'+]\d++(?:\.\d++)?+)"
)
_HANDLE_SEARCH = r"(?U)(?:\G|(?<![A-Za-z0-9]))[A-Za-z0-9]*+[#|@]\w+"

ENTITY_TYPE = "array<struct<serial:int,entity:string>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, however often that mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def replace_all(col: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


# Characters below U+0100 are listed one by one: such a class is one table, while every range in it is tested in turn.
_LATIN_LETTERS = "".join(c for c in map(chr, range(0x100)) if c.isalpha() and c not in "ªµº")
# Latin letters, single spaces, commas, hyphens, single apostrophes and a dot at the end: most sentences are no more.
_PLAIN = rf"\A[{_LATIN_LETTERS}\x{{100}}-\x{{24F}} ,'\-]*\.?\z"


def _is_plain(text: Column) -> Column:
    """True for text that no rule for punctuation, digits or entities changes."""
    return text.rlike(_PLAIN) & ~text.contains("  ") & ~text.contains("''")


def _if_any(text: Column, marks: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """``change``, for text that holds one of the marks; without them it is known to change nothing."""
    return F.when(reduce(or_, [text.contains(m) for m in marks]), change(text)).otherwise(text)


# Text without any of these is not changed by the punctuation rules.
_PUNCTUATION_TRIGGER = r"[\r():;`%\"\x{A0}\x{AB}\x{B4}\x{BB}\x{2010}-\x{203F}]|''|  "


def normalize_punctuation(col: Column) -> Column:
    """Plain ASCII quotes, dashes and spacing."""

    def rules(text: Column) -> Column:
        text = replace_all(text, PUNCTUATION)
        for pattern, new in PUNCTUATION_PATTERNS:
            text = F.regexp_replace(text, pattern, new)
        return text

    return _bind(col, lambda t: strip(F.when(t.rlike(_PUNCTUATION_TRIGGER), rules(t)).otherwise(t)))


def normalize_numerals(col: Column) -> Column:
    """Native digits to ASCII digits."""
    pairs = [(chr(zero + i), str(i)) for zero, lo, hi in DIGIT_BLOCKS for i in range(lo, hi)]
    native = "".join(a for a, _ in pairs)
    ascii_digits = lambda t: F.translate(t, native, "".join(b for _, b in pairs))
    # Only text with characters beyond ASCII can hold any.
    return _bind(col, lambda t: F.when((F.octet_length(t) != F.char_length(t)) & t.rlike(f"[{min(native)}-{max(native)}]"), ascii_digits(t)).otherwise(t))


def email_spans(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(_EMAIL_SEARCH), 0)


# Characters that stand for hyphens while URLs are searched; text that holds either is searched as it is.
_TIED, _FREE = "\x03", "\x02"
_URL_SEARCH_TIED = (
    r"(?U)\b(?<![\w/.\x03])(?:(?:https?|ftp)://)?[\w\x03-]++\.(?!\.)[\w/\-\x03?#&=%.]+(?!\.\w+)\b"
)


def url_spans(col: Column) -> Column:
    """URLs of the text, in time proportional to its length.

    A URL may begin behind any hyphen.  In a run of words and hyphens, though, a later place can only begin one
    if the first allowed place does, unless a scheme follows: all need the dot at the run's end.  So the hyphen in front of every
    other word of a run is marked first, and no URL begins behind a marked one.
    """

    def tied(t: Column) -> Column:
        # The first words of a run behind a slash or dot begin none; the ones after them are the first allowed place.
        t = F.regexp_replace(t, r"(?U)([/.]\w++-*)-(?=\w)", f"$1{_FREE}")
        t = F.regexp_replace(t, r"(?U)(\w)(-*)-(?=\w)(?!(?:https?|ftp)://)", f"$1$2{_TIED}")
        found = F.regexp_extract_all(F.translate(t, _FREE, "-"), F.lit(_URL_SEARCH_TIED), 0)
        return F.transform(found, lambda u: F.translate(u, _TIED, "-"))

    plain = lambda t: F.regexp_extract_all(t, F.lit(_URL_SEARCH), 0)
    return _bind(col, lambda t: F.when(t.contains("-") & ~t.rlike(f"[{_TIED}{_FREE}]"), tied(t)).otherwise(plain(t)))


def numeral_spans(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(_NUMERAL_SEARCH), 0)


def handle_spans(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(_HANDLE_SEARCH), 0)


def _drop_chars(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


# Text of characters among which the space is the only white space.
_NO_ODD_SPACE = "\\A[" + "".join(rf"\x{{{i:X}}}" for i in range(0x20, 0x100) if i not in (0x85, 0xA0)) + r"\x{100}-\x{167F}]*\z"

# A URL has a dot that is followed by one of these.
_URL_TRIGGER = r"\.[\w/\-?#&=%\x{80}-\x{10FFFF}]"


def wrap_entities(col: Column) -> Column:
    """Hide e-mails, URLs, numerals and handles behind ``<ID1>``, ``<ID2>``, ...

    Gives ``struct(text, entities)``.  Each kind is searched in the text the kinds before
    it left; entities are numbered by first appearance; equal spans share a number.
    """
    nothing = F.array().cast("array<string>")
    # Each kind comes with a cheap test that is true wherever the kind occurs.
    steps = (
        ("@", email_spans, None),
        (_URL_TRIGGER, url_spans, "."),
        (r"\p{Nd}", numeral_spans, " .:"),
        ("[#|@]", handle_spans, None),
    )

    def put(state: Column, span: Column) -> Column:
        serial = F.size(state["entities"]) + 1
        holder = F.concat(F.lit("<ID"), serial.cast("string"), F.lit(">"))
        return F.struct(
            F.replace(state["text"], span, holder).alias("text"),
            F.concat(
                state["entities"], F.array(F.struct(serial.alias("serial"), span.alias("entity")))
            ).alias("entities"),
        )

    def step(may_hold, find, ignored) -> Callable[[Column], Column]:
        def run(s: Column) -> Column:
            spans = F.when(s["text"].rlike(may_hold), F.array_distinct(find(s["text"]))).otherwise(nothing)
            if ignored:
                spans = F.filter(spans, lambda m: F.length(_drop_chars(m, ignored)) >= SHORTEST_ENTITY)
            return F.aggregate(spans, s, put)

        return run

    def hide(text: Column) -> Column:
        state = F.struct(text.alias("text"), F.array().cast(ENTITY_TYPE).alias("entities"))
        bare = state
        for kind in steps:
            state = _bind(state, step(*kind))
        return F.when(text.rlike(rf"[\p{{Nd}}#|@]|{_URL_TRIGGER}"), state).otherwise(bare)

    def tidy(s: Column) -> Column:
        spaced = F.when(
            s["text"].contains("  ") | ~s["text"].rlike(_NO_ODD_SPACE), F.regexp_replace(s["text"], r"(?U)[\s\x1c-\x1f]+", " ")
        ).otherwise(s["text"])
        text = replace_all(spaced, ((">/", ">"), ("]/", "]")))
        return F.struct(text.alias("text"), s["entities"].alias("entities"))

    return _bind(_bind(col, hide), tidy)


def placeholder_forms() -> list[tuple[str, str]]:
    """What may stand before and after a serial number in model output, in restore order."""
    forms = [(f"{a}ID", b) for a, b in ID_FORMS]
    forms += [(f"{a}{word}{gap}", b) for word in ID_SPELLINGS for a, gap, b in SPELLING_FORMS]
    return list(dict.fromkeys(forms))


def _forms_column() -> Column:
    """The forms as one constant array."""
    forms = json.dumps([{"before": a, "after": b} for a, b in placeholder_forms()])
    return F.from_json(F.lit(forms), "array<struct<before:string,after:string>>")


def entity_map(entities: Column) -> Column:
    """Every placeholder spelling of every entity, as ``map<string,string>``."""
    entry = lambda e, f: F.struct(
        F.concat(f["before"], e["serial"].cast("string"), f["after"]).alias("key"), e["entity"].alias("value")
    )
    pairs = F.flatten(F.transform(entities, lambda e: F.transform(_forms_column(), lambda f: entry(e, f))))
    return F.map_from_entries(pairs)


def _spelled_pattern() -> str:
    """All spellings of a placeholder, the serial being the only number in them."""
    quoted = lambda x: re.sub(r"([\[\]().])", r"\\\1", x)
    after: dict[str, list[str]] = {}
    for a, b in placeholder_forms():
        after.setdefault(b, []).append(a)
    groups = [f"(?:{'|'.join(quoted(a) for a in sorted(before, key=lambda x: (-len(x), x)))})[1-9][0-9]*+{quoted(b)}" for b, before in after.items()]
    return "|".join(groups)


def restore_entities(text: Column, entities: Column) -> Column:
    """Put entities back in one pass over the text, whichever way their placeholders are spelled.

    A placeholder without an entity stays.  No entity is itself a part of a placeholder, so the order in which
    they would be replaced one by one makes no difference.
    """
    pattern = _spelled_pattern()
    by_serial = F.map_from_entries(F.transform(entities, lambda e: F.struct(e["serial"].cast("string").alias("key"), e["entity"].alias("value"))))

    def put(known: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), 0)
        new = F.transform(hits, lambda hit: F.coalesce(F.element_at(known, F.regexp_extract(hit, "[0-9]+", 0)), hit))
        parts = F.zip_with(F.split(text, pattern, -1), new, lambda piece, value: F.concat(piece, F.coalesce(value, F.lit(""))))
        return F.array_join(parts, "")

    worth = (F.size(entities) > 0) & text.rlike(r"[<\[]")
    return F.when(worth, _bind(by_serial, put)).otherwise(text)


def add_language_tags(col: Column, src_lang: Column | str, tgt_lang: Column | str, delimiter: str = " ") -> Column:
    """``src tgt sentence``."""
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.concat_ws(delimiter, as_col(src_lang), as_col(tgt_lang), strip(col))


def _collapse(col: Column) -> Column:
    return strip(_bind(col, lambda t: _if_any(t, ("  ",), lambda x: F.regexp_replace(x, " {2,}", " "))))


def _close(col: Column, before: str = "", after: str = "") -> Column:
    """Without the space in front of every mark of ``before`` and behind every mark of ``after``.

    A mark and its space overlap with no other mark's, so one after the other is the same as all at once.
    """
    return replace_all(col, (*((f" {m}", m) for m in before), *((f"{m} ", m) for m in after)))


def tokenize_english(col: Column) -> Column:
    """Set punctuation apart: symbols, commas away from digits, apostrophes, a final dot."""

    def commas(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, r"([^\p{N}]),", "$1 , "), r",([^\p{N}])", " , $1")

    def apostrophes(t: Column) -> Column:
        return F.regexp_replace(t, r"([\p{L}])'([\p{L}])", "$1 '$2")

    def apart(t: Column) -> Column:
        symbols = F.regexp_replace(t, r"([^\p{L}\p{N}\s.'`,\-])", " $1 ")
        # Plain text has no symbols, and no digits that keep a comma; a comma alone is left in any case.
        alone = replace_all(t, ((",", " , "), ("  ", " ")))
        return F.when(_is_plain(t), alone).otherwise(_bind(symbols, lambda x: _if_any(x, (",",), commas)))

    col = _bind(_bind(col, apart), lambda t: _if_any(t, ("'",), apostrophes))
    size = F.char_length
    ends = lambda t: t.endswith(".") & ~t.endswith("..") & (size(t) > 1)
    final_dot = lambda t: F.when(ends(t), F.concat(F.substring(t, F.lit(1), size(t) - 1), F.lit(" ."))).otherwise(t)
    return _collapse(_bind(col, final_dot))


def detokenize_english(col: Column) -> Column:
    """Close the spaces that tokenising opened."""
    col = _close(col, before=",.!?;:%)]}", after="([{")
    col = _bind(col, lambda t: _if_any(t, (" '",), lambda x: F.regexp_replace(x, r"([\p{L}]) '([\p{L}])", "$1'$2")))
    col = _bind(col, lambda t: _if_any(t, ('" ',), lambda x: F.regexp_replace(x, r'" ([^"]*) "', '"$1"')))
    return _collapse(col)


def tokenize_indic(col: Column) -> Column:
    """Set every punctuation mark apart, but keep numbers, dates and times whole."""
    col = F.regexp_replace(col, f"({INDIC_PUNCTUATION})", " $1 ")
    col = F.regexp_replace(F.replace(col, F.lit("\t"), F.lit(" ")), " {2,}", " ")
    return strip(F.regexp_replace(col, r"([0-9]) ([,.:/]) (?=[0-9])", "$1$2"))


def detokenize_indic(col: Column) -> Column:
    """Close spaces before closing marks, after opening marks and around joiners."""
    col = _close(_close(col, before="!%),.:;>?]}।॥"), after="#$([{<@")
    col = _bind(col, lambda t: _if_any(t, ("-", "/", "\\"), lambda x: F.regexp_replace(x, r" ?([\-/\\]) ?", "$1")))
    col = _bind(col, lambda t: _if_any(t, ('" ',), lambda x: F.regexp_replace(x, r'" ([^"]*) "', '"$1"')))
    return _collapse(col)


def normalize_sentence(col: Column, placeholders: bool = True) -> Column:
    """``struct(text, entities)`` of a sentence: digits normalised, entities hidden if asked."""
    text = normalize_numerals(strip(col))
    if placeholders:
        return wrap_entities(text)
    return F.struct(text.alias("text"), F.array().cast(ENTITY_TYPE).alias("entities"))


def preprocess_sentence(col: Column, src_lang: str | Column, placeholders: bool = True, full: bool = False) -> Column:
    """``struct(text, entities)`` ready for language tags; the language may differ by row.

    With ``full``, English is tokenised with its abbreviations, runs of dots and apostrophes, and all other text is
    brought to the normal form of its script before it is tokenised.
    """

    def alike(tag: str):
        kept = lang.script_of(tag) in lang.UNCONVERTED_SCRIPTS
        code = lang.language_code(tag)
        return code == "en", None if kept else lang.BLOCK_START[code], code if full else None

    def finish(s: Column) -> Column:
        body = strip(s["text"])

        def make(tag: str) -> Column:
            code = lang.language_code(tag)
            if code == "en":
                return tz.tokenize_english(normalize_punctuation(body)) if full else tokenize_english(body)
            if not full:
                return lang.to_devanagari(tokenize_indic(body), tag)
            split = tz.tokenize_urdu if code == "ur" else tz.tokenize_indic
            return lang.to_devanagari(_bind(nz.normalize_script(body, code), split), tag)

        return F.struct(lang.by_language(src_lang, make, alike).alias("text"), s["entities"].alias("entities"))

    def normal(t: Column) -> Column:
        bare = F.struct(F.trim(t).alias("text"), F.array().cast(ENTITY_TYPE).alias("entities"))
        return F.when(_is_plain(t), bare).otherwise(normalize_sentence(normalize_punctuation(t), placeholders))

    return _bind(_bind(col, normal), finish)


def repair_output(col: Column, tgt_lang: str) -> Column:
    """Script-specific repairs of model output."""
    if lang.script_of(tgt_lang) in ("Arab", "Aran"):
        col = replace_all(col, PERSO_ARABIC_FIXES)
    if tgt_lang.split("_")[0] == "ory":
        col = replace_all(col, (ODIA_FIX,))
    return col


def postprocess_sentence(col: Column, entities: Column, tgt_lang: str | Column, full: bool = False) -> Column:
    """Readable text from decoded model output; the language may differ by row.

    With ``full`` the quotes, contractions and currency of the text decide where tokens are joined.
    """

    def alike(tag: str):
        arabic, odia = lang.script_of(tag) in ("Arab", "Aran"), tag.split("_")[0] == "ory"
        return tag == lang.ENGLISH, lang.BLOCK_START.get(lang.language_code(tag)), arabic, odia

    def spaced(text: Column) -> Callable[[str], Column]:
        def make(tag: str) -> Column:
            english, indic = (tz.detokenize_english, tz.detokenize_indic) if full else (detokenize_english, detokenize_indic)
            return english(text) if tag == lang.ENGLISH else indic(lang.from_devanagari(text, tag))

        return make

    repaired = _bind(col, lambda t: lang.by_language(tgt_lang, lambda tag: repair_output(t, tag), alike))
    restored = _bind(repaired, lambda t: restore_entities(t, entities))
    return _bind(restored, lambda t: lang.by_language(tgt_lang, spaced(t), alike))
