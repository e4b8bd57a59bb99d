"""Tokenising and its inverse with all their context: abbreviations, runs of dots, quotes, numbers.

The short forms in ``sentences`` look at one place at a time; these look at the tokens around.  All are column
expressions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
# English words that keep their dot: single capitals, then titles, other abbreviations, months.
PREFIXES = (
    *string.ascii_uppercase,
    "Adj", "Adm", "Adv", "Asst", "Bart", "Bldg", "Brig", "Bros", "Capt", "Cmdr", "Col", "Comdr", "Con", "Corp", "Cpl",
    "DR", "Dr", "Drs", "Ens", "Gen", "Gov", "Hon", "Hr", "Hosp", "Insp", "Lt", "MM", "MR", "MRS", "MS", "Maj", "Messrs",
    "Mlle", "Mme", "Mr", "Mrs", "Ms", "Msgr", "Op", "Ord", "Pfc", "Ph", "Prof", "Pvt", "Rep", "Reps", "Res", "Rev", "Rt",
    "Sen", "Sens", "Sfc", "Sgt", "Sr", "St", "Supt", "Surg",
    "v", "vs", "i.e", "rev", "e.g", "Nos", "Nr",
    "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
# Those that keep it in front of a number only.
NUMBER_PREFIXES = ("No", "Art", "pp")
# Escapes that are undone before tokens are joined, the ampersand last.
ESCAPES = (
    ("&bar;", "|"), ("&#124;", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&bra;", "["), ("&ket;", "]"), ("&quot;", '"'),
    ("&apos;", "'"), ("&#91;", "["), ("&#93;", "]"), ("&amp;", "&"),
)
# Punctuation that the Indic and the Urdu tokeniser set apart (the backslash is not among it).
INDIC_MARKS = r"[!-/:-@\[\]-`{-~\x{964}\x{965}\x{AAF0}\x{AAF1}\x{ABEB}-\x{ABEF}\x{1C7E}\x{1C7F}]"
URDU_MARKS = r"[!-/:-@\[\]-`{-~\x{609}\x{60A}\x{60C}\x{61E}\x{66A}-\x{66D}\x{6D4}]"
# Marks of Indic text that join the word before, the word after, or both.
JOIN_BEFORE, JOIN_AFTER, JOIN_BOTH = r"[!%)\]},.:;>?।॥]", r"[#$(\[{<@]", r"[\-/\\]"
ALTERNATING = "'\"`"
# --------------------------------------------------------------------------------

_ALPHA, _ALNUM = r"\p{L}\p{M}", r"\p{L}\p{M}\p{N}"
_DOT = "\x01"  # a dot of a run; control characters are dropped before


def _bind(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _squeeze(col: Column) -> Column:
    return F.btrim(F.regexp_replace(col, " {2,}", " "))


def _keep_dots(text: Column) -> Column:
    """Parts the dot from words that end with one, but for abbreviations; what follows decides for some."""
    prefixes = F.array(*map(F.lit, PREFIXES))
    numeric = F.array(*map(F.lit, NUMBER_PREFIXES))

    def part(tokens: Column):
        def one(token: Column, i: Column) -> Column:
            after = F.coalesce(F.get(tokens, i + 1), F.lit(""))

            def decide(word: Column) -> Column:
                kept = (
                    (word.contains(".") & word.rlike(f"[{_ALPHA}]"))
                    | F.array_contains(prefixes, word)
                    | after.rlike(r"^\p{Ll}")
                    | (F.array_contains(numeric, word) & after.rlike("^[0-9]"))
                )
                return F.when(kept, token).otherwise(F.concat(word, F.lit(" .")))

            ends = F.endswith(token, F.lit(".")) & (F.length(token) > 1)
            return F.when(ends, _bind(F.left(token, F.length(token) - 1), decide)).otherwise(token)

        return F.transform(tokens, one)

    return F.array_join(_bind(F.split(text, " "), part), " ")


def tokenize_english(col: Column) -> Column:
    """English text in tokens, with a space between any two.

    Symbols stand alone, runs of dots stay whole, commas stay within numbers, an apostrophe goes with what
    follows it, and a final dot stays with an abbreviation, a word with dots inside, or in front of a word in lower case.
    White space and control characters are tidied.  Null stays null.
    """
    text = F.btrim(F.regexp_replace(F.regexp_replace(col, r"(?U)[\s\x1c-\x1f]+", " "), r"[\x00-\x1f]", ""))
    text = F.regexp_replace(text, rf"([^{_ALNUM}\s.'`,\-])", " $1 ")

    def dots(t: Column) -> Column:
        t = F.regexp_replace(t, r"(\.{2,})", " $1 ")
        return F.replace(F.replace(t, F.lit(".."), F.lit(_DOT * 2)), F.lit(f"{_DOT}."), F.lit(_DOT * 2))

    def commas(t: Column) -> Column:
        t = F.regexp_replace(t, r"([^\p{N}]),", "$1 , ")
        t = F.regexp_replace(t, r",([^\p{N}])", " , $1")
        return F.regexp_replace(t, r"(\p{N}),\z", "$1 , ")

    def apostrophes(t: Column) -> Column:
        t = F.regexp_replace(t, rf"([^{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2")
        t = F.regexp_replace(t, rf"([^{_ALNUM}])'([{_ALPHA}])", "$1 ' $2")
        t = F.regexp_replace(t, rf"([{_ALPHA}])'([^{_ALPHA}])", "$1 ' $2")
        t = F.regexp_replace(t, rf"([{_ALPHA}])'([{_ALPHA}])", "$1 '$2")
        return F.regexp_replace(t, r"(\p{N})'(s)", "$1 '$2")

    where = lambda mark, change: lambda t: F.when(t.contains(mark), change(t)).otherwise(t)
    for mark, change in (("..", dots), (",", commas), ("'", apostrophes)):
        text = _bind(text, where(mark, change))
    text = _bind(_squeeze(text), lambda t: F.when(t.contains("."), _keep_dots(t)).otherwise(t))
    text = F.regexp_replace(text, r"\.' ?\z", " . ' ")
    return _squeeze(F.translate(text, _DOT, "."))


_NEITHER, _LEFT, _RIGHT = "0", "1", "2"


def _sides(tokens: Column) -> Column:
    """Of every token whether it joins what stands before (1), after (2) or neither (0), as one string.

    A quote joins what follows and its partner what precedes; the state is the quotes that are open.
    """
    state = F.struct(F.lit("").alias("sides"), F.array().cast("array<string>").alias("open"), F.lit("").alias("before"))

    def step(s: Column, token: Column) -> Column:
        quote = F.when(token.rlike("^[„“”]+$"), F.lit('"')).otherwise(token)
        is_quote = token.rlike("^['\"„“`]+$")
        is_open = F.array_contains(s["open"], quote)
        possessive = (token == "'") & F.endswith(s["before"], F.lit("s")) & ~is_open
        first = s["before"] == ""
        side = (
            F.when(token.rlike(r"^[\p{Sc}(\[{¿¡]+$"), F.lit(_RIGHT))
            .when(token.rlike(r"^[,.?!:;\\%}\])]+$"), F.lit(_LEFT))
            .when(~first & token.rlike(rf"^'[{_ALPHA}]"), F.lit(_LEFT))
            .when(is_quote & (is_open | possessive), F.lit(_LEFT))
            .when(is_quote, F.lit(_RIGHT))
            .otherwise(F.lit(_NEITHER))
        )
        turned = F.when(is_open, F.array_remove(s["open"], quote)).otherwise(F.array_append(s["open"], quote))
        now_open = F.when(is_quote & ~possessive, turned).otherwise(s["open"])
        return F.struct(F.concat(s["sides"], side).alias("sides"), now_open.alias("open"), token.alias("before"))

    return F.aggregate(tokens, state, step)["sides"]


def detokenize_english(col: Column) -> Column:
    """Tokens back in running English text; escapes are undone first.

    Opening marks and currency join what follows, closing marks and contractions what precedes, quotes by turns, but
    an apostrophe behind an s is a possessive.  Null stays null.
    """
    text = F.replace(col, F.lit(" @-@ "), F.lit("-"))

    def unescape(t: Column) -> Column:
        plain = t
        for escape, c in ESCAPES:
            plain = F.replace(plain, F.lit(escape), F.lit(c))
        return F.when(t.contains("&"), plain).otherwise(t)

    def joined(tokens: Column) -> Column:
        def spaced(sides: Column) -> Column:
            def one(token: Column, i: Column) -> Column:
                closed = (F.get(sides, i) == _LEFT) | (F.get(sides, i - 1) == _RIGHT)
                return F.when((i == 0) | F.coalesce(closed, F.lit(False)), token).otherwise(F.concat(F.lit(" "), token))

            return F.array_join(F.transform(tokens, one), "")

        return _bind(F.split(_sides(tokens), ""), spaced)

    words = F.filter(F.split(_bind(text, unescape), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    return _bind(words, lambda w: F.when(F.size(w) == 0, F.lit("")).otherwise(joined(w)))


_NUMBER_GAPS = r"([0-9]) ([,.:/]) (?=[0-9])"


def tokenize_indic(col: Column) -> Column:
    """Every punctuation mark apart, but numbers, dates and times whole."""
    text = F.regexp_replace(F.replace(col, F.lit("\t"), F.lit(" ")), f"({INDIC_MARKS})", " $1 ")
    return F.regexp_replace(_squeeze(text), _NUMBER_GAPS, "$1$2")


def tokenize_urdu(col: Column) -> Column:
    """Every punctuation mark of Urdu apart."""
    return _squeeze(F.regexp_replace(F.replace(col, F.lit("\t"), F.lit(" ")), f"({URDU_MARKS})", " $1 "))


def detokenize_indic(col: Column) -> Column:
    """Tokens back in running text of an Indic script; a quote joins what follows, its partner what precedes."""
    text = F.regexp_replace(col, _NUMBER_GAPS, "$1$2")
    text = F.regexp_replace(text, f" ({JOIN_BOTH}) ", "$1")
    text = F.regexp_replace(text, f" ({JOIN_BEFORE})", "$1")
    text = F.regexp_replace(text, f"({JOIN_AFTER}) ", "$1")

    def turns(mark: str):
        def run(pieces: Column) -> Column:
            def one(piece: Column, i: Column) -> Column:
                inside = F.regexp_replace(piece, "^ ", "")
                inside = F.when(i < F.size(pieces) - 1, F.regexp_replace(inside, r" \z", "")).otherwise(inside)
                return F.when(i % 2 == 1, inside).otherwise(piece)

            return F.array_join(F.transform(pieces, one), mark)

        return run

    where = lambda mark: lambda t: F.when(t.contains(mark), _bind(F.split(t, mark, -1), turns(mark))).otherwise(t)
    for mark in ALTERNATING:
        text = _bind(text, where(mark))
    return text
