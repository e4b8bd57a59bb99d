"""Queries of the full tokenisers and the normal forms of scripts, and the same in DuckDB SQL.

The SQL applies every rule in turn, spelled out by code point; the library compiles its rules from the Unicode
data into one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.functions import languages as lang
from corpus_mt.functions import normalize as nz
from corpus_mt.functions import tokenize as tz
from corpus_mt.operators import tokens as tk
from corpus_mt.plans.oracles import ENTITIES, WS, _join_virama, _numerals, _punct, _q, _strip, _to_script, _wrap_ctes
from corpus_mt.plans.queries import SRC, TGT, _entity_list, _read

SCRIPTS = ("hin_Deva", "ben_Beng", "pan_Guru", "guj_Gujr", "ory_Orya", "tam_Taml", "tel_Telu", "kan_Knda", "mal_Mlym")
# Places in a block that stand for the letters a to z: signs, bases and consonants that meet in the rules.
PLACES = (0x0F, 0x15, 0x1C, 0x21, 0x57, 0x2B, 0x17, 0x46, 0x3F, 0x72, 0x05, 0x32, 0x28, 0x3E, 0x47, 0x13, 0x58, 0x56, 0x42, 0x3C, 0x55, 0x35, 0x64, 0x33, 0x59, 0x65)
JOINER = "\u200d"
# Plain marks to odd ones, in turn.
ODD = ((". ", "…\u00a0"), (",", ":"), ("-", "|"), ("'", "’’"), ("?", "\u200b—\u2060"))


def _in_script(text: Column, tag: str) -> Column:
    start = lang.BLOCK_START[lang.language_code(tag)]
    for plain, odd in ODD:
        text = F.replace(text, F.lit(plain), F.lit(odd))
    text = F.replace(F.lower(text), F.lit("th"), F.lit(chr(start + 0x28) + chr(start + 0x4D) + JOINER))
    return F.translate(text, "abcdefghijklmnopqrstuvwxyz", "".join(chr(start + p) for p in PLACES))


def normalize_indic(spark, d):
    """Every script's own rules on text that meets them, with the language by row."""
    written = F.array(*[F.struct(F.lit(t).alias("lang"), _in_script(F.col("text"), t).alias("text")) for t in SCRIPTS])
    rows = _read(spark, d, "conversations").select("conv_id", "turn", F.inline(written))
    return rows.select("conv_id", "turn", "lang", nz.normalize_indic(F.col("text"), F.col("lang")).alias("text"))


# Words to others that bring abbreviations, numbers, apostrophes and runs of dots, in turn.
BUSY = (
    (" the ", " Dr. the "), (" in ", " e.g. 1,000.5, "), (" on ", " No. 7 o'clock "), (" is ", " No. is... "), (" of ", " Corp. Of U.S. 'of' "),
    (" at ", " 5's boys' At. "), (" and ", " ($5) \"and\" "),
)


def _busy(text: Column) -> Column:
    for plain, busy in BUSY:
        text = F.replace(text, F.lit(plain), F.lit(busy))
    return text


def tokenize_english_full(spark, d):
    return _read(spark, d, "documents").select("doc_id", tz.tokenize_english(_busy(F.col("text"))).alias("line"))


def detokenize_scripts(spark, d):
    """Turns tokenised and joined again, in English and in three scripts."""
    turns = _read(spark, d, "conversations").select("conv_id", "turn", _busy(F.lower("text")).alias("text"))
    out = turns.select("conv_id", "turn", F.lit(SRC).alias("lang"), tz.detokenize_english(tz.tokenize_english(F.col("text"))).alias("text"))
    for tag in ("hin_Deva", "tel_Telu", "ory_Orya"):
        start = lang.BLOCK_START[lang.language_code(tag)]
        text = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "".join(chr(start + 0x15 + i) for i in range(26)))
        done = tz.detokenize_indic(tz.tokenize_indic(text))
        out = out.unionByName(turns.select("conv_id", "turn", F.lit(tag).alias("lang"), done.alias("text")))
    return out


def preprocess_full(spark, d):
    """English and Kannada turns, from punctuation to the tagged line, with the full tokenisers."""
    turns = _read(spark, d, "conversations").select("conv_id", "turn", "text")
    english = turns.select("conv_id", "turn", F.lit(SRC).alias("src_lang"), F.lit(TGT).alias("tgt_lang"), _busy(F.lower("text")).alias("sub_str"))
    kannada = turns.select("conv_id", "turn", F.lit("kan_Knda").alias("src_lang"), F.lit(SRC).alias("tgt_lang"), _in_script(F.col("text"), "kan_Knda").alias("sub_str"))
    lines = tk.preprocess(english.unionByName(kannada), F.col("src_lang"), F.col("tgt_lang"), full=True)
    return lines.select("conv_id", "turn", "src_lang", "line", _entity_list("entities").alias("entities"))


QUERIES: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (normalize_indic, tokenize_english_full, detokenize_scripts, preprocess_full)}


# --- the same in SQL --------------------------------------------------------------------------


def _sub(x: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {_q(old)}, {_q(new)})"
    return x


def _script_sql(tag: str) -> str:
    start = lang.BLOCK_START[lang.language_code(tag)]
    x = f"lower({_sub('text', *ODD)})"
    x = _sub(x, ("th", chr(start + 0x28) + chr(start + 0x4D) + JOINER))
    return f"translate({x}, 'abcdefghijklmnopqrstuvwxyz', {_q(''.join(chr(start + p) for p in PLACES))})"


_EVERY = (
    *((c, "") for c in "\ufeff\ufffe\u2060\u00ad\u200c\u200d"), ("\u200b", " "), ("\u00a0", " "),
    *((c, '"') for c in "„“”"), ("–", "-"), ("—", " - "), *((c, "'") for c in "´‘‚’"), ("''", '"'), ("…", "..."),
)
# By script: rules before those of every script, then rules after them, in order.
_OWN: dict[str, tuple[tuple, tuple]] = {
    "hin_Deva": ((), (
        ("ॲ", "ए"), ("ऩ", "ऩ"), ("ऱ", "ऱ"), ("ऴ", "ऴ"), ("क़", "क़"),
        ("ख़", "ख़"), ("ग़", "ग़"), ("ज़", "ज़"), ("ड़", "ड़"), ("ढ़", "ढ़"),
        ("फ़", "फ़"), ("य़", "य़"), ("|", "।"),
    )),
    "ben_Beng": ((), (
        ("ড়", "ড়"), ("ঢ়", "ঢ়"), ("য়", "য়"), ("৤", "।"), ("৥", "॥"),
        ("|", "।"), ("৷", "।"), ("ো", "ো"), ("ৌ", "ৌ"),
    )),
    "pan_Guru": ((
    ), (
        ("ਅਾ", "ਆ"), ("ੲਿ", "ਇ"), ("ੲੀ", "ਈ"), ("ੳੁ", "ਉ"), ("ੳੂ", "ਊ"),
        ("ੲੇ", "ਏ"), ("ਅੈ", "ਐ"), ("ੳੋ", "ਓ"), ("ਅੌ", "ਔ"),
        ("ਲ਼", "ਲ਼"), ("ਸ਼", "ਸ਼"), ("ਖ਼", "ਖ਼"), ("ਗ਼", "ਗ਼"), ("ਜ਼", "ਜ਼"),
        ("ਫ਼", "ਫ਼"), ("|", "।"), ("੤", "।"), ("੥", "॥"),
    )),
    "guj_Gujr": ((), (("૤", "।"), ("૥", "॥"))),
    "ory_Orya": ((), (
        ("ଅା", "ଆ"), ("ଏୗ", "ଐ"), ("ଓୗ", "ଔ"), ("ଡ଼", "ଡ଼"), ("ଢ଼", "ଢ଼"),
        ("୤", "।"), ("୥", "॥"), ("|", "।"), ("ଵ", "ବ"), ("ୈ", "ୈ"), ("ୋ", "ୋ"), ("ୌ", "ୌ"),
    )),
    "tam_Taml": ((), (
        ("௤", "।"), ("௥", "॥"), ("ஔ", "ஔ"), ("ொ", "ொ"), ("ோ", "ோ"), ("ௌ", "ௌ"),
    )),
    "tel_Telu": ((), (("౤", "।"), ("౥", "॥"), ("ై", "ై"))),
    "kan_Knda": ((), (
        ("೤", "।"), ("೥", "॥"), ("ೀ", "ೀ"), ("ೇ", "ೇ"), ("ೈ", "ೈ"), ("ೊ", "ೊ"), ("ೋ", "ೋ"),
    )),
    "mal_Mlym": ((
        ("ണ്\u200d", "ൺ"), ("ന്\u200d", "ൻ"), ("ര്\u200d", "ർ"), ("ല്\u200d", "ൽ"),
        ("ള്\u200d", "ൾ"), ("ക്\u200d", "ൿ"),
    ), (
        ("൤", "।"), ("൥", "॥"), ("ൊ", "ൊ"), ("ോ", "ോ"), ("ൌ", "ൌ"), ("ൗ", "ൌ"),
    )),
}


def _normal_sql(x: str, tag: str) -> str:
    before, after = _OWN[tag]
    x = _sub(x, *before, *_EVERY, *after)
    start = lang.BLOCK_START[lang.language_code(tag)]
    block = f"[\\x{{{start:x}}}-\\x{{{start + 2:x}}}\\x{{{start + 4:x}}}-\\x{{{start + 0x7F:x}}}]"
    return f"regexp_replace({x}, '({block}):', '\\1' || chr({start + 3}), 'g')"


_ALPHA, _ALNUM = r"\p{L}\p{M}", r"\p{L}\p{M}\p{N}"
_KEEP = (
    "[" + ", ".join(f"'{c}'" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ") + ", "
    "'Adj', 'Adm', 'Adv', 'Asst', 'Bart', 'Bldg', 'Brig', 'Bros', 'Capt', 'Cmdr', 'Col', 'Comdr', 'Con', 'Corp', 'Cpl', 'DR', 'Dr', 'Drs', 'Ens', "
    "'Gen', 'Gov', 'Hon', 'Hr', 'Hosp', 'Insp', 'Lt', 'MM', 'MR', 'MRS', 'MS', 'Maj', 'Messrs', 'Mlle', 'Mme', 'Mr', 'Mrs', 'Ms', 'Msgr', 'Op', 'Ord', "
    "'Pfc', 'Ph', 'Prof', 'Pvt', 'Rep', 'Reps', 'Res', 'Rev', 'Rt', 'Sen', 'Sens', 'Sfc', 'Sgt', 'Sr', 'St', 'Supt', 'Surg', 'v', 'vs', 'i.e', 'rev', "
    "'e.g', 'Nos', 'Nr', 'Jan', 'Feb', 'Mar', 'Apr', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec']"
)


def _english_sql(source: str, text: str, keys: str, name: str = "english") -> str:
    """CTEs up to ``name`` with the keys and ``line``, the tokens of ``text`` (an expression over ``source``)."""
    x = f"trim(regexp_replace(regexp_replace({text}, '[\\s\\v\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g'), '[\\x00-\\x1f]', '', 'g'))"
    steps = (
        (rf"([^{_ALNUM}\s.''`,\-])", r" \1 "), (r"(\.{2,})", r" \1 "), (r"([^\p{N}]),", r"\1 , "), (r",([^\p{N}])", r" , \1"), (r"(\p{N}),$", r"\1 , "),
        (rf"([^{_ALPHA}])''([^{_ALPHA}])", r"\1 '' \2"), (rf"([^{_ALNUM}])''([{_ALPHA}])", r"\1 '' \2"), (rf"([{_ALPHA}])''([^{_ALPHA}])", r"\1 '' \2"),
        (rf"([{_ALPHA}])''([{_ALPHA}])", r"\1 ''\2"), (r"(\p{N})''(s)", r"\1 ''\2"), (r" {2,}", " "),
    )
    for pattern, new in steps:
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    word = "t[1:-2]"
    ends = "t LIKE '%.' AND length(t) > 1 AND NOT t SIMILAR TO '\\.+'"
    after = "coalesce(toks[i + 1], '')"
    kept = (
        f"(contains({word}, '.') AND regexp_matches({word}, '[{_ALPHA}]')) OR list_contains({_KEEP}, {word}) OR regexp_matches({after}, '^\\p{{Ll}}') "
        f"OR ({word} IN ('No', 'Art', 'pp') AND regexp_matches({after}, '^[0-9]'))"
    )
    return f"""{name}_0 AS (SELECT {keys}, string_split(trim({x}), ' ') AS toks FROM {source}),
{name}_1 AS (SELECT {keys}, array_to_string(list_transform(toks, lambda t, i: CASE WHEN {ends} AND NOT ({kept}) THEN {word} || ' .' ELSE t END), ' ') AS line FROM {name}_0),
{name} AS (SELECT {keys}, trim(regexp_replace(regexp_replace(line, '\\.'' ?$', ' . '' '), ' {{2,}}', ' ', 'g')) AS line FROM {name}_1)"""


def _join_english_sql(x: str) -> str:
    """The state is six characters in front of the text: open ', ", ` (1); whether the next token joins; whether the last
    one ended with s; whether there was none."""
    x = _sub(x, (" @-@ ", "-"), ("&bar;", "|"), ("&#124;", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&bra;", "["), ("&ket;", "]"), ("&quot;", '"'), ("&apos;", "'"), ("&#91;", "["), ("&#93;", "]"), ("&amp;", "&"))
    words = f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"
    at = "CASE t WHEN '''' THEN 1 WHEN '\"' THEN 2 ELSE 3 END"
    is_open = f"substr(acc, {at}, 1) = '1'"
    quote = "t IN ('''', '\"', '`')"
    possessive = f"(t = '''' AND substr(acc, 5, 1) = '1' AND NOT {is_open})"
    side = (
        r"CASE WHEN regexp_matches(t, '^[\p{Sc}(\[{¿¡]+$') THEN 2 WHEN regexp_matches(t, '^[,.?!:;\\%}\])]+$') THEN 1 "
        rf"WHEN substr(acc, 6, 1) = '0' AND regexp_matches(t, '^''[{_ALPHA}]') THEN 1 WHEN {quote} AND ({is_open} OR {possessive}) THEN 1 WHEN {quote} THEN 2 ELSE 0 END"
    )
    flip = f"CASE WHEN {quote} AND NOT {possessive} THEN substr(acc, 1, ({at}) - 1) || CASE WHEN {is_open} THEN '0' ELSE '1' END || substr(acc, ({at}) + 1, 3 - ({at})) ELSE substr(acc, 1, 3) END"
    gap = f"CASE WHEN substr(acc, 6, 1) = '1' OR substr(acc, 4, 1) = '1' OR ({side}) = 1 THEN '' ELSE ' ' END"
    step = f"{flip} || CASE WHEN ({side}) = 2 THEN '1' ELSE '0' END || CASE WHEN t LIKE '%s' THEN '1' ELSE '0' END || '0' || substr(acc, 7) || {gap} || t"
    return f"substr(list_reduce({words}, lambda acc, t: {step}, '000001'), 7)"


def _marks(x: str) -> str:
    marks = "[!-/:-@\\[\\]-`{-~।॥\\x{aaf0}\\x{aaf1}\\x{abeb}-\\x{abef}\\x{1c7e}\\x{1c7f}]"
    x = f"trim(regexp_replace(regexp_replace(replace({x}, chr(9), ' '), '({marks})', ' \\1 ', 'g'), ' {{2,}}', ' ', 'g'))"
    return _close_numbers(x)


def _close_numbers(x: str) -> str:
    for _ in range(2):
        x = f"regexp_replace({x}, '([0-9]) ([,.:/]) ([0-9])', '\\1\\2\\3', 'g')"
    return x


def _join_indic_sql(x: str) -> str:
    x = _close_numbers(x)
    for pattern, new in ((r" ([\-/\\]) ", r"\1"), (r" ([!%)\]},.:;>?}।॥])", r"\1"), (r"([#$(\[{<@]) ", r"\1")):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    for mark in ("''", '"', "`"):
        x = f"regexp_replace(regexp_replace({x}, '{mark} ?([^{mark}]*?) ?{mark}', '{mark}\\1{mark}', 'g'), '^((?:[^{mark}]*{mark}[^{mark}]*{mark})*[^{mark}]*{mark}) ([^{mark}]*)$', '\\1\\2')"
    return x


_BUSY = _sub("text", *BUSY)
_BUSY_LOWER = _sub("lower(text)", *BUSY)


def _letters(tag: str) -> str:
    start = lang.BLOCK_START[lang.language_code(tag)]
    return f"translate(text, 'abcdefghijklmnopqrstuvwxyz', {_q(''.join(chr(start + 0x15 + i) for i in range(26)))})"


ORACLES: dict[str, str] = {
    "normalize_indic": " UNION ALL ".join(f"SELECT conv_id, turn, '{t}' AS lang, {_normal_sql(_script_sql(t), t)} AS text FROM conversations" for t in SCRIPTS),
    "tokenize_english_full": f"WITH {_english_sql('documents', _BUSY, 'doc_id')} SELECT doc_id, line FROM english",
    "detokenize_scripts": f"""
        WITH turns AS (SELECT conv_id, turn, {_BUSY_LOWER} AS text FROM conversations),
        {_english_sql('turns', 'text', 'conv_id, turn')}
        SELECT conv_id, turn, '{SRC}' AS lang, {_join_english_sql('line')} AS text FROM english"""
    + "".join(f" UNION ALL SELECT conv_id, turn, '{t}' AS lang, {_join_indic_sql(_marks(_letters(t)))} AS text FROM turns" for t in ("hin_Deva", "tel_Telu", "ory_Orya")),
    "preprocess_full": f"""
        WITH {_wrap_ctes('conversations', _numerals(_strip(_punct(_BUSY_LOWER))), 'conv_id, turn')},
        hidden AS (SELECT conv_id, turn, es, {_punct(f"trim(t, {WS})")} AS t FROM wrapped),
        {_english_sql('hidden', 't', 'conv_id, turn, es')}
        SELECT conv_id, turn, '{SRC}' AS src_lang, '{SRC} {TGT} ' || trim(line, {WS}) AS line, {ENTITIES} AS entities FROM english
        UNION ALL
        SELECT * FROM (WITH {_wrap_ctes('conversations', _numerals(_strip(_punct(_script_sql('kan_Knda')))), 'conv_id, turn')}
        SELECT conv_id, turn, 'kan_Knda' AS src_lang, 'kan_Knda {SRC} ' ||
          {_strip(_join_virama(_to_script(_marks(_normal_sql(_strip('t'), 'kan_Knda')), 'kn', 'hi')))} AS line, {ENTITIES} AS entities
        FROM wrapped)""",
}
