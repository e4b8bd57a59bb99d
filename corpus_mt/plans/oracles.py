"""The queries of ``queries.py`` stated in DuckDB SQL.

The SQL follows the definitions and not the Spark plans: no look-behind splitting, no
staged row numbers, no Arrow lookups.
"""

from __future__ import annotations

from corpus_mt.functions import languages as lang
from corpus_mt.functions import sentences as st
from corpus_mt.functions import text as tx

SRC, TGT = "eng_Latn", "hin_Deva"
BASE = "/corpus/translated"


def _q(text: str) -> str:
    """A string literal; characters outside printable ASCII are spelled by number."""
    parts, plain = [], ""
    for c in text:
        if " " <= c <= "~":
            plain += c
        else:
            if plain:
                parts.append("'" + plain.replace("'", "''") + "'")
            parts.append(f"chr({ord(c)})")
            plain = ""
    if plain or not parts:
        parts.append("'" + plain.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


WS = _q(tx.WHITE_SPACE)


def _strip(x: str) -> str:
    return f"trim({x}, {WS})"


def _clean(x: str) -> str:
    bare = _strip(f"trim({x}, {_q(tx.EDGE_SYMBOLS)})")
    return _strip(f"regexp_replace({bare}, '^([•○*\\-]|[0-9]+\\.)', '')")


def _distinct(xs: str) -> str:
    """List without repeats, in order of first appearance."""
    return f"list_transform(list_filter(list_zip({xs}, range(1, len({xs}) + 1)), lambda z: list_position({xs}, z[1]) = z[2]), lambda z: z[1])"


# Dots next to a digit are hidden behind chr(2), delimiters marked with chr(1).
_HIDDEN = (
    r"regexp_replace(regexp_replace(lower(text), '(\p{Nd})\.', '\1' || chr(2), 'g'), "
    r"'\.(\p{Nd})', chr(2) || '\1', 'g')"
)
_PIECES = (
    f"list_transform(string_split(regexp_replace({_HIDDEN}, '([.]|[?!।|॥؟۔\\n]\\n*)', '\\1' || chr(1), 'g'), chr(1)), "
    "lambda p: replace(p, chr(2), '.'))"
)
DOC_ID = "CASE WHEN doc_id = 0 THEN sha256('None' || 'None' || lower(text) || 'web') ELSE doc_id::VARCHAR END"

DOCS = f"""
pieces AS (
  SELECT {DOC_ID} AS doc_id, doc_id AS raw_id, lower(text) AS text,
         list_filter(list_transform({_PIECES}, lambda p: {_clean('p')}), lambda s: s <> '') AS cleaned
  FROM documents WHERE text IS NOT NULL AND text <> '' AND text <> 'None'
),
docs AS (
  SELECT doc_id, raw_id, text, {_distinct('cleaned')} AS sub_strs FROM pieces
)"""

SENTENCES = (
    DOCS
    + """,
sentences AS (
  SELECT doc_id, raw_id, (pos - 1)::INTEGER AS pos, sub_str, sha256(sub_str) AS sid
  FROM (SELECT doc_id, raw_id, unnest(sub_strs) AS sub_str, generate_subscripts(sub_strs, 1) AS pos FROM docs)
)"""
)

INDEXED = (
    SENTENCES
    + """,
indexed AS (SELECT *, row_number() OVER (ORDER BY raw_id, pos) - 1 AS tlt_idx FROM sentences)"""
)

# Documents numbered in id order, with the name of their batch of 256.
NUMBERED = """
numbered AS (
  SELECT doc_id AS raw_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx
  FROM documents WHERE text IS NOT NULL AND text <> '' AND text <> 'None'
),
batches AS (
  SELECT row_idx // 256 AS batch, sha256('[' || string_agg(row_idx::VARCHAR, ', ' ORDER BY row_idx) || ']') AS name
  FROM numbered GROUP BY 1
),
folders AS (SELECT raw_id, row_idx, batch, name FROM numbered JOIN batches ON row_idx // 256 = batch)"""

LOCATED = (
    SENTENCES
    + ","
    + NUMBERED
    + f""",
located AS (
  SELECT s.*, '{BASE}/' || name || '/' || doc_id AS tlt_folder, '{BASE}/' || name || '/' || doc_id || '/' || sid AS tlt_file_loc
  FROM sentences s JOIN folders USING (raw_id)
)"""
)

TRANSLATION = "CASE WHEN substr(sid, 1, 1) < 'c' THEN reverse(sub_str) END"

# --- sentence text ----------------------------------------------------------------


def _punct(x: str) -> str:
    for old, new in st.PUNCTUATION:
        x = f"replace({x}, {_q(old)}, {_q(new)})"
    steps = (
        ("'[ ]{2,}'", "' '"),
        (r"'\) ([\.!:?;,])'", r"')\1'"),
        (r"'(\p{Nd}) %'", r"'\1%'"),
        (r"""'"([,\.]+)'""", """'\\1"'"""),
        (r"'(\p{Nd})' || chr(160) || '(\p{Nd})'", r"'\1.\2'"),
    )
    for pattern, new in steps:
        x = f"regexp_replace({x}, {pattern}, {new}, 'g')"
    return _strip(x)


def _numerals(x: str) -> str:
    pairs = [(chr(zero + i), str(i)) for zero, lo, hi in st.DIGIT_BLOCKS for i in range(lo, hi)]
    return f"translate({x}, {_q(''.join(a for a, _ in pairs))}, '{''.join(b for _, b in pairs)}')"


_W = r"\p{L}\p{N}_"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
# No look-behind here: the character before is consumed, and the run is cut after its last word character.
URL = rf"(?:^|[^{_W}/.])((?:(?:https?|ftp)://)?(?:[{_W}-]+\.)+(?:[{_W}/\-?#&=%][{_W}/\-?#&=%.]*)?[{_W}])"
NUMERAL = (
    r"~?\p{Nd}+\.?\p{Nd}*\s?%?\s?-?\s?~?\p{Nd}+\.?\p{Nd}*\s?%|~?\p{Nd}+%"
    r"|\p{Nd}+[-/.,:'']\p{Nd}+[-/.,:''+]\p{Nd}+(?:\.\p{Nd}+)?|\p{Nd}+[-/.:''+]\p{Nd}+(?:\.\p{Nd}+)?"
)
HANDLE = rf"[A-Za-z0-9]*[#|@][{_W}]+"


def _wrap_ctes(source: str, text: str, keys: str) -> str:
    """CTEs ``w0 .. w4, wrapped`` hiding the entities of ``text`` (an expression over ``source``)."""
    found = (
        f"regexp_extract_all(t, '{EMAIL}')",
        f"list_filter(regexp_extract_all(t, '{URL}', 1), lambda m: length(replace(m, '.', '')) >= 4)",
        f"list_filter(regexp_extract_all(t, '{NUMERAL}'), lambda m: length(replace(replace(replace(m, ' ', ''), '.', ''), ':', '')) >= 4)",
        f"regexp_extract_all(t, '{HANDLE}')",
    )
    out = [f"w0 AS (SELECT {keys}, {text} AS t, [] :: VARCHAR[] AS es FROM {source})"]
    for i, spans in enumerate(found, 1):
        out.append(f"f{i} AS (SELECT {keys}, t, es, {spans} AS f FROM w{i - 1})")
        out.append(f"d{i} AS (SELECT {keys}, t, es, {_distinct('f')} AS f FROM f{i})")
        out.append(
            f"w{i} AS (SELECT {keys}, list_reduce(list_transform(f, lambda m, k: (len(es) + k)::VARCHAR || chr(1) || m), "
            "lambda acc, x: replace(acc, split_part(x, chr(1), 2), '<ID' || split_part(x, chr(1), 1) || '>'), t) AS t, "
            f"list_concat(es, f) AS es FROM d{i})"
        )
    tidy = "replace(replace(regexp_replace(t, '[\\s\\v\\x1c-\\x1f\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'), '>/', '>'), ']/', ']')"
    out.append(f"wrapped AS (SELECT {keys}, {tidy} AS t, es FROM w4)")
    return ",\n".join(out)


ENTITIES = "array_to_string(list_transform(es, lambda e, i: i::VARCHAR || '=' || e), chr(10))"


def _restore(text: str) -> str:
    forms = ", ".join(f"[{_q(a)}, {_q(b)}]" for a, b in st.placeholder_forms())
    keyed = (
        "flatten(list_transform(es, lambda e, i: list_transform("
        f"[{forms}], lambda f: f[1] || i::VARCHAR || f[2] || chr(1) || e)))"
    )
    return (
        f"list_reduce({keyed}, lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2)), {text})"
    )


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, ' {{2,}}', ' ', 'g')")


def _tokenize_english(x: str) -> str:
    for pattern, new in (
        (r"([^\p{L}\p{N}\s.''`,\-])", r" \1 "),
        (r"([^\p{N}]),", r"\1 , "),
        (r",([^\p{N}])", r" , \1"),
        (r"([\p{L}])''([\p{L}])", r"\1 ''\2"),
        (r"([^.])\.$", r"\1 ."),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return _collapse(x)


def _tokenize_indic(x: str) -> str:
    x = f"regexp_replace({x}, '(' || {_q('[!-/:-@')} || '\\[-`{{-~' || {_q('।॥')} || '\\x{{aaf0}}\\x{{aaf1}}\\x{{abeb}}-\\x{{abef}}\\x{{1c7e}}\\x{{1c7f}}])', ' \\1 ', 'g')"
    x = f"regexp_replace(replace({x}, chr(9), ' '), ' {{2,}}', ' ', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, '([0-9]) ([,.:/]) ([0-9])', '\\1\\2\\3', 'g')"
    return _strip(x)


def _detokenize_indic(x: str) -> str:
    for pattern, new in (
        (r" ([!%)\],.:;>?}।॥])", r"\1"),
        (r"([#$(\[{<@]) ", r"\1"),
        (r" ?([\-/\\]) ?", r"\1"),
        ('" ([^"]*) "', r'"\1"'),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return _collapse(x)


def _block(code: str) -> str:
    return "".join(chr(lang.BLOCK_START[code] + o) for o in range(0x70) if o not in (0x64, 0x65))


def _to_script(x: str, a: str, b: str) -> str:
    return f"translate({x}, {_q(_block(a))}, {_q(_block(b))})"


def _as_indic(x: str, code: str) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return f"translate(lower({x}), '{letters}', {_q(''.join(chr(lang.BLOCK_START[code] + 0x15 + i) for i in range(26)))})"


def _as_arabic(x: str) -> str:
    arabic = "".join(chr(0x0628 + i) for i in range(19)) + "".join(chr(0x0641 + i) for i in range(7))
    x = f"translate(lower({x}), 'abcdefghijklmnopqrstuvwxyz', {_q(arabic)})"
    for mark, apart in ((".", " ۔"), (",", " ،"), ("?", " ؟"), ("-", "\u066e\u06ea")):
        x = f"replace({x}, '{mark}', {_q(apart)})"
    return x


def _join_virama(x: str) -> str:
    return f"replace({x}, ' ' || chr(2381) || ' ', chr(2381))"


PREPROCESSED = SENTENCES + ",\n" + _wrap_ctes("sentences", _numerals(_punct("sub_str")), "doc_id, raw_id, pos, sid, sub_str")
LINE = f"'{SRC} {TGT} ' || {_tokenize_english(_strip('t'))}"

# --- token arrays -----------------------------------------------------------------

_FIXED = ["<s>", "<pad>", "</s>", "<unk>", *sorted(lang.LANGUAGE_CODES)]
VOCAB = f"""
vocab AS (
  SELECT unnest([{", ".join(f"'{t}'" for t in _FIXED)}]) AS token, unnest(range(0, {len(_FIXED)})) AS vid
  UNION ALL
  SELECT token, row_number() OVER (ORDER BY token) + {len(_FIXED) - 1}
  FROM (SELECT DISTINCT '▁' || w AS token FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM benchmark) WHERE w <> '')
)"""
WORDS = "list_transform(list_filter(string_split({x}, ' '), lambda w: w <> ''), lambda w: '▁' || w)"

TURNS = f"""
turns AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS tlt_idx, '{SRC} {TGT} ' || {_strip('lower(text)')} AS line
  FROM conversations
),
tokens AS (
  SELECT tlt_idx, list_concat(string_split(line, ' ')[1:2], {WORDS.format(x="array_to_string(string_split(line, ' ')[3:], ' ')")}) AS toks
  FROM turns
)"""


def _encoded(source: str, keys: str, toks: str = "toks") -> str:
    """CTE ``encoded``: the keys and ``ids``, in token order."""
    return f""",
flat AS (SELECT {keys}, unnest({toks}) AS token, generate_subscripts({toks}, 1) AS k FROM {source}),
encoded AS (
  SELECT {keys}, list(coalesce(vid, 3) ORDER BY k) AS ids FROM flat LEFT JOIN vocab USING (token) GROUP BY {keys}
)"""


def _padded(width: str, cut: str = "") -> str:
    return (
        "WITH "
        + TURNS
        + ","
        + VOCAB
        + f""",
cut AS (SELECT tlt_idx, toks{cut} AS toks FROM tokens),
wide AS (SELECT tlt_idx, toks, {width} AS width FROM cut)"""
        + _encoded("wide", "tlt_idx, len(toks), width").replace("tlt_idx, len(toks), width", "tlt_idx, n, width").replace(
            "FROM wide)", "FROM (SELECT *, len(toks) AS n FROM wide))"
        )
        + """
SELECT tlt_idx, n::INTEGER AS lengths,
  array_to_string(list_concat(repeat([1], (width - n)::INTEGER), list_concat(ids, [2])), ' ') AS ids,
  array_to_string(list_concat(repeat([0], (width - n)::INTEGER), repeat([1], (n + 1)::INTEGER)), ' ') AS mask
FROM encoded"""
    )


_UNPADDED = "WITH " + TURNS + "," + VOCAB + _encoded("tokens", "tlt_idx")
_REPAD_WIDE = """,
sized AS (SELECT *, len(ids) AS n, max(len(ids)) OVER (PARTITION BY tlt_idx // 64) AS width, count(*) OVER (PARTITION BY tlt_idx // 64) AS n_rows FROM encoded)"""
_REPAD_IDS = "array_to_string(list_concat(repeat([1], (width - n)::INTEGER), ids), ' ') AS ids"

_TOKENIZED = (
    "WITH "
    + PREPROCESSED
    + f""",
lined AS (SELECT doc_id, raw_id, pos, sid, sub_str, es, {LINE} AS line FROM wrapped),
tokened AS (
  SELECT doc_id, raw_id, pos, sid, sub_str, es,
    list_concat(string_split(line, ' ')[1:2], {WORDS.format(x="array_to_string(string_split(line, ' ')[3:], ' ')")}) AS toks
  FROM lined
),"""
    + VOCAB
)
_BINARIZED = (
    _TOKENIZED
    + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY raw_id, pos) - 1 AS tlt_idx FROM tokened)"""
    + _encoded("ranked", "tlt_idx")
    + """,
wide AS (
  SELECT tlt_idx, sid, es, ids, len(ids) AS n, max(len(ids)) OVER (PARTITION BY tlt_idx // 64) AS width
  FROM ranked JOIN encoded USING (tlt_idx)
)
SELECT tlt_idx, sid,
  array_to_string(list_concat(repeat([1], (width - n)::INTEGER), list_concat(ids, [2])), ' ') AS ids,
  array_to_string(list_concat(repeat([0], (width - n)::INTEGER), repeat([1], (n + 1)::INTEGER)), ' ') AS mask,
  """
    + ENTITIES
    + " AS entities FROM wide"
)
# Reverse of the words of a line cut to 255 tokens, tags dropped, end of sentence added.
_MODEL = (
    _TOKENIZED
    + """,
ranked AS (SELECT * REPLACE (toks[1:255] AS toks), row_number() OVER (ORDER BY raw_id, pos) - 1 AS tlt_idx FROM tokened)"""
    + _encoded("ranked", "tlt_idx")
    + """,
model AS (SELECT doc_id, pos, sid, sub_str, es, tlt_idx, list_reverse(ids[3:]) AS out FROM ranked JOIN encoded USING (tlt_idx))"""
)


def _decoded(source: str, keys: str, ids: str) -> str:
    return f""",
out_flat AS (SELECT {keys}, unnest({ids}) AS vid, generate_subscripts({ids}, 1) AS k FROM {source}),
out_text AS (
  SELECT {keys}, {_strip("replace(replace(string_agg(coalesce(token, '<unk>'), '' ORDER BY k), ' ', ''), '▁', ' ')")} AS decoded
  FROM out_flat LEFT JOIN vocab USING (vid) WHERE coalesce(token, '') NOT IN ('<s>', '<pad>', '</s>') GROUP BY {keys}
)"""


# --- translations back ------------------------------------------------------------

_ESCAPED = r"""regexp_replace(k, '([\\.\[\]{}()*+?^$|])', '\\\1', 'g')"""
REPLACED = (
    "WITH "
    + SENTENCES
    + f""",
found AS (
  SELECT doc_id, list(sub_str ORDER BY pos) AS ks, list(reverse(sub_str) ORDER BY pos) AS vs
  FROM sentences WHERE substr(sid, 1, 1) < 'c' GROUP BY doc_id
),
patterns AS (SELECT doc_id, ks, vs, array_to_string(list_transform(ks, lambda k: {_ESCAPED}), '|') AS p FROM found),
cut AS (
  SELECT docs.doc_id, sub_strs, text, ks, vs, p,
    CASE WHEN p IS NOT NULL THEN string_split_regex(text, p) END AS parts,
    CASE WHEN p IS NOT NULL THEN regexp_extract_all(text, p) END AS hits
  FROM docs LEFT JOIN patterns USING (doc_id)
),
replaced AS (
  SELECT doc_id, len(sub_strs) AS n_sentences, coalesce(array_to_string(vs, '|'), 'None') AS substr_tlt,
    CASE WHEN p IS NULL THEN text ELSE
      parts[1] || array_to_string(list_transform(hits, lambda h, i: vs[list_position(ks, h)] || parts[i + 1]), '') END AS translated
  FROM cut
)
"""
)

# --- evaluation -------------------------------------------------------------------

_TAGS = ", ".join(f"'{t}'" for t in lang.EVALUATED_LANGUAGES)
PARALLEL = f"""
langs AS (SELECT unnest([{_TAGS}]) AS lang),
texts AS (
  SELECT item_id AS id, 'gen' AS ds_type, lower(text) AS text FROM benchmark
  UNION ALL
  SELECT item_id, 'conv', lower(text) || ' on 12/10/2023?' FROM benchmark
),
parallel AS (
  SELECT id, ds_type, '{lang.ENGLISH}' AS lang, text AS sentence FROM texts
  UNION ALL
  SELECT id, ds_type, lang, lang || ' ' || reverse(text) FROM texts, langs
),
pairs AS (
  SELECT a.id, a.ds_type, a.lang AS src_lang, b.lang AS tgt_lang, a.sentence AS source, b.sentence AS reference,
    CASE WHEN a.lang = '{lang.ENGLISH}' THEN 'en-indic' WHEN b.lang = '{lang.ENGLISH}' THEN 'indic-en' ELSE 'indic-indic' END AS direction
  FROM parallel a JOIN parallel b ON a.id = b.id AND a.ds_type = b.ds_type AND a.lang <> b.lang
)"""


def _repair_arabic(x: str) -> str:
    for old, new in st.PERSO_ARABIC_FIXES:
        x = f"replace({x}, {_q(old)}, {_q(new)})"
    return x


def _detokenize_english(x: str) -> str:
    for pattern, new in (
        (r" ([,.!?;:%)\]}])", r"\1"),
        (r"([(\[{]) ", r"\1"),
        (r"([\p{L}]) ''([\p{L}])", r"\1''\2"),
        ('" ([^"]*) "', r'"\1"'),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return _collapse(x)


def _evaluated() -> str:
    """The stand-in sentences are in Latin letters, so no script is converted."""
    keys = "id, ds_type, direction, src_lang, tgt_lang"
    line = f"CASE WHEN src_lang = '{lang.ENGLISH}' THEN {_tokenize_english(_strip('t'))} ELSE {_join_virama(_tokenize_indic(_strip('t')))} END"
    return (
        "WITH "
        + PARALLEL
        + ","
        + VOCAB
        + ",\n"
        + _wrap_ctes("pairs", _numerals(_strip(_punct("source"))), keys + ", source, reference")
        + f""",
lined AS (SELECT {keys}, source, reference, es, src_lang || ' ' || tgt_lang || ' ' || trim({line}, {WS}) AS line FROM wrapped),
tokened AS (
  SELECT *, list_concat(string_split(line, ' ')[1:2], {WORDS.format(x="array_to_string(string_split(line, ' ')[3:], ' ')")})[1:255] AS toks
  FROM lined
)"""
        + _encoded("tokened", keys)
        + f",\nmodel AS (SELECT {keys}, list_reverse(ids[3:]) AS out FROM encoded)"
        + _decoded("model", keys, "out")
        + f""",
repaired AS (
  SELECT {keys}, es, source, reference,
    CASE WHEN tgt_lang LIKE '%_Arab' THEN {_repair_arabic("coalesce(decoded, '')")} ELSE coalesce(decoded, '') END AS t
  FROM lined LEFT JOIN out_text USING ({keys})
),
back AS (SELECT {keys}, source, reference, {_restore("t")} AS t FROM repaired),
evaluated AS (
  SELECT {keys}, source, reference,
    CASE WHEN tgt_lang = '{lang.ENGLISH}' THEN {_detokenize_english("t")} ELSE {_detokenize_indic("t")} END AS prediction
  FROM back
)
"""
    )


_WORSE = "replace(replace(lower(text), ' the ', ' a '), 'er', 're')"
SCORED = f"WITH scored AS (SELECT conv_id, turn, role, lower(text) AS ref, {_WORSE} AS pred FROM conversations)"


def _gram_counts(order: int, items: str, sep: str, scored: str = SCORED, row: str = "conv_id, turn", group: str = "role", name: str = "") -> str:
    """Items placed one per row; an n-gram is a row joined to the n - 1 rows after it."""
    keys = f"{row}, {group}, is_pred"
    later = [f"lead(c, {k}) OVER w" for k in range(order)]
    grams = [f" || '{sep}' || ".join(later[: n + 1]) + f" AS g{n + 1}" for n in range(order)]
    each = " UNION ALL ".join(f"SELECT {keys}, {n} AS n, g{n} AS gram FROM grams{name} WHERE g{n} IS NOT NULL" for n in range(1, order + 1))
    return f"""{scored},
sides{name} AS (
  SELECT {row}, {group}, 0 AS is_pred, {items.format(x="ref")} AS xs FROM scored
  UNION ALL SELECT {row}, {group}, 1, {items.format(x="pred")} FROM scored
),
placed{name} AS (SELECT {keys}, unnest(xs) AS c, generate_subscripts(xs, 1) AS i FROM sides{name}),
grams{name} AS (SELECT {keys}, {", ".join(grams)} FROM placed{name} WINDOW w AS (PARTITION BY {keys} ORDER BY i)),
listed{name} AS ({each}),
counts{name} AS (
  SELECT {row}, {group}, n, gram, sum(is_pred) AS in_pred, sum(1 - is_pred) AS in_ref FROM listed{name} GROUP BY ALL
),
stats{name} AS (
  SELECT {group}, n, sum(least(in_pred, in_ref)) AS m, sum(in_pred) AS tp, sum(in_ref) AS tr FROM counts{name} GROUP BY {group}, n
)
"""


_BLEU = """round(CASE WHEN count(*) < 4 OR min(m) = 0 THEN 0.0 ELSE
          100 * CASE WHEN sum(tp) FILTER (n = 1) >= sum(tr) FILTER (n = 1) THEN 1.0
            ELSE exp(1 - (sum(tr) FILTER (n = 1)) / (sum(tp) FILTER (n = 1))) END * exp(sum(ln(m / tp)) / 4) END, 6) AS bleu"""
_CHRF = "round(CASE WHEN p + r > 0 THEN 100 * 5 * p * r / (4 * p + r) ELSE 0.0 END, 6) AS chrf"
_SPLIT_WORDS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"
_SPLIT_CHARS = "list_filter(string_split(regexp_replace({x}, '\\s+', '', 'g'), ''), lambda c: c <> '')"

ORACLES: dict[str, str] = {
    "split_slice": """
        SELECT doc_id, lang, n_chars FROM (
          SELECT doc_id, lang, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
        WHERE i >= floor(n * 0.10) AND i < floor(n * 0.35)""",
    "sample_head": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100",
    "terminal_line_filter": """
        SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)),
          lambda l: regexp_matches(l, '[.!?:,;)"'']$') AND NOT ends_with(l, '...')), chr(10)) AS text FROM documents""",
    "doc_ids": """
        WITH p AS (
          SELECT *, epoch_ms(page_id * 86400000) AS seen, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS netloc
          FROM pages WHERE html IS NOT NULL AND html NOT IN ('', 'None'))
        SELECT page_id, sha256(url || strftime(seen, '%Y-%m-%d %H:%M:%S') || lower(html) || 'crawl') AS doc_id,
          replace(regexp_replace(trim(netloc, 'w.'), '\\.[^.]*$', ''), '.', '_') AS source, url,
          strftime(seen, '%m/%d/%Y, %H:%M:%S') AS timestamp FROM p""",
    "url_source": """
        WITH p AS (SELECT page_id, url, trim(regexp_extract(
          CASE WHEN starts_with(url, 'http') THEN url ELSE 'http://' || url END, '^[^:]+://([^/?#]*)', 1), 'w.') AS host FROM pages)
        SELECT page_id, url, host, CASE WHEN url IS NULL OR url = '' THEN NULL WHEN NOT contains(host, '.') THEN url
          ELSE regexp_replace(regexp_replace(host, '\\.[^.]*$', ''), '[./\\\\]', '_', 'g') END AS source FROM p""",
    "timestamp_text": """
        SELECT event_id, coalesce(strftime(ts, '%m/%d/%Y, %H:%M:%S'), 'None') AS shown,
          coalesce(CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END, 'None') AS hashed FROM events""",
    "chunk_template": f"""
        WITH c AS (SELECT conv_id::VARCHAR || '-' || turn::VARCHAR AS doc_id, list_transform(
          list_filter(string_split(lower(text), chr(10)), lambda l: l <> ''), lambda l: {_clean('l')}) AS xs
          FROM conversations WHERE text IS NOT NULL AND text NOT IN ('', 'None')),
        u AS (SELECT doc_id, {_distinct('xs')} AS xs FROM c)
        SELECT doc_id, (generate_subscripts(xs, 1) - 1)::INTEGER AS pos, unnest(xs) AS sub_str FROM u""",
    "sentence_template": f"WITH {SENTENCES} SELECT doc_id, pos, sub_str FROM sentences",
    "sentence_ids": f"WITH {SENTENCES} SELECT doc_id, pos, sid FROM sentences",
    "sentence_rows": f"WITH {LOCATED} SELECT doc_id, pos, sid, sub_str, tlt_file_loc FROM located",
    "stream_sentences": f"WITH {SENTENCES} SELECT doc_id, pos, sid, sub_str FROM sentences",
    "json_roundtrip": f"""
        WITH {DOCS} SELECT doc_id, to_json(sub_strs)::VARCHAR AS sub_json,
          to_json(list_transform(sub_strs, lambda s: sha256(s)))::VARCHAR AS sid_json,
          len(sub_strs)::INTEGER AS n, array_to_string(sub_strs, '|') AS joined FROM docs""",
    "global_index": f"WITH {INDEXED} SELECT doc_id, pos, sid, tlt_idx FROM indexed",
    "tlt_folder": f"""
        WITH {NUMBERED} SELECT {DOC_ID} AS doc_id, row_idx, '{BASE}/' || name || '/' || {DOC_ID} AS tlt_folder
        FROM folders JOIN documents ON raw_id = documents.doc_id""",
    "tlt_folder_filtered": f"""
        WITH {NUMBERED} SELECT {DOC_ID} AS doc_id, row_idx, '{BASE}/' || name || '/' || {DOC_ID} AS tlt_folder,
          '{BASE}/rows/batch=' || name || '/document=' || {DOC_ID} AS csv_path
        FROM folders JOIN documents ON raw_id = documents.doc_id""",
    "doc_csv_rows": f"""WITH {LOCATED}
        SELECT doc_id, '{BASE}/rows/batch=' || name || '/document=' || doc_id AS csv_path, sid, sub_str AS substr
        FROM sentences JOIN folders USING (raw_id)""",
    "batch_csv_positions": f"""
        WITH {DOCS}, {NUMBERED},
        sized AS (SELECT doc_id, batch, row_idx, name, len(sub_strs) AS n FROM docs JOIN folders USING (raw_id))
        SELECT doc_id, '{BASE}/rows/batch=' || name AS csv_path,
          (1 + coalesce(sum(n) OVER (PARTITION BY batch ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start_pos,
          (1 + sum(n) OVER (PARTITION BY batch ORDER BY row_idx))::BIGINT AS end_pos FROM sized""",
    "written_status": f"WITH {LOCATED} SELECT doc_id, pos, tlt_file_loc, substr(sid, 1, 1) < 'c' AS written FROM located",
    "reroot_path": f"WITH {LOCATED} SELECT doc_id, pos, '/moved/root/' || doc_id || '/' || sid AS path FROM located",
    "partition_plan": """
        SELECT lang, count(*) AS n_rows, ceil(count(*) / 2056.0)::BIGINT AS n_partitions FROM documents GROUP BY lang""",
    "shard_plan": f"WITH {SENTENCES} SELECT count(*) AS n_rows, ceil(count(*) / 10000.0)::BIGINT AS n_shards FROM sentences",
    "salt_balance": "SELECT count(*) AS n_rows, ceil(count(*) / 128.0)::BIGINT AS n_partitions, true AS is_even FROM documents",
    "rank_assign": f"""
        WITH {INDEXED}, t AS (SELECT tlt_idx, sid, count(*) OVER () AS n FROM indexed),
        s AS (SELECT *, n // 8 AS size, n % 8 AS extra FROM t)
        SELECT tlt_idx, sid, (CASE WHEN tlt_idx < extra * (size + 1) THEN tlt_idx // (size + 1)
          ELSE extra + (tlt_idx - extra * (size + 1)) // size END)::INTEGER AS rank FROM s""",
    "shard_round_robin": """
        WITH p AS (SELECT DISTINCT '/corpus/shards/' || ((row_number() OVER (ORDER BY doc_id) - 1) // 16)::VARCHAR AS path FROM documents),
        r AS (SELECT path, row_number() OVER (ORDER BY path) - 1 AS shard_idx FROM p)
        SELECT path, shard_idx, [3, 1, 4][shard_idx % 3 + 1]::INTEGER AS device FROM r""",
    "punct_norm": "SELECT doc_id, "
    + _punct("replace(replace(text, ', ', " + _q(",\u00a0") + "), '. ', " + _q("\u00a0»\u00a0; («\u00a0") + ")")
    + " AS text FROM documents",
    "numeral_norm": f"SELECT doc_id, {_numerals('translate(text, ' + chr(39) + '0123456789' + chr(39) + ', ' + _q('०১૨೩۴୫੬᱗౮꯹') + ')')} AS text FROM documents",
    "entity_spans": f"""
        SELECT doc_id, array_to_string(regexp_extract_all(text, '{EMAIL}'), chr(10)) AS emails,
          array_to_string(regexp_extract_all(text, '{URL}', 1), chr(10)) AS urls,
          array_to_string(regexp_extract_all(text, '{NUMERAL}'), chr(10)) AS numerals,
          array_to_string(regexp_extract_all(text, '{HANDLE}'), chr(10)) AS handles FROM documents""",
    "entity_wrap": f"WITH {_wrap_ctes('documents', _numerals(_strip('text')), 'doc_id')} SELECT doc_id, t AS text, {ENTITIES} AS entities FROM wrapped",
    "entity_restore": f"WITH {_wrap_ctes('documents', _numerals(_strip('text')), 'doc_id')} SELECT doc_id, {_restore('t')} AS text FROM wrapped",
    "script_convert": f"""
        WITH x AS (SELECT doc_id, {_join_virama(_to_script(_as_indic('text', 'bn'), 'bn', 'hi'))} AS deva FROM documents)
        SELECT doc_id, deva, {_to_script('deva', 'hi', 'te')} AS telu FROM x""",
    "lang_tags": f"SELECT conv_id, turn, '{SRC} {TGT} ' || {_strip('text')} AS line FROM conversations",
    "preprocess": f"WITH {PREPROCESSED} SELECT doc_id, pos, {LINE} AS line, {ENTITIES} AS entities FROM wrapped",
    "preprocess_indic": f"""
        WITH {_wrap_ctes('conversations', _numerals(_strip(_punct(_as_indic('text', 'kn')))), 'conv_id, turn')}
        SELECT conv_id, turn, 'kan_Knda {SRC} ' ||
          {_strip(_join_virama(_to_script(_tokenize_indic(_strip('t')), 'kn', 'hi')))} AS line, {ENTITIES} AS entities
        FROM wrapped""",
    "entity_maps": f"""
        WITH {_wrap_ctes('conversations', _numerals(_strip(_punct('lower(text)'))), 'conv_id, turn')},
        forms AS (SELECT unnest([{", ".join(f"struct_pack(a := {_q(a)}, b := {_q(b)})" for a, b in st.placeholder_forms())}]) AS f),
        found AS (SELECT conv_id, turn, unnest(es) AS entity, generate_subscripts(es, 1) AS serial FROM wrapped)
        SELECT conv_id, turn, f.a || serial::VARCHAR || f.b AS holder, entity FROM found, forms""",
    "postprocess_scripts": f"""
        WITH arabic AS (SELECT conv_id, turn, 'urd_Arab' AS tgt_lang, {_detokenize_indic(_repair_arabic(_as_arabic('text')))} AS translated FROM conversations),
        odia AS (SELECT conv_id, turn, 'ory_Orya' AS tgt_lang,
          {_detokenize_indic(_to_script(f"replace(replace({_as_indic('text', 'hi')}, '.', {_q(st.ODIA_FIX[0] + ' .')}), {_q(st.ODIA_FIX[0])}, {_q(st.ODIA_FIX[1])})", 'hi', 'or'))} AS translated FROM conversations),
        telugu AS (SELECT conv_id, turn, 'tel_Telu' AS tgt_lang,
          {_detokenize_indic(_to_script(f"replace({_as_indic('text', 'hi')}, '.', {_q(' ।')})", 'hi', 'te'))} AS translated FROM conversations),
        english AS (SELECT conv_id, turn, '{lang.ENGLISH}' AS tgt_lang, {_detokenize_english("replace(replace(text, '.', ' .'), ',', ' ,')")} AS translated FROM conversations)
        SELECT * FROM arabic UNION ALL SELECT * FROM odia UNION ALL SELECT * FROM telugu UNION ALL SELECT * FROM english""",
    "replace_string": "SELECT conv_id, turn, replace(text, 'the', upper(role)) AS text FROM conversations",
    "postprocess": f"""
        WITH {PREPROCESSED}, toked AS (SELECT doc_id, pos, es, {_tokenize_english(_strip('t'))} AS t FROM wrapped),
        back AS (SELECT doc_id, pos, {_restore('t')} AS t FROM toked)
        SELECT doc_id, pos, {_detokenize_indic('t')} AS translated FROM back""",
    "encode_ids": f"WITH {SENTENCES}, {VOCAB}, tokened AS (SELECT doc_id, pos, {WORDS.format(x='sub_str')} AS toks FROM sentences)"
    + _encoded("tokened", "doc_id, pos")
    + " SELECT doc_id, pos, array_to_string(ids, ' ') AS ids FROM encoded",
    "pad_longest": _padded("max(len(toks)) OVER (PARTITION BY tlt_idx // 64)"),
    "pad_max_length": _padded("255", "[1:255]"),
    "repad_batches": _UNPADDED
    + _REPAD_WIDE
    + f" SELECT tlt_idx, {_REPAD_IDS}, array_to_string(list_concat(repeat([0], (width - n)::INTEGER), repeat([1], n::INTEGER)), ' ') AS mask FROM sized",
    "drop_last": _UNPADDED + _REPAD_WIDE + f" SELECT tlt_idx, {_REPAD_IDS} FROM sized WHERE n_rows = 64",
    "decode_text": _UNPADDED
    + ", bare AS (SELECT tlt_idx, ids[3:] AS ids FROM encoded)"
    + _decoded("bare", "tlt_idx", "ids")
    + " SELECT tlt_idx, coalesce(decoded, '') AS decoded FROM encoded LEFT JOIN out_text USING (tlt_idx)",
    "binarize": _BINARIZED,
    "model_output": _MODEL
    + ","
    + NUMBERED
    + f""" SELECT m.doc_id, sid, sub_str, tlt_idx, '{BASE}/' || name || '/' || m.doc_id || '/' || sid AS tlt_file_loc,
          array_to_string(list_concat(out, [2]), ' ') AS translated_ids, (100 * len(es))::INTEGER AS n_placeholders
        FROM model m JOIN docs USING (doc_id) JOIN folders USING (raw_id)""",
    "decode": _MODEL
    + _decoded("model", "doc_id, pos, es", "out")
    + f""", back AS (SELECT doc_id, pos, {_restore('decoded')} AS t FROM out_text)
        SELECT m.doc_id, m.pos, {_detokenize_indic("coalesce(t, '')")} AS translated FROM model m LEFT JOIN back USING (doc_id, pos)""",
    "translate_distinct": f"WITH {SENTENCES} SELECT doc_id, pos, sid, {TRANSLATION} AS translated FROM sentences",
    "translation_lookup": f"WITH {SENTENCES} SELECT doc_id, pos, sid, sub_str, reverse(sub_str) AS translated FROM sentences WHERE substr(sid, 1, 1) < 'c'",
    "translation_lookup_copies": f"""
        WITH pieces AS (
          SELECT sha256('None' || 'None' || lower(text) || 'web') AS doc_id,
            list_filter(list_transform({_PIECES}, lambda p: {_clean('p')}), lambda s: s <> '') AS cleaned
          FROM documents WHERE text IS NOT NULL AND text <> '' AND text <> 'None'
        ),
        docs AS (SELECT doc_id, {_distinct('cleaned')} AS sub_strs FROM pieces),
        sentences AS (SELECT doc_id, (generate_subscripts(sub_strs, 1) - 1)::INTEGER AS pos, unnest(sub_strs) AS sub_str FROM docs)
        SELECT doc_id, pos, sha256(sub_str) AS sid, sub_str, reverse(sub_str) AS translated, count(*) AS n_copies
        FROM sentences WHERE substr(sha256(sub_str), 1, 1) < 'c' GROUP BY ALL""",
    "replace_documents": REPLACED + "SELECT doc_id, translated FROM replaced",
    "substr_tlt": REPLACED + "SELECT doc_id, substr_tlt FROM replaced",
    "round_trip": REPLACED + "SELECT doc_id, n_sentences::INTEGER AS n_sentences, translated FROM replaced",
    "language_pairs": f"""
        WITH {PARALLEL} SELECT ds_type, direction, src_lang, tgt_lang, count(*) AS n_rows, sum(length(source))::BIGINT AS source_chars
        FROM pairs GROUP BY ALL""",
    "evaluation_run": _evaluated() + "SELECT id, ds_type, direction, src_lang, tgt_lang, source, reference, prediction FROM evaluated",
    "pred_ref_pairs": _evaluated()
    + """SELECT ds_type, src_lang || '__' || tgt_lang AS pair, row_number() OVER (ORDER BY ds_type, src_lang, tgt_lang, id) - 1 AS line,
          replace(replace(replace(prediction, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r') AS prediction,
          replace(replace(replace(reference, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r') AS reference FROM evaluated""",
    "pair_parse": f"""
        WITH {PARALLEL}
        SELECT id, '/out/' || ds_type || '/' || src_lang || '__' || tgt_lang AS path, src_lang AS src, tgt_lang AS tgt, ds_type FROM pairs""",
    "corpus_bleu": _gram_counts(4, _SPLIT_WORDS, " ") + f"SELECT role, {_BLEU} FROM stats GROUP BY role",
    "corpus_chrf": _gram_counts(6, _SPLIT_CHARS, "")
    + f""", pr AS (SELECT role, avg(m / tp) AS p, avg(m / tr) AS r FROM stats WHERE tp > 0 AND tr > 0 GROUP BY role)
        SELECT role, {_CHRF} FROM pr""",
}
_PAIR = "ds_type, direction, src_lang, tgt_lang"
_PAIR_SCORED = _evaluated() + f", scored AS (SELECT id, {_PAIR}, reference AS ref, prediction AS pred FROM evaluated)"
ORACLES["pair_scores"] = (
    _gram_counts(4, _SPLIT_WORDS, " ", _PAIR_SCORED, "id", _PAIR, "_w")
    + _gram_counts(6, _SPLIT_CHARS, "", "", "id", _PAIR, "_c")
    + f""", b AS (SELECT {_PAIR}, {_BLEU} FROM stats_w GROUP BY {_PAIR}),
    pr AS (SELECT {_PAIR}, avg(m / tp) AS p, avg(m / tr) AS r FROM stats_c WHERE tp > 0 AND tr > 0 GROUP BY {_PAIR})
    SELECT {_PAIR}, bleu, {_CHRF} FROM b JOIN pr USING ({_PAIR})"""
)
ORACLES["encode_ids_joined"] = ORACLES["encode_ids"]
