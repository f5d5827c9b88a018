"""DuckDB oracle SQL for the registered queries.

Written from the pinned definitions in DuckDB's own dialect (RE2 patterns,
``lambda x:`` list functions), independently of the Spark expressions. Every
computed column is aliased to the name the Spark query uses, and integer
results are cast to BIGINT on both sides.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

# Tokenizer fragments (RE2).
LETTER = r"'\p{L}+'"


def letter_lower(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), {LETTER})"


SQL["term_stats"] = f"""
WITH e AS (SELECT doc_id, lang, unnest({letter_lower()}) AS token FROM documents)
SELECT lang, token, CAST(count(*) AS BIGINT) AS tf, CAST(count(DISTINCT doc_id) AS BIGINT) AS df FROM e GROUP BY lang, token
"""
SQL["top_terms"] = f"""
WITH e AS (SELECT doc_id, lang, unnest({letter_lower()}) AS token FROM documents),
c AS (SELECT lang, token, count(*) AS tf, count(DISTINCT doc_id) AS df FROM e GROUP BY lang, token),
r AS (SELECT lang, token, tf, df,
             row_number() OVER (PARTITION BY lang ORDER BY df DESC, tf DESC, token) AS rank FROM c)
SELECT lang, token, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df, CAST(rank AS BIGINT) AS rank
FROM r WHERE rank <= 20
"""


# ---------------------------------------------------------------------------
# Text oracles. Fragments take and return DuckDB list expressions.
# ---------------------------------------------------------------------------


def lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


_W = r"(?:[\p{L}\p{M}]+(?:[.'’:][\p{L}\p{M}]+)*|\p{Nd}+(?:[.,;']\p{Nd}+)*|_)+"
STD_RE = r"\p{Han}|" + _W
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
URL_RE = r"(?:https?|ftp)://[^\s<>\"']*[^\s<>\"'.,;:!?)\]]"
CLASSIC_RE = "|".join([EMAIL_RE, r"\p{L}(?:\.\p{L})+\.?", r"[\p{L}\p{Nd}]+(?:\.[\p{L}\p{Nd}]+)+",
                       r"\p{L}+(?:'\p{L}+)+", r"\p{L}+[&@]\p{L}+", r"[\p{L}\p{Nd}]+"])


def d_split_long(l: str) -> str:
    return (f"flatten(list_transform({l}, lambda t: CASE WHEN length(t) <= 255 THEN [t] ELSE "
            f"list_transform(range(0, (length(t) - 1) // 255 + 1), "
            f"lambda i: substring(t, i * 255 + 1, 255)) END))")


def d_extract(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {lit(pattern)})"


def d_standard(text="text"):
    return d_split_long(d_extract(text, STD_RE))


def d_map(l: str, body: str) -> str:
    """list_transform with the element named x."""
    return f"list_transform({l}, lambda x: {body})"


def d_lower(l):
    return d_map(l, "lower(x)")


def d_std_lower(text="text"):
    return d_lower(d_standard(text))


_META = set("\\^$.|?*+()[]{}")


def d_fold_expr(x: str, steps) -> str:
    for kind, a, b in steps:
        if kind == "map":
            x = f"translate({x}, {lit(a)}, {lit(b)})"
        elif not (_META & set(a)) and "$" not in b:
            x = f"replace({x}, {lit(a)}, {lit(b)})"
        else:
            b = b.replace("$1", "\\1")
            x = f"regexp_replace({x}, {lit(a)}, {lit(b)}, 'g')"
    return x


# Profiles whose every source character is outside ASCII: an ASCII token is unchanged.
_NON_ASCII_ONLY = {"asciifolding", "cjk_width", "decimal_digit", "arabic_normalization",
                   "persian_normalization", "serbian_normalization"}


def d_fold(l, profile_name):
    from .functions import fold
    body = d_fold_expr("x", fold.profile(profile_name))
    if profile_name in _NON_ASCII_ONLY:
        body = f"CASE WHEN regexp_matches(x, '[^\\x00-\\x7F]') THEN {body} ELSE x END"
    return d_map(l, body)


def d_stop(l, words):
    return f"list_filter({l}, lambda x: NOT list_contains({lst(words)}, x))"


def d_english_stop(l):
    from .functions.stopwords import ENGLISH_STOP_33
    return d_stop(l, ENGLISH_STOP_33)


def counts_sql(tokens: str, where: str = "", text: str | None = None) -> str:
    w = f"WHERE {where}" if where else ""
    docs = f"(SELECT doc_id, lang, {text} AS text FROM documents)" if text else "documents"
    return (f"SELECT lang, token, CAST(count(*) AS BIGINT) AS n FROM "
            f"(SELECT lang, unnest({tokens}) AS token FROM {docs} {w}) GROUP BY lang, token")


def d_placed(text: str = "text", token: str = "lower(w)", pattern: str = STD_RE) -> str:
    """CTEs ending in p(doc_id, lang, pos, token, st, en): standard tokens with their offsets, from the pieces between them."""
    return (f"t AS (SELECT doc_id, lang, regexp_extract_all({text}, {lit(pattern)}) AS w, string_split_regex({text}, {lit(pattern)}) AS g FROM documents), "
            "u AS (SELECT doc_id, lang, unnest(w) AS w, unnest(g[1:len(w)]) AS g, unnest(range(0, len(w))) AS pos FROM t), "
            f"p AS (SELECT doc_id, lang, CAST(pos AS BIGINT) AS pos, {token} AS token, CAST(sum(length(g) + length(w)) OVER d - length(w) AS BIGINT) AS st, "
            "CAST(sum(length(g) + length(w)) OVER d AS BIGINT) AS en FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY pos))")


def _cjk_sql(text: str, token: str, stops: str) -> str:
    """Counts of the pairs of touching CJK characters and of the other tokens."""
    cjk = lit(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]")
    # letters beside the Han ones are Latin here; RE2 cannot take one class out of another
    return (f"WITH {d_placed(text, token, STD_RE.replace('{L}', '{Latin}'))}, n AS (SELECT lang, token, regexp_full_match(token, {cjk}) AS c, "
            f"lead(token) OVER o AS nt, lead(st) OVER o = en AND regexp_full_match(lead(token) OVER o, {cjk}) AS right_, "
            f"lag(en) OVER o = st AND regexp_full_match(lag(token) OVER o, {cjk}) AS left_ FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)), "
            "e AS (SELECT lang, CASE WHEN c AND right_ THEN token || nt WHEN c AND left_ THEN NULL ELSE token END AS token FROM n) "
            f"SELECT lang, token, CAST(count(*) AS BIGINT) AS n FROM e WHERE token IS NOT NULL {stops} GROUP BY lang, token")


_T = "text"
TOKEN_EXPR = {
    "tok_standard": d_standard(),
    "tok_letter": d_extract(_T, r"\p{L}+"),
    "tok_lowercase": d_extract("lower(text)", r"\p{L}+"),
    "tok_whitespace": d_split_long(d_extract(_T, r"\S+")),
    "tok_url_email": d_split_long(d_extract(_T, f"{URL_RE}|{EMAIL_RE}|{STD_RE}")),
    "tok_classic": d_split_long(d_extract(_T, CLASSIC_RE)),
    "tok_edge_ngram": ("CASE WHEN text IS NULL THEN NULL WHEN length(text) >= 2 THEN "
                       "[substring(text, 1, 1), substring(text, 1, 2)] WHEN length(text) = 1 "
                       "THEN [text] ELSE [] END"),
    "an_standard": d_std_lower(),
    "an_simple": d_lower(d_extract(_T, r"\p{L}+")),
    "an_whitespace": d_split_long(d_extract(_T, r"\S+")),
    "an_pattern": r"list_filter(string_split_regex(lower(text), '\W+'), lambda x: length(x) > 0)",
    "f_lowercase": d_std_lower(),
    "f_uppercase": d_map(d_standard(), "upper(x)"),
    "f_edge_ngram": (f"flatten({d_map(d_std_lower(), 'CASE WHEN length(x) >= 2 THEN [substring(x, 1, 1), substring(x, 1, 2)] WHEN length(x) = 1 THEN [x] ELSE [] END')})"),
    "f_ngram": (f"flatten({d_map(d_std_lower(), 'flatten(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN i < length(x) THEN [substring(x, i, 1), substring(x, i, 2)] ELSE [substring(x, i, 1)] END))')})"),
    "f_reverse": d_map(d_std_lower(), "reverse(x)"),
    "f_truncate": d_map(d_std_lower(), "substring(x, 1, 10)"),
    "f_classic": d_map(d_split_long(d_extract(_T, CLASSIC_RE)),
                       r"CASE WHEN regexp_full_match(regexp_replace(x, '[''’][sS]$', ''), '\p{L}(\.\p{L})+\.?') "
                       r"THEN replace(regexp_replace(x, '[''’][sS]$', ''), '.', '') "
                       r"ELSE regexp_replace(x, '[''’][sS]$', '') END"),
    "f_word_delimiter": (f"flatten({d_map(d_split_long(d_extract(_T, r'\S+')), chr(10).join([r'''list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '[''’][sS]$', ''), '(\p{Ll})(\p{Lu})', '\1 \2', 'g'), '(\p{L})(\p{Nd})', '\1 \2', 'g'), '(\p{Nd})(\p{L})', '\1 \2', 'g'), '[^\p{L}\p{Nd}]+'), lambda p: length(p) > 0)''']))})"),
    "f_trim": d_map("string_split_regex(text, '[.!?]')",
                    r"regexp_replace(x, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')"),
}
TOKEN_EXPR["f_elision"] = d_map(d_std_lower(), "regexp_replace(x, " + lit(
    "(?i)^(?:quoiqu|lorsqu|puisqu|jusqu|qu|l|m|t|n|s|j|d|c)['’]") + ", '')")
for _n, _p in [("f_asciifolding", "asciifolding"), ("f_cjk_width", "cjk_width"),
               ("f_decimal_digit", "decimal_digit"), ("f_scand_norm", "scandinavian_normalization"),
               ("f_scand_fold", "scandinavian_folding"), ("f_arabic", "arabic_normalization"),
               ("f_persian", "persian_normalization"), ("f_serbian", "serbian_normalization"),
               ("f_german", "german_normalization")]:
    TOKEN_EXPR[_n] = d_fold(d_std_lower(), _p)

LANG_WHERE: dict[str, str] = {}


def _lazy_text_sql():
    from .functions.stopwords import ENGLISH_STOP_33
    TOKEN_EXPR["an_stop"] = d_stop(d_lower(d_extract(_T, r"\p{L}+")), ENGLISH_STOP_33)
    TOKEN_EXPR["f_stop"] = d_stop(d_std_lower(), ENGLISH_STOP_33)
    from .catalog import SUBSTITUTED
    from .functions import fold
    for name, expr in TOKEN_EXPR.items():
        SQL.setdefault(name, counts_sql(expr, LANG_WHERE.get(name, ""), SUBSTITUTED.get(name)))
    SQL["f_cjk_bigram"] = _cjk_sql(SUBSTITUTED["f_cjk_bigram"], "lower(w)", "")
    SQL["an_cjk"] = _cjk_sql(SUBSTITUTED["an_cjk"], f"lower({d_fold_expr('w', fold.profile('cjk_width'))})",
                             f"AND token NOT IN ({', '.join(map(lit, ENGLISH_STOP_33))})")
    SQL["token_table"] = (f"WITH {d_placed()} SELECT doc_id, pos, token, st AS start, en AS \"end\", CASE WHEN regexp_full_match(token, {lit(chr(92) + 'p{Han}')}) "
                          f"THEN '<IDEOGRAPHIC>' WHEN regexp_matches(token, {lit('^' + chr(92) + 'p{Nd}')}) THEN '<NUM>' ELSE '<ALPHANUM>' END AS type FROM p")
    SQL["shingle_gaps"] = (f"WITH {d_placed()}, k AS (SELECT doc_id, pos, token, st, en, lead(token) OVER o AS nt, lead(pos) OVER o AS np, lead(st) OVER o AS ns, "
                           f"lead(en) OVER o AS ne FROM p WHERE token NOT IN ({', '.join(map(lit, ENGLISH_STOP_33))}) WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) "
                           "SELECT doc_id, pos, token || ' ' || nt AS token, st AS start, ne AS \"end\" FROM k WHERE np = pos + 1 "
                           "UNION ALL SELECT doc_id, pos, token || ' _', st, en FROM k WHERE np > pos + 1 "
                           "UNION ALL SELECT doc_id, np - 1, '_ ' || nt, ns, ne FROM k WHERE np > pos + 1")
    # n-grams of the whole text: character list, each char with its successor.
    SQL["tok_ngram"] = (
        "WITH c AS (SELECT lang, regexp_extract_all(text, '(?s).') AS ch FROM documents) "
        "SELECT lang, token, CAST(count(*) AS BIGINT) AS n FROM ("
        " SELECT lang, unnest(flatten(list_transform(ch, lambda x, i: CASE WHEN i < len(ch) "
        "THEN [x, x || ch[i + 1]] ELSE [x] END))) AS token FROM c) GROUP BY lang, token")
    SQL["f_shingle"] = (
        f"WITH t AS (SELECT lang, {d_std_lower()} AS a FROM documents) "
        "SELECT lang, token, CAST(count(*) AS BIGINT) AS n FROM ("
        " SELECT lang, unnest(flatten(list_transform(a, lambda x, i: CASE WHEN i < len(a) "
        "THEN [x, x || ' ' || a[i + 1]] ELSE [x] END))) AS token FROM t) GROUP BY lang, token")


SQL["scan_documents"] = "SELECT * FROM documents"
SQL["doc_count"] = "SELECT CAST(count(*) AS BIGINT) AS doc_count FROM documents"
SQL["tokenize_documents"] = (f"SELECT doc_id, array_to_string({d_fold(d_std_lower(), 'asciifolding')}, ' ') "
                             "AS text_tokenized FROM documents")
SQL["analyze_documents"] = f"SELECT doc_id, array_to_string({d_std_lower()}, ' ') AS text_analyzed FROM documents"
SQL["custom_analyzer"] = f"""
WITH t AS (SELECT doc_id, {d_fold(d_std_lower(), 'asciifolding')} AS a FROM documents),
e AS (SELECT doc_id, unnest(a) AS tok, generate_subscripts(a, 1) AS pos FROM t),
f AS (SELECT doc_id, tok, min(pos) AS pos FROM e GROUP BY doc_id, tok),
j AS (SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS s FROM f GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN t.a IS NULL THEN NULL ELSE coalesce(j.s, '') END AS text_analyzed
FROM t LEFT JOIN j ON t.doc_id = j.doc_id
"""
SQL["fingerprint_clusters"] = f"""
WITH t AS (SELECT doc_id, {d_fold(d_std_lower(), 'asciifolding')} AS a FROM documents),
k AS (SELECT doc_id, sha256(array_to_string(list_sort(list_distinct(a)), ' ')) AS fp FROM t WHERE len(a) > 0),
g AS (SELECT fp, min(doc_id) AS cluster_id, count(*) AS cluster_size FROM k GROUP BY fp HAVING count(*) > 1)
SELECT k.doc_id, g.cluster_id, CAST(g.cluster_size AS BIGINT) AS cluster_size FROM k JOIN g USING (fp)
"""
SQL["f_fingerprint"] = f"""
WITH t AS (SELECT doc_id, {d_std_lower()} AS a FROM documents),
f AS (SELECT doc_id, a, array_to_string(list_sort(list_distinct(a)), ' ') AS fp FROM t)
SELECT doc_id,
       CAST(CASE WHEN a IS NULL THEN -1 WHEN len(a) = 0 OR length(fp) > 255 THEN 0 ELSE 1 END AS BIGINT) AS n_tokens,
       CASE WHEN a IS NULL THEN NULL WHEN len(a) = 0 OR length(fp) > 255 THEN '' ELSE fp END AS fingerprint
FROM f
"""
SQL["f_limit"] = f"SELECT doc_id, array_to_string(list_slice({d_std_lower()}, 1, 1), ' ') AS first_token FROM documents"
SQL["f_unique"] = f"""
WITH t AS (SELECT source, {d_std_lower()} AS a FROM documents)
SELECT source, CAST(sum(len(a)) AS BIGINT) AS n_tokens, CAST(sum(len(list_distinct(a))) AS BIGINT) AS n_unique
FROM t GROUP BY source
"""
SQL["f_delimited_payload"] = """
SELECT event_type AS token, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS payload_sum
FROM events GROUP BY event_type
"""

# uppercase is pinned to full case mapping (ß -> SS), as Java's String.toUpperCase.
SQL["f_uppercase"] = counts_sql(d_map(d_standard(), "upper(replace(x, 'ß', 'ss'))"))


def _html_sql() -> str:
    """Written from the definition: markup and entities are found in one pass from the left, then told apart."""
    from html.entities import html5
    breaking = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|"
                "header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul")
    inside = """([^>"']|"[^"]*"|'[^']*')*"""
    found = "(?is)" + "|".join(["<!--.*?(-->|\\z)"] + [
        rf"<{e}([\s/]{inside})?>.*?(</{e}([\s/][^>]*)?>|\z)" for e in ("script", "style")] + [
        f"</?[a-z]{inside}>", "<[a-z/!?][^>]*>", "&(#x[0-9a-f]+;?|#[0-9]+;?|[a-z][a-z0-9]*;?)"])
    old = "|".join(sorted((n for n in html5 if n[-1] != ";"), key=len, reverse=True))
    names = f"MAP([{', '.join(map(lit, html5))}], [{', '.join(map(lit, html5.values()))}])"
    return f"""
WITH names AS MATERIALIZED (SELECT {names} AS m),
a AS (SELECT page_id, html, string_split_regex(html, {lit(found)}) AS pieces,
             regexp_extract_all(html, {lit(found)}) AS marks FROM pages),
e AS (SELECT DISTINCT unnest(marks) AS mark FROM a),
t AS (SELECT mark, regexp_extract(mark, {lit('^&(' + old + ')')}, 1) AS old, trim(substr(mark, 3), ';') AS digits FROM e),
d AS (SELECT mark, CASE
        WHEN starts_with(mark, '<') THEN
          CASE WHEN regexp_matches(mark, {lit(f'(?i)^</?({breaking})[ /> ' + chr(9) + chr(10) + chr(13) + chr(12) + ']')}) THEN chr(10) ELSE '' END
        WHEN starts_with(lower(mark), '&#x') THEN chr(CAST('0x' || substr(digits, 2) AS INTEGER))
        WHEN starts_with(mark, '&#') THEN chr(CAST(digits AS INTEGER))
        ELSE coalesce(m[substr(mark, 2)], CASE WHEN old <> '' THEN m[old] || substr(mark, 2 + length(old)) END, mark) END AS new
      FROM t CROSS JOIN names),
parts AS (SELECT page_id, unnest(pieces) AS piece, unnest(list_append(marks, NULL)) AS mark,
                 generate_subscripts(pieces, 1) AS i FROM a WHERE html IS NOT NULL)
SELECT page_id, string_agg(piece || coalesce(new, ''), '' ORDER BY i) AS html_stripped
FROM parts LEFT JOIN d USING (mark) GROUP BY page_id
UNION ALL SELECT page_id, NULL FROM pages WHERE html IS NULL
"""


SQL["html_strip_pages"] = _html_sql()


# ---------------------------------------------------------------------------
# Stemming oracles: one CTE per step over a vocabulary column ``w``.
# ---------------------------------------------------------------------------
def _porter_sql_steps() -> list[str]:
    from .functions import porter as P
    m = lambda e, pat: f"regexp_matches({e}, {lit(pat)})"          # noqa: E731
    ext = lambda e, pat, g: f"regexp_extract({e}, {lit(pat)}, {g})"

    def table_step(table, cond):
        alt = "|".join(sorted(table, key=len, reverse=True))
        pat = f"^(.+?)({alt})$"
        stem, suf = ext("w", pat, 1), ext("w", pat, 2)
        case = "CASE " + suf + " " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + " END"
        return f"CASE WHEN {m('w', pat)} AND {m(stem, cond)} THEN {stem} || {case} ELSE w END"

    s4 = "|".join(sorted(P.STEP4, key=len, reverse=True))
    return [
        # mark short words; initial y as consonant
        "CASE WHEN length(w) <= 2 THEN w || chr(2) ELSE regexp_replace(w, '^y', 'Y') END",
        # 1a
        f"CASE WHEN {m('w', 'sses$|ies$')} THEN regexp_replace(w, '(ss|i)es$', '\\1') "
        f"WHEN {m('w', '[^s]s$')} THEN regexp_replace(w, 's$', '') ELSE w END",
        # 1b
        f"CASE WHEN {m('w', '^.+?eed$')} THEN (CASE WHEN {m(ext('w', '^(.+?)eed$', 1), P.M_GT0)} "
        f"THEN regexp_replace(w, 'eed$', 'ee') ELSE w END) "
        f"WHEN {m('w', '^.+?(ed|ing)$')} AND {m(ext('w', '^(.+?)(ed|ing)$', 1), P.HAS_V)} "
        f"THEN {ext('w', '^(.+?)(ed|ing)$', 1)} || chr(1) ELSE w END",
        # 1b cleanup
        "CASE WHEN NOT ends_with(w, chr(1)) THEN w ELSE (SELECT CASE "
        f"WHEN {m('s', '(at|bl|iz)$')} THEN s || 'e' "
        f"WHEN {m('s', P.DOUBLE_NOT_LSZ)} THEN left(s, length(s) - 1) "
        f"WHEN {m('s', P.CVC)} THEN s || 'e' ELSE s END FROM (SELECT left(w, length(w) - 1) AS s)) END",
        # 1c
        f"CASE WHEN {m('w', '^.+?y$')} AND {m(ext('w', '^(.+?)y$', 1), P.HAS_V)} "
        f"THEN {ext('w', '^(.+?)y$', 1)} || 'i' ELSE w END",
        table_step(P.STEP2, P.M_GT0),
        table_step(P.STEP3, P.M_GT0),
        # 4
        f"CASE WHEN {m('w', f'^.+?({s4})$')} THEN (CASE WHEN {m(ext('w', f'^(.+?)({s4})$', 1), P.M_GT1)} "
        f"THEN {ext('w', f'^(.+?)({s4})$', 1)} ELSE w END) "
        f"WHEN {m('w', '^.+?[st]ion$')} AND {m(ext('w', '^(.+?)ion$', 1), P.M_GT1)} "
        f"THEN {ext('w', '^(.+?)ion$', 1)} ELSE w END",
        # 5a
        f"CASE WHEN {m('w', '^.+?e$')} AND ({m(ext('w', '^(.+?)e$', 1), P.M_GT1)} OR "
        f"({m(ext('w', '^(.+?)e$', 1), P.M_EQ1)} AND NOT {m(ext('w', '^(.+?)e$', 1), P.CVC)})) "
        f"THEN {ext('w', '^(.+?)e$', 1)} ELSE w END",
        # 5b
        f"CASE WHEN {m('w', 'll$')} AND {m('w', P.M_GT1)} THEN left(w, length(w) - 1) ELSE w END",
        # unmark
        "regexp_replace(regexp_replace(w, chr(2) || '$', ''), '^Y', 'y')",
    ]


def _light_sql_steps(lang: str) -> list[str]:
    if lang == "french":
        return [
            "CASE WHEN length(w) >= 6 AND NOT ends_with(w, 'x') THEN w || chr(3) ELSE w END",
            "CASE WHEN length(w) < 6 THEN w WHEN ends_with(w, 'aux') THEN left(w, length(w) - 2) || 'l' "
            "WHEN ends_with(w, 'x') THEN left(w, length(w) - 1) ELSE w END",
        ] + [f"CASE WHEN ends_with(w, {lit(c)} || chr(3)) THEN left(w, length(w) - 2) || chr(3) ELSE w END"
             for c in ("s", "r", "e", "é")] + [
            "CASE WHEN ends_with(w, chr(3)) AND length(w) >= 3 AND "
            "substring(w, length(w) - 1, 1) = substring(w, length(w) - 2, 1) "
            "THEN left(w, length(w) - 2) || chr(3) ELSE w END",
            "regexp_replace(w, chr(3) || '$', '')",
        ]
    if lang == "german":
        return [
            "translate(w, 'äöü', 'aou')",
            "CASE WHEN length(w) > 5 AND ends_with(w, 'ern') THEN left(w, length(w) - 3) "
            "WHEN length(w) > 4 AND regexp_matches(w, '(em|en|er|es)$') THEN left(w, length(w) - 2) "
            "WHEN length(w) > 3 AND ends_with(w, 'e') THEN left(w, length(w) - 1) "
            "WHEN length(w) > 3 AND regexp_matches(w, '[bdfghklmnrt]s$') THEN left(w, length(w) - 1) "
            "ELSE w END",
            "CASE WHEN length(w) > 5 AND ends_with(w, 'est') THEN left(w, length(w) - 3) "
            "WHEN length(w) > 4 AND regexp_matches(w, '(er|en)$') THEN left(w, length(w) - 2) "
            "WHEN length(w) > 5 AND regexp_matches(w, '[bdfghklmnt]st$') THEN left(w, length(w) - 2) "
            "ELSE w END",
        ]
    if lang == "spanish":
        return [
            "CASE WHEN length(w) >= 5 THEN translate(w, 'áéíóú', 'aeiou') ELSE w END",
            "CASE WHEN length(w) < 5 THEN w WHEN ends_with(w, 'eses') THEN left(w, length(w) - 2) "
            "WHEN ends_with(w, 'ces') THEN left(w, length(w) - 3) || 'z' "
            "WHEN regexp_matches(w, '(os|as|es)$') THEN left(w, length(w) - 2) "
            "WHEN regexp_matches(w, '[oae]$') THEN left(w, length(w) - 1) ELSE w END",
        ]
    raise KeyError(lang)


def _suffix_ctes(language: str, src: str) -> tuple[list[str], str]:
    """CTEs of a suffix stemmer over ``src`` (token, n); the last one has the stem as w."""
    from .functions import suffix_stem as S
    name = language[:2]
    parts, prev = [f"{name}0 AS (SELECT token, n, token AS w FROM {src})"], f"{name}0"
    for i, (kind, a, b) in enumerate(S.PROGRAMS[language], 1):
        if kind == "map":
            step, source = f"translate(w, {lit(a)}, {lit(b)})", prev
        elif kind == "sub":
            step, source = f"regexp_replace(w, {lit(a)}, {lit(b)}, 'g')", prev
        else:
            whens = []
            for suffixes, new, tests, cut in b:
                holds = " AND ".join([f"s IN ({', '.join(map(lit, suffixes))})",
                                      *[f"regexp_matches(h, {lit(S.expand(t, language))})" for t in tests]])
                whens.append(f"WHEN {holds} THEN left(h, length(h) - {cut}) || {lit(new)}")
            step = f"CASE WHEN s = '' THEN w {' '.join(whens)} ELSE w END"
            source = (f"(SELECT *, left(w, length(w) - length(s)) AS h FROM (SELECT *, "
                      f"regexp_extract(w, {lit(S.suffix_pattern(language, a, b))}, 1) AS s FROM {prev}))")
        parts.append(f"{name}{i} AS MATERIALIZED (SELECT token, n, {step} AS w FROM {source})")
        prev = f"{name}{i}"
    return parts, prev


def stem_ctes(src: str, steps: list[str], prefix: str, cols: str = "lang, token") -> tuple[str, str]:
    """CTE chain applying ``steps`` to ``w``; returns (ctes, last name)."""
    parts, prev = [f"{prefix}0 AS (SELECT {cols}, token AS w FROM {src})"], f"{prefix}0"
    for i, st in enumerate(steps, 1):
        parts.append(f"{prefix}{i} AS MATERIALIZED (SELECT {cols}, {st} AS w FROM {prev})")
        prev = f"{prefix}{i}"
    return ",\n".join(parts), prev


def _stem_oracles():
    from .functions.stopwords import ENGLISH_STOP_33, stop_words
    ctes, last = stem_ctes("v", _porter_sql_steps(), "p")
    SQL["f_porter_stem"] = f"""
WITH e AS (SELECT doc_id, lang, unnest({d_std_lower()}) AS token FROM documents),
v AS (SELECT DISTINCT lang, token FROM e),
{ctes},
j AS (SELECT e.doc_id, e.lang, {last}.w AS stem FROM e JOIN {last} USING (lang, token)),
f AS (SELECT lang, w AS stem, CAST(count(*) AS BIGINT) AS n_forms FROM {last} GROUP BY lang, w),
s AS (SELECT lang, stem, CAST(count(*) AS BIGINT) AS tf, CAST(count(DISTINCT doc_id) AS BIGINT) AS df
      FROM j GROUP BY lang, stem)
SELECT s.lang, s.stem, s.tf, s.df, f.n_forms FROM s JOIN f USING (lang, stem)
"""
    SQL["f_stemmer"] = f"""
WITH v AS (SELECT lang, token, count(*) AS n FROM
  (SELECT lang, unnest({d_std_lower()}) AS token FROM documents) GROUP BY lang, token),
{stem_ctes("v", _porter_sql_steps(), "p", "lang, token, n")[0]},
z AS (SELECT * FROM {stem_ctes("v", _porter_sql_steps(), "p", "lang, token, n")[1]})
SELECT lang, w AS token, CAST(sum(n) AS BIGINT) AS n FROM z GROUP BY lang, w
"""
    # Pre-stem filters per language on token lists, then stemming of the vocabulary.
    std = d_standard()
    poss = d_map(std, "regexp_replace(x, '[''’][sS]$', '')")
    pre = {
        "en": d_stop(d_lower(poss), ENGLISH_STOP_33),
        "fr": d_stop(d_lower(d_map(std, "regexp_replace(x, " + lit(
            "(?i)^(?:quoiqu|lorsqu|puisqu|jusqu|qu|l|m|t|n|s|j|d|c)['’]") + ", '')")), stop_words("french")),
        "de": d_fold(d_stop(d_lower(std), stop_words("german")), "german_normalization"),
        "es": d_stop(d_lower(std), stop_words("spanish")),
    }
    for code, lang in [("da", "danish"), ("nl", "dutch"), ("fi", "finnish"), ("hu", "hungarian"),
                       ("it", "italian"), ("no", "norwegian"), ("pt", "portuguese"), ("ru", "russian"),
                       ("sv", "swedish"), ("tr", "turkish")]:
        pre[code] = d_stop(d_lower(std), stop_words(lang))
    case = "CASE " + " ".join(f"WHEN lang = {lit(k)} THEN {v}" for k, v in pre.items()) + \
        f" ELSE {d_lower(std)} END"
    chains = {"en": _porter_sql_steps(), "fr": _light_sql_steps("french"),
              "de": _light_sql_steps("german"), "es": _light_sql_steps("spanish")}
    parts, prev, i = ["q0 AS (SELECT lang, token, n, token AS w FROM v)"], "q0", 0
    for code, steps in chains.items():
        for st in steps:
            i += 1
            parts.append(f"q{i} AS MATERIALIZED (SELECT lang, token, n, CASE WHEN lang = {lit(code)} THEN {st} "
                         f"ELSE w END AS w FROM {prev})")
            prev = f"q{i}"
    SQL["an_by_lang"] = f"""
WITH v AS (SELECT lang, token, count(*) AS n FROM
  (SELECT lang, unnest({case}) AS token FROM documents) GROUP BY lang, token),
{",".join(parts)}
SELECT lang, w AS token, CAST(sum(n) AS BIGINT) AS n FROM {prev} GROUP BY lang, w
"""
    from .catalog import SUBSTITUTED
    from .plans.analyze import STOP_ONLY_LANGUAGES
    chained, last = zip(*[_suffix_ctes(l, "v") for l in STOP_ONLY_LANGUAGES])
    stems = " UNION ALL ".join(f"SELECT {lit(l)} AS language, w AS stem, n FROM {t}" for l, t in zip(STOP_ONLY_LANGUAGES, last))
    SQL["an_stemmed"] = f"""
WITH v AS (SELECT token, count(*) AS n FROM (SELECT unnest({d_std_lower()}) AS token
  FROM (SELECT {SUBSTITUTED["an_stemmed"]} AS text FROM documents)) GROUP BY token),
{", ".join(sum(chained, []))}
SELECT language, stem, CAST(count(*) AS BIGINT) AS n_forms, CAST(sum(n) AS BIGINT) AS n FROM ({stems}) GROUP BY language, stem
"""
    sums = ", ".join(f"CAST(sum(len({d_stop('t', stop_words(l))})) AS BIGINT) AS {l}"
                     for l in STOP_ONLY_LANGUAGES)
    SQL["an_stop_lists"] = f"""
WITH d AS (SELECT {d_std_lower()} AS t FROM documents), w AS (SELECT {sums} FROM d)
UNPIVOT w ON {", ".join(STOP_ONLY_LANGUAGES)} INTO NAME analyzer VALUE n_tokens
"""



# ---------------------------------------------------------------------------
# Scans, keys, writes, shaping.
# ---------------------------------------------------------------------------
# Column lists of the driver tables (as documented in FIXTURES.md).
COLUMNS = {
    "events": "event_id ts user_id event_type value props".split(),
    "lineitem": ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
                 "l_tax l_returnflag l_linestatus l_shipdate").split(),
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split(),
    "supplier": "s_suppkey s_name s_nationkey s_acctbal".split(),
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice".split(),
}
ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()

SQL["read_many_union"] = ("SELECT 'conversations' AS _table, * FROM conversations "
                          "UNION ALL BY NAME SELECT 'customer' AS _table, * FROM customer")
SQL["table_inventory"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"index\", CAST(count(*) AS BIGINT) AS doc_count FROM {t}" for t in sorted(ALL_TABLES))
SQL["unwrap_source"] = "SELECT * FROM documents"
SQL["discover_columns"] = """
WITH k AS (SELECT props, unnest(json_keys(props)) AS key FROM events WHERE json_valid(props))
SELECT key, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE json_type(json_extract(props, '$."' || key || '"')) <> 'NULL') AS BIGINT) AS n_nonnull
FROM k GROUP BY key
"""
SQL["prefix_filter"] = ("SELECT doc_id, source FROM documents "
                        "WHERE starts_with(source, 'src1') AND NOT starts_with(source, '.')")
SQL["selection_filter"] = "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"
SQL["geo_point"] = """
SELECT CAST(CAST(c_custkey % 181 - 90 AS DOUBLE) AS VARCHAR) || ',' ||
       CAST(CAST((c_nationkey * 7) % 361 - 180 AS DOUBLE) AS VARCHAR) AS geo_point, c_custkey
FROM customer
"""
_UPD = """
b AS (SELECT * FROM (SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus,
        l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC,
          l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1)
"""
SQL["upsert_orders"] = f"""
WITH {_UPD}
SELECT o.* FROM orders o WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = o.o_orderkey)
UNION ALL
SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority FROM b
"""
SQL["bulk_write_separate"] = f"""
SELECT 'orders' AS "index", CAST(o_orderkey AS BIGINT) AS _id, o_orderstatus AS text, o_totalprice AS amount
  FROM ({SQL["upsert_orders"]})
UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier
"""
SQL["bulk_write_merged"] = """
WITH u AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, 'customer' AS _table, 0 AS _t, * FROM customer
  UNION ALL BY NAME SELECT CAST(s_suppkey AS VARCHAR) AS _id, 'supplier' AS _table, 1 AS _t, * FROM supplier
  UNION ALL BY NAME SELECT CAST(p_partkey AS VARCHAR) AS _id, 'part' AS _table, 2 AS _t, * FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY _t DESC) AS _rn FROM u)
SELECT * EXCLUDE (_t, _rn) FROM r WHERE _rn = 1
"""
SQL["apply_mapping"] = "SELECT * FROM events"
SQL["keyword_subfield"] = ('SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS "text.keyword" '
                           "FROM documents")
SQL["key_profile"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", 'doc_id' AS key, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(count(*) - count(doc_id) AS BIGINT) AS n_null, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_distinct, "
    f"CAST(count(doc_id) - count(DISTINCT doc_id) AS BIGINT) AS n_duplicates FROM {t}"
    for t in ("documents", "labels"))
SQL["add_key"] = """
SELECT 'supplier' AS _table, s_suppkey AS id, CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS BIGINT) AS _key
FROM supplier
UNION ALL
SELECT 'customer', c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) - 1 + (SELECT count(*) FROM supplier) AS BIGINT)
FROM customer
"""
SQL["add_key_offset"] = """
SELECT *, CAST(row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) + 99 AS BIGINT) AS _key
FROM orders
"""
SQL["flatten_struct"] = """
SELECT event_id, user_id AS "who.user_id", event_type AS "who.detail.event_type", value AS "who.detail.value",
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS "props.k" FROM events
"""
SQL["flatten_json_rows"] = """
SELECT event_id, j.key AS key, CASE WHEN j.type = 'NULL' THEN NULL ELSE CAST(j.value AS VARCHAR) END AS value
FROM events, json_each(props) AS j WHERE json_valid(props)
"""
SQL["nest_columns"] = """
SELECT event_id, to_json({'user_id': user_id, 'detail': {'event_type': event_type, 'value': value}}) AS who,
       to_json({'k': TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)}) AS props
FROM events
"""

# Value patterns of type inference (RE2 spelling of the pinned rule).
_INT, _FLOAT = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
_GEO = r"^-?[0-9]+(\.[0-9]+)?,-?[0-9]+(\.[0-9]+)?$"


def _number_sql(v: str) -> dict[str, str]:
    """Digits of a number in text, and the tests on it."""
    mantissa = f"regexp_extract({v}, '^[+-]?([0-9.]*)', 1)"
    whole = f"split_part({mantissa}, '.', 1)"
    part = f"rtrim(split_part({mantissa}, '.', 2), '0')"
    out = {"before": f"length(ltrim({whole}, '0'))", "after": f"length({part})", "sig": f"length(ltrim({whole} || {part}, '0'))",
           "exp": f"regexp_matches({v}, '[eE]')"}
    d = f"abs(TRY_CAST({v} AS DOUBLE))"
    inside = f"coalesce({d} >= 2.3e-308 AND {d} < CAST('inf' AS DOUBLE), false)"
    out["double"] = f"(({out['sig']} <= 15 AND ({out['sig']} = 0 OR {inside})) OR ({inside} AND CAST(TRY_CAST({v} AS DOUBLE) AS VARCHAR) = {v}))"
    out["int"], out["float"] = f"regexp_matches({v}, {lit(_INT)})", f"regexp_matches({v}, {lit(_FLOAT)})"
    out["date"], out["geo"] = f"regexp_matches({v}, {lit(_DATE)})", f"regexp_matches({v}, {lit(_GEO)})"
    out["calendar"] = f"TRY_CAST({v} AS TIMESTAMP) IS NOT NULL"
    out["globe"] = f"(abs(TRY_CAST(split_part({v}, ',', 1) AS DOUBLE)) <= 90 AND abs(TRY_CAST(split_part({v}, ',', 2) AS DOUBLE)) <= 180)"
    return out


def infer_types_sql(table: str, exprs: dict[str, str] | None = None) -> str:
    """One named class per value; the column's type from which classes occur."""
    parts = []
    for c, e in (exprs or {c: f"CAST({c} AS VARCHAR)" for c in COLUMNS[table]}).items():
        n = _number_sql("v")
        plain = f"CASE WHEN {n['before']} + {n['after']} <= 38 THEN 'exact' ELSE 'huge' END"
        cls = (f"CASE WHEN v IS NULL THEN NULL WHEN {n['int']} THEN CASE WHEN TRY_CAST(v AS BIGINT) IS NULL THEN {plain} "
               f"WHEN {n['sig']} <= 15 THEN 'short' ELSE 'long' END WHEN {n['float']} THEN CASE WHEN {n['double']} THEN "
               f"CASE WHEN {n['exp']} THEN 'expo' ELSE 'float' END WHEN {n['exp']} THEN 'huge' ELSE {plain} END "
               f"WHEN {n['date']} AND {n['calendar']} THEN 'date' WHEN {n['geo']} AND {n['globe']} THEN 'geo' ELSE 'text' END")
        only = lambda *names: f"bool_and(k IN ({', '.join(map(lit, names))}))"
        width = "greatest(max(bf) + max(af), 1)"
        parts.append(
            f"SELECT {lit(c)} AS \"column\", CASE WHEN count(v) = 0 THEN 'anytype' WHEN {only('short', 'long')} THEN 'int' "
            f"WHEN {only('short', 'float', 'expo')} THEN 'float' WHEN {only('short', 'long', 'float', 'exact')} AND {width} <= 38 "
            f"THEN 'decimal(' || {width} || ',' || max(af) || ')' WHEN {only('short', 'long', 'float', 'exact', 'huge', 'expo')} THEN 'str' "
            f"WHEN {only('date')} THEN 'date' WHEN {only('geo')} THEN 'geo_point' WHEN {only('text', 'huge')} THEN 'str' ELSE 'anytype' END AS type, "
            f"CAST(count(v) AS BIGINT) AS n_nonnull, CAST(max(length(v)) AS BIGINT) AS max_len FROM (SELECT v, {cls} AS k, "
            f"CASE WHEN {n['float']} THEN {n['before']} END AS bf, CASE WHEN {n['float']} THEN {n['after']} END AS af FROM (SELECT {e} AS v FROM {table}))")
    return " UNION ALL ".join(parts)


def _misfits_sql() -> tuple[str, dict[str, str]]:
    """The derived rows, and per column the reason why a value is refused (null: kept)."""
    from .catalog import MISFITS
    why = {}
    for c, (kind, _) in MISFITS.items():
        n = _number_sql(c)
        number = f"NOT {n['float']} THEN 'not a number'"
        why[c] = {
            "integer": f"CASE WHEN NOT {n['int']} THEN CASE WHEN {n['float']} THEN 'loses digits' ELSE 'not a number' END "
                       f"WHEN TRY_CAST({c} AS BIGINT) IS NULL THEN 'out of range' END",
            "float": f"CASE WHEN {number} WHEN coalesce(isinf(TRY_CAST({c} AS DOUBLE)), true) THEN 'out of range' WHEN NOT {n['double']} THEN 'loses digits' END",
            "date": f"CASE WHEN NOT {n['date']} THEN 'not a date' WHEN NOT {n['calendar']} THEN 'not in the calendar' END",
            "geo_point": f"CASE WHEN NOT {n['geo']} THEN 'not a point' WHEN NOT {n['globe']} THEN 'out of range' END",
            "decimal(5,2)": f"CASE WHEN {number} WHEN {n['exp']} OR {n['after']} > 2 THEN 'loses digits' "
                            f"WHEN TRY_CAST({c} AS DECIMAL(5,2)) IS NULL THEN 'out of range' END"}[kind]
    return "SELECT event_id, " + ", ".join(f"{e} AS {c}" for c, (_, e) in MISFITS.items()) + " FROM events", why


def _templates_sql() -> str:
    from .operators.shape import TEMPLATES
    rows = ", ".join(f"({lit(k)}, {lit(s)}, {lit(v) if v else 'NULL'})" for k, lst_ in TEMPLATES.items() for s, v in lst_)
    return f"(VALUES {rows}) AS tpl(type, suffix, value)"


def infer_mappings_sql(table: str, key_prefix: str = "") -> str:
    return (f"SELECT {lit(key_prefix)} || k.\"column\" || '.' || tpl.suffix AS key, coalesce(tpl.value, '\"' || k.type || '\"') AS value "
            f"FROM ({infer_types_sql(table)}) AS k JOIN {_templates_sql()} ON split_part(k.type, '(', 1) = tpl.type")


SQL["infer_types"] = infer_types_sql("lineitem")
SQL["infer_mappings"] = infer_mappings_sql("events")
SQL["nest_to_json"] = infer_mappings_sql("events", "properties.")
SQL["table_mappings"] = " UNION ALL ".join(
    f"SELECT '{t}' AS _table, key, value FROM ({infer_mappings_sql(t)})" for t in ("customer", "supplier", "part"))
SQL["field_stats"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS n_nonnull, "
    f"CAST(count(DISTINCT CAST({c} AS VARCHAR)) AS BIGINT) AS n_distinct, "
    f"CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS max_len FROM lineitem" for c in COLUMNS["lineitem"])

SQL["field_sketches"] = (
    "SELECT \"column\", count(*) AS n_rows, count(v) AS n_nonnull, CAST(max(length(v)) AS BIGINT) AS max_len, "
    "count(DISTINCT v) AS n_distinct, TRUE AS within_bound FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p}_{c} AS VARCHAR) AS v FROM {t}"
        for t, p, names in (("customer", "c", "custkey name nationkey mktsegment"),
                            ("orders", "o", "orderkey custkey orderstatus orderpriority"),
                            ("lineitem", "l", "orderkey partkey suppkey linenumber returnflag linestatus"))
        for c in names.split()) + ") GROUP BY 1")
SQL["stream_upsert_events"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""

SQL["stream_analyze_documents"] = SQL["analyze_documents"]


def _schemaless_oracles() -> None:
    from .catalog import SCHEMALESS
    objects = f"SELECT event_id, CASE WHEN json_valid(js) AND json_type(js) = 'OBJECT' THEN js END AS js FROM (SELECT event_id, {SCHEMALESS} AS js FROM events)"
    # every leaf of every object, its kinds merged
    paths = ["p.k", "who.id", "who.kind", "who.score", "tag", "flags"]
    leaves = " UNION ALL ".join(f"SELECT '{p}' AS path, json_type(js, '$.{p}') AS t FROM o WHERE json_exists(js, '$.{p}')" for p in paths)
    whole = "bool_and(t IN ('UBIGINT', 'BIGINT'))"
    SQL["merged_schema"] = (f"WITH o AS ({objects}), l AS ({leaves}) SELECT path, CASE WHEN {whole} THEN 'integer' "
                            "WHEN bool_and(t IN ('UBIGINT', 'BIGINT', 'DOUBLE')) THEN 'fraction' WHEN bool_and(t = 'VARCHAR') THEN 'text' "
                            "WHEN bool_and(t = 'ARRAY') THEN 'list' ELSE 'mixed' END AS kind FROM l GROUP BY path")
    SQL["typed_rows"] = (f"WITH o AS ({objects}) SELECT event_id, TRY_CAST(js->>'$.p.k' AS BIGINT) AS k, TRY_CAST(js->>'$.who.id' AS BIGINT) AS id, "
                         "js->>'$.who.kind' AS kind, TRY_CAST(js->>'$.who.score' AS DOUBLE) AS score, CAST(js->'$.tag' AS VARCHAR) AS tag, "
                         "CAST(js->'$.flags' AS VARCHAR) AS flags FROM o")


def _mapping_oracles() -> None:
    from .catalog import LATTICE
    SQL["infer_exact_types"] = infer_types_sql("lineitem", LATTICE)
    rows, why = _misfits_sql()
    SQL["mapping_rejects"] = f"WITH e AS ({rows}), r AS (" + " UNION ALL ".join(
        f"SELECT event_id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, {w} AS reason FROM e WHERE {c} IS NOT NULL"
        for c, w in why.items()) + ") SELECT * FROM r WHERE reason IS NOT NULL"
    kept = " AND ".join(f"({c} IS NULL OR ({w}) IS NULL)" for c, w in why.items())
    SQL["mapping_accepted"] = (f"WITH e AS ({rows}), k AS (SELECT * FROM e WHERE {kept}) SELECT event_id, TRY_CAST(user_id AS BIGINT) AS user_id, "
                               "TRY_CAST(amount AS DOUBLE) AS amount, TRY_CAST(day AS TIMESTAMP) AS day, place, TRY_CAST(price AS DOUBLE) AS price FROM k")


def all_sql() -> dict[str, str]:
    """Every oracle; the ones that need word lists are built here, not at import."""
    if "an_by_lang" not in SQL:
        _lazy_text_sql()
        _stem_oracles()
        _mapping_oracles()
        _schemaless_oracles()
    return dict(SQL)
