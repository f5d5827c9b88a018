"""Token filters: array<string> Column -> array<string> Column.

Each filter is a higher-order array expression evaluated in the JVM. Filters
that need a table (stop words, fold profiles) take it as a literal built on the
driver from fixed, bounded lists, so nothing is joined per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fold, porter, stopwords

def _empty() -> Column:
    return F.array().cast("array<string>")

# French articles removed by the `elision` filter (before ' or ’).
ELISION_ARTICLES = "l m t qu n s j d c jusqu quoiqu lorsqu puisqu".split()

TRIM_CHARS = r"[ \t\n\r\f\u000B]"


def lowercase(a: Column) -> Column:
    return F.transform(a, F.lower)


def uppercase(a: Column) -> Column:
    return F.transform(a, F.upper)


def trim(a: Column) -> Column:
    return F.transform(a, lambda x: F.regexp_replace(x, f"^{TRIM_CHARS}+|{TRIM_CHARS}+$", ""))


def truncate(a: Column, length: int = 10) -> Column:
    return F.transform(a, lambda x: F.substring(x, 1, length))


def limit(a: Column, max_token_count: int = 1) -> Column:
    return F.slice(a, 1, max_token_count)


def reverse(a: Column) -> Column:
    return F.transform(a, F.reverse)


def unique(a: Column) -> Column:
    """Keep the first occurrence of each token (order preserved)."""
    return F.array_distinct(a)


def stop(a: Column, words: Iterable[str] | str = "english") -> Column:
    """Drop stop words (case-sensitive). ``filter`` keeps duplicates of the rest."""
    ws = list(stopwords.stop_words(words) if isinstance(words, str) else words)
    # `isin` over literals becomes a hash-set lookup (InSet), not a list scan.
    return F.filter(a, lambda x: ~x.isin(ws))


def stop_by_lang(a: Column, lang: Column, codes_to_languages: dict[str, str]) -> Column:
    """Drop the stop words of each row's language (rows of other languages keep all tokens).

    The lists are one literal ``map<code, array<word>>`` built from a single
    JSON string (one expression, however many languages), looked up per row.
    """
    import json
    table = {code: list(stopwords.stop_words(language)) for code, language in codes_to_languages.items()}
    m = F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "map<string,array<string>>")
    words = F.coalesce(F.element_at(m, lang), F.array().cast("array<string>"))
    return F.filter(a, lambda x: ~F.array_contains(words, x))


def fingerprint(a: Column, max_output_size: int | None = 255, separator: str = " ") -> Column:
    """Sorted distinct tokens joined into one token; none when longer than the cap."""
    fp = F.array_join(F.array_sort(F.array_distinct(a)), separator)
    out = F.when(a.isNull(), F.lit(None).cast("array<string>")).when(F.size(a) == 0, _empty())
    if max_output_size is not None:
        out = out.when(F.length(fp) > max_output_size, _empty())
    return out.otherwise(F.array(fp))


def edge_ngram(a: Column, min_gram: int = 1, max_gram: int = 2) -> Column:
    """Prefixes of each token, shortest first."""
    def pre(x):
        parts = [F.when(F.length(x) >= g, F.array(F.substring(x, 1, g))).otherwise(_empty())
                 for g in range(min_gram, max_gram + 1)]
        return F.flatten(F.array(*parts))
    return F.flatten(F.transform(a, pre))


def ngram(a: Column, min_gram: int = 1, max_gram: int = 2) -> Column:
    """n-grams of each token, position-major (a ab b bc c)."""
    def grams(x):
        n = F.length(x)
        if (min_gram, max_gram) == (1, 2):      # a character and its next one, without a search from the start for each
            chars = F.split(x, "")
            return F.when(n == 0, _empty()).otherwise(F.flatten(F.transform(F.array(chars), lambda c: F.flatten(F.zip_with(
                c, _next(c), lambda a, b: F.when(b.isNull(), F.array(a)).otherwise(F.array(a, F.concat(a, b))))))))

        def at(i):
            parts = [F.when(i + g - 1 <= n, F.array(x.substr(i, F.lit(g)))).otherwise(_empty())
                     for g in range(min_gram, max_gram + 1)]
            return F.flatten(F.array(*parts))
        return F.when(n == 0, _empty()).otherwise(F.flatten(F.transform(F.sequence(F.lit(1), n), at)))
    return F.flatten(F.transform(a, grams))


def _next(a: Column) -> Column:
    """The array shifted left by one; zip_with pads it with a null at the end."""
    return F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))


def shingle(a: Column, separator: str = " ") -> Column:
    """Unigrams and 2-token shingles, position-major (t1, t1 t2, t2, t2 t3, t3)."""
    return F.flatten(F.zip_with(a, _next(a), lambda x, y: F.when(y.isNull(), F.array(x))
                                .otherwise(F.array(x, F.concat(x, F.lit(separator), y)))))


def bigram_shingles(a: Column, separator: str = " ") -> Column:
    """Only the 2-token shingles of ``shingle`` (what a phrase count needs)."""
    pairs = F.zip_with(a, _next(a), lambda x, y: F.concat(x, F.lit(separator), y))
    return F.filter(pairs, lambda s: s.isNotNull())


def classic(a: Column) -> Column:
    """Drop a trailing 's; drop the dots of an acronym (U.S.A. -> USA)."""
    def one(x):
        x = F.regexp_replace(x, "['’][sS]$", "")
        return F.when(x.rlike(r"^\p{L}(\.\p{L})+\.?$"), F.regexp_replace(x, r"\.", "")).otherwise(x)
    return F.transform(a, one)


def delimited_payload(a: Column, delimiter: str = "|") -> Column:
    """Keep the part before the first delimiter (the payload is ``payloads``)."""
    return F.transform(a, lambda x: F.substring_index(x, delimiter, 1))


def payloads(a: Column, delimiter: str = "|") -> Column:
    """Payload of each token: text after the first delimiter, null when there is none."""
    def one(x):
        at = F.instr(x, delimiter)
        return F.when(at > 0, x.substr(at + 1, F.length(x)))
    return F.transform(a, one)


def elision(a: Column, articles: Iterable[str] = ELISION_ARTICLES) -> Column:
    pattern = "(?i)^(?:" + "|".join(sorted(articles, key=len, reverse=True)) + ")['’]"
    return F.transform(a, lambda x: F.regexp_replace(x, pattern, ""))


def word_delimiter(a: Column) -> Column:
    """Drop 's; split at non-alphanumerics, lower->upper case changes and letter<->digit changes."""
    def parts(x):
        x = F.regexp_replace(x, "['’][sS]$", "")
        x = F.regexp_replace(x, r"(\p{Ll})(\p{Lu})", "$1 $2")
        x = F.regexp_replace(x, r"(\p{L})(\p{Nd})", "$1 $2")
        x = F.regexp_replace(x, r"(\p{Nd})(\p{L})", "$1 $2")
        return F.filter(F.split(x, r"[^\p{L}\p{Nd}]+"), lambda p: F.length(p) > 0)
    return F.flatten(F.transform(a, parts))


_CJK_CHAR = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"


def cjk_bigram(a: Column) -> Column:
    """CJK tokens next to each other in the array are joined into runs; a run becomes its
    overlapping character pairs, a single CJK character stays alone; other tokens pass.

    An array of strings does not tell whether two tokens touch in the text:
    ``stream.cjk_bigram`` does, and named pipelines use that.
    """
    sep = "\u0001"
    joined = F.array_join(a, sep)
    merged = F.regexp_replace(joined, f"({_CJK_CHAR}){sep}(?={_CJK_CHAR})", "$1")
    toks = F.when(F.size(a) == 0, _empty()).otherwise(F.split(merged, sep))

    def one(t):
        n = F.length(t)
        bigrams = F.transform(F.sequence(F.lit(1), n - 1), lambda i: t.substr(i, F.lit(2)))
        return (F.when(~t.rlike(f"^{_CJK_CHAR}+$"), F.array(t))
                .when(n == 1, F.array(t))
                .otherwise(bigrams))
    return F.flatten(F.transform(toks, one))


def possessive_english(a: Column) -> Column:
    """Drop a trailing 's (the English analyzer's possessive step)."""
    return F.transform(a, lambda x: F.regexp_replace(x, "['’][sS]$", ""))


def stem_steps(language: str = "english") -> list:
    """The steps of a language's stemmer, each a function of one lower-case word."""
    if language in ("english", "porter", "en"):
        return porter.porter_steps()
    from . import light_stem, suffix_stem
    return (suffix_stem if language in suffix_stem.PROGRAMS else light_stem).steps(language)


def stemmer(a: Column, language: str = "english") -> Column:
    """`stemmer` / `porter_stem`: English is Porter; see ``light_stem`` and ``suffix_stem`` for others."""
    for step in stem_steps(language):
        a = F.transform(a, step)
    return a


def _fold(name):
    return lambda a: fold.fold_chars(a, name)


FILTERS = {
    "asciifolding": _fold("asciifolding"),
    "cjk_bigram": cjk_bigram,
    "cjk_width": _fold("cjk_width"),
    "classic": classic,
    "decimal_digit": _fold("decimal_digit"),
    "delimited_payload": delimited_payload,
    "edge_ngram": edge_ngram,
    "elision": elision,
    "fingerprint": fingerprint,
    "limit": limit,
    "lowercase": lowercase,
    "ngram": ngram,
    "porter_stem": porter.porter_stem,
    "reverse": reverse,
    "shingle": shingle,
    "stemmer": stemmer,
    "stop": stop,
    "trim": trim,
    "truncate": truncate,
    "unique": unique,
    "uppercase": uppercase,
    "word_delimiter": word_delimiter,
    "arabic_normalization": _fold("arabic_normalization"),
    "german_normalization": _fold("german_normalization"),
    "hindi_normalization": _fold("hindi_normalization"),
    "persian_normalization": _fold("persian_normalization"),
    "scandinavian_normalization": _fold("scandinavian_normalization"),
    "scandinavian_folding": _fold("scandinavian_folding"),
    "serbian_normalization": _fold("serbian_normalization"),
    "sorani_normalization": _fold("sorani_normalization"),
}
