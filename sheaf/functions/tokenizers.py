"""Tokenizers: string Column -> array<string> Column.

Every tokenizer is one JVM expression (``regexp_extract_all`` plus array
functions), so it runs inside whole-stage code generation on whatever
partition holds the row. A null text gives a null array.

The definitions are pinned approximations of the defaults of the named
tokenizers; the patterns avoid look-around so that the same rule can be
written for RE2 engines too.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TOKEN_LENGTH = 255

# Letter (excluding Han ideographs, which are tokens of their own), digit. ASCII comes first, letter by letter: the JVM
# looks such a list up in one table, while ranges, categories and scripts are asked one by one.
_L = rf"[{string.ascii_letters}[[^\x00-\x7F]&&[\p{{L}}\p{{M}}]&&[^\p{{IsHan}}]]]"
_D = rf"[{string.digits}[[^\x00-\x7F]&&\p{{Nd}}]]"
_HAN = r"[[^\x00-\x7F]&&\p{IsHan}]"
# A word: runs of letters joined across . ' ’ : when letters are on both sides,
# runs of digits joined across . , ; ' when digits are on both sides, and `_`
# joining anything. Adjacent letter and digit runs belong to one word. What follows a run
# cannot fail, so a greedy run (the fast loop) is never tried again; the groups are possessive.
_WORD = rf"(?:{_L}+(?:[.'’:]{_L}+)*+|{_D}+(?:[.,;']{_D}+)*+|_)++"
STANDARD_PATTERN = rf"{_WORD}|{_HAN}"

# The local part is possessive (`++`): `@` is outside its class, so the match set
# is unchanged, but a long run of such characters is not re-scanned from each start.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
URL_PATTERN = r"(?:https?|ftp)://[^\s<>\"']*[^\s<>\"'.,;:!?)\]]"
URL_EMAIL_PATTERN = rf"{URL_PATTERN}|{EMAIL_PATTERN}|{STANDARD_PATTERN}"

# Classic tokenizer alternatives, tried in this order at each position.
CLASSIC_PATTERN = "|".join([
    EMAIL_PATTERN,
    r"\p{L}(?:\.\p{L})+\.?",                     # acronym: U.S.A.
    r"[\p{L}\p{Nd}]+(?:\.[\p{L}\p{Nd}]+)+",      # host / dotted number
    r"\p{L}+(?:'\p{L}+)+",                        # apostrophe: O'Reilly
    r"\p{L}+[&@]\p{L}+",                          # company: AT&T
    r"[\p{L}\p{Nd}]+",                            # alphanumeric
])


def _lit(s: str) -> Column:
    return F.lit(s)


def extract(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in ``text``, left to right."""
    return F.regexp_extract_all(text, _lit(pattern), 0)


def split_long(tokens: Column, max_len: int = MAX_TOKEN_LENGTH) -> Column:
    """Cut tokens longer than ``max_len`` into pieces of ``max_len`` characters."""
    def piece(t):
        n = F.length(t)
        starts = F.sequence(F.lit(0), F.floor((n - 1) / max_len).cast("int"))
        return F.when(n <= max_len, F.array(t)).otherwise(
            F.transform(starts, lambda i: t.substr(i * max_len + 1, F.lit(max_len))))
    # most arrays hold no long token and pass as they are
    return F.get(F.transform(F.array(tokens), lambda a: F.when(F.exists(a, lambda t: F.length(t) > max_len), F.flatten(F.transform(a, piece)))
                             .otherwise(a)), F.lit(0))


def pieces(text: Column) -> Column:
    """What stands between white space: no token of a tokenizer of words reaches from one piece into the next."""
    return F.split(text, r"\s+")


def standard(text: Column) -> Column:
    """Word segmentation (approximation of UAX #29 word boundaries)."""
    return split_long(extract(text, STANDARD_PATTERN))


def letter(text: Column) -> Column:
    """Maximal runs of letters."""
    return extract(text, r"\p{L}+")


def lowercase(text: Column) -> Column:
    """Z3: letter tokenizer over the lower-cased text."""
    return extract(F.lower(text), r"\p{L}+")


def whitespace(text: Column) -> Column:
    """Maximal runs of non-blank characters."""
    return split_long(extract(text, r"\S+"))


def uax_url_email(text: Column) -> Column:
    """URLs and e-mail addresses stay whole, the rest as Z1."""
    return split_long(extract(text, URL_EMAIL_PATTERN))


def classic(text: Column) -> Column:
    """E-mail, acronym, host, apostrophe, company, alphanumeric."""
    return split_long(extract(text, CLASSIC_PATTERN))


def characters(text: Column) -> Column:
    """Code points of the text, in order (one regex pass, no per-position substring)."""
    return extract(text, r"(?s).")


def ngram(text: Column, min_gram: int = 1, max_gram: int = 2) -> Column:
    """All n-grams of the whole text, position-major (a ab b bc c).

    Built from the character array and its shifted copies with ``zip_with``,
    so the cost is linear in the text length (nothing refers back to the whole
    array from inside a per-element lambda).
    """
    if (min_gram, max_gram) != (1, 2):
        raise NotImplementedError("only the default sizes 1..2 are built")
    chars = characters(text)
    # zip_with pads the shorter (shifted) array with a null at the end.
    nxt = F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0)))
    return F.flatten(F.zip_with(chars, nxt, lambda c, d: F.when(d.isNull(), F.array(c))
                                .otherwise(F.array(c, F.concat(c, d)))))


def edge_ngram(text: Column, min_gram: int = 1, max_gram: int = 2) -> Column:
    """Prefixes of the whole text of length min_gram..max_gram."""
    n = F.length(text)
    parts = [F.when(n >= g, F.array(F.substring(text, 1, g))).otherwise(F.array().cast("array<string>"))
             for g in range(min_gram, max_gram + 1)]
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).otherwise(F.flatten(F.array(*parts)))


def keyword(text: Column) -> Column:
    """No tokenizer: the whole text is one token (null stays null)."""
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).otherwise(F.array(text))


TOKENIZERS = {
    "standard": standard,
    "letter": letter,
    "lowercase": lowercase,
    "whitespace": whitespace,
    "uax_url_email": uax_url_email,
    "classic": classic,
    "ngram": ngram,
    "edge_ngram": edge_ngram,
    None: keyword,
    "None": keyword,
    "keyword": keyword,
}
