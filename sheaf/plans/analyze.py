"""Analysis pipelines: char filters -> tokenizer -> token filters.

``analyze`` composes the pieces into one Column expression; named analyzers
are presets of the same composition. Per-language analysis (N7-N11) is one
expression with a ``CASE lang`` per step, so a table of mixed languages is
analysed in one pass with no join and no Python.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import filters as flt
from ..functions import html, light_stem, porter, stopwords, stream, suffix_stem, tokenizers as tok


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text, tokenizer: str | None = "standard",
             token_filters: Sequence | None = None,
             char_filters: Sequence[str] | None = None) -> Column:
    """One tokenizer and any number of token filters, in order.

    ``None`` as tokenizer keeps the whole text as one token; ``None`` among
    the filters means no filter at all (as the choice list offers it).
    A filter is a name from ``FILTERS`` or any ``array -> array`` callable.
    """
    s = _as_col(text)
    for cf in char_filters or ():
        s = html.CHAR_FILTERS[cf](s) if isinstance(cf, str) else cf(s)
    if tokenizer not in tok.TOKENIZERS and not callable(tokenizer):
        raise KeyError(f"unknown tokenizer {tokenizer!r}")
    filters = list(token_filters or ())
    if any(f is None or f == "None" for f in filters):
        filters = []
    n = _positional(tokenizer, filters)
    if n:                           # filters that look at gaps, and what comes before them, on a stream
        typed = any(callable(f) for f in filters[:n])       # only a function may look at types
        a = stream.tokens(stream.apply(stream.tokenize(s, tokenizer, typed), filters[:n]))
    else:
        a = tokenizer(s) if callable(tokenizer) else tok.TOKENIZERS[tokenizer](s)
    for f in filters[n:]:
        if callable(f):
            a = f(a)
        elif f in flt.FILTERS:
            a = flt.FILTERS[f](a)
        else:
            raise KeyError(f"unknown token filter {f!r}")
    return a


def _positional(tokenizer, filters: Sequence) -> int:
    """How many of the filters need a token stream: all up to the last that pairs tokens behind one that parts them."""
    pairs = [i for i, f in enumerate(filters) if f == "cjk_bigram" or f == "shingle" and "stop" in filters[:i]]
    n = pairs[-1] + 1 if pairs else 0
    known = not callable(tokenizer) and tokenizer in stream.TOKENIZERS
    return n if known and all(not callable(f) and (f in stream.ONE_TO_ONE or f in stream.POSITIONAL) for f in filters[:n]) else 0


def token_stream(text, tokenizer: str = "standard", token_filters: Sequence = (), typed: bool = True) -> Column:
    """Tokens with offsets, positions and types (null without ``typed``), through filters that keep them."""
    return stream.apply(stream.tokenize(_as_col(text), tokenizer, typed), token_filters)


def joined(tokens: Column, sep: str = " ") -> Column:
    """T5: the token texts joined by one blank."""
    return F.array_join(tokens, sep)


def _stop_en(a):
    return flt.stop(a, stopwords.ENGLISH_STOP_33)


# Named analyzers as (tokenizer, filters).
ANALYZERS = {
    "standard": ("standard", ["lowercase"]),
    "simple": ("letter", ["lowercase"]),
    "whitespace": ("whitespace", []),
    "stop": ("letter", ["lowercase", _stop_en]),
    "pattern": (lambda s: F.filter(F.split(F.lower(s), r"\W+"), lambda x: F.length(x) > 0), []),
    "fingerprint": ("standard", ["lowercase", "asciifolding", lambda a: flt.fingerprint(a, None)]),
    "cjk": ("standard", ["cjk_width", "lowercase", "cjk_bigram", _stop_en]),
}
# Language -> (filters before the stemmer, the stemmer's steps of a word).
STOP_ONLY_LANGUAGES = ("danish dutch finnish hungarian italian norwegian portuguese "
                       "russian swedish turkish").split()


def _stop(language):
    return lambda a: flt.stop(a, language)


LANGUAGES = {
    "english": ([flt.possessive_english, "lowercase", _stop_en], porter.porter_steps),
    "french": (["elision", "lowercase", _stop("french")], lambda: light_stem.steps("french")),
    "german": (["lowercase", _stop("german"), "german_normalization"], lambda: light_stem.steps("german")),
    "spanish": (["lowercase", _stop("spanish")], lambda: light_stem.steps("spanish")),
    **{name: (["lowercase", _stop(name)], functools.partial(suffix_stem.steps, name)) for name in STOP_ONLY_LANGUAGES},
}


def _stemmed(a: Column, language: str) -> Column:
    for step in LANGUAGES[language][1]():
        a = F.transform(a, step)
    return a


for _name, (_before, _) in LANGUAGES.items():
    ANALYZERS[_name] = ("standard", [*_before, functools.partial(_stemmed, language=_name)])

# T4: user-named pipelines; register more with ``register_analyzer``.
CUSTOM_ANALYZERS: dict[str, tuple] = {
    "folded_words": ("standard", ["lowercase", "asciifolding", "unique"]),
}


def register_analyzer(name: str, tokenizer, token_filters, char_filters=()) -> None:
    CUSTOM_ANALYZERS[name] = (tokenizer, list(token_filters), list(char_filters))


def analyze(text, analyzer: str) -> Column:
    """Apply a named (built-in or registered) analyzer."""
    spec = ANALYZERS.get(analyzer) or CUSTOM_ANALYZERS.get(analyzer)
    if spec is None:
        raise KeyError(f"unknown analyzer {analyzer!r}")
    tokenizer, filters = spec[0], spec[1]
    char_filters = spec[2] if len(spec) > 2 else ()
    return tokenize(text, tokenizer, filters, char_filters)


def with_analyzed(df: DataFrame, col: str, analyzer: str, suffix: str = "_analyzed") -> DataFrame:
    """Add ``<col>_analyzed`` (joined tokens) next to the source column."""
    return df.withColumn(f"{col}{suffix}", joined(analyze(col, analyzer)))


def with_tokenized(df: DataFrame, col: str, tokenizer="standard", token_filters=None,
                   suffix: str = "_tokenized") -> DataFrame:
    return df.withColumn(f"{col}{suffix}", joined(tokenize(col, tokenizer, token_filters)))


def with_stripped(df: DataFrame, col: str, suffix: str = "_stripped") -> DataFrame:
    """html_strip only; the text stays one piece."""
    return df.withColumn(f"{col}{suffix}", html.html_strip(F.col(col)))


# N7-N11 in one expression: the language column picks the steps.
LANG_ANALYZER = {"en": "english", "fr": "french", "de": "german", "es": "spanish",
                 "da": "danish", "nl": "dutch", "fi": "finnish", "hu": "hungarian",
                 "it": "italian", "no": "norwegian", "pt": "portuguese", "ru": "russian",
                 "sv": "swedish", "tr": "turkish"}


def by_language(lang: Column, values: dict[str, Column], default: Column) -> Column:
    """The value of a row's language, or the default."""
    out = None
    for code, value in values.items():
        out = F.when(lang == code, value) if out is None else out.when(lang == code, value)
    return default if out is None else out.otherwise(default)


def before_stems(text, lang, languages: Sequence[str] | None = None, default: str = "standard") -> Column:
    """Tokens of each row through its language's filters before the stemmer; the tokenizer runs once."""
    base, lang = tok.standard(_as_col(text)), _as_col(lang)
    codes = list(LANG_ANALYZER) if languages is None else languages
    plain = {c: LANG_ANALYZER[c] for c in codes if LANG_ANALYZER[c] in STOP_ONLY_LANGUAGES}
    own = {}
    for code in codes:
        if code not in plain:
            own[code] = base
            for f in LANGUAGES[LANG_ANALYZER[code]][0]:
                own[code] = flt.FILTERS[f](own[code]) if isinstance(f, str) else f(own[code])
    other = analyze(text, default)
    if plain:       # lowercase, then the language's list: one branch looks the list up
        other = F.when(lang.isin(list(plain)), flt.stop_by_lang(flt.lowercase(base), lang, plain)).otherwise(other)
    return by_language(lang, own, other)


def analyze_by_lang(text, lang, languages: Sequence[str] | None = None,
                    default: str = "standard") -> Column:
    """Analyze each row with the analyzer of its language.

    The tokenizer is shared (standard); each language's filters are one ``CASE``
    branch, and so is its stemmer, over the tokens that are left. Rows of other
    languages, or of none, use ``default``. ``jobs.terms_by_lang`` counts the same
    tokens and stems each distinct one once.
    """
    codes = list(LANG_ANALYZER) if languages is None else list(languages)
    tokens = before_stems(text, lang, codes, default)
    return F.get(F.transform(F.array(tokens), lambda a: by_language(
        _as_col(lang), {c: _stemmed(a, LANG_ANALYZER[c]) for c in codes}, a)), F.lit(0))
