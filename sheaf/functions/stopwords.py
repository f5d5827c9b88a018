"""Stop-word lists.

Language lists are Spark ML's defaults (the files behind
``StopWordsRemover.loadDefaultStopWords``), kept unchanged as package data in
``sheaf/data/stopwords`` (Apache License 2.0, see the NOTICE there): neither a
jar nor a JVM is needed to build a plan or an oracle. A list is read on first
use, never at import.
"""

from __future__ import annotations

import functools
import os

# The 33-word English stop set used by the `stop` analyzer and
# the `stop` token filter with default parameters.
ENGLISH_STOP_33 = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with").split()

# Languages whose default list ships with Spark ML.
SPARK_LANGUAGES = ("danish dutch english finnish french german hungarian italian "
                   "norwegian portuguese russian spanish swedish turkish").split()

# ISO codes used in the `documents.lang` column.
LANG_CODES = {"en": "english", "fr": "french", "de": "german", "es": "spanish",
              "da": "danish", "nl": "dutch", "fi": "finnish", "hu": "hungarian",
              "it": "italian", "no": "norwegian", "nb": "norwegian", "pt": "portuguese",
              "ru": "russian", "sv": "swedish", "tr": "turkish"}


_DATA = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data", "stopwords")


@functools.lru_cache(maxsize=None)
def default_stop_words(language: str) -> tuple[str, ...]:
    """Spark ML's default list for ``language`` (english, french, ...)."""
    language = LANG_CODES.get(language, language)
    if language not in SPARK_LANGUAGES:
        raise KeyError(f"no default stop list for {language!r}")
    with open(os.path.join(_DATA, f"{language}.txt"), encoding="utf-8") as f:
        words = [w.strip() for w in f]
    return tuple(dict.fromkeys(w for w in words if w))


def stop_words(language: str = "english") -> tuple[str, ...]:
    """Stop set of an analyzer: English is the 33-word set, others Spark's lists."""
    if LANG_CODES.get(language, language) == "english":
        return tuple(ENGLISH_STOP_33)
    return default_stop_words(language)
