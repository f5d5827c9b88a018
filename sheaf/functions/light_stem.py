"""Light stemmers for French, German and Spanish, pinned.

These follow the published "light" stemming rules for the three languages
(plural and gender endings only), written as one chained ``transform`` per
step like the Porter chain. Tokens must be lower case.

French: words of six letters or more: final ``aux`` -> ``al``; else a final
``x`` is dropped; else drop a final ``s``, then ``r``, then ``e``, then ``é``,
then one letter of a final doubled letter.

German: umlauts fold to the base vowel; then one of ``ern`` (length > 5),
``em en er es`` (length > 4), ``e`` (length > 3), ``s`` after one of
b d f g h k l m n r t (length > 3) is dropped; then one of ``est`` (length > 5),
``er en`` (length > 4), ``st`` after one of b d f g h k l m n t (length > 5).

Spanish: words of five letters or more: accents fold; final ``eses`` -> ``es``,
``ces`` -> ``z``; else a final ``os as es`` is dropped; else a final ``o a e``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _french_steps():
    def s1(x):
        long = F.length(x) >= 6
        return (F.when(~long, x)
                .when(x.endswith("aux"), F.regexp_replace(x, "ux$", "l"))
                .when(x.endswith("x"), F.regexp_replace(x, "x$", ""))
                .otherwise(x))

    def drop(letter):
        # only on words that were >= 6 letters and did not end in x (marked by \u0003)
        return lambda x: F.when(x.endswith(letter + "\u0003"),
                                F.regexp_replace(x, letter + "\u0003$", "\u0003")).otherwise(x)

    def mark(x):
        return F.when((F.length(x) >= 6) & ~x.endswith("x"), F.concat(x, F.lit("\u0003"))).otherwise(x)

    def undouble(x):
        return F.when(x.rlike("(.)\\1\u0003$"), F.regexp_replace(x, ".\u0003$", "\u0003")).otherwise(x)

    def unmark(x):
        return F.regexp_replace(x, "\u0003$", "")
    return [mark, s1, drop("s"), drop("r"), drop("e"), drop("é"), undouble, unmark]


def _german_steps():
    def fold(x):
        return F.translate(x, "äöü", "aou")

    def step1(x):
        n = F.length(x)
        return (F.when((n > 5) & x.endswith("ern"), F.regexp_replace(x, "ern$", ""))
                .when((n > 4) & x.rlike("(em|en|er|es)$"), F.regexp_replace(x, "..$", ""))
                .when((n > 3) & x.endswith("e"), F.regexp_replace(x, "e$", ""))
                .when((n > 3) & x.rlike("[bdfghklmnrt]s$"), F.regexp_replace(x, "s$", ""))
                .otherwise(x))

    def step2(x):
        n = F.length(x)
        return (F.when((n > 5) & x.endswith("est"), F.regexp_replace(x, "est$", ""))
                .when((n > 4) & x.rlike("(er|en)$"), F.regexp_replace(x, "..$", ""))
                .when((n > 5) & x.rlike("[bdfghklmnt]st$"), F.regexp_replace(x, "st$", ""))
                .otherwise(x))
    return [fold, step1, step2]


def _spanish_steps():
    def fold(x):
        return F.when(F.length(x) >= 5, F.translate(x, "áéíóú", "aeiou")).otherwise(x)

    def step(x):
        n = F.length(x)
        return (F.when(n < 5, x)
                .when(x.endswith("eses"), F.regexp_replace(x, "es$", ""))
                .when(x.endswith("ces"), F.regexp_replace(x, "ces$", "z"))
                .when(x.rlike("(os|as|es)$"), F.regexp_replace(x, "..$", ""))
                .when(x.rlike("[oae]$"), F.regexp_replace(x, ".$", ""))
                .otherwise(x))
    return [fold, step]


STEPS = {"french": _french_steps, "german": _german_steps, "spanish": _spanish_steps}


def steps(language: str):
    return STEPS[language]()


def light_stem(a: Column, language: str) -> Column:
    for step in steps(language):
        a = F.transform(a, step)
    return a
