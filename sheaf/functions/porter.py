"""Porter (1980) stemmer as chained array transforms.

Each step is one ``transform`` over the token array; steps are chained, never
nested in one lambda, so the expression grows linearly with the number of
steps. Inside a step, conditions are regular expressions: the measure m of a
stem is tested with the patterns below, doubled consonants are listed instead
of using a back-reference. Tokens must be lower case (as for the filter).

Vowel / consonant rule: a, e, i, o, u are vowels; y is a vowel when it follows
a consonant. ``_C`` is a consonant run and ``_V`` a vowel run under that rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_c = "[^aeiou]"            # a consonant at the start of a run
_v = "[aeiouy]"            # a vowel at the start of a run
_C = _c + "[^aeiouy]*"     # consonant run
_V = _v + "[aeiou]*"       # vowel run

M_GT0 = f"^({_C})?{_V}{_C}"                    # m > 0
M_EQ1 = f"^({_C})?{_V}{_C}({_V})?$"            # m = 1
M_GT1 = f"^({_C})?{_V}{_C}{_V}{_C}"            # m > 1
HAS_V = f"^({_C})?{_v}"                        # stem contains a vowel
CVC = f"^{_C}{_v}[^aeiouwxy]$"                 # *o: ends consonant-vowel-consonant, not w x y
DOUBLE = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx|zz)$"
DOUBLE_NOT_LSZ = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"

# Suffix -> replacement of steps 2, 3 and 4 (4 removes).
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "logi": "log",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP4 = ("al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize").split()


def _alt(words) -> str:
    return "|".join(words)


def _stem_of(x: Column, suffix_re: str) -> Column:
    return F.regexp_extract(x, f"^(.+?)({suffix_re})$", 1)


def _suffix_of(x: Column, suffix_re: str) -> Column:
    return F.regexp_extract(x, f"^(.+?)({suffix_re})$", 2)


def _step1a(x: Column) -> Column:
    return (F.when(x.rlike("sses$|ies$"), F.regexp_replace(x, "(ss|i)es$", "$1"))
            .when(x.rlike("[^s]s$"), F.regexp_replace(x, "s$", ""))
            .otherwise(x))


def _step1b(x: Column) -> Column:
    eed_stem = F.regexp_extract(x, "^(.+?)eed$", 1)
    ed_stem = F.regexp_extract(x, "^(.+?)(ed|ing)$", 1)
    return (F.when(x.rlike("^.+?eed$"),
                   F.when(eed_stem.rlike(M_GT0), F.regexp_replace(x, "eed$", "ee")).otherwise(x))
            .when(x.rlike("^.+?(ed|ing)$") & ed_stem.rlike(HAS_V),
                  F.concat(ed_stem, F.lit("\u0001")))      # mark: step 1b cleanup applies
            .otherwise(x))


def _cleanup(x: Column) -> Column:
    s = F.regexp_replace(x, "\u0001$", "")
    marked = x.endswith("\u0001")
    return (F.when(~marked, x)
            .when(s.rlike("(at|bl|iz)$"), F.concat(s, F.lit("e")))
            .when(s.rlike(DOUBLE_NOT_LSZ), F.regexp_replace(s, ".$", ""))
            .when(s.rlike(CVC), F.concat(s, F.lit("e")))
            .otherwise(s))


def _step1c(x: Column) -> Column:
    stem = F.regexp_extract(x, "^(.+?)y$", 1)
    return F.when(x.rlike("^.+?y$") & stem.rlike(HAS_V), F.concat(stem, F.lit("i"))).otherwise(x)


def _map_step(x: Column, table: dict[str, str], cond: str) -> Column:
    suffix_re = _alt(sorted(table, key=len, reverse=True))
    stem = _stem_of(x, suffix_re)
    suf = _suffix_of(x, suffix_re)
    repl = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.when(x.rlike(f"^.+?({suffix_re})$") & stem.rlike(cond),
                  F.concat(stem, F.element_at(repl, suf))).otherwise(x)


def _step2(x: Column) -> Column:
    return _map_step(x, STEP2, M_GT0)


def _step3(x: Column) -> Column:
    return _map_step(x, STEP3, M_GT0)


def _step4(x: Column) -> Column:
    suffix_re = _alt(sorted(STEP4, key=len, reverse=True))
    stem = _stem_of(x, suffix_re)
    ion_stem = F.regexp_extract(x, "^(.+?)ion$", 1)
    return (F.when(x.rlike(f"^.+?({suffix_re})$"),
                   F.when(stem.rlike(M_GT1), stem).otherwise(x))
            .when(x.rlike("^.+?[st]ion$") & ion_stem.rlike(M_GT1), ion_stem)
            .otherwise(x))


def _step5a(x: Column) -> Column:
    stem = F.regexp_extract(x, "^(.+?)e$", 1)
    return F.when(x.rlike("^.+?e$") & (stem.rlike(M_GT1) | (stem.rlike(M_EQ1) & ~stem.rlike(CVC))),
                  stem).otherwise(x)


def _step5b(x: Column) -> Column:
    return F.when(x.rlike("ll$") & x.rlike(M_GT1), F.regexp_replace(x, ".$", "")).otherwise(x)


def _mark(x: Column) -> Column:
    """Words of one or two letters get a sentinel so no rule matches them; an
    initial y is written Y so that it counts as a consonant."""
    return F.when(F.length(x) <= 2, F.concat(x, F.lit("\u0002"))).otherwise(
        F.regexp_replace(x, "^y", "Y"))


def _unmark(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, "\u0002$", ""), "^Y", "y")


# The chain, in order.
STEPS = [_mark, _step1a, _step1b, _cleanup, _step1c, _step2, _step3, _step4, _step5a, _step5b,
         _unmark]


def porter_stem(a: Column) -> Column:
    """Stem every token of an array; one chained ``transform`` per step."""
    for step in STEPS:
        a = F.transform(a, step)
    return a


def porter_steps():
    """The per-word steps, for callers that stem a vocabulary column step by step."""
    return list(STEPS)
