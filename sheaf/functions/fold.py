"""Character folding profiles as one operator.

A profile is a list of steps, each one of
  ("map", from_chars, to_chars)   one character to one (or to nothing) -> translate
  ("sub", pattern, replacement)   a regular-expression rewrite        -> regexp_replace
``fold_chars(tokens, profile)`` applies the steps to every token, in order.
Large tables are built from a rule over the Unicode database, not listed.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that do not decompose to an ASCII base and their folds.
ASCII_SPECIALS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "TH",
    "ı": "i", "ŋ": "n", "Ŋ": "N", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ŀ": "l", "Ŀ": "L", "ŉ": "n",
    "ĸ": "q", "ſ": "s", "ƒ": "f", "ǝ": "e", "ə": "e", "Ə": "E",
}

# Latin blocks whose letters are folded by the decomposition rule.
_LATIN_RANGES = [(0x00C0, 0x024F), (0x1E00, 0x1EFF)]


@functools.lru_cache(maxsize=None)
def _ascii_fold_table() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from, to) for one-to-one folds, and the one-to-many pairs."""
    src, dst, multi = [], [], []
    for lo, hi in _LATIN_RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            if ch in ASCII_SPECIALS:
                continue
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if ord(c) < 128)
            if len(base) == 1 and base.isalpha():
                src.append(ch)
                dst.append(base)
    full, plain = _full_width_table()
    src += full
    dst += plain
    for ch, rep in ASCII_SPECIALS.items():
        if len(rep) == 1:
            src.append(ch)
            dst.append(rep)
        else:
            multi.append((ch, rep))
    return "".join(src), "".join(dst), tuple(multi)


def _full_width_table() -> tuple[str, str]:
    """Full-width ASCII variants U+FF01..U+FF5E -> U+0021..U+007E (offset rule)."""
    src = "".join(chr(cp) for cp in range(0xFF01, 0xFF5F))
    dst = "".join(chr(cp - 0xFEE0) for cp in range(0xFF01, 0xFF5F))
    return src, dst


def _half_width_kana() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Half-width katakana -> full width (compatibility mapping), then voiced-mark composition."""
    src, dst = [], []
    for cp in range(0xFF61, 0xFFA0):
        ch = chr(cp)
        full = unicodedata.normalize("NFKC", ch)
        if len(full) == 1 and full != ch:
            src.append(ch)
            dst.append(full)
    # A kana followed by a combining voiced / semi-voiced mark composes to one letter.
    pairs = []
    for mark_hw, mark in (("ﾞ", "゙"), ("ﾟ", "゚")):
        for cp in range(0x30A1, 0x30FB):
            k = chr(cp)
            composed = unicodedata.normalize("NFC", k + mark)
            if len(composed) == 1:
                pairs.append((k + mark, composed))
    return "".join(src), "".join(dst), tuple(pairs)


@functools.lru_cache(maxsize=None)
def _decimal_digits() -> tuple[str, str]:
    """Every Unicode decimal digit outside ASCII -> its ASCII digit (category Nd rule)."""
    import sys
    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


# Serbian Cyrillic (lower case) to "bald" Latin, and Latin with
# diacritics to bald Latin.
SERBIAN = [
    ("а", "a"), ("б", "b"), ("в", "v"), ("г", "g"), ("д", "d"), ("ђ", "dj"), ("е", "e"),
    ("ж", "z"), ("з", "z"), ("и", "i"), ("ј", "j"), ("к", "k"), ("л", "l"), ("љ", "lj"),
    ("м", "m"), ("н", "n"), ("њ", "nj"), ("о", "o"), ("п", "p"), ("р", "r"), ("с", "s"),
    ("т", "t"), ("ћ", "c"), ("у", "u"), ("ф", "f"), ("х", "h"), ("ц", "c"), ("ч", "c"),
    ("џ", "dz"), ("ш", "s"), ("ć", "c"), ("č", "c"), ("đ", "dj"), ("š", "s"), ("ž", "z"),
]

# Arabic normalization. Alef with madda / hamza above / hamza below
# -> alef; alef maksura -> yeh; teh marbuta -> heh; tatweel and the harakat
# U+064B..U+0652 are removed.
ARABIC_MAP = ("آأإىة", "ااايه")
ARABIC_DROP = "ـ" + "".join(chr(c) for c in range(0x064B, 0x0653))

# Persian normalization. Farsi yeh and yeh barree -> yeh, keheh -> kaf,
# heh with yeh above and heh goal -> heh; hamza above is removed.
PERSIAN_MAP = ("یےکۀہ", "ييكهه")
PERSIAN_DROP = "ٔ"


# Hindi normalization (code points). Letters with a dot below -> without; candra and
# short e / o -> e / o; long vowels and vowel signs -> short ones; candrabindu -> anusvara. The dot
# below, the virama and the joiners are removed; na + virama becomes anusvara first.
HINDI_MAP = {
    0x0929: 0x0928, 0x0931: 0x0930, 0x0934: 0x0933, 0x0958: 0x0915, 0x0959: 0x0916, 0x095A: 0x0917, 0x095B: 0x091C,
    0x095C: 0x0921, 0x095D: 0x0922, 0x095E: 0x092B, 0x095F: 0x092F, 0x0901: 0x0902, 0x0945: 0x0947, 0x0946: 0x0947,
    0x0949: 0x094B, 0x094A: 0x094B, 0x090D: 0x090F, 0x090E: 0x090F, 0x0911: 0x0913, 0x0912: 0x0913, 0x0972: 0x0905,
    0x0906: 0x0905, 0x0908: 0x0907, 0x090A: 0x0909, 0x0960: 0x090B, 0x0961: 0x090C, 0x0910: 0x090F, 0x0914: 0x0913,
    0x0940: 0x093F, 0x0942: 0x0941, 0x0944: 0x0943, 0x0963: 0x0962, 0x0948: 0x0947, 0x094C: 0x094B,
}
HINDI_DROP = "\u093c\u094d\u200c\u200d"

# Sorani normalization. Arabic yeh and alef maksura -> Farsi yeh; kaf -> keheh; teh marbuta -> ae;
# heh doachashmee -> heh; reh with small v above -> reh with small v below. Tatweel, harakat and joiners go.
SORANI_MAP = ("\u064a\u0649\u0643\u0629\u06be\u0692", "\u06cc\u06cc\u06a9\u06d5\u0647\u0695")
SORANI_DROP = "\u0640\u200c" + "".join(chr(c) for c in range(0x064B, 0x0653))


def _serbian_steps():
    one = [(a, b) for a, b in SERBIAN if len(b) == 1]
    many = [(a, b) for a, b in SERBIAN if len(b) > 1]
    steps = [("sub", a, b) for a, b in many]
    steps.append(("map", "".join(a for a, _ in one), "".join(b for _, b in one)))
    return steps


def profile(name: str) -> list[tuple[str, str, str]]:
    """The steps of a named fold profile."""
    if name == "asciifolding":
        src, dst, multi = _ascii_fold_table()
        return [("sub", a, b) for a, b in multi] + [("map", src, dst)]
    if name == "cjk_width":
        fs, fd = _full_width_table()
        ks, kd, pairs = _half_width_kana()
        return [("map", fs + ks, fd + kd)] + [("sub", a, b) for a, b in pairs]
    if name == "decimal_digit":
        s, d = _decimal_digits()
        return [("map", s, d)]
    if name == "german_normalization":
        # ae / oe -> a / o; ue -> u unless after a vowel, y, q or an umlaut;
        # then umlauts -> base vowel and sharp s -> ss.
        return [("sub", "([ao])e", "$1"),
                ("sub", "(^|[^aeiouyqäöü])ue", "$1u"),
                ("sub", "ß", "ss"),
                ("map", "äöü", "aou")]
    if name == "scandinavian_normalization":
        return [("sub", "a[aAoO]", "å"), ("sub", "A[aAoO]", "Å"),
                ("sub", "a[eE]", "æ"), ("sub", "A[eE]", "Æ"),
                ("sub", "o[eEoO]", "ø"), ("sub", "O[eEoO]", "Ø"),
                ("map", "äÄöÖ", "æÆøØ")]
    if name == "scandinavian_folding":
        return [("sub", "([aA])[aAeEoO]", "$1"), ("sub", "([oO])[eEoO]", "$1"),
                ("map", "åäæÅÄÆöøÖØ", "aaaAAAooOO")]
    if name == "arabic_normalization":
        return [("map", ARABIC_MAP[0] + ARABIC_DROP, ARABIC_MAP[1])]
    if name == "persian_normalization":
        return [("map", PERSIAN_MAP[0] + PERSIAN_DROP, PERSIAN_MAP[1])]
    if name == "hindi_normalization":
        return [("sub", "\u0928\u094d", "\u0902"),
                ("map", "".join(map(chr, HINDI_MAP)) + HINDI_DROP, "".join(map(chr, HINDI_MAP.values())))]
    if name == "sorani_normalization":
        # heh before a non-joiner or at the end of a word is the vowel ae; a first reh is the rolled one
        return [("sub", "\u0647\u200c", "\u06d5"), ("sub", "\u0647$", "\u06d5"), ("sub", "^\u0631", "\u0695"),
                ("map", SORANI_MAP[0] + SORANI_DROP, SORANI_MAP[1])]
    if name == "serbian_normalization":
        return _serbian_steps()
    raise KeyError(f"unknown fold profile {name!r}")


PROFILES = ("asciifolding cjk_width decimal_digit german_normalization "
            "scandinavian_normalization scandinavian_folding arabic_normalization "
            "persian_normalization serbian_normalization hindi_normalization "
            "sorani_normalization").split()


_REGEX_META = set("\\^$.|?*+()[]{}")


def fold_string(s: Column, steps) -> Column:
    for kind, a, b in steps:
        if kind == "map":
            s = F.translate(s, a, b)
        elif not (_REGEX_META & set(a)) and "$" not in b:
            s = F.replace(s, F.lit(a), F.lit(b))     # a literal rewrite: no regex engine
        else:
            s = F.regexp_replace(s, a, b)
    return s


def fold_chars(tokens: Column, name_or_steps) -> Column:
    """Apply a fold profile to every token of an array column."""
    steps = profile(name_or_steps) if isinstance(name_or_steps, str) else name_or_steps
    return F.transform(tokens, lambda t: fold_string(t, steps))


def profile_table(name: str) -> list[tuple[str, str]]:
    """The profile as (from, to) pairs, for docs and tests."""
    out = []
    for kind, a, b in profile(name):
        if kind == "map":
            out.extend((x, b[i] if i < len(b) else "") for i, x in enumerate(a))
        else:
            out.append((a, b))
    return out
