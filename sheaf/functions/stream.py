"""Token streams: tokens with offsets, positions and types.

A stream is ``array<struct<token, start, end, position, type>>``: ``start`` and
``end`` are code points of the text (end exclusive), ``position`` counts the
tokens that the tokenizer made, so a filter that drops tokens leaves a gap. What
an array of strings cannot tell, a stream can: whether two tokens touch, and
whether something stood between them.

Everything is one expression per row, as for plain tokens. Offsets come from the
lengths from match to match; their running sum is taken in blocks of blocks, so a
long text costs a bounded number of steps per token. A null text gives a null stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import filters as flt
from . import stopwords
from . import tokenizers as tok

#: The running sum is taken over blocks of four, over blocks of four such blocks, and so on, this many times.
_LEVELS = 5

_HAN, _KANA = r"\p{IsHan}", r"[\p{IsHiragana}\p{IsKatakana}]"
_CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"

#: Tokenizers by pattern, and what is done to their tokens at once.
TOKENIZERS = {
    "standard": (tok.STANDARD_PATTERN, ()), "uax_url_email": (tok.URL_EMAIL_PATTERN, ()), "classic": (tok.CLASSIC_PATTERN, ()),
    "letter": (r"\p{L}+", ()), "lowercase": (r"\p{L}+", ("lowercase",)), "whitespace": (r"\S+", ()),
}
#: Filters of tokens one by one: they keep the array's length, so offsets and positions stay.
ONE_TO_ONE = ("asciifolding cjk_width classic decimal_digit elision lowercase porter_stem reverse stemmer trim truncate uppercase "
              "arabic_normalization german_normalization hindi_normalization persian_normalization scandinavian_normalization "
              "scandinavian_folding serbian_normalization sorani_normalization").split()


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _token(token: Column, start: Column, end: Column, position: Column, kind: Column) -> Column:
    return F.struct(token.alias("token"), start.cast("int").alias("start"), end.cast("int").alias("end"),
                    position.cast("int").alias("position"), kind.alias("type"))


def _ends(lengths: Column) -> Column:
    """For each of ``lengths`` the sum up to and with it."""
    def few(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x)))

    def many(values: Column, levels: int) -> Column:
        if levels == 0:
            return few(values)
        at = lambda i: F.coalesce(F.get(values, i), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(values), 2)), lambda b: at(b * 4) + at(b * 4 + 1) + at(b * 4 + 2) + at(b * 4 + 3))

        def of(before: Column) -> Column:       # what the blocks before it hold, and its own block's items up to it
            def end(x: Column, i: Column) -> Column:
                own, back = i.bitwiseAND(3), lambda k: F.get(values, i - k)
                head = x + F.coalesce(F.get(before, F.shiftright(i, 2) - 1), F.lit(0))
                return (F.when(own == 0, head).when(own == 1, head + back(1)).when(own == 2, head + back(1) + back(2))
                        .otherwise(head + back(1) + back(2) + back(3)))
            return F.transform(values, end)
        return _let(_let(blocks, lambda b: many(b, levels - 1)), of)
    return F.when(F.size(lengths) <= 16, few(lengths)).otherwise(many(lengths, _LEVELS))


def _kind(token: Column) -> Column:
    return (F.when(token.rlike(r"^\p{IsLatin}[^:@]*$"), "<ALPHANUM>").when(token.rlike(r"^\p{Nd}[^:@]*$"), "<NUM>")
            .when(token.rlike(f"^{_HAN}$"), "<IDEOGRAPHIC>").when(token.rlike(f"^{_KANA}+$"), "<KANA>").when(token.rlike(r"^\p{IsHangul}+$"), "<HANGUL>")
            .when(token.rlike(f"^(?:{tok.URL_PATTERN})$"), "<URL>").when(token.rlike(f"^(?:{tok.EMAIL_PATTERN})$"), "<EMAIL>")
            .when(token.rlike(r"^\p{Nd}"), "<NUM>").otherwise("<ALPHANUM>"))


def spans(text: Column, pattern: str, max_len: int = tok.MAX_TOKEN_LENGTH, typed: bool = True) -> Column:
    """The stream of all matches of a pattern; matches beyond ``max_len`` are cut into tokens of that length.

    Where nobody reads the types, ``typed=False`` leaves them null and saves up to eight matches per token.
    """
    kind = _kind if typed else lambda _: F.lit(None).cast("string")

    def cut(t: Column, start: Column) -> Column:
        piece = lambda i: F.substring(t, i * max_len + 1, F.lit(max_len))
        return F.transform(F.sequence(F.lit(0), F.floor((F.length(t) - 1) / max_len).cast("int")), lambda i: _token(
            piece(i), start + i * max_len, start + i * max_len + F.length(piece(i)), F.lit(0), kind(piece(i))))

    def placed(found: Column) -> Column:
        def of(ends: Column) -> Column:
            plain = F.transform(found, lambda t, i: _token(t, F.get(ends, i) - F.length(t), F.get(ends, i), i, kind(t)))
            long = F.flatten(F.transform(found, lambda t, i: cut(t, F.get(ends, i) - F.length(t))))
            numbered = F.transform(long, lambda x, i: _token(x["token"], x["start"], x["end"], i, x["type"]))
            return F.when(F.exists(found, lambda t: F.length(t) > max_len), numbered).otherwise(plain)
        # each match with what stands before it, and at last the rest of the text
        reach = F.transform(tok.extract(text, rf"(?s:.*?)(?:{pattern}|\z)"), F.length)
        return _let(_let(reach, lambda n: _ends(n)), of)
    return F.when(text.isNotNull(), _let(tok.extract(text, pattern), placed))


def tokenize(text: Column, tokenizer: str = "standard", typed: bool = True) -> Column:
    """The stream of a tokenizer; without ``typed``, its types are null."""
    if tokenizer not in TOKENIZERS:
        raise KeyError(f"tokenizer {tokenizer!r} has no stream")
    pattern, after = TOKENIZERS[tokenizer]
    out = spans(text, pattern, typed=typed)
    for name in after:
        out = per_token(out, flt.FILTERS[name])
    return out


def tokens(stream: Column) -> Column:
    """The texts of a stream."""
    return F.transform(stream, lambda x: x["token"])


def per_token(stream: Column, fn: Callable[[Column], Column]) -> Column:
    """A filter of tokens one by one (an array function that keeps the length); offsets and positions stay."""
    return _let(stream, lambda s: F.zip_with(s, fn(tokens(s)), lambda x, t: _token(t, x["start"], x["end"], x["position"], x["type"])))


def stop(stream: Column, words: Iterable[str] | str = "english") -> Column:
    """drop stop words; the positions of the others stay, so gaps show."""
    kept = list(stopwords.stop_words(words) if isinstance(words, str) else words)
    return F.filter(stream, lambda x: ~x["token"].isin(kept))


def _after(stream: Column) -> Column:
    """The stream without its first token: beside the stream, each token's next one."""
    return F.slice(stream, F.lit(2), F.size(stream))


def shingle(stream: Column, separator: str = " ", filler: str = "_", unigrams: bool = True) -> Column:
    """tokens and 2-token shingles in the order of the text; where tokens were dropped, the filler stands in.
    Without ``unigrams``, the shingles alone.

    ``a [gap] b`` gives ``a``, ``a _``, ``_ b``, ``b``. A shingle that the filler
    begins has the position before its token, and the token's offsets.
    """
    def of(x: Column, n: Column) -> Column:
        join = lambda a, b: F.concat(a, F.lit(separator), b)
        fill, kind = F.lit(filler), F.lit("shingle")
        own = [x] if unigrams else []
        whole = F.array(*own, _token(join(x["token"], n["token"]), x["start"], n["end"], x["position"], kind))
        gap = F.array(*own, _token(join(x["token"], fill), x["start"], x["end"], x["position"], kind),
                      _token(join(fill, n["token"]), n["start"], n["end"], n["position"] - 1, kind))
        last = F.array(x) if unigrams else F.filter(F.array(x), lambda _: F.lit(False))
        return F.when(n.isNull(), last).when(n["position"] == x["position"] + 1, whole).otherwise(gap)
    return _let(stream, lambda s: F.flatten(F.zip_with(s, _after(s), of)))


def cjk_bigram(stream: Column) -> Column:
    """CJK characters that touch become overlapping pairs; one alone stays, other tokens pass.

    ``中文字 单`` gives ``中文``, ``文字``, ``单``: a blank, a dropped token or another
    token between two characters parts them. Words of several CJK characters
    are taken apart first.
    """
    def several(x: Column) -> Column:
        n = F.length(x["token"])
        return (n > 1) & (n == x["end"] - x["start"]) & x["token"].rlike(f"^{_CJK}{{2,}}$")

    def single(x: Column) -> Column:
        letters = F.transform(F.sequence(F.lit(1), F.length(x["token"])), lambda i: _token(
            F.substring(x["token"], i, F.lit(1)), x["start"] + i - 1, x["start"] + i, x["position"], x["type"]))
        return F.when(several(x), letters).otherwise(F.array(x))

    def touch(x: Column, n: Column) -> Column:
        cjk = lambda t: t["token"].rlike(f"^{_CJK}$")
        return F.coalesce((x["end"] == n["start"]) & cjk(x) & cjk(n), F.lit(False))

    def paired(s: Column) -> Column:
        def of(touches: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                n = F.get(s, i + 1)
                pair = _token(F.concat(x["token"], n["token"]), x["start"], n["end"], x["position"], F.lit("<DOUBLE>"))
                return F.when(F.get(touches, i), pair).when(~F.coalesce(F.get(touches, i - 1), F.lit(False)), x)
            return F.filter(F.transform(s, one), lambda x: x.isNotNull())
        return _let(F.zip_with(s, _after(s), touch), of)
    return _let(_let(stream, lambda s: F.when(F.exists(s, several), F.flatten(F.transform(s, single))).otherwise(s)), paired)


#: Filters that look at offsets or positions, or drop tokens.
POSITIONAL = {"cjk_bigram": cjk_bigram, "shingle": shingle, "stop": stop}


def apply(stream: Column, filters: Sequence) -> Column:
    """Filters by name (``ONE_TO_ONE`` and ``POSITIONAL``), or functions of streams, in order."""
    for f in filters:
        if callable(f):
            stream = f(stream)
        elif f in POSITIONAL:
            stream = POSITIONAL[f](stream)
        elif f in ONE_TO_ONE:
            stream = per_token(stream, flt.FILTERS[f])
        else:
            raise KeyError(f"filter {f!r} has no stream form")
    return stream
