"""Token streams: offsets, positions, gaps and touching tokens."""
import random
import re

from pyspark.sql import functions as F

from sheaf.functions import filters as flt
from sheaf.functions import stream
from sheaf.functions import tokenizers as tok
from sheaf.plans import analyze as an


def rows(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.s for r in df.select("i", column.alias("s")).orderBy("i").collect()]


def test_offsets_against_the_text(spark):
    rng = random.Random(4)
    pieces = ["foo", "Bar's", "3.14", " ", "  ", "\n", "中文", "é😀", "x" * 600, "-", ", ", "a_b", "ひらがな", "한글", "u@v.org"]
    texts = [None, "", " ", "a"] + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 150))) for _ in range(40)]
    for name, plain in (("standard", tok.standard), ("whitespace", tok.whitespace), ("letter", tok.letter), ("uax_url_email", tok.uax_url_email)):
        both = rows(spark, texts, F.struct(stream.tokenize(F.col("t"), name).alias("s"), plain(F.col("t")).alias("a")))
        for text, (s, a) in zip(texts, both):
            assert (s is None) == (text is None)
            if s is not None:
                if name != "letter":
                    assert [x.token for x in s] == a
                assert all(text[x.start:x.end] == x.token for x in s) and [x.position for x in s] == list(range(len(s)))
                assert all(x.end <= y.start for x, y in zip(s, s[1:]))


def test_types(spark):
    (got,) = rows(spark, ["中 word 42 ひら 한글 u@v.org http://a.b/c"], stream.tokenize(F.col("t"), "uax_url_email"))
    assert [x.type for x in got] == ["<IDEOGRAPHIC>", "<ALPHANUM>", "<NUM>", "<KANA>", "<HANGUL>", "<EMAIL>", "<URL>"]


def test_pairs_of_touching_characters_only(spark):
    texts = ["中文字 单", "中 文", "一中文x字单", "ひらがな漢", "abc", "", "中", "中文。字单", None, "한글 말"]
    got = rows(spark, texts, an.tokenize("t", "standard", ["cjk_bigram"]))
    assert got == [["中文", "文字", "单"], ["中", "文"], ["一中", "中文", "x", "字单"], ["ひら", "らが", "がな", "な漢"], ["abc"], [], ["中"], ["中文", "字单"],
                   None, ["한글", "말"]]
    assert rows(spark, ["The ＡＢＣ 中文字 单"], an.analyze("t", "cjk")) == [["abc", "中文", "文字", "单"]]


def test_shingles_over_gaps(spark):
    texts = ["please divide this sentence into words", "the cat", "cat the", "the", "", "a b", None]
    got = rows(spark, texts, an.tokenize("t", "standard", ["lowercase", "stop", "shingle"]))
    assert got[0] == ["please", "please divide", "divide", "divide _", "_ sentence", "sentence", "sentence _", "_ words", "words"]
    assert got[1:] == [["cat"], ["cat"], [], [], ["b"], None]
    (s,) = rows(spark, ["one of two"], an.token_stream("t", "standard", ["stop", "shingle"]))
    assert [(x.token, x.start, x.end, x.position) for x in s] == [
        ("one", 0, 3, 0), ("one _", 0, 3, 0), ("_ two", 7, 10, 1), ("two", 7, 10, 2)]


def test_shingles_without_gaps_equal_the_array_filter(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 40))) for _ in range(30)]
    for s, a in rows(spark, texts, F.struct(stream.tokens(an.token_stream("t", "standard", ["shingle"])), flt.shingle(tok.standard(F.col("t"))))):
        assert s == a


def test_one_to_one_filters_keep_places(spark):
    for name in stream.ONE_TO_ONE:
        (s, a) = rows(spark, ["Çafé the 12 Straße L'eau running"], F.struct(an.token_stream("t", "standard", [name]), flt.FILTERS[name](tok.standard(F.col("t")))))[0]
        assert [x.token for x in s] == a and [x.position for x in s] == list(range(len(a)))


def test_long_text(spark):
    text = "word " * 30000
    (s,) = rows(spark, [text], stream.tokenize(F.col("t")))
    assert len(s) == 30000 and s[-1].start == 149995 and re.fullmatch("word", s[-1].token)


def test_hindi_and_sorani_are_filters():
    assert {"hindi_normalization", "sorani_normalization"} <= set(flt.FILTERS)
