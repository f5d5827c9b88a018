"""Hand fixtures for scripts and rules the driver tables do not hold (FIXTURES.md)."""
import pytest
from pyspark.sql import functions as F

from sheaf.functions import filters as flt
from sheaf.functions import fold, html, porter
from sheaf.functions import tokenizers as tok
from sheaf.plans import analyze as an


def one(spark, expr, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expr(F.col("t")).alias("r")).first()["r"]


def tokens(spark, text, tokenizer="standard", filters=()):
    return one(spark, lambda c: an.tokenize(c, tokenizer, list(filters)), text)


# fold_words: one row per changed letter of each profile
FOLD_WORDS = [
    ("asciifolding", "café", "cafe"), ("asciifolding", "straße", "strasse"),
    ("asciifolding", "œuvre", "oeuvre"), ("asciifolding", "Ærø", "AEro"), ("asciifolding", "łódź", "lodz"),
    ("cjk_width", "ＡＢＣ１", "ABC1"), ("cjk_width", "ｶﾀｶﾅ", "カタカナ"), ("cjk_width", "ｶﾞ", "ガ"),
    ("decimal_digit", "٣٤", "34"), ("decimal_digit", "१२३", "123"),
    ("german_normalization", "häuser", "hauser"), ("german_normalization", "strasse", "strasse"),
    ("german_normalization", "weiß", "weiss"), ("german_normalization", "schoen", "schon"),
    ("german_normalization", "blaue", "blaue"), ("german_normalization", "mueller", "muller"),
    ("german_normalization", "quelle", "quelle"),
    ("scandinavian_normalization", "räksmörgås", "ræksmørgås"), ("scandinavian_normalization", "blaabær", "blåbær"),
    ("scandinavian_normalization", "oe", "ø"),
    ("scandinavian_folding", "räksmörgås", "raksmorgas"), ("scandinavian_folding", "blaabær", "blabar"),
    ("arabic_normalization", "أحمد", "احمد"), ("arabic_normalization", "مدرسة", "مدرسه"),
    ("arabic_normalization", "مُحَمَّد", "محمد"), ("arabic_normalization", "كتـــاب", "كتاب"),
    ("persian_normalization", "کتاب", "كتاب"), ("persian_normalization", "ی", "ي"),
    ("serbian_normalization", "ђак", "djak"), ("serbian_normalization", "љубав", "ljubav"),
    ("serbian_normalization", "čačak", "cacak"),
]


@pytest.mark.parametrize("profile,word,expected", FOLD_WORDS)
def test_fold_profiles(spark, profile, word, expected):
    assert one(spark, lambda c: fold.fold_chars(F.array(c), profile), word) == [expected]


# porter_words: examples printed in Porter (1980), one per rule
PORTER_WORDS = [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("caress", "caress"), ("cats", "cat"),
    ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"),
    ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
    ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"), ("falling", "fall"), ("hissing", "hiss"),
    ("fizzed", "fizz"), ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
    ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"), ("valenci", "valenc"),
    ("hesitanci", "hesit"), ("digitizer", "digit"), ("conformabli", "conform"), ("radicalli", "radic"),
    ("differentli", "differ"), ("vileli", "vile"), ("analogousli", "analog"),
    ("vietnamization", "vietnam"), ("predication", "predic"), ("operator", "oper"),
    ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"),
    ("callousness", "callous"), ("formaliti", "formal"), ("sensitiviti", "sensit"),
    ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("formative", "form"),
    ("formalize", "formal"), ("electriciti", "electr"), ("electrical", "electr"), ("hopeful", "hope"),
    ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"),
    ("airliner", "airlin"), ("gyroscopic", "gyroscop"), ("adjustable", "adjust"),
    ("defensible", "defens"), ("irritant", "irrit"), ("replacement", "replac"),
    ("adjustment", "adjust"), ("dependent", "depend"), ("adoption", "adopt"), ("homologou", "homolog"),
    ("communism", "commun"), ("activate", "activ"), ("angulariti", "angular"),
    ("homologous", "homolog"), ("effective", "effect"), ("bowdlerize", "bowdler"),
    ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"),
    ("roll", "roll"), ("generalizations", "gener"), ("oscillators", "oscil"), ("yelling", "yell"),
]


def test_porter_words(spark):
    words = [w for w, _ in PORTER_WORDS]
    df = spark.createDataFrame([(words,)], "a array<string>")
    got = df.select(porter.porter_stem(F.col("a")).alias("s")).first()["s"]
    assert got == [e for _, e in PORTER_WORDS]


def test_standard_tokenizer_rules(spark):
    t = "U.S.A mail2.example.com 3.14 1,000 thwhhe.68 don't l'homme 漢字 ab_cd"
    assert tokens(spark, t, "standard", []) == [
        "U.S.A", "mail2", "example.com", "3.14", "1,000", "thwhhe", "68", "don't", "l'homme",
        "漢", "字", "ab_cd"]


def test_long_tokens_are_split(spark):
    assert [len(x) for x in tokens(spark, "a" * 600, "standard", [])] == [255, 255, 90]


# url_text
def test_url_email_and_classic(spark):
    t = "see https://example.com/a?b=1. mail john.doe@example.org now, U.S.A. O'Reilly AT&T"
    assert tokens(spark, t, "uax_url_email", []) == [
        "see", "https://example.com/a?b=1", "mail", "john.doe@example.org", "now", "U.S.A",
        "O'Reilly", "AT", "T"]
    assert tokens(spark, t, "classic", ["classic"]) == [
        "see", "https", "example.com", "a", "b", "1", "mail", "john.doe@example.org", "now", "USA",
        "O'Reilly", "AT&T"]


def test_ngrams_and_shingles(spark):
    assert one(spark, tok.ngram, "abc") == ["a", "ab", "b", "bc", "c"]
    assert one(spark, tok.ngram, "") == []
    assert one(spark, tok.edge_ngram, "abc") == ["a", "ab"]
    assert tokens(spark, "abc de", "whitespace", ["ngram"]) == ["a", "ab", "b", "bc", "c", "d", "de", "e"]
    assert tokens(spark, "abc de", "whitespace", ["edge_ngram"]) == ["a", "ab", "d", "de"]
    assert tokens(spark, "a b c", "whitespace", ["shingle"]) == ["a", "a b", "b", "b c", "c"]
    assert tokens(spark, "", "whitespace", ["shingle"]) == []


def test_simple_filters(spark):
    t = "The Quick quick brown Fox's"
    assert tokens(spark, t, "standard", ["lowercase", "stop"]) == ["quick", "quick", "brown", "fox's"]
    assert tokens(spark, t, "standard", ["lowercase", "unique"]) == ["the", "quick", "brown", "fox's"]
    assert tokens(spark, t, "standard", ["limit"]) == ["The"]
    assert tokens(spark, t, "standard", ["uppercase", "reverse"]) == ["EHT", "KCIUQ", "KCIUQ", "NWORB", "S'XOF"]
    assert tokens(spark, "abcdefghijklm", "standard", ["truncate"]) == ["abcdefghij"]
    assert tokens(spark, t, "standard", ["lowercase", "fingerprint"]) == ["brown fox's quick the"]
    assert tokens(spark, "Wi-Fi PowerShot500 O'Neil's", "whitespace", ["word_delimiter"]) == [
        "Wi", "Fi", "Power", "Shot", "500", "O", "Neil"]
    assert tokens(spark, "l'avion qu'il jusqu'ici aujourd'hui", "standard", ["elision"]) == [
        "avion", "il", "ici", "aujourd'hui"]
    assert tokens(spark, "click|3 view", "whitespace", ["delimited_payload"]) == ["click", "view"]


def test_trim_and_none(spark):
    assert one(spark, lambda c: flt.trim(F.array(c)), "  padded \t") == ["padded"]
    assert tokens(spark, "Whole Text", None, ["lowercase"]) == ["whole text"]
    assert tokens(spark, "Whole Text", "whitespace", ["lowercase", None]) == ["Whole", "Text"]
    assert one(spark, lambda c: an.tokenize(c, "standard", ["lowercase"]), None) is None


# cjk_text
def test_cjk(spark):
    # named pipelines pair characters that touch in the text (on a token stream)
    assert tokens(spark, "中文字 单", "standard", ["cjk_bigram"]) == ["中文", "文字", "单"]
    assert tokens(spark, "中 abc 文", "standard", ["cjk_bigram"]) == ["中", "abc", "文"]
    assert tokens(spark, "abc 中", "standard", ["cjk_bigram"]) == ["abc", "中"]
    assert one(spark, lambda c: an.analyze(c, "cjk"), "ＡＢＣ 中文 the") == ["abc", "中文"]


# multilang_stops
@pytest.mark.parametrize("lang,text,gone", [
    ("danish", "og hund", "og"), ("dutch", "de hond", "de"), ("finnish", "ja koira", "ja"),
    ("hungarian", "a kutya", "a"), ("italian", "il cane", "il"), ("norwegian", "og hund", "og"),
    ("portuguese", "o cão", "o"), ("russian", "и собака", "и"), ("swedish", "och hund", "och"),
    ("turkish", "ve köpek", "ve")])
def test_stop_only_languages(spark, lang, text, gone):
    out = one(spark, lambda c: an.analyze(c, lang), text)
    assert gone not in out and len(out) == 1


def test_english_analyzer(spark):
    assert one(spark, lambda c: an.analyze(c, "english"), "The runner's shoes were running") == [
        "runner", "shoe", "were", "run"]


# html_text
def test_html_strip(spark):
    h = ("<html><head><script>var t=\"</p>\";</script><style>p{}</style></head><body><!-- c -->"
         "<p>One <b>bold</b>&nbsp;&#65;&#x42;</p><div>x &amp;lt; y</div></body></html>")
    # html, head, /head, body, p -> five breaks; /p, div; /div, /body, /html -> three
    assert one(spark, html.html_strip, h) == "\n\n\n\n\nOne bold\xa0AB\n\nx &lt; y\n\n\n"


@pytest.mark.parametrize("name", sorted(k for k in tok.TOKENIZERS if k not in (None, "None", "keyword")))
def test_tokenizers_null_and_empty(spark, name):
    df = spark.createDataFrame([(None,), ("",), ("   ",)], "t string")
    got = [r[0] for r in df.select(tok.TOKENIZERS[name](F.col("t"))).collect()]
    assert got[0] is None
    assert got[1] == []
    assert all(x.strip() == "" for x in got[2]) if name in ("ngram", "edge_ngram") else got[2] == []


@pytest.mark.parametrize("name", sorted(flt.FILTERS))
def test_filters_null_and_empty_arrays(spark, name):
    df = spark.createDataFrame([(None,), ([],)], "a array<string>")
    got = [r[0] for r in df.select(flt.FILTERS[name](F.col("a"))).collect()]
    assert got[0] is None
    assert got[1] == []


def test_html_text_between_brackets_and_entities(spark):
    from sheaf.functions import html
    cases = {"a < b > c": "a < b > c", "x<b>y</b>z": "xyz", "<!doctype html>t<?pi?>": "t", "&eacute;&Uuml;&nbsp;&unknown;": "éÜ\xa0&unknown;",
             "&amp;lt; &#38;lt;": "&lt; &lt;", "&#00000000065;&#x000000042;": "AB", "&#xFFFFFFFFFFFFFFFFFF;&#0;": "��", "5 &lt 6 & 7": "5 < 6 & 7",
             '<a title="x > y">t</a>': "t", "<a title='x > y' b=\"'>\">t</a>": "t", '<a title="x>t</a> u': "t u", "don't <b>do</b> it's": "don't do it's",
             "a<script>if (a<b) '</p>'": "a", "a<style >x": "a", "a<!-- x > y": "a", "a<script-x>b</script-x>": "ab", "<p-x>a<p/>b": "a\nb",
             "<SCRIPT src='>'>x</ScRiPt >y": "y", "&check;&notit;&notin;&copy2&Aacutex&#65 &#x42": "✓¬it;∉©2Áx" + "A B", "&NotEqualTilde;": "≂̸",
             "<!-- a --><!-- b -->c": "c", "x" * 9 + "<p " + "a='>' " * 20000 + ">y": "x" * 9 + "\ny", "<div>": "\n", "": "", "&": "&", "&;<": "&;<"}
    df = spark.createDataFrame(list(cases.items()), "html string, want string")
    from pyspark.sql import functions as F
    for r in df.select("html", "want", html.html_strip(F.col("html")).alias("got")).collect():
        assert r.got == r.want, r.html


@pytest.mark.parametrize("profile,word,want", [
    ("asciifolding", "ŋＡＢｃŊ１", "nABcN1"), ("persian_normalization", "ےی", "يي"),
    ("hindi_normalization", "अँगरेज़ी", "अंगरेजि"), ("hindi_normalization", "अन्गरेज़ी", "अंगरेजि"), ("hindi_normalization", "आईऊॐ", "अइउॐ"),
    ("sorani_normalization", "يىكـً", "ییک"), ("sorani_normalization", "ره", "ڕە"),
    ("sorani_normalization", "ه‌اھة", "ەاهە")])
def test_more_folds(spark, profile, word, want):
    from sheaf.functions import fold
    df = spark.createDataFrame([([word],)], "t array<string>")
    assert df.select(fold.fold_chars(F.col("t"), profile)).first()[0] == [want]
