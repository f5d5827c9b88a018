"""Jobs that count the pieces between white space first give what tokenizing every row gives, and tokenize less."""

import pytest
from pyspark.sql import functions as F

from sheaf import catalog
from sheaf.functions import porter, tokenizers as tok
from sheaf.plans import analyze as an, jobs

TEXTS = ["don't 3.14 a_b  U.S.A.\tcafé's\n中文字 单 中a文", " lead and trail ", "x", "", None, "  ", "a  b", "ΑΣ Σ ΟΔΟΣ", "－Ａｂ ｶﾞ ｶ ﾞ",
         "l'été 中文，字。日本語テスト", "w" * 600 + " " + "é" * 255, "one two three", "-- ,, ''", "running runs; The Running\u000bthe", "😀a 😀",
         "visit https://a.b/c?d=e. mail x.y@z.org AT&T", "i̇ İstanbul STRASSE", "a:b 1,2;3'4", "line\nbreak\r\nend\n"] * 3
LANGS = ["en", "fr", None, "de", "xx", "ru"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, LANGS[i % len(LANGS)], t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(data, "doc_id long, lang string, text string")


def counted(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("name", "an_cjk f_cjk_bigram f_cjk_width f_ngram tok_url_email tok_classic tok_lowercase an_pattern f_word_delimiter".split())
def test_jobs_by_piece_count_as_jobs_by_row(rows, name):
    tokens = catalog.TERM_COUNT_JOBS[name]()
    got = counted(jobs.term_counts_by_piece(rows, "text", tokens, ["lang"]))
    assert got == counted(jobs.term_counts(rows, tokens, ["lang"])) and got


def test_a_piece_is_tokenized_once_however_often_it_occurs(spark):
    """Fails where tokens are made row by row: the tokenizer would see every occurrence."""
    spark.createDataFrame([("en", "same words here " * 500)] * 40, "lang string, text string").createOrReplaceTempView("pieces_in")
    seen = spark.sparkContext.accumulator(0)

    def count(words):
        seen.add(1)
        return words
    see = F.udf(count, "string")
    df = spark.table("pieces_in")
    out = jobs.term_counts_by_piece(df, "text", tok.standard(see("text")), ["lang"])
    assert {r["token"]: r["n"] for r in out.collect()} == dict.fromkeys(["same", "words", "here"], 20000)
    assert seen.value <= 4


def test_stems_by_piece(rows):
    t = catalog.std_lower()
    assert counted(jobs.stem_counts(rows, t, "english", ["lang"], text="text")) == counted(jobs.stem_counts(rows, t, "english", ["lang"]))
    languages = an.STOP_ONLY_LANGUAGES[:3]
    assert counted(jobs.stems_by_language(rows, t, languages, text="text")) == counted(jobs.stems_by_language(rows, t, languages))


def test_ngrams_of_pieces_are_those_of_texts(rows):
    assert counted(jobs.ngram_counts(rows, F.col("text"), ["lang"])) == counted(jobs.term_counts(rows, tok.ngram(F.col("text")), ["lang"]))


def test_terms_by_lang_by_piece(rows):
    slow = rows.select("lang", F.explode(an.analyze_by_lang("text", "lang")).alias("token")).groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
    assert counted(jobs.terms_by_lang(rows, "text", "lang")) == counted(slow)


def test_stem_groups_by_piece(rows):
    """Documents are counted once per stem, also where an id has several rows."""
    again = rows.unionByName(rows.withColumn("text", F.upper("text")))
    args = (catalog.std_lower(), porter.porter_steps(), "doc_id", ["lang"])
    got = counted(jobs.stem_groups(again, *args, text="text"))
    assert got == counted(jobs.stem_groups(again, *args, min_hot_size=1, text="text")) == counted(jobs.stem_groups(again, *args))
    assert ("en", "run", 2, 2, 2) not in got and any(r[1] == "run" and r[4] == 2 for r in got)
