"""Stemmers of ten languages on published examples, and the jobs that stem a vocabulary once."""
import pytest
from pyspark.sql import functions as F

from sheaf.functions import filters as flt
from sheaf.functions import suffix_stem as S
from sheaf.plans import analyze as an
from sheaf.plans import jobs

# Forms and the stems that the published descriptions of the stemmers give (Finnish, Hungarian, Turkish: pinned here).
STEMS = {
    "danish": {"underste": "underst", "undersøgelse": "undersøg", "undersøgelserne": "undersøg", "uheldige": "uheld", "arbejdsløst": "arbejdsløs", "løst": "løst",
               "venlighed": "ven", "hus": "hus", "på": "på"},
    "norwegian": {"havnedistriktene": "havnedistrikt", "havnemyndighetene": "havnemynd", "havnedistrikter": "havnedistrikt",
                  "opprettes": "opprett", "av": "av"},
    "swedish": {"jaktkarlarne": "jaktkarl", "jaktkarlens": "jaktkarl", "klokaste": "klok", "klostergården": "klostergård",
                "klokheten": "klok", "jakten": "jakt", "fullt": "fullt"},
    "dutch": {"lichamelijke": "licham", "lichamen": "licham", "opgingen": "opging", "oplossingen": "oploss", "mogelijkheden": "mogelijk",
              "bomen": "bom", "boom": "bom", "katten": "kat", "kat": "kat"},
    "italian": {"abbandonata": "abbandon", "abbandonarono": "abbandon", "pronunziare": "pronunz", "gatto": "gatt", "gatti": "gatt",
                "velocemente": "veloc", "nazione": "nazion", "boschi": "bosc"},
    "portuguese": {"quilométricas": "quilométr", "quilométricos": "quilométr", "boiou": "boi", "felizmente": "feliz",
                   "meninos": "menin", "menina": "menin", "nações": "naçõ"},
    "russian": {"важная": "важн", "важнейшие": "важн", "важные": "важн", "вагоне": "вагон", "вагонов": "вагон", "падение": "паден",
                "павловна": "павловн", "павловне": "павловн", "поднялся": "подня"},
    "finnish": {"taloissa": "talo", "talossa": "talo", "talon": "talo", "talot": "talo", "talokin": "talo"},
    "hungarian": {"házakban": "ház", "házban": "ház", "házak": "ház", "kertek": "kert", "kertben": "kert"},
    "turkish": {"evlerimizden": "ev", "evler": "ev", "evde": "ev", "kitaplar": "kitap", "kitaplarda": "kitap"},
}


@pytest.mark.parametrize("language", sorted(STEMS))
def test_stems(spark, language):
    words = list(STEMS[language])
    df = spark.createDataFrame([(words,)], "a array<string>")
    got = df.select(flt.stemmer(F.col("a"), language)).first()[0]
    assert dict(zip(words, got)) == STEMS[language]


def test_odd_tokens(spark):
    rows = spark.createDataFrame([(["", None, "s", "12", "x" * 5000, "日本"],), (None,), ([],)], "a array<string>")
    for language in S.PROGRAMS:
        first, null, empty = [r[0] for r in rows.select(flt.stemmer(F.col("a"), language)).collect()]
        assert first[0] == "" and first[1] is None and first[3] == "12" and first[5] == "日本" and null is None and empty == []


def test_counted_stems_equal_the_filter(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", flt.lowercase(F.split("text", r"\s+")).alias("t"))
    for language in ("english", "spanish", "dutch"):
        slow = jobs.term_counts(d, flt.stemmer(F.col("t"), language), ["lang"])
        fast = jobs.stem_counts(d, F.col("t"), language, ["lang"])
        assert sorted(map(tuple, slow.collect()), key=repr) == sorted(map(tuple, fast.collect()), key=repr)


def test_terms_by_lang_equal_the_analyzer(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    codes = ["en", "fr", "de", "es", "da", "nl", "fi", "hu", "it", "no", "pt", "ru", "sv", "tr", None, "xx"]
    dealt = F.when(F.crc32("text") % 2 == 0, F.col("lang")).otherwise(F.get(F.array(*[F.lit(c) for c in codes]), F.crc32("text") % len(codes)))
    d = d.withColumn("lang", dealt)
    slow = jobs.term_counts(d.select("lang", an.analyze_by_lang("text", "lang").alias("t")), F.col("t"), ["lang"])
    fast = jobs.terms_by_lang(d, "text", "lang")
    one, two = slow.collect(), fast.collect()
    assert len({r.lang for r in one}) > 6
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
