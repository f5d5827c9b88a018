"""Composer API, per-language analysis, and job equivalences."""
from collections import Counter

from pyspark.sql import functions as F

from sheaf.functions import filters as flt
from sheaf.functions import tokenizers as tok
from sheaf.operators import shape
from sheaf.plans import analyze as an
from sheaf.plans import jobs
from sheaf.sources.tables import read_table


def test_derived_columns(spark):
    df = spark.createDataFrame([(1, "Hello <b>World</b>")], "id bigint, t string")
    out = an.with_stripped(an.with_analyzed(an.with_tokenized(df, "t", "whitespace", ["uppercase"]),
                                            "t", "simple"), "t").first()
    assert out["t_tokenized"] == "HELLO <B>WORLD</B>"
    assert out["t_analyzed"] == "hello b world b"
    assert out["t_stripped"] == "Hello World"


def test_register_custom_analyzer(spark):
    an.register_analyzer("shout_stems", "standard", ["lowercase", "porter_stem", "uppercase"])
    df = spark.createDataFrame([("running dogs",)], "t string")
    assert df.select(an.analyze("t", "shout_stems")).first()[0] == ["RUN", "DOG"]


def test_analyze_by_lang(spark):
    df = spark.createDataFrame([("en", "The cats were running"), ("fr", "L'avion des chevaux"),
                                ("de", "Die Häuser"), ("es", "Los gatos"), ("xx", "Other Words"),
                                ("it", "Il cane e il gatto")],
                               "lang string, t string")
    got = {r["lang"]: r["a"] for r in df.select("lang", an.analyze_by_lang("t", "lang").alias("a")).collect()}
    assert got["en"] == ["cat", "were", "run"]
    assert got["fr"] == ["avion", "cheval"]
    assert got["de"] == ["haus"]
    assert got["es"] == ["gat"]
    assert got["xx"] == ["other", "words"]
    assert got["it"] == ["can", "gatt"]


def test_ngram_counts_equal_tokenizer_multiset(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("lang", "text")
    fast = {(r["lang"], r["token"]): r["n"] for r in jobs.ngram_counts(d, F.col("text"), ["lang"]).collect()}
    slow = {(r["lang"], r["token"]): r["n"] for r in
            jobs.term_counts(d, tok.ngram(F.col("text")), ["lang"]).collect()}
    assert fast == slow


def test_shingle_bag_equals_shingle(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select(flt.lowercase(tok.standard(F.col("text"))).alias("t"))
    rows = d.select(flt.shingle(F.col("t")).alias("a"),
                    F.concat(F.col("t"), flt.bigram_shingles(F.col("t"))).alias("b")).collect()
    assert all(Counter(r["a"]) == Counter(r["b"]) for r in rows)


def test_term_stats_matches_counts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    t = tok.lowercase(F.col("text"))
    stats = {(r["lang"], r["token"]): (r["tf"], r["df"]) for r in jobs.term_freqs(d, t, ["lang"]).collect()}
    tf = {(r["lang"], r["token"]): r["n"] for r in jobs.term_counts(d, t, ["lang"]).collect()}
    df_ = {(r["lang"], r["token"]): r["n"] for r in jobs.term_counts(d, F.array_distinct(t), ["lang"]).collect()}
    assert stats == {k: (tf[k], df_[k]) for k in tf}


def test_field_stats_approx_close(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    exact = {r["column"]: r["n_distinct"] for r in shape.field_stats(li).collect()}
    approx = {r["column"]: r["n_distinct"] for r in shape.field_stats(li, approx=True).collect()}
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.1 * n)


def test_fingerprint_hot_split_same_result(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    fp = F.element_at(an.analyze("text", "fingerprint"), 1)
    base = sorted(tuple(r) for r in jobs.fingerprint_clusters(d, "doc_id", fp).collect())
    # every cluster of 2+ treated as hot (broadcast path), and none (shuffle path)
    hot = sorted(tuple(r) for r in jobs.fingerprint_clusters(d, "doc_id", fp, min_hot_size=2).collect())
    assert base and hot == base


def test_fingerprint_hot_cluster(spark):
    rows = [(i, "same words here") for i in range(50)] + [(100, "other"), (101, "other"), (102, "lone")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    fp = F.element_at(an.analyze("text", "fingerprint"), 1)
    out = jobs.fingerprint_clusters(d, "doc_id", fp, max_hot_keys=10, min_hot_size=10)
    got = {r["doc_id"]: (r["cluster_id"], r["cluster_size"]) for r in out.collect()}
    assert got == {**{i: (0, 50) for i in range(50)}, 100: (100, 2), 101: (100, 2)}


def test_stem_groups_hot_split_same_result(spark, sf_dir):
    from sheaf.functions import porter
    d = read_table(spark, sf_dir, "documents").filter(F.col("lang") == "en")
    t = flt.lowercase(tok.standard(F.col("text")))
    base = sorted(tuple(r) for r in jobs.stem_groups(d, t, porter.porter_steps(), "doc_id", ["lang"]).collect())
    hot = sorted(tuple(r) for r in jobs.stem_groups(d, t, porter.porter_steps(), "doc_id", ["lang"],
                                                   min_hot_size=5).collect())
    assert base and hot == base
