"""Toxic documents of good quality go; held-out labels."""
from pyspark.sql import functions as F

from sheaf.llm import cotrain as C

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_held_out_toxic(spark):
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), C.toxic_labels(spark, LARGER)      # sf0.01 has 51 toxic labels
    words = C.toxic_words(docs, labels.filter(F.col("id") % 3 != 0))
    test = docs.join(labels.filter(F.col("id") % 3 == 0), F.col("doc_id") == F.col("id"))
    rows = test.select("y", C.is_toxic(F.col("text"), words).alias("bad")).collect()
    toxic, clean = [r.bad for r in rows if r.y], [r.bad for r in rows if not r.y]
    print(len(words), sum(toxic), len(toxic), sum(clean), len(clean))
    assert len(toxic) > 8 and sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.03


def test_rows_of_the_query(spark):
    got = {r.doc_id: r.kept for r in C.op10_quality(spark, SF).collect()}
    toxic = [r.id for r in C.toxic_labels(spark, SF).filter("y = 1").collect() if r.id in got]
    assert sum(got[i] for i in toxic) / len(toxic) < 0.3


def test_no_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    assert C.toxic_words(docs, C.toxic_labels(spark, SF).limit(0)) == []
