"""Co-training: held-out accuracy, bounds, and defined results for odd inputs."""
import pytest
from pyspark.sql import functions as F

from sheaf.llm import cotrain as C

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return C.quality_labels(spark, SF)


def test_held_out_accuracy(spark, docs, labels):
    train, test = labels.filter(F.col("id") % 3 != 0), labels.filter(F.col("id") % 3 == 0)
    out = C.classify(docs, train, carry=("doc_id",)).join(test, F.col("doc_id") == F.col("id")).collect()
    right = sum((r.score >= C.KEEP) == bool(r.y) for r in out)
    good = [r for r in out if r.y]
    assert len(out) > 100 and right / len(out) > 0.93
    assert sum(r.score >= C.KEEP for r in good) / len(good) > 0.97      # clean documents stay


def test_pseudo_labels_change_the_models(spark, docs, labels):
    views = C.featurise(C._inputs(docs, "doc_id", "text", ("source", "lang"), ("n_chars",))).cache()
    few = labels.filter(F.col("id") < 250)
    with C.Scratch(spark) as scratch:
        alone, together = C.train(views, few, scratch, rounds=0), C.train(views, few, scratch, rounds=2)
        again = C.train(views.repartition(5), few, scratch, rounds=2)
    assert abs(alone["models"][1] - together["models"][1]).max() > 1e-3
    for a, b in zip(together["models"], again["models"]):
        assert abs(a - b).max() < 1e-6


def test_odd_inputs(spark, labels):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "src", "en", -5), (2, "a " * 50000, "é", "", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    df = df.withColumn("score", F.lit("mine")).withColumn("z0", F.lit(1))
    none = spark.createDataFrame([], "id bigint, y int")
    assert C.keep_good(df, none).count() == 4                            # nothing known: nothing rejected
    bad = spark.createDataFrame([(1, 0), (1, 0), (1, None), (None, 1)], "id bigint, y int")
    assert C.keep_good(df, bad).count() == 0                             # one class known: its share
    mixed = spark.createDataFrame([(1, 0), (2, 1)], "id bigint, y int")
    out = C.keep_good(df, mixed)
    assert out.columns == df.columns and out.count() <= 4
    assert C.keep_good(df.limit(0), mixed).count() == 0
