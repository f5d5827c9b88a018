"""Mergeable field sketches: exact counts, error bounds, merging without a rescan."""
from pyspark.sql import functions as F

from sheaf.operators import sketches as sk
from sheaf.sources.tables import read_table


def test_merged_sketches_are_within_their_bounds(spark, tmp_path):
    """Two stored sketches, overlapping by half: 300,000 distinct values of 1 to 6 digits."""
    for name, low, high in (("a", 0, 200_000), ("b", 100_000, 300_000)):
        rows = spark.range(low, high).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("void"), (F.col("id") % 7).alias("few"))
        sk.sketch_fields(rows).write.parquet(str(tmp_path / name))
    both = sk.merge_fields(*[spark.read.parquet(str(tmp_path / n)) for n in "ab"])
    got = {r.column: r for r in sk.read_fields(both, (0.0, 0.5, 1.0)).collect()}
    assert abs(got["k"].n_distinct - 300_000) <= 0.03 * 300_000            # over three standard deviations
    assert (got["k"].n_rows, got["k"].n_nonnull, got["k"].max_len, list(got["k"].len_quantiles)) == (400_000, 400_000, 6, [1, 6, 6])
    assert (got["few"].n_distinct, got["few"].max_len) == (7, 1)
    assert (got["void"].n_rows, got["void"].n_nonnull, got["void"].n_distinct, got["void"].max_len, got["void"].len_quantiles) == (
        400_000, 0, 0, None, None)


def test_merging_equals_one_sketch_of_all_rows(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    parts = [sk.sketch_fields(docs.filter(F.col("doc_id") % 3 == i)) for i in range(3)]
    one = {r.column: r for r in sk.read_fields(sk.sketch_fields(docs)).collect()}
    for r in sk.read_fields(sk.merge_fields(*parts)).collect():
        assert (r.n_rows, r.n_nonnull, r.max_len) == (one[r.column].n_rows, one[r.column].n_nonnull, one[r.column].max_len)
        assert abs(r.n_distinct - one[r.column].n_distinct) <= max(1, 0.03 * one[r.column].n_distinct)
    n = docs.filter("text is not null").count()
    for rank, value in zip((0.5, 0.95), one["text"].len_quantiles):
        below, upto = docs.agg(F.count_if(F.length("text") < value), F.count_if(F.length("text") <= value)).first()
        assert below - 0.02 * n - 1 <= rank * n <= upto + 0.02 * n + 1


def test_empty_tables_and_odd_names(spark):
    df = spark.createDataFrame([], "`a.b` bigint, `column` string")
    assert sorted((r.column, r.n_rows, r.n_distinct, r.len_quantiles) for r in sk.read_fields(sk.sketch_fields(df)).collect()) == [
        ("a.b", 0, 0, None), ("column", 0, 0, None)]
    assert sk.sketch_fields(spark.range(3).select()).count() == 0
