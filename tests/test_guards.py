"""One test per pinned refusal."""
import pytest

from sheaf.operators import keys, shape, upsert
from sheaf.sources import tables


def test_empty_prefix_refused(spark):
    with pytest.raises(ValueError):
        tables.names_with_prefix(["a", "b"], "")
    with pytest.raises(ValueError):
        tables.names_with_prefix(["a", ".b"], ".b")


def test_no_match_refused(spark, sf_dir):
    with pytest.raises(ValueError):
        tables.read_many(spark, tables.catalog(sf_dir), prefix="zzz")


def test_null_key_fails_the_job(spark):
    b = spark.createDataFrame([(1, 1, "a"), (None, 2, "b")], "k bigint, ord bigint, v string")
    with pytest.raises(Exception, match="null key"):
        upsert.upsert(None, b, "k", "ord").collect()


def test_missing_key_column(spark):
    b = spark.createDataFrame([(1, "a")], "x bigint, v string")
    with pytest.raises(upsert.KeyError_):
        upsert.upsert(None, b, "k", "x")


def test_reserved_column(spark):
    b = spark.createDataFrame([(1, "a")], "k bigint, _id string")
    with pytest.raises(upsert.KeyError_):
        upsert.upsert(None, b, "k", "k")


def test_existing_merged_target(spark):
    t = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(upsert.KeyError_):
        upsert.merge_tables([("t", t, "k", "k")], existing_names=["merged"], target="merged")


def test_merge_checks_keys_before_anything(spark):
    good = spark.createDataFrame([(1,)], "k bigint")
    bad = spark.createDataFrame([(1,)], "x bigint")
    with pytest.raises(upsert.KeyError_):
        upsert.merge_tables([("a", good, "k", "k"), ("b", bad, "k", "k")], target="m")


def test_leaf_prefix_clash(spark):
    df = spark.createDataFrame([(1, 2)], "`a` int, `a.b` int")
    with pytest.raises(ValueError, match="leaf and a prefix"):
        shape.nest_columns(df)


def test_case_only_clash(spark):
    df = spark.createDataFrame([((1,), 2)], "s struct<A: int>, `s.a` int")
    with pytest.raises(ValueError, match="case"):
        shape.flatten_struct(df)


@pytest.mark.parametrize("bad", ["-1", "1.5", "x", -3])
def test_bad_offset(spark, bad):
    df = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(ValueError):
        keys.add_key([df], [["k"]], offset=bad)


def test_no_common_key(spark):
    a = spark.createDataFrame([(1,)], "x bigint")
    b = spark.createDataFrame([(1,)], "y bigint")
    with pytest.raises(ValueError):
        keys.common_columns([a, b])
