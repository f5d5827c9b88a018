"""Pivotal mixing: targets against a plain water filling, mass and limits of the rounding."""
import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import mixing


def brute_targets(sizes: dict, cap=3.0):
    order = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return {**target, **{s: weight[s] * level for s in free}}
        target |= {s: cap * sizes[s] for s in over}
        free -= over


def rows(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, source string, size bigint, copies string")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    out = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "Z", None]), int(rng.integers(0, 300)), "x")
           for i in range(3000)]
    return [(i, None if s is None else str(s), n, x) for i, s, n, x in out] + [(9001, "tiny", 5, "x")] * 3


def test_targets_and_words(spark, data):
    docs = rows(spark, data).drop("copies")
    sizes = collections.Counter()
    for _, s, n, _ in data:
        sizes[s] += n
    want = brute_targets(sizes)
    out = mixing.mix(docs, chunk_rows=64).collect()
    assert len(out) == len(data)
    took, most = collections.Counter(), collections.Counter()
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        took[r.source] += r.copies * r["size"]
        most[r.source] = max(most[r.source], r["size"])
    for s in sizes:
        assert abs(took[s] - want[s]) <= most[s] + 1e-6, s      # off by one document at most


def test_reruns_agree_in_any_partitioning(spark, data):
    docs = rows(spark, data).drop("copies")
    one = sorted(map(tuple, mixing.mix(docs, chunk_rows=64).collect()), key=repr)
    two = sorted(map(tuple, mixing.mix(docs.repartition(7, "size"), chunk_rows=64).collect()), key=repr)
    assert one == two


def test_expectation_is_kept():
    size, hits = np.array([5.0, 1.0, 30.0, 7.0, 2.0, 11.0]), np.zeros(6)
    p = np.array([0.3, 0.5, 0.9, 0.2, 0.6, 0.4])
    rng = np.random.default_rng(1)
    for _ in range(20000):
        q = p.copy()
        left = mixing._pivot(size, q, rng.random(6))
        if left >= 0:
            assert 0 < q[left] < 1
            q[left] = rng.random() < q[left]
        assert set(q) <= {0.0, 1.0}
        hits += q
    assert np.abs(hits / 20000 - p).max() < 0.02


def test_edge_rows(spark):
    docs = rows(spark, [(None, None, None, "x"), (1, "a", 0, "x"), (1, "a", 0, "x"), (2, "", 4, "x")]).drop("copies")
    assert mixing.mix(docs).count() == 4
    assert mixing.mix(docs.limit(0)).count() == 0
    clash = docs.withColumn("__p", F.lit("mine")).withColumn("__chunk", F.lit(1.5))
    out = mixing.mix(clash)
    assert out.columns[:5] == ["doc_id", "source", "size", "__p", "__chunk"]
    assert {r["__p"] for r in out.collect()} == {"mine"}


def test_a_row_repeated_for_most_of_the_table(spark):
    hot = spark.range(100_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("a").alias("source"), F.lit(4).cast("bigint").alias("size"))
    docs = hot.unionByName(spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
                                                     (F.col("id") % 50).alias("size")).withColumnRenamed("id", "doc_id"))
    dealt, chunks = mixing.deal(docs, ["doc_id", "size"], "chunk", mixing.CHUNK_ROWS)
    groups = dealt.groupBy("source", "chunk").count()
    assert chunks == 51 and groups.agg(F.max("count")).first()[0] <= mixing.CHUNK_ROWS
    assert groups.filter("source = 'a'").count() >= 49
    out = mixing.mix(docs.withColumn("__part", F.lit("mine")).withColumn("__start", F.lit(1.5)))
    for r in out.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("took"), F.max("target").alias("want"),
                                       F.count(F.lit(1)).alias("n"), F.max("__part").alias("part")).collect():
        assert abs(r.took - r.want) <= 50 and r.part == "mine" and r.n in (101_500, 1_500)
