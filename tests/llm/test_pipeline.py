"""The pipeline, stage by stage, on the smallest tables; each against its own input."""
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_bagminhash import bag, similarity
from tests.llm.test_decontam import shingles
from tests.llm.test_pii import brute, redact

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in P.STAGES:
        after = P.save_shared(f(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before.collect(), after.collect(), before, after) for name, before, after in out}


def test_columns(spark, steps):
    want = spark.read.parquet(f"{SF}/documents.parquet").columns
    for name, _ in P.STAGES[:-1]:
        assert steps[name][3].columns == want
    assert steps["mixing"][3].columns == want + ["copies"]


def test_near_dedup_leaves_one_of_each_class(steps):
    before, after, _, _ = steps["near_dedup"]
    bags = {r.doc_id: bag(r.text) for r in before}
    near = lambda a, b: (lambda x, y: y and 5 * x >= 4 * y)(*similarity(bags[a], bags[b]))
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in bags:
        for b in bags:
            if b < a and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after) == sorted({find(i) for i in bags})


def test_decontamination(spark, steps):
    before, after, _, _ = steps["decontamination"]
    items = [s for s in (shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()) if s]
    bad = {r.doc_id for r in before if any(5 * len(s & shingles(r.text)) >= 4 * len(s) for s in items)}
    assert bad and sorted(r.doc_id for r in after) == sorted({r.doc_id for r in before} - bad)


def test_pii(steps):
    before, after, _, _ = steps["pii"]
    order = sorted(before, key=lambda r: r.doc_id)
    want = {r.doc_id: redact(r.text, s) if s else r.text for r, s in zip(order, brute([r.text for r in order]))}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_pii_with_disclosing_terms(spark):
    """The stage where a term tells of an address; the tables have no such term."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = [(10 ** 6 + i, f"n{i} Quarkling ann.lee@x-mail.co.uk {'ipsum ' * i}", "en", "src0", 0) for i in range(4)]
    docs = docs.unionByName(spark.createDataFrame(told + [(10 ** 6 + 9, "lorem Quarkling alone", "en", "src1", 21)], docs.schema))
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    spans = brute(texts)
    assert sum(k >= 4 for x in spans for _, k, _ in x) >= 5
    got = [r.text for r in P.sanitisation(spark, docs, SF).orderBy("doc_id").collect()]
    assert got == [redact(t, s) if s else t for t, s in zip(texts, spans)] and "uarkling" not in got[-1]


def test_mixing(steps):
    before, after, _, _ = steps["mixing"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    assert {r.copies for r in after} <= {1, 2, 3}
    total, taken = sum(size(r.text) for r in before), sum(size(r.text) * r.copies for r in after)
    assert abs(taken - total) / total < .2
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}


def test_run_is_all_stages(spark, steps):
    got = P.run(spark, SF).orderBy("doc_id").collect()
    assert got == sorted(steps["mixing"][1], key=lambda r: r.doc_id)


def test_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = docs.unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (5, "", "en", None, 0), (5, "", "en", None, 0), (6, "x " * 30000, "en", "src0", 60000)], docs.schema))
    for rows in (odd, docs.limit(0)):
        for name, f in P.STAGES:
            out = P.save_shared(f(spark, rows.withColumns({c: F.lit("mine") for c in ("size", "copies", "node", "class", "entities", "score", "id")}), SF), name)
            assert out.count() <= rows.count()
