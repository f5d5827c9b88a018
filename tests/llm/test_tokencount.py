"""Edit-aware counts against encoding the whole text again."""
import random

import pytest
from pyspark.sql import functions as F

from sheaf.llm import tokencount as K

ALPHABET = ["a", "b", "the", " the", "é", "ß", "𝄞", " ", "  ", "   ", "\n", "\t", "\r\n", "'s", "'", "'ll", "1", "23", "!", "##", "　", "中", "."]


@pytest.fixture(scope="module")
def count():
    return K.Counter(K.RANKS)


def make(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def random_edits(rng, text, k):
    out = []
    for _ in range(k):
        a = rng.randint(0, len(text))
        out.append({"start": a, "end": a + rng.choice([0, 0, 1, 2, 7, 40]), "replacement": make(rng, rng.choice([0, 0, 1, 3, 30]))})
    return out


def test_edits_equal_full_encoding(count, monkeypatch):
    rng = random.Random(1)
    for leaf in (1, 2, 5, 64):
        monkeypatch.setattr(K, "LEAF", leaf)
        for _ in range(400):
            text = make(rng, rng.choice([0, 1, 5, 60, 300]))
            chars, sums = K.build_tree(text, count)
            assert K.root(sums) == len(count.bpe.encode_ordinary(text)) and sum(chars) == len(text)
            for _ in range(3):                          # edit the edited tree again
                edits = K.normal_edits(random_edits(rng, text, rng.randint(0, 5)), len(text))
                want = K.apply_edits(text, edits)
                text, chars, sums, _ = K.edit_tree(text, chars, sums, edits, count)
                assert text == want and sum(chars) == len(text), (text, edits)
                assert K.root(sums) == len(count.bpe.encode_ordinary(text)), (text, edits)
                assert sums[1:] == K.tree_of(sums[len(sums) // 2:])[1:]


def test_only_the_touched_region_is_recounted(count):
    text = "some words in a row. " * 5000
    chars, sums = K.build_tree(text, count)
    _, _, _, redone = K.edit_tree(text, chars, sums, [(50_000, 50_004, "other")], count)
    assert 0 < redone < 2000


def test_query_functions(spark, count):
    rng = random.Random(2)
    rows = [(1, None, None), (2, "", [(0, 0, "new text")]), (3, "abc", [None, (None, 2, None), (1, 3, "late")]), (4, "x", [(-5, 99, None)])]
    rows += [(i, t := make(rng, 80), [(e["start"], e["end"], e["replacement"]) for e in random_edits(rng, t, 3)]) for i in range(5, 40)]
    rows += rows[-3:]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, edits array<struct<start:int,end:int,replacement:string>>")
    df = df.withColumn("n_tokens", F.lit("mine"))
    out = K.recount(K.build(df)).collect()
    assert len(out) == len(rows) and {r.n_tokens for r in out} == {"mine"}
    by_id = {r[0]: r for r in rows}
    for r in out:
        _, text, edits = by_id[r.doc_id]
        normal = K.normal_edits([e and dict(zip(("start", "end", "replacement"), e)) for e in edits or ()], len(text or ""))
        want = K.apply_edits(text or "", normal)
        assert (r.text or "") == want and r.n_tokens_after == len(count.bpe.encode_ordinary(want))
        assert r._n_tokens == len(count.bpe.encode_ordinary(text or ""))
    assert K.recount(K.build(df.limit(0))).count() == 0


def test_op8_equals_full_encoding(spark, count):
    from sheaf.llm.catalog import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = QUERIES["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()
    import re
    pattern = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]++|(?<![0-9])[0-9]++(?:\.[0-9]++){3}|(?<![0-9])[0-9](?:[ ().-]?[0-9]){9,}+")
    assert len(out) == len(docs) and sum(r.n_edits for r in out) > 5
    for r in out:
        after = pattern.sub("<PRIVATE>", docs[r.doc_id])
        assert r.n_tokens == len(count.bpe.encode_ordinary(docs[r.doc_id]))
        assert (r.n_tokens_after, r.n_chars_after) == (len(count.bpe.encode_ordinary(after)), len(after))
