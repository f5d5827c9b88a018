"""Runs of repeated words against a plain search over all periods."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from sheaf.llm import periodic as P

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def brute(w):
    """(start, length, period) of every run, by comparing each word with the one a period later."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)           # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def looped(doc_id, text):
    w = WORDS.findall(text or "")
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def row(doc_id, text):
    w = looped(doc_id, text)
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), math.floor(1000 * best[1] / best[2]) if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def texts():
    rng = random.Random(13)
    out = [None, "", " \n\t", "a", "a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", "a b " * 3, "é ß\x0bz\x0c" * 40, "x " * 3000,
           "a b a b a b a b a a a a a a b a b a b a b", ("a " * 7 + "b ") * 9, ("x y " * 5 + "z ") * 6, "a a b " * 5 + "a a a b " * 5]
    for _ in range(250):
        w = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            i, k = rng.randint(0, len(w)), rng.randint(1, 9)
            block = w[i:i + k]
            w[i:i] = (block * rng.randint(2, 9))[rng.randint(0, 2):]
        out.append(rng.choice([" ", "\n", "  "]).join(w))
    return out + out[-3:]


def test_runs_against_brute_force():
    ts = [t or "" for t in texts()]
    for block in (P.BLOCK_WORDS, 100):
        old, P.BLOCK_WORDS = P.BLOCK_WORDS, block
        got, collapsed = P._measure(ts, True)
        P.BLOCK_WORDS = old
        for t, runs, c in zip(ts, got, collapsed):
            w = WORDS.findall(t)
            want = brute(w)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want, t
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert c == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_a_lying_hash_is_corrected(monkeypatch):
    """With a hash that calls nearly everything equal, the words decide."""
    class Weak(P.Hashes):
        def __init__(self, ids):
            super().__init__(ids // 2)
    monkeypatch.setattr(P, "Hashes", Weak)
    rng = np.random.default_rng(3)
    for _ in range(200):
        ids = rng.integers(0, 3, rng.integers(6, 40))
        got = list(zip(*(x.tolist() for x in P.word_runs(ids, np.zeros(len(ids), dtype=np.int64)))))
        assert {(s, e - s, q) for s, e, q in got} <= set(brute(ids.tolist())) | {(s, e - s, q) for s, e, q in got if (ids[s:e - q] == ids[s + q:e]).all()}


def test_grammar_derives_the_words():
    """Every place of a node derives the same words as its first place."""
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5, 3000)
    doc = np.sort(rng.integers(0, 20, 3000))
    lo, mid, hi, places, nodes = P.Grammar(ids, doc).arrays()
    assert len(places) > len(lo) and ((lo < mid) & (mid < hi)).all()
    for at, k in zip(places.tolist(), nodes.tolist()):
        assert np.array_equal(ids[at:at + hi[k] - lo[k]], ids[lo[k]:hi[k]])


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted(row(r.doc_id, r.text) for r in docs)
    assert sum(x[1] > 0 for x in want) > 5
    assert sorted(map(tuple, P.op13_periodic_runs(spark, SF).collect())) == want


def test_odd_rows(spark, tmp_path):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts())] + [(30, "a b c " * 50)] * 4
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df.withColumn("runs", F.lit("mine")).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op13_periodic_runs(spark, str(tmp_path)).collect()
    null_last = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=null_last) == sorted((row(*r) for r in rows), key=null_last)
    out = P.periodic_runs(df.withColumn("runs", F.lit("mine")).withColumn("Collapsed", F.lit(1)))
    assert out.columns == ["doc_id", "text", "runs", "Collapsed", "_runs", "_collapsed"]
    assert P.periodic_runs(df.limit(0), collapse=False).collect() == []
