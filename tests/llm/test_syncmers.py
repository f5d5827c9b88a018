"""Closed syncmers, fingerprints and neighbours against plain Python."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sheaf.llm import syncmers as Y

SF = "/root/testdata/sf0.001"


def hashes_of(spark, texts):
    """Spark's own hashes of the s-mers of each text, and of all its pieces."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    pieces = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(Y.PIECE), F.lit(0)), lambda p: F.xxhash64(p))
    return {r.i: (list(r.h), r.n) for r in df.select("i", Y._smers(pieces).alias("h"), F.size(pieces).alias("n")).collect()}


def chosen(h):
    """Numbers of the k-mers whose smallest s-mer is their first or last."""
    out = []
    for i in range(len(h) - Y.WINDOW + 1):
        window = h[i:i + Y.WINDOW]
        if min(window) in (window[0], window[-1]):
            out.append(i)
    return out


def texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdéf\U0001F600") for _ in range(rng.randint(1, 12))) for _ in range(80)]
    out = [None, "", " \n", "a", "ab cd", "abcdefgh", "x" * 400, "the " * 300, "a b\x0bc\x0cd\re\tf"]
    for _ in range(120):
        out.append(rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randint(0, 120))))
    return out


def test_anchors_against_windows(spark):
    ts = texts()
    h = hashes_of(spark, ts)
    df = spark.createDataFrame(list(enumerate(ts)), "i int, text string")
    for r in df.select("i", Y.anchors(F.col("text")).alias("a")).collect():
        smers, n = h[r.i]
        want = chosen(smers) or ([0] if n else [])
        assert [a.pos for a in r.a] == want, ts[r.i]


def test_anchors_are_free_of_context(spark):
    """A passage has the same anchors wherever it stands."""
    passage = " ".join(t for t in texts()[10:20] if t)
    df = spark.createDataFrame([(passage,), ("zz yy xx " + passage,), (passage + " tail of it",)], "text string")
    alone, later, before = (r.a for r in df.select(Y.anchors(F.col("text")).alias("a")).collect())
    assert len(alone) > 20
    assert {(p + 3, x) for p, x in alone} <= set(later)
    assert before[:len(alone)] == alone


def likeness(a, b):
    cut = lambda x: [x[i:i + 8] for i in range(0, len(x), 8)]
    a, b = set(cut(a)), set(cut(b))
    signed = lambda x: (int(x, 16) ^ 2 ** 31) - 2 ** 31
    both = sorted(a | b, key=signed)[:Y.SKETCH]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def expect(rows):
    """(id, n_chars, digest of the edited text, text, edited text, next text) of every row."""
    distinct = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    after = {r: distinct[(k + 1) % len(distinct)][1] for k, r in enumerate(distinct)}
    out = []
    for i, t in rows:
        t = t or ""
        c = len(t) // 3
        edited = t[:len(t) - c] + after[i, t][:c]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, after[i, t]))
    return out


def check(spark, rows, got):
    want = expect(rows)
    every = sorted({t for r in want for t in r[3:]})
    prints = {r.text: r.f for r in spark.createDataFrame([(t,) for t in every], "text string").select("text", Y.fingerprint(F.col("text")).alias("f")).collect()}
    key = lambda r: tuple((x is None, x) for x in r)
    full = [(i, n, sha, prints[t], prints[e], likeness(prints[t], prints[e]), likeness(prints[t], prints[x])) for i, n, sha, t, e, x in want]
    assert sorted(map(tuple, got), key=key) == sorted(full, key=key)


def test_query_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = Y.op11_syncmer_fingerprints(spark, SF).collect()
    check(spark, [tuple(r) for r in docs], got)
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > .25 for r in long) > .97 * len(long) and sum(r.near_next < .1 for r in long) > .95 * len(long)


@pytest.mark.parametrize("count", [0, 1, 140])
def test_odd_rows(spark, tmp_path, count):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())]
    rows = (rows + [(3, "same text here")] * 5 + [(3, "another one")])[:count]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit(1), "place": F.lit("x"), "digest": F.lit("x")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, rows, Y.op11_syncmer_fingerprints(spark, str(tmp_path)).collect()) if count else None
    assert Y.op11_syncmer_fingerprints(spark, str(tmp_path)).count() == len(rows)


def test_leading_anchors(spark):
    df = spark.createDataFrame([("aa bb cc dd ee ff gg hh ii jj kk", "aa bb cc dd ee ff gg hh ii zz yy xx"), ("", ""), ("a", "b")], "a string, b string")
    got = df.select(Y.anchors(F.col("a")).alias("a"), Y.anchors(F.col("b")).alias("b")).select("a", "b", Y.leading_anchors(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        n = 0
        while n < min(len(r.a), len(r.b)) and r.a[n] == r.b[n]:
            n += 1
        assert r.n == n
