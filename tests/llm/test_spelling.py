"""Spelling variants against all pairs of words."""
import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sheaf.llm import spelling as S

SF = "/root/testdata/sf0.001"


def counted(rows):
    out = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in S._UPPER else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(words):
    """Pairs by the shortened forms of each word (equal ones are looked at letter by letter)."""
    groups = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            groups[w[:i] + w[i + 1:]].add(w)
        groups[w].add(w)

    def one(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))
    return {(a, b) for g in groups.values() for a in g for b in g if a != b and one(a, b)}


def brute(words):
    mates = collections.defaultdict(set)
    for a, b in near(words):
        mates[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(mates[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(mates[w]), words.get(form[w])) for w, n in words.items())


def texts():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 12))) for _ in range(60)] + ["Straßenbahn", "ÀÉÎÕÜÿÿÿ", "aaaaaaaa", "aaaaaaa", "a" * 500, "a" * 499, "ab" * 300]
    out = [None, "", "1234 -- ..", "short", "ßß x×y÷z" * 3]
    for _ in range(400):
        w = [rng.choice(base) for _ in range(rng.randint(0, 30))] + base[:3] * rng.randint(0, 4)
        for _ in range(rng.randint(0, 6)):
            if w:
                i = rng.randrange(len(w))
                j = rng.randrange(len(w[i]))
                w[i] = w[i][:j] + rng.choice(["", "d", "é", w[i][j] * 2]) + w[i][j + 1:]
        out.append(rng.choice([" ", ", ", "\n", "7"]).join(x.upper() if rng.random() < .1 and "ß" not in x and "ÿ" not in x else x for x in w))
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("wide", [S.WIDE, 5])
def test_against_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(S, "WIDE", wide)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts())]
    rows += rows[-5:]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"word": F.lit("mine"), "n": F.lit(3), "run": F.lit("x")})
    words = counted(rows)
    want = brute(words)
    assert sum(r[1] is not None for r in want) > 20
    got = S.word_counts(df)
    assert {r.word: r.n for r in got.collect()} == words
    assert rows_of(S.spelling_groups(got)) == want


def test_chains_of_forms(spark):
    words = {"chained" + "x" * k: 10 ** k for k in range(14)} | {"chained" + "x" * k + "y": 1 for k in range(3)} | {"lonelyword": 5}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert rows_of(S.spelling_groups(df)) == brute(words)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(S.op12_spelling_variants(spark, SF)) == brute(counted(map(tuple, docs)))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.spelling_groups(S.word_counts(df)).collect() == []
    one = spark.createDataFrame([(1, "sometimes sometimes")], "doc_id bigint, text string")
    assert rows_of(S.spelling_groups(S.word_counts(one))) == brute(counted([(1, "sometimes sometimes")]))
