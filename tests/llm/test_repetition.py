"""Suffix-array repeats against a plain search over windows."""
import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

from sheaf.llm import repetition as R

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORDS.findall(text)
    n = len(w)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(n - 7))
    covered = set()
    for i in range(n - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    longest = 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and w[i + k] == w[j + k]:
                k += 1
            longest = max(longest, k if k >= 8 else 0)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "covered_chars": sum(len(w[i]) for i in covered), "longest_repeat": longest,
            "base_failed": n < 20 or 100 * len(covered) > 30 * n}


def texts():
    rng = random.Random(5)
    out = [None, "", "   \n\t", "a", "das " * 90, "x y " * 30, "é ß a\x0bb\x0cc\rd   z" * 4, "a|b #\n\n a|b #\n"]
    for _ in range(60):
        w = [rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            i, j = rng.randint(0, len(w)), rng.randint(0, len(w))
            w[i:i] = w[j:j + rng.randint(5, 40)]
        out.append(rng.choice([" ", "\n", "  ", "\t"]).join(w))
    return out + out[-3:]


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_words_", F.lit(1))
    text = F.coalesce("text", F.lit(""))
    df = df.select("doc_id", text.alias("text"), *[c.alias(k) for k, c in R.line_and_symbol_counts(text).items()])
    got = {r.doc_id: r for r in R.judge(R.repetition(df)).collect()}
    for i, t in rows:
        want = brute(t)
        assert {k: got[i][k] for k in want} == want, (i, t)
        share = want["covered_chars"] / want["word_chars"] if want["word_chars"] else 0
        assert got[i].kept == (not want["base_failed"] and share <= R.MAX_COVERED
                               and want["longest_repeat"] <= R.MAX_LONGEST)


def test_blocks_do_not_change_the_result(monkeypatch):
    ts = [t or "" for t in texts()]
    whole = R._measure(ts)
    monkeypatch.setattr(R, "BLOCK_WORDS", 50)
    for k, v in R._measure(ts).items():
        assert np.array_equal(v, whole[k]), k


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert R.repetition(df).count() == 0


def test_judge_reads_its_own_columns_beside_clashing_ones(spark):
    texts = ["only a few words", " ".join(f"w{i}" for i in range(60)), "one two three four five six seven eight nine " * 12, None, ""]
    plain = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counted = R.line_and_symbol_counts(F.coalesce("text", F.lit("")))["word_chars"].alias("word_chars")
    want = {r.doc_id: (r.covered_share, r.base_failed, r.kept) for r in R.judge(R.repetition(plain.select("*", counted))).collect()}
    clash = ("n_words", "n_repeat_words", "covered_chars", "longest_repeat", "base_failed", "kept", "Covered_Share")
    df = plain.select("*", counted, *[F.lit(7).alias(c) for c in clash])
    out = R.judge(R.repetition(df), measured=df)
    rows = out.collect()
    assert all(r[c] == 7 for r in rows for c in clash)
    assert {r.doc_id: (r["_covered_share"], r["_base_failed"], r["_kept"]) for r in rows} == want
    assert {k for _, _, k in want.values()} == {True, False}
