"""Word pattern, running sums of offsets, streams without types, shingles alone, n-grams: each against plain Python."""

import re
import string

import pytest
from pyspark.sql import functions as F

from sheaf.functions import filters as flt, stream, tokenizers as tok
from sheaf.plans import analyze as an, jobs


def test_the_word_pattern_asks_ascii_letter_by_letter_and_takes_greedy_runs(spark):
    """Ranges and possessive runs matched the same words in 2.7 times the time."""
    assert tok._L.startswith(f"[{string.ascii_letters}[") and tok._D.startswith(f"[{string.digits}[")
    assert not re.search(r"\]\]\+\+", tok.STANDARD_PATTERN)
    slow_l, slow_d = r"[A-Za-z[\p{L}\p{M}&&[^\p{IsHan}]]]", r"\p{Nd}"
    slow = rf"(?:{slow_l}++(?:[.'’:]{slow_l}++)*+|{slow_d}++(?:[.,;']{slow_d}++)*+|_)++|[[^\x00-\x7F]&&\p{{IsHan}}]"
    texts = ["".join(map(chr, range(1, 0x3100))), " ".join(map(chr, range(1, 0x3100))), "a.b c..d 1,2,,3 a1.2b _x_.y 字1a々〇⺀ ３.４ don't a'1 '' 𠀀a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.filter(~tok.extract(F.col("text"), tok.STANDARD_PATTERN).eqNullSafe(tok.extract(F.col("text"), slow))).count() == 0


def test_ngrams_of_tokens(spark):
    tokens = ["abc", "", "é😀x", "y"]
    got = spark.createDataFrame([(tokens,)], "a array<string>").select(flt.ngram(F.col("a")).alias("g")).first()["g"]
    assert got == [t[i:i + k] for t in tokens for i in range(len(t)) for k in (1, 2) if i + k <= len(t)]
    assert "substring" not in str(spark.range(1).select(flt.ngram(F.array(F.lit("x"))).alias("g"))._jdf.queryExecution().analyzed())


@pytest.mark.parametrize("n", [0, 1, 4, 16, 17, 64, 65, 1023, 1025, 5000])
def test_running_sums_of_any_length(spark, n):
    lengths = [(i * 7919) % 13 for i in range(n)]
    got = spark.createDataFrame([(lengths,)], "v array<int>").select(stream._ends(F.col("v")).alias("e")).first()["e"]
    assert got == [sum(lengths[:i + 1]) for i in range(n)]


def test_offsets_cut_their_tokens_out_of_the_text(spark):
    texts = ["", " . ", "a", "  lead, 3.14 trail.  ", "中文字 x😀y\n" * 300, "w" * 600 + " é" * 40, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for row in df.select("text", an.token_stream("text", "standard").alias("s"), tok.standard(F.col("text")).alias("t")).collect():
        assert (row["s"] is None) == (row["text"] is None)
        if row["s"] is not None:
            assert [x["token"] for x in row["s"]] == row["t"] == [row["text"][x["start"]:x["end"]] for x in row["s"]]
            assert [x["position"] for x in row["s"]] == list(range(len(row["t"])))


def test_shingles_alone_are_those_among_the_tokens_also_without_types(spark):
    texts = ["The cat and the hat of a dog", "of the", "", "one", "中文 a b", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    mixed = F.filter(an.token_stream("text", "standard", ["lowercase", "stop", "shingle"]), lambda x: x["type"] == "shingle")
    alone = an.token_stream("text", "standard", ["lowercase", "stop", lambda s: stream.shingle(s, unigrams=False)], typed=False)
    rows = [sorted(tuple(r) for r in jobs.stream_table(df, ["doc_id"], s).collect()) for s in (mixed, alone)]
    assert rows[0] == rows[1] and any(r[2] == "cat _" for r in rows[0])
    plain = [r["x"] for r in df.select(an.token_stream("text", "standard", typed=False).alias("s")).select(F.explode("s").alias("x")).collect()]
    assert plain and all(x["type"] is None for x in plain)
