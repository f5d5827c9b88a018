"""Benchmark items in documents: containment search against all pairs by brute force."""
import random

import duckdb
from pyspark.sql import functions as F

from sheaf.llm import decontam as D


def runs(text, n=5):
    w = (text or "").encode().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def shingles(item):
    """Of an item: runs of five words, or all of its words if it has fewer."""
    return runs(item, min(5, len((item or "").split()) or 5))


def data():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 6, 9, 14, 20, 33, 57, 140])))) for k in range(40)]
    items += [(100 + k, t) for k, t in items[:5]] + [(200, None), (201, ""), (202, "four words are few"), (203, "w1"), (204, "W2 w2"),
              (205, "w3 w4"), (206, "w5  w6\tw7"), (207, "four words are few"), (None, "w1 w2 w3 w4 w5 w6 w7")]
    docs = [None, "", "a b", "das " * 300, "w3 w4", "w3 x w4", "four words are few", "so four words are few\nand more", "xw1 w11", "w5 w6 w7 w8"]
    for k in range(150):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 8, 60, 400, 2500]))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(items[:40])[1].split()
            if rng.random() < .5:
                t = t[:max(1, int(len(t) * rng.uniform(.6, 1)))]
            if rng.random() < .3:
                t[rng.randrange(len(t))] = "edited"
            at = rng.randint(0, len(w))
            w[at:at] = t
        docs.append(rng.choice([" ", "\n", " \t"]).join(w))
    docs += docs[-8:]
    return items, [(i if i % 31 else None, t) for i, t in enumerate(docs)]


def test_against_brute_force(spark):
    items, docs = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("hash", F.lit(1))
    by_text = {}
    for i, t in items:
        by_text.setdefault(t or "", []).append(i)
    want = set()
    for r, (_, d) in enumerate(docs):
        have = set().union(*[runs(d, n) for n in range(1, 6)])
        for t, ids in by_text.items():
            s = shingles(t)
            if s and 5 * len(s & have) >= 4 * len(s):
                want.add((d or "", min((i for i in ids if i is not None), default=None), len(ids), len(s & have), len(s)))
    found = D.contained(df, bench)
    keyed = df.select(F.coalesce("text", F.lit("")).alias("text"), D._key(F.coalesce("text", F.lit(""))).alias("text_key")).distinct()
    got = {tuple(r) for r in keyed.join(found, "text_key").select("text", "item", "n_items", "n_shared", "n_item").collect()}
    assert len(want) > 60 and got == want
    clean = D.decontaminate(df, bench)
    assert clean.columns == df.columns
    bad = {t for t, *_ in want}
    assert sorted((r.doc_id, r.text) for r in clean.collect() if r.doc_id is not None) == sorted(
        (i, t) for i, t in docs if (t or "") not in bad and i is not None)


def test_shuffled_lookup_finds_the_same(spark, monkeypatch):
    items, docs = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    one = sorted(map(tuple, D.contained(df, bench).collect()), key=repr)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, D.contained(df, bench).collect()), key=repr) == one


def test_empty_tables(spark):
    items, docs = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert D.contained(df.limit(0), bench).count() == 0
    assert D.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_columns_of_the_caller_keep_their_values(spark):
    """Documents and items with columns named like those of the search."""
    items, docs = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("shingles", F.lit(1)).withColumn("w", F.lit(2))
    names = ("text_key", "hash", "pos", "item", "all", "hashes", "__text_key", "n_words")
    df = spark.createDataFrame(docs, "doc_id bigint, text string").select("*", *[F.lit(n).alias(n) for n in names])
    clean = D.decontaminate(df, bench)
    plain = D.decontaminate(df.select("doc_id", "text"), bench)
    assert clean.columns == df.columns and all(r[n] == n for r in clean.collect() for n in names)
    assert sorted(map(repr, clean.select("doc_id", "text").collect())) == sorted(map(repr, plain.collect()))


def test_short_items_against_sql(spark, tmp_path):
    items, docs = data()
    con = duckdb.connect()
    for name, rows, schema in (("benchmark", items, "item_id bigint, text string"), ("documents", docs, "doc_id bigint, text string")):
        spark.createDataFrame([r for r in rows if r[0] is not None], schema).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = D.op3_decontamination(spark, str(tmp_path))
    want = con.execute(D.OP3_SQL).fetchdf()[got.columns].itertuples(index=False, name=None)
    assert sorted(map(tuple, got.collect())) == sorted(want)
