"""BagMinHash near duplicates: unbiased signatures, classes against all pairs by brute force."""
import collections
import random

import numpy as np
from pyspark.sql import functions as F

from sheaf.llm import bagminhash as B
from sheaf.llm.shingles import _WordHashes, occurrences, shingle_hashes, split_words


def bag(text):
    w = (text or "").encode().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def similarity(a, b):
    both, either = sum((a & b).values()), sum((a | b).values())
    return (both, either)


def brute_classes(rows):
    """Row number -> (smallest id, rows) of its class."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            both, either = similarity(bags[i], bags[j])
            if either and 5 * both >= 4 * either:
                root[find(i)] = find(j)
    cls = {t: find(i) for i, t in enumerate(texts)}
    ids, size = collections.defaultdict(list), collections.Counter()
    for i, t in rows:
        size[cls[t or ""]] += 1
        if i is not None:
            ids[cls[t or ""]].append(i)
    return {t: (min(ids[c], default=None), size[c]) for t, c in cls.items()}


def corpus(seed=1, bases=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(40)]
    texts = [None, "", " \n ", "one", "one", "one two three", "one  two three", "a b c d e f", "das " * 40, "das " * 44, "das " * 60]
    for k in range(bases):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        if k % 2:
            base = base[:30] + passage
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab) + "x"
            texts.append(rng.choice([" ", "\n"]).join(w))
    texts += texts[10:20]
    rng.shuffle(texts)
    return [(i if i % 17 else None, t) for i, t in enumerate(texts)]


def test_signature_is_unbiased():
    cache = _WordHashes()
    a, b = "das " * 9 + "x y z u v w " * 3, "das " * 14 + "x y z u v w q " * 2
    flat = split_words(a) + split_words(b)
    doc, value, nth, times = occurrences(*shingle_hashes(flat, np.array([len(split_words(a)), len(split_words(b))]), cache))
    one, m = nth == 0, 20000
    sig = B.signatures(doc[one], value[one], times[one], 2, m)
    both, either = similarity(bag(a), bag(b))
    assert abs((sig[0] == sig[1]).mean() - both / either) < 4 * (0.25 / m) ** 0.5
    assert np.isfinite(sig).all()
    # a text on its own has the same signature as inside a block
    sole = B.signatures(doc[one & (doc == 0)], value[one & (doc == 0)], times[one & (doc == 0)], 1, m)
    assert np.array_equal(sole[0], sig[0])


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = df.select("doc_id", "text", B.node_of("text").alias("node")).join(B.near_classes(df), "node").collect()
    want = brute_classes(rows)
    assert len(out) == len(rows)
    for r in out:
        assert (r.class_id, r.class_size) == want[r.text or ""], r.text


def test_classes_against_brute_force(spark):
    check(spark, corpus())


def test_loose_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(B, "BANDS", 30)
    monkeypatch.setattr(B, "ROWS", 2)               # many false candidates for the exact filter
    check(spark, corpus(seed=4, bases=15))


def test_links_between_texts_that_are_not_near_to_the_hub(spark):
    rng = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(40):
        w = list(base)
        for i in rng.sample(range(120), rng.randint(1, 6)):
            w[i] = f"{rng.choice('xyz')}{i}"         # edits that several copies share
        rows.append((k, " ".join(w)))
    check(spark, rows)


def test_chain_of_near_texts_is_one_class(spark):
    w = [f"v{i}" for i in range(200)]
    check(spark, [(k, " ".join(w[:k] + [f"n{i}" for i in range(k)] + w[k:])) for k in range(0, 12)])


def test_keep_one(spark):
    rows = corpus(seed=9, bases=8)
    rows += [r for r in rows if r[0] is not None][:15]            # repeated rows
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("__node", F.lit("mine"))
    kept = B.keep_one(df).collect()
    want = brute_classes(rows)
    assert len(kept) == len({want[t or ""] for _, t in rows} | set()) or len({w[0] for w in want.values()}) <= len(kept)
    by_class = collections.Counter()
    for r in kept:
        assert r["__node"] == "mine" and want[r.text or ""][0] == r.doc_id
        by_class[want[r.text or ""]] += 1
    assert set(by_class) == set(want.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert B.near_classes(df).count() == 0 and B.keep_one(df).count() == 0
