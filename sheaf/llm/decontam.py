"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

A test item of q shingles inside a document of N >> q has a Jaccard similarity
near q / N, which MinHash cannot see. So the search is partitioned by size: items
are put into classes by the power of two w that bounds their shingles, and for each
class a document counts as overlapping blocks of 2 w shingles, one every w. An item
that a document contains lies in one block whole, with a similarity of
t q / (2 w + (1 - t) q) > 0.19 at a containment of t = 0.8, whatever the document's
length; with ``FUNCTIONS`` hash functions, one equal minimum is missed with a
probability below 0.81 ** 64 = 1.4e-6.

The blocks' minima are not computed for a whole corpus. A block can only share a
minimum with an item if it holds the very shingle that is the item's minimum, so
the shingles of all documents are first looked up in the (small) set of the items'
minimum shingles; block minima are then taken around the hits alone. Candidates are
verified by the exact containment of the item's shingles in the document, as texts.

An item of one to four words has one shingle, all of its words: a document contains it
where the same words stand in a row. Such items need no signature; the runs of as many
words of all documents are looked up as the minimum shingles are.

Defined cases: null texts are empty; an item without words matches nothing; a document
of fewer than five words can only contain items of as many words or fewer; copies of an item are one item, the smallest
id; exact copies of a document are searched once; repeated rows are reported as
often as they occur; other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SHINGLE, Scratch, fresh, let, save_shared, table, text_of, within, words

#: Containment from which an item counts as found, as a fraction: 4 / 5 = 0.8.
NUM, DEN = 4, 5
#: MinHash functions of an item's signature.
FUNCTIONS = 64
#: Rows up to which a table of keys is broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 500_000


def _shingles(text: Column, of, size: int = SHINGLE) -> Column:
    """``of(words, i)`` for every run of ``size`` words of a text."""
    return let(words(text), lambda w: F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: of(w, i))))


def _hashed(text: Column, size: int = SHINGLE) -> Column:
    return _shingles(text, lambda w, i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]), size)


def _spelled(text: Column, size: int = SHINGLE) -> Column:
    return F.array_distinct(_shingles(text, lambda w, i: F.array_join(F.slice(w, i + 1, size), " "), size))


def _all_of(parts: list[Column], kind: str) -> Column:
    """Arrays one after the other; null ones are empty."""
    return F.concat(*[F.coalesce(p, F.array().cast(f"array<{kind}>")) for p in parts])


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def item_signatures(items: DataFrame, scratch: Scratch, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Items (item, n_items, shingles, w) and their signatures (item, w, i, value, hash); w is 0 for items under five words."""
    text = text_of(text_col)
    one = items.groupBy(text.alias("text")).agg(F.min(id_col).alias("item"), F.count(F.lit(1)).alias("n_items"))
    whole = words(F.col("text"))
    listed = one.withColumn("shingles", F.coalesce(_spelled(F.col("text")), F.when(F.size(whole) > 0, F.array(F.array_join(whole, " ")))))
    listed = listed.filter(F.size("shingles") > 0).withColumn("n_words", F.size(whole))
    w = F.greatest(F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles")))).cast("int"), F.lit(4))
    listed = scratch.save(listed.withColumn("w", F.when(F.col("n_words") < SHINGLE, 0).otherwise(w)), "items")
    minima = F.transform(F.sequence(F.lit(0), F.lit(FUNCTIONS - 1)), lambda i: F.array_min(F.transform(
        "hashes", lambda h: F.struct(F.xxhash64(h, i).alias("value"), h.alias("hash"), i.alias("i")))))
    signed = (listed.filter("w > 0").withColumn("hashes", F.array_distinct(_hashed(F.col("text"))))
                    .select("item", "w", F.explode(minima).alias("m")).select("item", "w", "m.i", "m.value", "m.hash"))
    return listed, scratch.save(signed, "signed")


def contained(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """(text_key, item, n_items, n_shared, n_item): the items that the distinct texts of ``docs`` contain."""
    with Scratch(docs.sparkSession) as scratch:
        return save_shared(_contained(docs, items, text_of(text_col), scratch), "contained")


def _contained(docs: DataFrame, items: DataFrame, text: Column, scratch: Scratch) -> DataFrame:
    plain = docs.select(_key(text).alias("text_key"), text.alias("text"))
    listed, signed = item_signatures(items, scratch)
    # hits: the shingles of documents that are some item's minimum
    sizes = sorted(r[0] for r in listed.filter("w = 0").select("n_words").distinct().collect())       # some of 1 to 4
    minima = signed.select("hash").distinct()
    placed = F.posexplode(_hashed(F.col("text"))).alias("pos", "hash")
    if sizes:       # runs of as many words as a short item has stand without a place
        short = listed.filter("w = 0").select("item", F.coalesce(*[
            F.when(F.col("n_words") == k, F.get(_hashed(F.col("text"), k), F.lit(0))) for k in sizes]).alias("hash"))
        minima = minima.union(short.select("hash")).distinct()
        runs = [F.transform(F.array_distinct(_hashed(F.col("text"), k)), lambda h: F.struct(F.lit(-1).alias("pos"), h.alias("hash"))) for k in sizes]
        long = F.transform(_hashed(F.col("text")), lambda h, i: F.struct(i.alias("pos"), h.alias("hash")))
        placed = F.inline(_all_of([long, *runs], "struct<pos:int,hash:bigint>"))
    if within(minima, BROADCAST_ROWS):
        minima = F.broadcast(minima)
    hits = plain.select("text_key", placed).join(minima, "hash").distinct()
    hits = scratch.save(hits, "hits")
    # the texts with hits, each once
    keys = scratch.save(hits.select("text_key").distinct(), "keys")
    if within(keys, BROADCAST_ROWS):
        keys = F.broadcast(keys)
    texts = scratch.save(plain.join(keys, "text_key").groupBy("text_key").agg(F.first("text").alias("text")), "texts")
    hashed = texts.select("text_key", _hashed(F.col("text")).alias("hashes"))
    per_item = (hits.filter("pos >= 0").join(signed, "hash").groupBy("text_key", "item", "w")
                    .agg(F.collect_list(F.struct("pos", "i", "value")).alias("at")))

    def block_agrees(e: Column, start: Column) -> Column:
        block = F.slice("hashes", F.greatest(start, F.lit(0)) + 1, F.least(start, F.lit(0)) + 2 * F.col("w"))
        return F.array_min(F.transform(block, lambda h: F.xxhash64(h, e["i"]))) == e["value"]
    first = lambda e: F.floor(e["pos"] / F.col("w")).cast("int") * F.col("w")
    candidates = (per_item.join(hashed, "text_key")
                  .filter(F.exists("at", lambda e: block_agrees(e, first(e)) | block_agrees(e, first(e) - F.col("w"))))
                  .select("text_key", "item"))
    every = _spelled(F.col("text"))
    if sizes:
        candidates = candidates.union(hits.filter("pos < 0").join(short, "hash").select("text_key", "item"))
        every = _all_of([_spelled(F.col("text"), k) for k in [SHINGLE, *sizes]], "string")
    spelled = texts.select("text_key", every.alias("all"))
    return (candidates.join(spelled, "text_key").join(listed.drop("text"), "item")
            .select("text_key", "item", "n_items", F.size(F.array_intersect("shingles", "all")).cast("bigint").alias("n_shared"),
                    F.size("shingles").cast("bigint").alias("n_item"))
            .filter(DEN * F.col("n_shared") >= NUM * F.col("n_item")))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without those that contain a benchmark item."""
    (key,) = fresh(docs, "__text_key")
    bad = contained(docs, items, text_col).select(F.col("text_key").alias(key)).distinct()
    if within(bad, BROADCAST_ROWS):
        bad = F.broadcast(bad)
    return docs.withColumn(key, _key(text_of(text_col))).join(bad, key, "left_anti").drop(key)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = contained(docs, items)
    return (docs.select("doc_id", _key(text_of("text")).alias("text_key")).join(found, "text_key")
                .select("doc_id", F.col("item").alias("item_id"), "n_items", "n_shared", "n_item",
                        (F.col("n_shared") / F.col("n_item")).alias("containment")))


OP3_SQL = r"""
WITH w AS (SELECT min(item_id) AS item_id, count(*) AS n_items, text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM benchmark GROUP BY text),
i AS (SELECT item_id, n_items, least(len(w), 5) AS size, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)),
             lambda k: array_to_string(w[k:k+4], ' ')))) AS s FROM w WHERE len(w) > 0),
q AS (SELECT item_id, n_items, count(*) AS n_item FROM i GROUP BY ALL),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, r, unnest(list_distinct(list_transform(range(1, len(w) - size + 2),
             lambda k: array_to_string(w[k:k+size-1], ' ')))) AS s FROM d, (SELECT DISTINCT size FROM i)),
c AS (SELECT doc_id, r, item_id, count(*) AS n_shared FROM g JOIN i USING (s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_items AS BIGINT) AS n_items, CAST(n_shared AS BIGINT) AS n_shared,
       CAST(n_item AS BIGINT) AS n_item, n_shared / n_item AS containment
FROM c JOIN q USING (item_id) WHERE 5 * n_shared >= 4 * n_item
"""
