"""Near duplicates by BagMinHash on multisets of word shingles.

Signature. A shingle of multiplicity w is a strip of height w above the shingle;
over every strip runs a Poisson process in time whose points fall uniformly on
its height and on the components of the signature. The process is hierarchical:
the height is discretised to unit cells and cut into the intervals [0,1), [1,2),
[2,4), [4,8), ...; each interval is a process of its own with a rate equal to its
length, and the points of the top interval that fall above w are discarded. Texts
that both hold a shingle share the points under the lower of the two heights, so
the earliest point of a component is the same with a probability equal to the
weighted Jaccard similarity. A process is followed only until it passes the latest
of the components' current minima.

Search. Signatures are cut into bands; texts with an equal band share a bucket.
No bucket is expanded into pairs: in each, one hub (the text with the most
bucket mates) is compared with all others, and texts linked by verified pairs form
classes. Pairs of *different* classes that share a bucket are then compared one by
one, after an exact filter on the shingles that a text has alone (``_open_pairs``):
where very many texts share a passage, or are almost near to each other, it leaves
few of them. Every comparison counts the multiset overlap exactly.

Output: one row per document with the class it belongs to; exact copies are one
text throughout, so copies cost nothing but their own row.

Defined cases: a null text equals an empty one; texts without words are all one
class; a text of one to four words has one shingle, its word list; repeated rows
fall into the class of their text; extra columns are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fresh, save_shared, table, text_of, within
from .shingles import _WordHashes, blocks, mix, occurrences, shingle_hashes

#: Components of a signature: bands times rows. At a similarity of 0.8 a pair shares no band
#: with a probability of (1 - 0.8 ** ROWS) ** BANDS = 8e-6. Long rows keep texts that only share a passage apart.
BANDS, ROWS = 64, 8
#: Verified similarity, as a fraction: NEAR_NUM / NEAR_DEN = 0.8.
NEAR_NUM, NEAR_DEN = 4, 5
#: 64-bit words of a parity sketch (see ``_open_pairs``).
PARITY_WORDS = 16
#: Texts to verify are picked by a broadcast of their keys up to this number, else by a shuffle.
BROADCAST_KEYS = 250_000


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Earliest point of each component for each text: (n_docs, m) of times, inf where a text is empty.

    ``doc``, ``value``, ``count``: text, hash and multiplicity of every distinct shingle.
    """
    best = np.full(n_docs * m, np.inf)
    # one process per shingle and interval: [0,1) is level 0; [2 ** (l - 1), 2 ** l) is level l
    parts = [(doc, value, count, np.zeros(len(doc), dtype=np.int64))]
    level = 1
    while True:
        has = count > 1 << (level - 1)
        if not has.any():
            break
        parts.append((doc[has], value[has], count[has], np.full(int(has.sum()), level)))
        level += 1
    doc, value, count, level = (np.concatenate(x) for x in zip(*parts))
    length = np.where(level > 0, np.int64(1) << np.maximum(level - 1, 0), 1)
    state = mix(value + mix(level.astype(np.uint64) + np.uint64(1)))
    time = np.zeros(len(doc))
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(doc):
        points = int(min(max(150_000 // len(doc), 1), 64))
        turn = np.arange(1, points + 1, dtype=np.uint64) * step
        at = state[:, None] + turn[None, :]
        u = ((mix(at) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        # gaps lie on a fixed grid and rates are powers of two: sums are exact, whatever the machine
        gaps = np.rint(-np.log(u) * 2.0 ** 30) * 2.0 ** -30 / length[:, None]
        times = np.cumsum(np.concatenate((time[:, None], gaps), axis=1), axis=1)[:, 1:]
        where = mix(at ^ np.uint64(0xD1B54A32D192ED03))
        component = ((where >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        base = np.where(level > 0, length, 0)
        cell = base[:, None] + (where & (length - 1).astype(np.uint64)[:, None]).astype(np.int64)
        under = cell < count[:, None]
        np.minimum.at(best, (doc[:, None] * m + component)[under], times[under])
        state, time = at[:, -1], times[:, -1]
        alive = np.unique(doc)
        latest = np.full(n_docs, -np.inf)
        latest[alive] = best.reshape(n_docs, m)[alive].max(axis=1)
        go = time < latest[doc]
        doc, count, level, length, state, time = (x[go] for x in (doc, count, level, length, state, time))
    return best.reshape(n_docs, m)


def band_keys(times: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band: equal for texts whose components in the band are equal."""
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(31) + bits[:, :, r])
    return key.view(np.int64)


def _signed(batches):
    cache = _WordHashes()
    for batch in batches:
        first = {}                                          # copies inside a batch are signed once
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            first.setdefault(node, text)
        nodes, texts = list(first), list(first.values())
        for begin, end, flat, counts in blocks(texts):
            doc, value, nth, times = occurrences(*shingle_hashes(flat, counts, cache))
            size = np.bincount(doc, minlength=end - begin)
            one = nth == 0
            keys = band_keys(signatures(doc[one], value[one], times[one], end - begin, BANDS * ROWS), BANDS, ROWS)
            full = np.flatnonzero(size)
            offsets = np.arange(len(full) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[begin + i] for i in full], type=pa.binary()), pa.array(size[full].astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel()))],
                names=["node", "n", "bands"])


def _bagged(batches):
    cache = _WordHashes()
    for batch in batches:
        nodes = batch.column(0).to_pylist()
        for begin, end, flat, counts in blocks(batch.column(1).to_pylist()):
            doc, value, nth, _ = occurrences(*shingle_hashes(flat, counts, cache))
            # the nth occurrence of a shingle is an element of its own: multiset overlap is set overlap
            element = mix(value + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=end - begin)))).astype(np.int32)
            bits = 64 * PARITY_WORDS
            odd = np.bincount(doc * bits + (element & (bits - 1)), minlength=(end - begin) * bits) & 1
            parity = np.packbits(odd.astype(np.uint8)).view(np.int64)
            words = np.arange(end - begin + 1, dtype=np.int32) * PARITY_WORDS
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[begin:end], type=pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(element)),
                 pa.ListArray.from_arrays(pa.array(words), pa.array(parity))], names=["node", "bag", "parity"])


def node_of(text_col: str) -> Column:
    """Key of a text: equal texts, and only they, have equal keys."""
    return F.unhex(F.md5(text_of(text_col)))


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    left = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = F.size(F.array_intersect("bag_a", "bag_b"))
    found = (pairs.join(left, "a").join(right, "b")
                  .select("a", "b", both.alias("both"), (F.size("bag_a") + F.size("bag_b")).alias("sum")))
    return found.filter(NEAR_DEN * F.col("both") >= NEAR_NUM * (F.col("sum") - F.col("both"))).select("a", "b")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, class) of the connected components of ``links`` (a, b); the class is the smallest node.

    Label propagation with shortcuts; every round is written to the shared
    folder, so a lost executor costs a round at most. Only the number of changed
    labels reaches the driver.
    """
    edges = scratch.save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .distinct(), "edges")
    labels = scratch.save(edges.groupBy("a").agg(F.min("b").alias("low"))
                         .select(F.col("a").alias("node"), F.least("a", "low").alias("class")), "labels")
    while True:
        heard = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                      .groupBy("a").agg(F.min("class").alias("heard")).withColumnRenamed("a", "node"))
        told = labels.join(heard, "node").select("node", F.col("class").alias("was"), F.least("class", "heard").alias("to"))
        # shortcut: the label of my label
        jump = labels.select(F.col("node").alias("to"), F.col("class").alias("further"))
        new = scratch.save(told.join(jump, "to", "left").select(
            "node", "was", F.least("to", F.coalesce("further", "to")).alias("class")), "labels")
        labels = new.select("node", "class")
        if new.filter(F.col("was") != F.col("class")).isEmpty():
            return labels


def _hub_pairs(groups: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of (bucket, node, n): the pairs of each bucket's hub with its other members, and each bucket's hub.

    The hub is the member with the most bucket mates over all buckets: the
    original of a group of near copies has more of them than any copy.
    """
    sizes = groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    multi = scratch.save(groups.join(sizes, "bucket"), "multi")
    mass = multi.groupBy("node").agg(F.sum("size").alias("mass"))
    hubs = scratch.save(multi.join(mass, "node").groupBy("bucket").agg(
        F.max(F.struct("mass", "node"))["node"].alias("hub")), "hubs")
    rest = multi.join(hubs, "bucket").filter(F.col("node") != F.col("hub"))
    pairs = rest.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    return pairs, rest.select("bucket", "node", "n")


def _open_buckets(rest: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (bucket, node, n, class), and the buckets that still hold several classes (bucket, least n)."""
    named = rest.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))
    some = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min("n").alias("least"))
    return named, some.filter(F.col("low") != F.col("high")).select("bucket", "least")


def _open_pairs(named: DataFrame, buckets: DataFrame, bags: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs of different classes in ``buckets`` that can still be near.

    Two exact filters go before any pair is made. Of the n shingles of a text, u
    occur in no other text of the buckets, so no partner shares more than s = n - u
    of them; near texts of n and m shingles share t / (1 + t) (n + m) at least. A
    text that cannot reach that even with the smallest member leaves the bucket
    (texts that only have a passage in common leave this way), and a pair is made
    only where both sides can reach it. The second filter counts what differs: near
    texts differ in (1 - t) / (1 + t) (n + m) shingles at most. Shingles are dealt to
    the bits of a sketch that hold whether their number is odd; every bit in which two
    sketches differ takes one shingle at least that only one of the texts has.
    """
    members = scratch.save(named.join(buckets, "bucket"), "members")
    nodes = members.select("node").distinct()
    shingles = nodes.join(bags, "node").select("node", F.explode("bag").alias("shingle"))
    # a shingle of one text only names that text: two aggregations, no join on shingles
    sole = (shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node"))
                    .filter(F.col("df") == 1).groupBy("node").agg(F.count(F.lit(1)).alias("u")))
    shared = F.col("n") - F.coalesce("u", F.lit(0))
    # the largest partner that a text of n shingles can have: (1 + t) / t s - n
    largest = F.floor(shared * F.lit(NEAR_NUM + NEAR_DEN) / F.lit(NEAR_NUM)).cast("bigint") - F.col("n")
    able = members.join(sole, "node", "left").withColumn("most", largest).filter(F.col("most") >= F.col("least"))
    able = scratch.save(able.join(bags.select("node", "parity"), "node")
                            .select("bucket", "class", "node", "n", "most", "parity"), "able")
    left, right = able.alias("x"), able.alias("y")
    differ = sum((F.bit_count(F.get("x.parity", F.lit(i)).bitwiseXOR(F.get("y.parity", F.lit(i)))) for i in range(PARITY_WORDS)), F.lit(0))
    few_differ = differ * (NEAR_DEN + NEAR_NUM) <= (F.col("x.n") + F.col("y.n")) * (NEAR_DEN - NEAR_NUM)
    return left.join(right, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node"))
                     & (F.col("x.class") != F.col("y.class")) & (F.col("x.n") <= F.col("y.most"))
                     & (F.col("y.n") <= F.col("x.most")) & few_differ).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, class_id, class_size, is_first, firsts) for every distinct text.

    ``class_id`` is the smallest id of its class, ``class_size`` the class's
    documents. ``is_first`` marks one text of each class, which holds a document
    of that id; ``firsts`` counts its rows with that id. ``node`` is
    ``node_of(text_col)``. Ids may repeat or be null: nulls come last.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _classes(docs, id_col, text_col, scratch)


def _classes(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    slim = docs.select(F.col(id_col).alias("id"), node_of(text_col).alias("node"))
    keyed = docs.select(node_of(text_col).alias("node"), text_of(text_col).alias("text"))
    per_id = slim.groupBy("node", "id").agg(F.count(F.lit(1)).alias("rows"))
    texts = scratch.save(per_id.groupBy("node").agg(
        F.min("id").alias("id"), F.sum("rows").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rows"))["rows"].alias("firsts")), "texts")
    signed = scratch.save(keyed.mapInArrow(_signed, "node binary, n bigint, bands array<bigint>")
                         .dropDuplicates(["node"]), "signed")
    pairs, rest = _hub_pairs(signed.select(F.explode("bands").alias("bucket"), "node", "n"), scratch)
    pairs = scratch.save(pairs, "pairs")
    rest = scratch.save(rest, "rest")

    # the multisets of the texts that share a bucket at all, one document of each text
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = scratch.save(wanted.join(texts, "node").select("node", F.col("id").alias("keep")), "wanted")
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    rows = docs.select(node_of(text_col).alias("node"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    picked = rows.join(wanted, "node").filter(F.col("id").eqNullSafe(F.col("keep"))).select("node", "text")
    bags = scratch.save(picked.mapInArrow(_bagged, "node binary, bag array<bigint>, parity array<bigint>").dropDuplicates(["node"]), "bags")

    links = scratch.save(_verified(pairs, bags), "links")
    labels = components(links, scratch)
    # pairs of texts of different classes that share a bucket
    named, buckets = _open_buckets(rest, labels)
    named, buckets = scratch.save(named, "named"), scratch.save(buckets, "open")
    more = _open_pairs(named, buckets, bags, scratch)
    links = scratch.save(links.unionByName(_verified(more, bags)), "links")
    labels = components(links, scratch)
    named = texts.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))
    classes = named.groupBy("class").agg(
        F.min("id").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))["node"].alias("first"))
    done = named.join(classes, "class").select("node", "class_id", "class_size",
                                               (F.col("node") == F.col("first")).alias("is_first"), "firsts")
    return save_shared(done, "classes")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id.

    Repeated rows of that id (or, in a class without ids, all rows) are reduced to
    one as well; only the rows of such classes are compared for it.
    """
    node, first, rows, chosen = fresh(docs, "__node", "__first", "__rows", "__chosen")
    classes = near_classes(docs, id_col, text_col).filter(F.col("class_size") > 1)
    groups = classes.select(F.col("node").alias(node), F.col("class_id").alias(first), F.col("firsts").alias(rows),
                            F.col("is_first").alias(chosen))
    if within(groups, BROADCAST_KEYS):          # texts of classes of one are not in it, and need no shuffle then
        groups = F.broadcast(groups)
    joined = docs.withColumn(node, node_of(text_col)).join(groups, node, "left")
    kept = joined.filter(F.col(chosen).isNull() | (F.col(chosen) & F.col(f"`{id_col}`").eqNullSafe(F.col(first))))
    one = kept.filter(F.coalesce(F.col(rows), F.lit(1)) == 1)
    more = kept.filter(F.col(rows) > 1).dropDuplicates([node])
    return one.unionByName(more).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = near_classes(docs)
    return (docs.select("doc_id", node_of("text").alias("node")).join(classes, "node")
                .select("doc_id", "class_id", "class_size"))
