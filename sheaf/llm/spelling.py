"""Spelling variants: words that differ by one letter, by a frontier of states over a relational trie.

The distinct words form a trie, and their reversals a second one. Chains without
a branch are folded into one edge, so a trie is a table of edges (node, first
letter, label, child); a node is known by the hash of its prefix. Two words that
differ by one deletion or replacement part at a node that both of their paths
visit, and one of the two directions meets that node in the far half of the
word, where a trie has few branches. So the frontier starts there:

* the states without an edit are the nodes on a word's own path in its far half;
* one edit makes of them (word, position, node, 1): the word's next letter is
  skipped, or an edge with another, greater first letter is taken in its place;
* level by level every state takes the one edge that starts with the word's next
  letter and whose whole label agrees; states without such an edge end;
* a state at the end of its word, at a node that is a word, is a pair.

Insertions are the deletions of the other word, and replacements by a smaller
letter those of the other word by a greater one. A pair counts only if the words
themselves show it, so equal hashes of different prefixes add nothing.

Every join is by (node, letter). Nodes with more than ``WIDE`` words below them
are dealt to ``SALTS`` parts, their edges repeated for each. A level is written to
the shared folder before the next one begins; there are as many levels as the
deepest path below a branch has edges.

Defined cases: null texts have no words; a null id is written as an empty one;
words occur as often as rows repeat them; an empty table gives an empty result;
words of any length are read whole; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, save_shared, table, text_of
from .shingles import mix

#: Least code points and occurrences of a word.
MIN_LENGTH, MIN_COUNT = 7, 2
#: A word's form occurs at least so many times as often.
FORM_RATIO = 10
#: One run in so many (by a checksum of document and run) loses a letter.
DELETE_ONE_IN = 31
#: A node with more words below it is dealt to so many parts.
WIDE, SALTS = 2_000, 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts, after one in ``DELETE_ONE_IN`` has lost a letter."""
    letter = r"[A-Za-z\x{C0}-\x{FF}]"
    runs = F.regexp_extract_all(text_of(text_col), F.lit(rf"(?<!{letter}){letter}{{{min_length},}}+"), F.lit(0))
    at = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    at = at.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    at = at.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    gone = (F.col("h") % F.length("run")).cast("int")
    spelled = F.when(F.col("h") % DELETE_ONE_IN == 0, F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))).otherwise(F.col("run"))
    counted = at.groupBy(spelled.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _far(size, back):
    """Where the far half of a path of ``size`` letters begins; both halves meet in the middle of the word."""
    return size // 2 + back * (size % 2)


def _prefixes(paths: DataFrame) -> DataFrame:
    """(path, back, depth, node, letter): the prefixes that reach into a path's far half, with the letter behind ('' at the end)."""
    def run(batches):
        for batch in batches:
            words, back = batch.column(0), batch.column(1)
            texts = words.to_pylist()
            sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
            points = np.frombuffer("\0".join(texts + [""]).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            first = np.cumsum(sizes) - sizes
            depth = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
            power = np.full(int(sizes.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
            power[0] = 1
            weighed = mix(points + np.uint64(1)) * np.cumprod(power)[depth]
            before = np.cumsum(weighed) - weighed                    # wraps, and so do differences
            row = np.repeat(np.arange(len(texts)), sizes)
            seed = mix(np.array(back.to_numpy(zero_copy_only=False), dtype=np.uint64) + np.uint64(7))[row]
            node = mix(before - before[first][row] + seed + mix(depth.astype(np.uint64))).view(np.int64)
            reverse = np.array(back.to_numpy(zero_copy_only=False), dtype=np.int64)
            at = np.flatnonzero(depth >= _far(sizes - 1, reverse)[row])
            letters = pa.array([c for t in texts for c in (*t, "")], pa.string())
            row = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([words.take(row), back.take(row), pa.array(depth[at].astype(np.int32)), pa.array(node[at]), letters.take(pa.array(at))],
                                             names=["path", "back", "depth", "node", "letter"])
    return paths.select("path", "back").mapInArrow(run, "path string, back boolean, depth int, node bigint, letter string")


def trie(words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The folded tries of the words and of their reversals, from the depths on at which states can start.

    Two words that differ by one letter have lengths that differ by one at most,
    so a word's prefixes before its own far half are met by no state. Returns the paths (path, back, nodes: array of depth, node, wide), where
    ``path`` is the word or its reversal, and the edges (node, letter, label,
    child, child_ends, child_wide, salt).
    """
    paths = words.select(F.col("word").alias("path"), F.lit(False).alias("back")).unionByName(
        words.select(F.reverse("word").alias("path"), F.lit(True).alias("back")))
    prefixes = _prefixes(paths)
    shape = prefixes.groupBy("node").agg(
        F.min("letter").alias("low"), F.max("letter").alias("high"), F.count(F.lit(1)).alias("n"))
    ends = F.col("low") == ""
    nodes = scratch.save(shape.filter((F.col("low") != F.col("high")) | ends)
                              .select("node", ends.alias("ends"), (F.col("n") > WIDE).alias("wide")), "nodes")
    listed = prefixes.join(nodes, "node").groupBy("path", "back").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node", "ends", "wide"))).alias("nodes"))
    listed = scratch.save(listed, "paths")
    steps = F.transform(F.arrays_zip(F.slice("nodes", 1, F.size("nodes") - 1).alias("a"), F.slice("nodes", 2, F.size("nodes")).alias("b")),
                        lambda z: F.struct(z["a"]["node"].alias("node"), F.substring("path", z["a"]["depth"] + 1, z["b"]["depth"] - z["a"]["depth"]).alias("label"),
                                           z["b"]["node"].alias("child"), z["b"]["ends"].alias("child_ends"), z["b"]["wide"].alias("child_wide"), z["a"]["wide"].alias("wide")))
    edges = listed.filter(F.size("nodes") > 1).select(F.explode(steps).alias("e")).select("e.*").distinct()
    edges = edges.withColumn("letter", F.left("label", F.lit(1))).withColumn(
        "salt", F.explode(F.when(F.col("wide"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return listed, scratch.save(edges.drop("wide"), "edges")


def _salt(wide: Column) -> Column:
    return F.when(wide, F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).otherwise(0)


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): the pairs of words that differ by one letter, each pair in both orders."""
    paths, edges = trie(words, scratch)
    size = F.length("path")
    # states without an edit: the nodes on a word's own path
    own = paths.select("path", "back", F.explode("nodes").alias("at")).select("path", "back", F.col("at.depth").alias("pos"), "at.node", "at.ends", "at.wide")
    own = own.filter(F.col("pos") < size).withColumn("salt", _salt(F.col("wide")))
    end = F.col("pos") + F.length("label")

    def take(states: DataFrame, keys: list[str], agrees: Column) -> DataFrame:
        """States one edge further; ``agrees`` says how the label must agree with the word."""
        moved = states.join(edges, keys).filter(agrees)
        return moved.select("path", "back", end.alias("pos"), F.col("child").alias("node"), F.col("child_ends").alias("ends"),
                            F.col("child_wide").alias("wide"))
    follows = F.substring("path", F.col("pos") + 1, F.length("label")) == F.col("label")
    replaced = (F.col("letter") > F.substring("path", F.col("pos") + 1, F.lit(1))) & (end <= size) & (
        F.substring("path", F.col("pos") + 2, F.length("label") - 1) == F.substring("label", F.lit(2), F.length("label")))
    # of a run of one letter the last is skipped: there the two words part
    letter = lambda at: F.substring("path", at, F.lit(1))
    skipped = own.filter(letter(F.col("pos") + 1) != letter(F.col("pos") + 2)).select("path", "back", (F.col("pos") + 1).alias("pos"), "node", "ends", "wide")
    frontier = skipped.unionByName(take(own.drop("ends", "wide"), ["node", "salt"], replaced))
    found = []
    while True:
        frontier = scratch.save(frontier, "frontier")
        found.append(frontier.filter((F.col("pos") == size) & F.col("ends")).select("path", "back", "node"))
        going = frontier.filter(F.col("pos") < size).drop("ends")
        if going.isEmpty():
            break
        going = going.withColumn("letter", F.substring("path", F.col("pos") + 1, F.lit(1))).withColumn("salt", _salt(F.col("wide"))).drop("wide")
        frontier = take(going, ["node", "salt", "letter"], follows)
    ended = found[0]
    for more in found[1:]:
        ended = ended.unionByName(more)
    # the words at the final nodes; both are read forwards again
    last = F.element_at("nodes", -1)
    named = paths.select(last["node"].alias("node"), F.col("path").alias("other"))
    forward = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    pairs = ended.join(named, "node").select(forward("path").alias("a"), forward("other").alias("b")).distinct()
    pairs = pairs.filter((F.col("a") != F.col("b")) & (F.levenshtein("a", "b") == 1))
    pairs = scratch.save(pairs, "pairs")                 # each from one side only: the longer word, or the smaller letter
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def spelling_groups(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words.

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if it occurs ``ratio`` times as often; ``root`` is where the forms
    lead to. A chain of forms at least doubles at each step for a ratio of 2 or
    more, so pointers meet their root within seven doublings.
    """
    with Scratch(words.sparkSession) as scratch:
        words = scratch.save(words.select("word", "n"), "words")
        pairs = near_pairs(words, scratch)
        weighed = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
        near = weighed.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.max("b_n").alias("top"),
                                        F.min(F.struct((-F.col("b_n")).alias("order"), "b")).alias("best"))
        near = near.select(F.col("a").alias("word"), "n_near", "top", F.col("best.b").alias("best"))
        listed = words.join(near, "word", "left")
        has = F.col("top") >= ratio * F.col("n")
        listed = scratch.save(listed.select("word", "n", F.when(has, F.col("best")).alias("form"), F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                                            F.when(has, F.col("top")).alias("form_n")), "listed")
        links = scratch.save(listed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "links")
        while True:
            further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
            moved = scratch.save(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
            links = moved.drop("moved")
            if moved.filter("moved").isEmpty():
                break
        out = listed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
        return save_shared(out.select("word", "form", "root", "n", "n_near", "form_n"), "spelling")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))
