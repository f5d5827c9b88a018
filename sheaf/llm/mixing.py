"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies,
``target / source_size``. Its whole part is taken as it is; the fractional
parts are rounded by the pivotal method: two documents with fractional copy
probabilities meet, word mass moves from one to the other in a random
direction (chosen so that both keep their expectation) until one of them is
integral, and the other goes on to the next document. Because the mass that
moves is counted in *words* (probability times size), the words a source gives
are kept exactly, up to the one document that is left over.

Distribution: the documents are put in order of a hash, numbered and cut into chunks
of a bounded number of rows, so that a source, or one repeated row, with a third of
all rows is many chunks; what a chunk holds of one source is one group, and each
group leaves at most one fractional document, and these residuals are combined
by further rounds over chunks of chunks (a reduction tree). The last residual of
a source is rounded by a coin of its own probability.

Defined cases: a null text has size 0; documents of size 0 carry no mass and are
rounded one by one; an empty table gives an empty result; identical rows are
interchangeable; a null source is a source of its own, last in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import WORD, fresh, save_shared, table, text_of

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: A target stops at so many times the size of its source.
MAX_REPEAT = 3.0
#: Rows of a chunk in which one task rounds, and residuals that one task combines.
CHUNK_ROWS = 2048
#: Up to so many sources the table of their targets is broadcast; beyond, it is joined by shuffle.
BROADCAST_SOURCES = 100_000


def source_targets(docs: DataFrame, source_col: str, size_col: str,
                   weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """One row per source: (source, source_size, n_docs, weight, target).

    The sources share the total size by weight; a source above ``max_repeat``
    times its size stops there and its excess is shared again by the rest,
    until none is above. Each pass is one aggregate over the table of sources;
    only its sums reach the driver.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size_col).cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked, _ = number_rows(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = save_shared(ranked.withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))), "sources")
    cap = F.col("source_size") * F.lit(max_repeat)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    # A source is capped once its cap is below its share at the current level (words per
    # unit of weight); the level only rises, so no source is ever released again.
    level, capped = 0.0, -1
    while True:
        is_capped = cap < F.col("weight") * F.lit(level)
        row = ranked.agg(F.sum(F.when(is_capped, cap)).alias("fixed"), F.count(F.when(is_capped, 1)).alias("n"),
                         F.sum(F.when(~is_capped, F.col("weight"))).alias("weight")).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped = row["n"]
        level = (total - (row["fixed"] or 0.0)) / row["weight"]
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _pivot(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> int:
    """Round ``p`` in place, conserving the sum of size times p; the index that stays fractional, or -1."""
    carry = -1
    for j in np.flatnonzero((p > 0) & (p < 1)):
        if carry < 0:
            carry = j
            continue
        a, b, pa_, pb = size[carry], size[j], p[carry], p[j]
        r = b / a
        up, down = min(1 - pa_, pb * r), min(pa_, (1 - pb) * r)
        if u[j] * (up + down) < down:       # raise the carried one, lower the new one
            if 1 - pa_ <= pb * r:
                pa_, pb = 1.0, pb - (1 - pa_) / r
            else:
                pa_, pb = pa_ + pb * r, 0.0
        elif pa_ <= (1 - pb) * r:
            pa_, pb = 0.0, pb + pa_ / r
        else:
            pa_, pb = pa_ - (1 - pb) * r, 1.0
        # what is integral up to rounding errors is integral
        p[carry], p[j] = (0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x for x in (pa_, pb))
        if not 0 < p[carry] < 1:
            carry = j if 0 < p[j] < 1 else -1
    return carry


def deal(rows: DataFrame, order: list[str], chunk: str, chunk_rows: int) -> tuple[DataFrame, int]:
    """``rows`` plus ``chunk``, their rank in ``order`` by ``chunk_rows``; and the number of chunks."""
    rows, total = number_rows(rows, order, chunk)
    return rows.withColumn(chunk, F.floor(F.col(chunk) / F.lit(chunk_rows)).cast("bigint")), -(-total // chunk_rows)


def mix(docs: DataFrame, source_col: str = "source", size_col: str = "size", key_cols: tuple[str, ...] = ("doc_id",),
        weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 17,
        chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` plus (source_size, target, copies): how often the mix takes each row.

    Where ``docs`` has a column of one of these names, underscores are put before the new one.

    ``key_cols`` seed the random choices: the same rows give the same result in
    any order and partitioning. Columns of ``docs`` pass through unchanged.
    """
    p, h, chunk, whole, lev, src = fresh(docs, "__p", "__h", "__chunk", "__whole", "__done", "__src")
    in_source, target, copies = fresh(docs, "source_size", "target", "copies")
    targets = source_targets(docs, source_col, size_col, weights, max_repeat).select(
        F.col("source").alias(src), F.col("source_size").alias(in_source), F.col("target").alias(target))
    # whether the table of sources may be broadcast is decided on its counted size
    small = targets.count() <= BROADCAST_SOURCES
    joined = docs.join(F.broadcast(targets) if small else targets, docs[source_col].eqNullSafe(targets[src]))
    ratio = F.when(F.col(in_source) > 0, F.least(F.lit(max_repeat), F.col(target) / F.col(in_source))).otherwise(0.0)
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("coin"), *key_cols), 11) / F.lit(float(1 << 53))
    frac = ratio - F.floor(ratio)
    zero = F.coalesce(F.col(size_col), F.lit(0)) <= 0
    rows = (joined
            .withColumn(whole, F.floor(ratio).cast("bigint"))
            # a document without words is rounded by its own coin at once
            .withColumn(p, F.when(zero, F.when(unit < frac, 1.0).otherwise(0.0)).otherwise(frac))
            .withColumn(h, F.xxhash64(F.lit(seed), *key_cols, size_col)))
    rows, most = deal(rows, [h, *key_cols, size_col], chunk, chunk_rows)
    rows = rows.withColumn(lev, F.lit(False))
    schema = rows.schema

    def rounding(level: int):
        def run(key, group):
            # large documents meet first, so that what stays fractional in the end is small
            group = group.take(pc.sort_indices(group, sort_keys=[(size_col, "descending"), (h, "ascending")]))
            probs = group.column(p).to_numpy().copy()
            size = group.column(size_col).cast(pa.float64()).fill_null(0).to_numpy()
            own = (level << 48) ^ int(group.column(h)[0].as_py()) ^ int(group.column(chunk)[0].as_py()) * 0x9E3779B97F4A7C15
            rng = np.random.Generator(np.random.Philox(key=[seed, own & (1 << 64) - 1]))
            left = _pivot(size, probs, rng.random(len(probs)))
            done = np.ones(len(probs), dtype=bool)
            if left >= 0:
                done[left] = False
            names = group.schema.names
            group = group.set_column(names.index(p), p, pa.array(probs))
            return group.set_column(names.index(lev), lev, pa.array(done))
        return run

    parts = []
    level, rest = 0, rows
    while True:
        out = save_shared(rest.groupBy(src, chunk).applyInArrow(rounding(level), schema), f"mix{level}")
        parts.append(out.filter(F.col(lev)))
        rest = out.filter(~F.col(lev))
        if most <= 1:
            break
        most, level = -(-most // chunk_rows), level + 1
        rest = rest.withColumn(chunk, F.floor(F.col(chunk) / F.lit(chunk_rows)).cast("bigint"))
    last = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("last"), *key_cols), 11) / F.lit(float(1 << 53))
    parts.append(rest.withColumn(p, F.when(last < F.col(p), 1.0).otherwise(0.0)))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn(copies, F.col(whole) + F.col(p).cast("bigint")).drop(p, h, chunk, whole, lev, src)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.regexp_count(text_of("text"), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("text_hash"))
    return mix(docs, key_cols=("doc_id", "text_hash")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
