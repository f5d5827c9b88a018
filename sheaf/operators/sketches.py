"""Field statistics as mergeable sketches.

``sketch_fields`` reads a table once and leaves one small row per column: counts, a
HyperLogLog sketch of the values' text forms and a KLL sketch of their lengths. Such
rows are kept per table (or per day, per load); ``merge_fields`` unites them without
a rescan, as if all tables had been read together, and ``read_fields`` estimates.

Only sketches are shuffled: with the defaults at most about 20 KB per column and task,
whatever the number of rows. Errors: distinct values 0.8 % (one standard deviation at
``LG_K`` = 14), quantiles of lengths by rank 1 %. Counts and the greatest length are exact.

Defined cases: nulls count as rows only; a column of nulls, or of an empty table, has 0
distinct values and null lengths; a table without columns gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a HyperLogLog sketch, and the size parameter of a KLL sketch.
LG_K, KLL_K = 14, 400


def sketch_fields(df: DataFrame, columns: Sequence[str] | None = None, lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """One row per column of ``df``: (column, n_rows, n_nonnull, max_len, distinct, lengths), the last two sketches."""
    fields = []
    for name in df.columns if columns is None else columns:
        value = F.col("`" + name.replace("`", "``") + "`").cast("string")
        length = F.length(value).cast("bigint")
        fields.append(F.struct(F.lit(name).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_nonnull"),
                               F.max(length).alias("max_len"), F.hll_sketch_agg(value, F.lit(lg_k)).alias("distinct"),
                               F.kll_sketch_agg_bigint(length, F.lit(kll_k)).alias("lengths")))
    if not fields:
        return sketch_fields(df.select(F.lit("").alias("c"))).filter(F.lit(False))
    return df.agg(F.array(*fields).alias("fields")).select(F.explode("fields").alias("f")).select("f.*")


def merge_fields(*sketches: DataFrame) -> DataFrame:
    """The sketches of several tables as one; columns of the same name are united."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nonnull").alias("n_nonnull"), F.max("max_len").alias("max_len"),
        F.hll_union_agg("distinct", F.lit(True)).alias("distinct"), F.kll_merge_agg_bigint("lengths").alias("lengths"))


def read_fields(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """(column, n_rows, n_nonnull, max_len, n_distinct, len_quantiles), the last two estimated."""
    quantiles = F.array(*[F.kll_sketch_get_quantile_bigint("lengths", F.lit(float(r))) for r in ranks])
    return sketches.select("column", "n_rows", "n_nonnull", "max_len", F.hll_sketch_estimate("distinct").alias("n_distinct"),
                           F.when(F.col("n_nonnull") > 0, quantiles).alias("len_quantiles"))
