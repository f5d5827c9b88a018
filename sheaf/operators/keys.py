"""Keys (SURVEY K1-K3).

``add_key`` numbers rows 0..n-1 (plus an offset) in an explicit order without
a global window: the whole rows are range-partitioned on the order columns
once and written to the shared folder with their partition's number; each
row's key is its rank inside its partition plus the rows of all earlier
partitions (``ranking.number_rows``). Counts and keys are read from that one
copy, so they cannot disagree whatever columns a reader keeps. Several tables
run on from one another by the number of rows of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import number_rows


def common_columns(tables: Sequence[DataFrame]) -> list[str]:
    """K1 step 1: names present in every table (case-sensitive, as dict keys)."""
    if not tables:
        raise ValueError("no tables selected")
    names = set(tables[0].columns)
    for t in tables[1:]:
        names &= set(t.columns)
    if not names:
        raise ValueError("no common key in selected tables")
    return sorted(names)


def key_profile(tables: dict[str, DataFrame], candidates: Sequence[str] | None = None) -> DataFrame:
    """K1: judge every common column as a key, over all tables, in one job.

    Per (table, key): rows, nulls, distinct non-null values, and duplicates
    (non-null rows minus distinct values: rows that would overwrite another).
    Distinct counting groups by (table, key, value) first: a hot value is
    pre-aggregated in each task, and no value list is ever collected.
    """
    names = list(tables)
    cands = list(candidates) if candidates else common_columns([tables[n] for n in names])
    long = None
    for n in names:                 # one scan per table: its candidates are unpivoted
        each = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("v")) for c in cands])
        part = tables[n].select(F.lit(n).alias("table"), F.inline(each))
        long = part if long is None else long.unionByName(part)
    per_value = long.groupBy("table", "key", "v").agg(F.count(F.lit(1)).alias("cnt"))
    return (per_value.groupBy("table", "key")
            .agg(F.sum("cnt").cast("bigint").alias("n_rows"),
                 F.sum(F.when(F.col("v").isNull(), F.col("cnt")).otherwise(0)).cast("bigint").alias("n_null"),
                 F.count("v").cast("bigint").alias("n_distinct"),
                 F.sum(F.when(F.col("v").isNotNull(), F.col("cnt") - 1).otherwise(0))
                  .cast("bigint").alias("n_duplicates")))


def choose_key(profile: DataFrame) -> str:
    """K1 last step: the first candidate (by name) with no nulls and no
    duplicates in any table. The profile has one row per (table, candidate),
    bounded by the schema widths, so reading it on the driver is safe."""
    rows = profile.collect()
    by_key: dict[str, bool] = {}
    for r in rows:
        ok = r["n_null"] == 0 and r["n_duplicates"] == 0
        by_key[r["key"]] = by_key.get(r["key"], True) and ok
    good = sorted(k for k, ok in by_key.items() if ok)
    if not good:
        raise ValueError("no common column is a key in every table")
    return good[0]


def _check_offset(offset) -> int:
    if isinstance(offset, str):
        if not offset.isdigit():
            raise ValueError(f"{offset} is not a valid number")
        offset = int(offset)
    if not isinstance(offset, int) or offset < 0:
        raise ValueError(f"{offset} is not a valid number")
    return offset


def add_key(tables: Sequence[DataFrame], order_by: Sequence[Sequence[str]], name: str = "_key",
            offset: int | str = 0) -> list[DataFrame]:
    """K2 / K3: consecutive bigint keys over several tables, running on; every column is kept.

    ``order_by[i]`` lists the order columns of table i; together they must
    identify a row (add a unique column as the last one), otherwise ties are
    numbered in an unspecified but still gap-free order.
    """
    start, out = _check_offset(offset), []
    for df, order in zip(tables, order_by):
        numbered, n = number_rows(df, order, name, start)
        out.append(numbered)
        start += n
    return out
