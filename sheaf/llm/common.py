"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import Scratch, delete_path, save_shared  # noqa: F401  (re-exported)

#: A word, as every contract of this subpackage defines it.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a shingle, and the similarity from which two texts are near duplicates.
SHINGLE, NEAR = 5, 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array (empty for a blank text)."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A name for each of ``names`` that clashes with no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def within(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows (reads no more than that many)."""
    return df.limit(limit + 1).count() <= limit


def broadcast_within(df: DataFrame, limit: int) -> DataFrame:
    """``df`` with a broadcast hint only if it was counted to have at most ``limit`` rows."""
    return F.broadcast(df) if within(df, limit) else df


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)
