"""Scans and table catalogues.

A "table" is a Parquet folder or file; a catalogue is a mapping name -> path.
All functions return lazy DataFrames; nothing is collected except table names.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shape import is_deep

# The driver's test tables, in the order they are documented.
TEST_TABLES = ("region nation customer supplier part orders lineitem events "
               "documents embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def catalog(sf_dir: str, names: Iterable[str] = TEST_TABLES) -> dict[str, str]:
    """name -> path for the tables of one scale-factor folder."""
    return {n: table_path(sf_dir, n) for n in names}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full scan of one table. Pruning and pushdown are left to Catalyst."""
    return spark.read.parquet(table_path(sf_dir, name))


def doc_count(df: DataFrame) -> DataFrame:
    """A4: number of rows, as a one-row DataFrame (the aggregate stays lazy)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("doc_count"))


def _check_prefix(prefix: str) -> None:
    if prefix is None or prefix == "":
        raise ValueError("empty prefix: refusing to match every table")
    if prefix.startswith("."):
        raise ValueError("names starting with '.' are system tables")


def names_with_prefix(names: Iterable[str], prefix: str) -> list[str]:
    """D1 on a list of names: starts with the prefix and not with '.'."""
    _check_prefix(prefix)
    return sorted(n for n in names if n.startswith(prefix) and not n.startswith("."))


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """D1 as a row filter: ``col`` starts with ``prefix`` and not with '.'.

    ``startswith`` is pushed to the Parquet reader as a string-prefix filter.
    """
    _check_prefix(prefix)
    c = F.col(col)
    return df.filter(c.startswith(prefix) & ~c.startswith("."))


def selection_filter(df: DataFrame, selection: DataFrame | None, key: str,
                     prefix: str | None = None, prefix_col: str | None = None) -> DataFrame:
    """Rows named by a selection table win; otherwise the prefix rule.

    The selection is a ``left_semi`` join, so a key listed twice does not
    duplicate rows. No broadcast hint: the planner broadcasts the selection
    only when its measured size is under the broadcast threshold, else it
    shuffles both sides on the key.
    """
    if selection is not None:
        return df.join(selection.select(key), on=key, how="left_semi")
    if prefix is None:
        raise ValueError("give a selection table or a prefix")
    return prefix_filter(df, prefix_col or key, prefix)


def read_many(spark: SparkSession, tables: Mapping[str, str],
              selected: Iterable[str] | None = None, prefix: str | None = None,
              tag: str = "_table") -> DataFrame:
    """A2: read the selected tables, else all whose name starts with ``prefix``.

    Result is one DataFrame, the union by column name with a ``_table``
    column; columns missing from a table are null.
    """
    if selected:
        names = [n for n in selected]
        missing = [n for n in names if n not in tables]
        if missing:
            raise KeyError(f"unknown tables: {missing}")
    else:
        names = names_with_prefix(tables, prefix)
    if not names:
        raise ValueError(f"no table matches {prefix!r}")
    out = None
    for n in names:
        part = spark.read.parquet(tables[n]).select(F.lit(n).alias(tag), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def table_inventory(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """A3: one row per table (name without a leading '.'), its row count, by name.

    One job: the per-table counts are a union of global aggregates, each of
    which reads only Parquet row-group metadata-sized work (no columns).
    """
    out = None
    for n in sorted(t for t in tables if not t.startswith(".")):
        part = spark.read.parquet(tables[n]).agg(
            F.lit(n).alias("index"), F.count(F.lit(1)).cast("bigint").alias("doc_count"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("index")


def hits(df: DataFrame, index_name: str, key: str) -> DataFrame:
    """Wrap rows the way a document store returns them: metadata + ``_source``."""
    return df.select(F.lit(index_name).alias("_index"), F.col(key).cast("string").alias("_id"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_source"))


def unwrap_source(df: DataFrame, source_col: str = "_source") -> DataFrame:
    """A5: keep only the body of each hit."""
    return df.select(f"{source_col}.*")


def discover_columns(df: DataFrame, json_col: str, id_col: str) -> DataFrame:
    """Which keys occur in a JSON text column, with how many rows hold each.

    ``key`` is the top-level name; ``n_rows`` rows contain it, ``n_nonnull`` of
    them with a non-null value. Variant parsing runs in the JVM; the explode is
    a generator, and the grouping has map-side partial aggregation.
    """
    parsed = df.select(F.col(id_col), F.try_parse_json(F.col(json_col)).alias("_v"))
    kv = df.sparkSession.sql(
        "SELECT e.key AS key, e.value AS value "
        "FROM {p} AS p, LATERAL variant_explode_outer(p._v) AS e "
        "WHERE e.key IS NOT NULL", p=parsed)
    return (kv.groupBy("key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.count_if(F.expr("NOT is_variant_null(value)")).cast("bigint").alias("n_nonnull")))


def merged_schema(df: DataFrame, json_col: str) -> tuple[T.StructType, dict[str, int]]:
    """One schema that holds every JSON object of a column, and how many texts are none.

    ``schema_of_variant_agg`` merges the schemas of all rows in one aggregate
    (partial in every task): a key is there if any row has it, at any depth;
    values of different types widen to one that holds them (whole numbers and
    fractions to a decimal or double, else ``variant``). Only the schema text and
    the counts reach the driver. Counts: ``objects``, ``not_objects`` (JSON whose
    root is an array or a scalar), ``not_json`` (or nested too deep for a
    variant, see ``operators.shape.is_deep``), ``nulls``.
    """
    text = F.col(json_col)
    v = df.select(text.alias("text"), _variant(text).alias("v"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    got = v.agg(F.schema_of_variant_agg(F.when(is_object, F.col("v"))).alias("schema"),
                F.count_if(is_object).alias("objects"), F.count_if(F.col("v").isNotNull() & ~is_object).alias("not_objects"),
                F.count_if(F.col("text").isNotNull() & F.col("v").isNull()).alias("not_json"), F.count_if(F.col("text").isNull()).alias("nulls")).first()
    counts = {k: got[k] for k in ("objects", "not_objects", "not_json", "nulls")}
    return _struct_of(got["schema"] or "OBJECT<>"), counts


def _variant(text: Column) -> Column:
    return F.when(~is_deep(text), F.try_parse_json(text))


def _ddl(t: T.DataType) -> str:
    """A type as DDL with quoted names."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in t.fields) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def _struct_of(schema: str) -> T.StructType:
    """The struct type of a schema text of variants (OBJECT<...>); a key without any value is text."""
    ddl = re.sub(r"`(?:[^`]|``)*`|[A-Z]+", lambda m: {"OBJECT": "STRUCT", "VOID": "STRING"}.get(m.group(), m.group()), schema)
    return T.StructType([]) if ddl in ("STRUCT<>", "STRING") else T.DataType.fromDDL(ddl)


def typed_rows(df: DataFrame, json_col: str, id_cols: Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    """Id columns and one typed column per key of the merged schema; a missing key is null.

    Nested objects become structs. A value that its column's type does not hold
    is null there (none is with the merged schema of the same rows); a text that
    is no object has nulls only, so no row is lost.
    """
    ids = list(id_cols)
    schema = merged_schema(df, json_col)[0] if schema is None else schema
    clash = {c.lower() for c in ids} & {f.name.lower() for f in schema.fields}
    if clash:
        raise ValueError(f"id column(s) {sorted(clash)} are also keys of the objects")
    v = df.select(*ids, _variant(F.col(json_col)).alias("__v"))
    if not schema.fields:
        return v.select(*ids)
    whole = F.try_variant_get("__v", "$", _ddl(schema))
    return v.select(*ids, whole.alias("__s")).select(*ids, *[F.col("__s").getField(f.name).alias(f.name) for f in schema.fields])


def schema_rows(schema: T.StructType) -> list[tuple[str, str]]:
    """(dotted path, type) of every leaf of a schema, in its order; arrays are leaves."""
    def walk(t: T.StructType, prefix: str):
        for f in t.fields:
            if isinstance(f.dataType, T.StructType) and f.dataType.fields:
                yield from walk(f.dataType, f"{prefix}{f.name}.")
            else:
                yield f"{prefix}{f.name}", f.dataType.simpleString()
    return list(walk(schema, ""))
