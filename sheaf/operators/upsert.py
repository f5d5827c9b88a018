"""Keyed writes.

A document store indexes every row under ``_id = key``: a later row with the
same id replaces the earlier one in full. Here a write is a DataFrame transform:

    new_table = upsert(target, batch, key, order)

* in-batch last-wins: ``groupBy(key).agg(max_by(struct(*), order))`` — a sort
  aggregate (the row is a struct), partial on the map side, so a key holding a
  third of the batch is reduced inside every task before the shuffle;
* rows of the target whose key is in the batch are dropped with a
  ``left_anti`` join (the planner broadcasts the batch only when its measured
  size is under the threshold; both sides have unique keys, so no join skew);
* the batch rows are appended with ``unionByName(allowMissingColumns=True)``:
  columns the batch lacks are null (full replace, not a merge).

``replace_table`` writes a result to a new folder through Spark's commit and
then points the catalogue entry to it, one metadata change: a failed or retried
job leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .kinds import rejects_of
from .ranking import save_shared

RESERVED = ("_id", "_index")


class KeyError_(ValueError):
    """A key rule was broken (missing, null, reserved column)."""


def _order_expr(order) -> Column:
    """The order as a struct: never null itself, so a row with a null order value still
    counts (it is smaller than any other) instead of being skipped by ``max_by``."""
    parts = order if isinstance(order, (list, tuple)) else [order]
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in parts])


def check_columns(df: DataFrame, key: str, name: str = "batch") -> None:
    """Driver-side checks on the schema only (no job)."""
    if key not in df.columns:
        raise KeyError_(f"{name}: key column {key!r} is missing")
    bad = [c for c in df.columns if c in RESERVED]
    if bad:
        raise KeyError_(f"{name}: reserved column name(s) {bad}")


def guard_null_keys(df: DataFrame, key: str) -> DataFrame:
    """Fail the job at run time on a null key (lazy: no extra pass over the data)."""
    k = F.col(key)
    return df.withColumn(key, F.when(k.isNull(), F.raise_error(F.lit(f"null key in column {key}")))
                         .otherwise(k).cast(df.schema[key].dataType))


def latest_per_key(batch: DataFrame, key: str, order, drop_order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (make it unique per key)."""
    cols = [c for c in batch.columns if c not in drop_order]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    return (batch.groupBy(key)
                 .agg(F.max_by(row, _order_expr(order)).alias("_row"))
                 .select("_row.*"))


def upsert(target: DataFrame | None, batch: DataFrame, key: str, order,
           drop_order: Sequence[str] = ()) -> DataFrame:
    """B1: the target with every key of the batch replaced by its latest batch row."""
    check_columns(batch, key)
    latest = latest_per_key(guard_null_keys(batch, key), key, order, drop_order)
    if target is None:
        return latest
    check_columns(target, key, "target")
    kept = target.join(latest.select(key), on=key, how="left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def bulk_write(batches: Mapping[str, tuple], existing: Mapping[str, DataFrame] | None = None
               ) -> dict[str, DataFrame]:
    """B2: each batch into the table of its own name; created when missing, else upserted.

    ``batches``: name -> (DataFrame, key, order[, drop_order]). All key checks
    run before any table is touched.
    """
    existing = existing or {}
    for name, spec in batches.items():
        check_columns(spec[0], spec[1], name)
    out = {}
    for name, spec in batches.items():
        df, key, order = spec[:3]
        drop = spec[3] if len(spec) > 3 else ()
        out[name] = upsert(existing.get(name), df, key, order, drop)
    return out


def merge_tables(tables: Sequence[tuple], existing_names: Sequence[str] = (),
                 target: str | None = None) -> DataFrame:
    """All tables into one new table, ids from each table's own key column.

    ``tables``: (name, DataFrame, key, order). ``_id`` is the key as a string;
    on an id collision the later table wins, inside one table the greatest
    order wins. Fails when ``target`` already exists; all checks first.
    """
    if target is not None and target in existing_names:
        raise KeyError_(f"table {target!r} already exists")
    for name, df, key, _ in tables:
        check_columns(df, key, name)
    parts = None
    for i, (name, df, key, order) in enumerate(tables):
        # Inside a table its own order column decides (typed comparison);
        # across tables the later one wins, by position.
        own = latest_per_key(guard_null_keys(df, key), key, order)
        p = own.select(F.col(key).cast("string").alias("_id"), F.lit(name).alias("_table"),
                       F.lit(i).alias("_ord"), "*")
        parts = p if parts is None else parts.unionByName(p, allowMissingColumns=True)
    return latest_per_key(parts, "_id", "_ord", drop_order=("_ord",))


# ---- B4: explicit mappings -------------------------------------------------

# Mapping type name -> Spark SQL type. The integer family is
# widened to bigint and float to double, so that no value is lost.
MAPPING_TYPES = {
    "integer": "bigint", "long": "bigint", "short": "bigint", "byte": "bigint",
    "float": "double", "double": "double", "half_float": "double", "scaled_float": "double",
    "date": "timestamp_ntz", "boolean": "boolean", "keyword": "string", "text": "string",
    "geo_point": "string", "binary": "binary",
}


def mapped_types(mapping: DataFrame | Mapping[str, str]) -> dict[str, tuple[str, str]]:
    """{column: (Spark type, mapped type)} of mapping rows (key 'a.b.type', value JSON) or of {column: mapped or Spark type}.

    Only the ``<field>.type`` rows are needed; a mapping has one such row per
    field, so the collected list is bounded by the schema width, not the data.
    """
    if isinstance(mapping, Mapping):
        named = dict(mapping)
    else:
        rows = (mapping.filter(F.col("key").endswith(".type") & ~F.col("key").contains(".fields."))
                       .select("key", "value").collect())
        named = {r["key"][: -len(".type")]: r["value"].strip('"') for r in rows}
    known = set(MAPPING_TYPES.values())
    return {c: (t if t in known or t.startswith("decimal(") else MAPPING_TYPES.get(t, "string"), t) for c, t in named.items()}


def mapping_schema(mapping: DataFrame) -> dict[str, str]:
    """Mapping rows -> {column: Spark type}."""
    return {c: t for c, (t, _) in mapped_types(mapping).items()}


def apply_mapping(df: DataFrame, mapping: DataFrame | Mapping[str, str]) -> DataFrame:
    """Project every mapped column through ``try_cast`` to its mapped type.

    Columns without a mapping pass unchanged. A mapping inferred from the same
    rows changes no value; under another one, values that do not fit become
    null: ``split_by_mapping`` tells them apart.
    """
    schema = mapped_types(mapping)
    return df.select(*[F.col(f"`{c}`").try_cast(schema[c][0]).alias(c) if c in schema else F.col(f"`{c}`") for c in df.columns])


def split_by_mapping(df: DataFrame, mapping: DataFrame | Mapping[str, str], id_cols: Sequence[str]
                     ) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """B4 with a dead-letter table: (accepted rows, rejects, counts), no value lost.

    The store refuses a document with a value that its mapping cannot keep. The
    rows are judged and written once; accepted rows have every mapped column in
    its type, rejects are (id columns, column, value, reason), one per refused
    value, with the text as it was. The counts (``rows``, ``rejected``, taken
    while the rows are written) are Python numbers.

    A null is accepted by every type; a number that only loses digits is
    refused, too. Column names of rejects that clash with an id column raise.
    """
    clash = {"column", "value", "reason"} & {c.lower() for c in id_cols}
    if clash:
        raise ValueError(f"id column(s) {sorted(clash)} clash with the columns of the rejects")
    schema, seen = mapped_types(mapping), Observation()
    mark = "_refused"
    while mark in df.columns:
        mark = f"_{mark}"
    judged = df.withColumn(mark, rejects_of(df, schema))
    judged = judged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(mark) > 0).alias("rejected"))
    written = save_shared(judged, "mapped")
    accepted = apply_mapping(written.filter(F.size(mark) == 0).drop(mark), mapping if isinstance(mapping, Mapping) else {c: t for c, (_, t) in schema.items()})
    rejects = written.select(*[F.col(f"`{c}`") for c in id_cols], F.explode(mark).alias(mark)).select(
        *[F.col(f"`{c}`") for c in id_cols], f"{mark}.column", f"{mark}.value", f"{mark}.reason")
    return accepted, rejects, dict(seen.get)


def keyword_subfield(df: DataFrame, col: str, ignore_above: int = 256) -> DataFrame:
    """``<col>.keyword``: the exact text when at most ``ignore_above`` characters."""
    c = F.col(f"`{col}`")
    return df.withColumn(f"{col}.keyword", F.when(F.length(c) <= ignore_above, c))


# ---- persistence: catalogue tables ---------------------------------------------
# A table is a catalogue entry that points to a folder of Parquet files. A write goes
# to a new folder through Spark's own commit, and only when it is complete does one
# metadata change point the entry to it. Whatever fails before that leaves the entry,
# and the old folder, as they were.

def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_table(df: DataFrame, table: str, root: str) -> str:
    """Create ``table`` from ``df`` with its files under ``root`` (fails if it exists)."""
    spark = df.sparkSession
    if table_exists(spark, table):
        raise KeyError_(f"table {table!r} already exists")
    location = _new_version(df, table, root)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    return table


def replace_table(df: DataFrame, table: str, root: str) -> str:
    """Point ``table`` to a new folder with the rows of ``df``, which may read the table itself.

    Columns that the entry lacks are added first (readers of the old folder see
    nulls); columns it has must be in ``df``. The old folder stays for readers
    that still use it; ``drop_old_versions`` removes it.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        return create_table(df, table, root)
    old = spark.table(table).schema
    lost = [c for c in old.names if c not in df.columns]
    if lost:
        raise KeyError_(f"{table}: column(s) {lost} are missing")
    location = _new_version(df, table, root)
    new = [f for f in df.schema.fields if f.name not in old.names]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return table


def _new_version(df: DataFrame, table: str, root: str) -> str:
    location = f"{root.rstrip('/')}/{table}/version-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(location)
    return location


def drop_old_versions(spark: SparkSession, table: str, root: str) -> None:
    """Delete the folders of ``table`` that its entry does not point to (no reader may use them any more)."""
    current = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"][0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        if status.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]:
            fs.delete(status.getPath(), True)


def upsert_into(table: str, batch: DataFrame, key: str, order, root: str, drop_order: Sequence[str] = ()) -> str:
    """B1 against a catalogue table: read, upsert, write a new folder, switch the entry."""
    spark = batch.sparkSession
    target = spark.table(table) if table_exists(spark, table) else None
    return replace_table(upsert(target, batch, key, order, drop_order), table, root)


def bulk_write_to(root: str, batches: Mapping[str, tuple]) -> dict[str, str]:
    """B2 on storage: each batch into the catalogue table of its name, created when missing, else upserted.

    Key checks for every batch run before any table is touched; each table is its own Spark job."""
    for name, spec in batches.items():
        check_columns(spec[0], spec[1], name)
    return {name: upsert_into(name, spec[0], spec[1], spec[2], root, spec[3] if len(spec) > 3 else ())
            for name, spec in batches.items()}


def write_merged(table: str, tables: Sequence[tuple], root: str) -> str:
    """B3 on storage: refuse an existing target, check every key, then write once."""
    if table_exists(tables[0][1].sparkSession, table):
        raise KeyError_(f"table {table!r} already exists")
    return create_table(merge_tables(tables), table, root)


def create_with_mapping(df: DataFrame, mapping: DataFrame | Mapping[str, str], table: str, root: str) -> str:
    """B4 on storage: cast under the mapping and create the table (fails if it exists)."""
    return create_table(apply_mapping(df, mapping), table, root)
