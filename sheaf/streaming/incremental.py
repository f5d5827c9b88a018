"""Repeated keyed loads as a stream.

``readStream`` over a folder of Parquet batches -> ``foreachBatch`` that merges
each micro-batch into a keyed Parquet table with the *guarded* rule: per key
the row with the greatest order value wins, whatever batch it arrived in. That
makes the result independent of how the input is cut into micro-batches, and
a replayed batch (after an executor or driver loss) changes nothing.

The target is a catalogue table, partitioned by ``pmod(xxhash64(key), buckets)``.
A micro-batch reads only the partitions its keys fall in, writes their merged rows
to a new folder through Spark's own commit, and points those partitions to it
(``ALTER TABLE … PARTITION … SET LOCATION``). Last the table property of the stream
is set to the epoch, so that a replayed epoch is a no-op. No file that an entry
points to is ever changed or deleted by a merge: whatever step a job dies at, each
partition shows its rows before or after the epoch, and the replay, which merges by
the same rule, ends in the same table. ``drop_unused`` deletes the folders that no
partition points to. A catalogue that ends with the session (no metastore) keeps the
table only as long as the session.

Bucket count: the unit of rewrite. A micro-batch whose keys spread over all
buckets rewrites the whole table, so large tables want many buckets (thousands)
and micro-batches sized so that each touches a fraction of them.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..operators.ranking import delete_path
from ..operators.upsert import KeyError_, check_columns, guard_null_keys, latest_per_key, table_exists
from ..session import checkpoint_dir

BUCKET = "_bucket"


def _create(spark: SparkSession, table: str, schema: StructType, root: str) -> None:
    """The keyed table without a partition, if the catalogue has no such table; else its columns must be those of the batch."""
    if table_exists(spark, table):
        have = [c for c in spark.table(table).columns if c != BUCKET]
        if sorted(have) != sorted(schema.names):
            raise KeyError_(f"{table}: columns {have} differ from the batch's {schema.names}")
        return
    columns = StructType([*[f for f in schema.fields]]).add(BUCKET, LongType()).toDDL()
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{root.rstrip('/')}/empty'")


def _known(spark: SparkSession, table: str) -> set[int]:
    """Buckets that the catalogue has; at most as many as the table has buckets."""
    return {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _epoch(spark: SparkSession, table: str, stream: str) -> int:
    """The last epoch of ``stream`` that the table holds, or -1."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(found.get(f"epoch.{stream}", -1))


def _write(merged: DataFrame, root: str, epoch: int) -> str:
    version = f"{root.rstrip('/')}/epoch={epoch}-{uuid.uuid4().hex}"
    merged.write.mode("errorifexists").partitionBy(BUCKET).parquet(version)
    return version


def _point(spark: SparkSession, table: str, bucket: int, location: str, known: bool) -> None:
    """One metadata change: the partition of ``bucket`` is what lies at ``location``."""
    spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET}={bucket}) SET LOCATION '{location}'" if known else
              f"ALTER TABLE {table} ADD PARTITION ({BUCKET}={bucket}) LOCATION '{location}'")


def _mark(spark: SparkSession, table: str, stream: str, epoch: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('epoch.{stream}'='{epoch}')")


def merge_batch(batch: DataFrame, epoch: int, table: str, key: str, order, buckets: int, root: str,
                stream: str = "batch") -> None:
    """Guarded merge of one micro-batch into the bucketed ``table``, whose folders lie under ``root``."""
    spark = batch.sparkSession
    check_columns(batch, key)
    _create(spark, table, batch.schema, root)
    if _epoch(spark, table, stream) >= epoch:
        return
    b = guard_null_keys(batch, key).withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))
    # The touched buckets: at most `buckets` small integers.
    touched = sorted(r[0] for r in b.select(BUCKET).distinct().collect())
    if touched:
        current = spark.table(table).filter(F.col(BUCKET).isin(touched))
        # one task per touched bucket, so a micro-batch leaves one file in each
        merged = latest_per_key(current.unionByName(b), key, order).repartition(BUCKET)
        version, known = _write(merged, root, epoch), _known(spark, table)
        for bucket in touched:
            _point(spark, table, bucket, f"{version}/{BUCKET}={bucket}", bucket in known)
    _mark(spark, table, stream, epoch)


def drop_unused(spark: SparkSession, table: str, root: str) -> int:
    """Delete the folders under ``root`` that no partition of ``table`` points to (no reader may use them any more)."""
    used = set()
    for bucket in _known(spark, table):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({BUCKET}={bucket})").collect()
        place = [r["data_type"] for r in rows if r["col_name"] == "Location" and f"{BUCKET}={bucket}" in r["data_type"]][0]
        used.add("/".join(place.rstrip("/").split("/")[-2:]))
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs, dropped = folder.getFileSystem(spark._jsc.hadoopConfiguration()), 0
    for version in fs.listStatus(folder):
        if not version.getPath().getName().startswith("epoch="):
            continue
        for part in fs.listStatus(version.getPath()):
            name = f"{version.getPath().getName()}/{part.getPath().getName()}"
            if part.isDirectory() and name not in used:
                delete_path(spark, part.getPath().toString())
                dropped += 1
    return dropped


def stream_upsert(spark: SparkSession, source_dir: str, schema, table: str, key: str, order,
                  root: str, buckets: int = 64, checkpoint: str | None = None,
                  max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the incremental load.

    Returns the streaming query; the catalogue table ``table``, with its files
    under ``root``, holds, per key, the row with the greatest ``order`` over
    everything read so far.
    """
    state = checkpoint or os.path.join(checkpoint_dir(spark), "stream_upsert", table)
    name = hashlib.md5(state.encode()).hexdigest()      # epochs count per checkpoint
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def run(batch_df, epoch_id):
        # The micro-batch is read twice (touched buckets, merge): keep it for
        # the duration of this batch instead of re-reading the source files.
        batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merge_batch(batch_df, epoch_id, table, key, order, buckets, root, name)
        finally:
            batch_df.unpersist()

    writer = (stream.writeStream.foreachBatch(run)
              .option("checkpointLocation", os.path.join(state, "offsets")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_upserted(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)
    return spark.table(table).drop(BUCKET)


def stream_analyze(spark: SparkSession, source_dir: str, schema, out_dir: str, id_col: str,
                   text_col: str, analyzer: str = "standard", checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None):
    """Text analysis on a stream: the same stateless column expression as in
    batch (`<col>_analyzed`), appended to a Parquet sink; exactly-once through
    the file sink's commit log. Runs to the end of the input (availableNow)."""
    from ..plans.analyze import analyze, joined
    root = checkpoint or os.path.join(checkpoint_dir(spark), "stream_analyze")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = reader.parquet(source_dir).select(
        id_col, joined(analyze(text_col, analyzer)).alias(f"{text_col}_analyzed"))
    q = (out.writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", os.path.join(root, "offsets"))
            .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
