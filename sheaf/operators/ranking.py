"""Global consecutive numbers without a one-task window."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def save_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columnar: readers keep
    column pruning, statistics and filter pushdown. The files survive the loss
    of the executor that wrote them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one computation in the shared folder; all are deleted when the ``with`` block ends.

    What the block returns must not read them any more: write it with
    ``save_shared`` before.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``save_shared`` for the length of the block."""
        path = f"{checkpoint_dir(self.spark)}/tables/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a file system that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def number_rows(df: DataFrame, order_by: Sequence[str], name: str = "_key", offset: int = 0) -> tuple[DataFrame, int]:
    """``df`` plus ``name``, consecutive integers from ``offset`` in the order of ``order_by``; and the number of rows.

    ``order_by`` are column names (ascending) or sort expressions. The rows are
    range-partitioned *once* and written to the shared folder together with the
    number of their partition; the counts and the numbered rows are both read
    from that one copy, so they cannot disagree. Only one row per range
    partition goes through the unpartitioned window and the broadcast: both are
    bounded by the number of shuffle partitions, not by the data.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    part, start = "__part", "__start"
    taken = {c.lower() for c in df.columns}
    while taken & {part, start}:
        part, start = "_" + part, "_" + start
    ranged = save_shared(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(start))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    numbered = (ranged.join(F.broadcast(starts), part)
                      .withColumn(name, (F.col(start) + within - 1 + offset).cast("bigint"))
                      .drop(part, start))
    return numbered, ranged.count()
