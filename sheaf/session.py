"""Session helpers: one place for the settings every job relies on.

Nothing here is needed on a managed cluster, where the session already exists;
``get_session`` is what tests, the bench and local runs use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the jobs in this package, whatever the cluster size.
_DEFAULTS = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions and demote sort-merge joins to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Upserts overwrite only the key buckets a batch touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # JSON objects with a repeated key keep the last value (as a dict would)
    # instead of being rejected as invalid.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Written-once intermediates (checkpoint files) are removed when their
    # DataFrame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "sheaf",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with our defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SHEAF_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session with neither set gets a scratch folder of its own; on a
    cluster an unset value is an error, because a machine-local folder would
    vanish with the executor that wrote it.
    """
    try:
        sc = spark.sparkContext
    except Exception:               # a Spark Connect session: the server's setting applies
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        return current
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    path = tempfile.mkdtemp(prefix="sheaf-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives as fewer splits than the cluster has cores.

    Text steps are CPU bound and run per row; a Parquet file with one row group
    is one split and would run on one core. On a large input the split count is
    already far above the core count and this is a no-op.
    """
    spark = df.sparkSession
    try:
        want = min_partitions or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:               # no RDD view (Spark Connect): leave the scan as it is
        return df
    if have < want:
        return df.repartition(want)
    return df
