"""The training-corpus pipeline: five stages over ``documents``, each written and read again.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import bagminhash, cotrain, decontam, mixing, pii
from sheaf.llm.common import WORD, fresh, save_shared, table, text_of


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go, and toxic ones."""
    return cotrain.keep_good(docs, cotrain.quality_labels(spark, sf_dir), toxic=cotrain.toxic_labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest id."""
    return bagminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; n_chars follows a changed text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document for the mix, by pivotal rounding; documents that the mix does not take go."""
    size, key = fresh(docs, "size", "text_hash")
    sized = (docs.withColumn(size, F.regexp_count(text_of("text"), F.lit(WORD)).cast("bigint"))
                 .withColumn(key, F.xxhash64("text")))
    in_source, target, copies = fresh(sized, "source_size", "target", "copies")
    mixed = mixing.mix(sized, "source", size, ("doc_id", key))
    return mixed.filter(F.col(copies) > 0).drop(size, key, in_source, target)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", sanitisation),
    ("mixing", mix_sources),
]

#: The quality classifier and the random rounding have no SQL form; the stages are tested by themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save_shared(stage(spark, docs, sf_dir), name)      # written and read again
    return STAGES[-1][1](spark, docs, sf_dir)
