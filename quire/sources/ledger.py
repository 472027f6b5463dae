"""Ledgers of finished work. A batch counts once its ledger row is there, never before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.session import read_if_exists


def read_completed(spark: SparkSession, path: str) -> DataFrame:
    """Completed parts; an absent ledger is an empty one."""
    found = read_if_exists(spark, path, schemas.COMPLETED_PARTS)
    if found is None:
        return spark.createDataFrame([], schemas.COMPLETED_PARTS)
    return found.select(*schemas.COMPLETED_PARTS.names)


def next_batch(completed: DataFrame) -> int:
    """Number of the batch to write next."""
    last = completed.agg(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1


def commit_parts(parts: DataFrame, path: str, batch_id: int) -> None:
    """Record ``parts`` as done by ``batch_id``; repeating a batch replaces its own record."""
    (
        parts.select(
            "part",
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.current_timestamp().alias("committed_at"),
        )
        .distinct()
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{path}/commit={batch_id:06d}")
    )


def not_done(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key is not among the done ones; order columns and repeats are kept.

    Both sides hold one row per file. Spark broadcasts the smaller one if its own
    threshold allows it.
    """
    return items.join(done.select(key).distinct(), key, "left_anti")


def ledger_union(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both ledgers."""
    return old.select(key).union(new.select(key)).distinct()
