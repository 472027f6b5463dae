"""Bookkeeping over parts. Every frame here has one row per part file unless noted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def part_counts(parts: DataFrame, works: DataFrame) -> DataFrame:
    """``parts`` with ``n`` works each, zero included. ``works`` is reduced before the join."""
    counts = works.groupBy("part").agg(F.count("*").alias("n"))
    return parts.join(counts, "part", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def run_counts(parts: DataFrame, done: DataFrame) -> DataFrame:
    """One row: parts in total, to do and already done."""
    flagged = parts.join(
        done.select("part").distinct().withColumn("_done", F.lit(True)), "part", "left"
    )
    return flagged.agg(
        F.count("*").alias("n_total"),
        F.count_if(F.col("_done").isNull()).alias("n_todo"),
        F.count_if(F.col("_done")).alias("n_done"),
    )


def mark_part_ends(parts: DataFrame, works: DataFrame, order: str) -> DataFrame:
    """Works with ``part_done`` true on the last row of each part, plus one sentinel row
    for each part without works.

    The last row is found by a partial ``max`` per part rather than by sorting parts, so
    a part that holds most of the rows stays spread over its tasks.
    """
    last = works.groupBy("part").agg(F.max(order).alias("_last"))
    marked = (
        works.join(F.broadcast(last) if _few(parts) else last, "part")
        .withColumn("part_done", F.col(order) == F.col("_last"))
        .withColumn("sentinel", F.lit(False))
        .drop("_last")
    )
    empty = (
        parts.select("part")
        .distinct()
        .join(last, "part", "left_anti")
        .select("part", F.lit(True).alias("part_done"), F.lit(True).alias("sentinel"))
    )
    return marked.unionByName(empty, allowMissingColumns=True)


#: Parts up to which their per-part totals may be broadcast (a path and a number each).
FEW_PARTS = 200_000


def _few(parts: DataFrame) -> bool:
    return parts.limit(FEW_PARTS + 1).count() <= FEW_PARTS


def plan_shards(counts: DataFrame, shard_size: int) -> DataFrame:
    """``(pos, part, n, shard_idx)``: a shard closes at the first part that fills it.

    Each step depends on the one before, so one task walks the ordered per-part totals,
    a path and a number per file; the works themselves are not touched.
    """

    def walk(frames):
        shard, filled = 0, 0
        for frame in frames:
            shards = []
            for n in frame["n"]:
                shards.append(shard)
                filled += n
                if filled >= shard_size:
                    shard, filled = shard + 1, 0
            yield frame.assign(shard_idx=shards)

    ordered = counts.select("pos", "part", "n").repartition(1).sortWithinPartitions("pos")
    return ordered.mapInPandas(walk, "pos int, part string, n bigint, shard_idx int")


def soft_limit(counts: DataFrame, max_works: int) -> DataFrame:
    """Parts in order up to and including the one that reaches ``max_works``.

    The running total is over one number per part file.
    """
    before = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("n_before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(
        F.col("n_before") < max_works
    )
