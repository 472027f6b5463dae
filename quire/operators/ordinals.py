"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import stable


def with_ordinal(df: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """Add the 0-based position of each row in the order of the given columns.

    Rows are range-partitioned and sorted, so a hot leading value is split by the columns
    after it, and rows equal in all of them by the rest of the row. The sorted rows are kept in the shared folder: the partition boundaries must
    be the same for counting and for numbering. Each row then gets its place in its
    partition plus the number of rows in the partitions before.
    """
    keys = [*order, F.xxhash64(*df.columns)]
    ordered = stable(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    tagged = ordered.withColumn("_rid", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_rid", 33).alias("_pid"),
        F.col("_rid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_idx"),
    )
    # One row per partition of the sorted table: a running total over a few thousand numbers.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_pid")
        .agg(F.count("*").alias("_n"))
        .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_offset") + F.col("_idx"))
        .drop("_rid", "_pid", "_idx", "_offset")
    )


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Exactly the first ``n`` rows in the given order, however large ``n`` is.

    Only the order columns are sorted, to find the key of row ``n``; the rows are then
    filtered by it.
    """
    keys = with_ordinal(df.select(*order), *order, name="_at")
    cut = keys.where(F.col("_at") == n - 1).drop("_at").first()
    if cut is None:
        return df
    key = F.struct(*order)
    last = F.struct(*[F.lit(cut[c]).cast(df.schema[c].dataType).alias(c) for c in order])
    n_before = keys.where(F.struct(*order) < last).count()
    return df.where(key < last).unionByName(df.where(key == last).limit(n - n_before))


def with_batches(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Add ``batch_no``: rows in order, ``size`` to a batch."""
    return with_ordinal(df, *order, name="_at").withColumn(
        "batch_no", F.floor(F.col("_at") / size)
    ).drop("_at")
