"""Rows of Parquet files in the order of the files and of the rows in them.

A row's place in its file is in the file's metadata, and how many rows a file has in its footer. So a row's place
in the whole folder is its place in its file plus the rows of the files before: one number a file, and
neither the rows are sorted nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import broadcast_limit

#: Bytes that a path and two numbers take at most in a broadcast.
FILE_BYTES = 1024


def _read(spark: SparkSession, paths, schema) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("recursiveFileLookup", True).schema(schema).parquet(*paths)


def file_offsets(spark: SparkSession, paths, schema) -> DataFrame:
    """``(path, n, before)`` of each file with rows: its rows and those of the files before it, by name, then path.

    No column is read, only footers. The running total is over one row per file.
    """
    counts = _read(spark, paths, schema).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.substring_index("path", "/", -1), "path").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))


def in_file_order(spark: SparkSession, paths, schema, columns: list[str], name: str = "ordinal") -> DataFrame:
    """The chosen columns of every row, and its 0-based place in the folder as ``name``."""
    offsets = file_offsets(spark, paths, schema).select(F.col("path").alias("_path"), "before")
    rows = _read(spark, paths, schema).select(
        *columns, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row")
    )
    if offsets.count() * FILE_BYTES <= broadcast_limit(spark):
        offsets = F.broadcast(offsets)
    return rows.join(offsets, "_path").withColumn(name, F.col("before") + F.col("_row")).select(*columns, name)


def first_rows(spark: SparkSession, paths, schema, columns: list[str], n: int) -> DataFrame:
    """Exactly the first ``n`` rows. Files beyond them aren't opened, and nothing is sorted."""
    offsets = file_offsets(spark, paths, schema).where(F.col("before") < n)
    files = offsets.orderBy("before").collect()  # one row per file
    if not files:
        return _read(spark, paths, schema).select(*columns).limit(0)
    last = files[-1]
    rows = _read(spark, [f["path"] for f in files], schema)
    if last["before"] + last["n"] <= n:
        return rows.select(*columns)
    own = (F.col("_metadata.file_path") != last["path"]) | (F.col("_metadata.row_index") < n - last["before"])
    return rows.where(own).select(*columns)


def with_batches(spark: SparkSession, paths, schema, columns: list[str], size: int) -> DataFrame:
    """The rows with ``batch_no``: in file order, ``size`` to a batch."""
    rows = in_file_order(spark, paths, schema, columns, "_at")
    return rows.withColumn("batch_no", F.floor(F.col("_at") / size)).drop("_at")
