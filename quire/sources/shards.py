"""Vector shards: Parquet files of works with their embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas

#: Rows a shard file holds at most.
SHARD_ROWS = 25_000


def shard_rows(embedded: DataFrame) -> DataFrame:
    """The eight shard columns, the vector as float32."""
    return embedded.select(
        *schemas.WORK_COLUMNS, "text", F.col("embedding").cast("array<float>").alias("embedding")
    )


def write_shards(embedded: DataFrame, path: str, rows_per_file: int = SHARD_ROWS) -> None:
    """Write zstd Parquet shards; ``path`` is replaced, so a repeated batch leaves no copy."""
    (
        shard_rows(embedded)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def shard_name(index: Column, prefix: str) -> Column:
    """Conventional name of shard number ``index``."""
    return F.format_string(f"{prefix}_%06d.parquet", index)


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, path, length, modified)`` of every Parquet file below ``path``; an empty folder is an error.

    Only the file listing is read, no file is opened.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(F.substring_index("path", "/", -1).alias("shard"), "path", "length", F.col("modificationTime").alias("modified"))
    )
    if listed.isEmpty():
        raise FileNotFoundError(f"{path!r} holds no Parquet file")
    return listed


def read_vectors(spark: SparkSession, paths) -> DataFrame:
    """``(id, embedding, shard)`` of the shard files; no other column is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.option("recursiveFileLookup", True)
        .schema(schemas.SHARD)
        .parquet(*paths)
        .select("id", "embedding", F.col("_metadata.file_name").alias("shard"))
    )


def row_counts(spark: SparkSession, paths) -> DataFrame:
    """``(shard, n_vectors)`` of the shard files that have rows. No column is read, only the files' footers."""
    rows = spark.read.option("recursiveFileLookup", True).schema(schemas.SHARD).parquet(*paths)
    return rows.groupBy(F.col("_metadata.file_name").alias("shard")).agg(F.count("*").alias("n_vectors"))


def first_dim(vectors: DataFrame, expected: int | None = None) -> int:
    """Length of one vector. Reading all of them is left to the job, which checks each block."""
    row = vectors.where(F.col("embedding").isNotNull()).select(F.size("embedding")).first()
    if row is None:
        raise RuntimeError("without a vector its length is unknown")
    if expected is not None and expected != row[0]:
        raise RuntimeError(f"the index takes vectors of {expected} numbers, these have {row[0]}")
    return row[0]


def detect_dim(vectors: DataFrame, expected: int | None = None) -> int:
    """Common length of all vectors; mixed lengths, nulls or no rows are errors."""
    row = vectors.agg(
        F.min(F.size("embedding")).alias("lo"),
        F.max(F.size("embedding")).alias("hi"),
        F.count_if(F.col("embedding").isNull()).alias("nulls"),
    ).first()
    if row["lo"] is None:
        raise RuntimeError("without a vector its length is unknown")
    if row["nulls"] or row["lo"] != row["hi"]:
        raise RuntimeError(
            f"vectors differ in length: {row['lo']} to {row['hi']}, {row['nulls']} missing"
        )
    if expected is not None and expected != row["hi"]:
        raise RuntimeError(f"the index takes vectors of {expected} numbers, these have {row['hi']}")
    return row["hi"]
