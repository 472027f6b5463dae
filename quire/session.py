"""Session settings the jobs depend on: the shared folder and the size limit for broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Most bytes one side of a join, or one model matrix, may have to be broadcast.
BROADCAST_BYTES = 256 * 1024 * 1024


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``quire.broadcast.maxBytes``, or the default limit."""
    return int(spark.conf.get("quire.broadcast.maxBytes", str(BROADCAST_BYTES)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        named = context.getCheckpointDir()
        if not named:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
            named = tempfile.mkdtemp(prefix="quire-")
            context.setCheckpointDir(named)
    return named.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new_run_dir` that nothing needs any more."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path!r} does not lie in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that re-reading it gives the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is at ``path``; only the listing is read."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
