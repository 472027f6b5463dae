"""Registration of queries, and tables derived once per session."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quire.session import new_run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_staged: dict[tuple[str, str, str], str] = {}
_shipped: set[str] = set()


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` and the SQL it must agree with."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp()) / "quire_package"), "zip", root_dir=root, base_dir="quire"
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from ``sf_dir``, written to the shared folder once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        path = new_run_dir(spark, f"derived-{name}")
        write(path)
        _staged[key] = path
    return _staged[key]
