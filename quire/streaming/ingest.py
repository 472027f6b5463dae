"""New snapshot parts to shards, and new shards to an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire import schemas
from quire.functions import text as X
from quire.functions.embedders import EmbedFn
from quire.operators.embedding import embed
from quire.plans import index_job
from quire.plans.embed_job import corpus_rows
from quire.session import exists
from quire.sources import ledger, shards, snapshot


def ingest_parts(
    spark: SparkSession,
    root: str,
    out_dir: str,
    embed_fn: EmbedFn,
    *,
    concept_id: str = X.DEFAULT_CONCEPT,
    mode: str = "title_abstract",
    max_files: int | None = None,
) -> StreamingQuery:
    """Embed the ``.gz`` parts below ``root`` that earlier runs have not seen.

    The stream's checkpoint in ``out_dir`` decides what is new. A micro-batch overwrites
    ``shards/batch=N`` and then its row in ``parts``, so a repeated one leaves no copies; one that
    is on record keeps its files, by whose names an index knows them. A folder that a
    job writes to is refused. Re-shipped works are new rows. A part without matching works is on record as well.
    """

    if exists(spark, f"{out_dir}/manifests"):
        raise ValueError(f"{out_dir!r} belongs to a job")

    def write(lines: DataFrame, batch_id: int) -> None:
        done = ledger.read_completed(spark, f"{out_dir}/parts")
        if not done.where(F.col("batch_id") == batch_id).isEmpty():
            return
        rows = corpus_rows(lines, concept_id=concept_id, mode=mode)
        embedded = embed(rows, embed_fn, spread=True)
        shards.write_shards(embedded, f"{out_dir}/shards/batch={batch_id:06d}")
        ledger.commit_parts(lines.select("part").distinct(), f"{out_dir}/parts", batch_id)

    lines = snapshot.read_lines(spark, root, streaming=True, max_files=max_files)
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{out_dir}/stream")
        .trigger(availableNow=True)
        .start()
    )


def index_batches(
    spark: SparkSession,
    out_dir: str,
    index_dir: str,
    options: index_job.IndexOptions | None = None,
) -> StreamingQuery:
    """Extend the index at ``index_dir`` by every batch of shards newly on record."""
    committed = (
        spark.readStream.schema(schemas.COMPLETED_PARTS)
        .option("recursiveFileLookup", True)
        .parquet(f"{out_dir}/parts")
    )

    def add(rows: DataFrame, _: int) -> None:
        batches = rows.select("batch_id").distinct().collect()  # one row per batch
        paths = [f"{out_dir}/shards/batch={r['batch_id']:06d}" for r in batches]
        if paths:
            index_job.run(spark, paths, index_dir, options)

    return (
        committed.writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{index_dir}/stream")
        .trigger(availableNow=True)
        .start()
    )
