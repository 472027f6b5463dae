"""Batch search: queries to ranked, hydrated hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.embedders import EmbedFn
from quire.functions.vectors import l2_normalize
from quire.operators.embedding import embed
from quire.operators.hydrate import hydrate
from quire.operators.neighbours import cell_neighbours, probe_cells
from quire.plans import index_job
from quire.session import stable

#: Cells searched per query unless asked otherwise.
NPROBE = 32
DEFAULT_K = 50
MAX_K = 200


def valid_queries(queries: DataFrame) -> DataFrame:
    """Queries with their text stripped and ``k`` clamped; blank ones are left out."""
    cleaned = queries.select(
        "query_id",
        X.strip(F.col("query")).alias("query"),
        X.clamp_k(F.col("k"), DEFAULT_K, MAX_K).alias("k"),
    )
    return cleaned.where(F.col("query") != "")


def rejected_queries(queries: DataFrame) -> DataFrame:
    """Queries without text."""
    return queries.where(F.coalesce(X.strip(F.col("query")), F.lit("")) == "")


def embed_queries(queries: DataFrame, embed_fn: EmbedFn, normalized: bool) -> DataFrame:
    """Add ``vector``, of unit length iff the index holds unit vectors."""
    out = embed(queries, embed_fn, text="query", vector="vector")
    return out.withColumn("vector", l2_normalize(F.col("vector"))) if normalized else out


def limit_per_query(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """The first ``k`` hits of each query, with its text."""
    wanted = queries.select("query_id", "query", "k")
    return hits.join(wanted, "query_id").where(F.col("rank") <= F.col("k"))


def pruned(postings: DataFrame, probes: DataFrame, n_probes: int) -> DataFrame:
    """Postings of the probed buckets only; with many probes all of them are read anyway."""
    if n_probes > index_job.BUCKETS:
        return postings
    buckets = probes.select(F.pmod(F.col("cell"), F.lit(index_job.BUCKETS)).alias("b"))
    return postings.where(F.col("bucket").isin([r["b"] for r in buckets.distinct().collect()]))


def run(
    spark: SparkSession,
    queries: DataFrame,
    index_dir: str,
    works: DataFrame,
    embed_fn: EmbedFn,
    *,
    nprobe: int = NPROBE,
    latest: list[str] = (),
) -> DataFrame:
    """``query_id, query, rank, score, work_id, title, abstract, publication_year, doi, url``."""
    meta = index_job.check_integrity(spark, index_dir)
    quantiser = index_job.load_quantiser(spark, index_dir, meta)
    asked = valid_queries(queries)
    vectors = stable(embed_queries(asked, embed_fn, meta["normalized"]).select("query_id", "vector", "k"))
    row = vectors.agg(
        F.count("*").alias("n"), F.max(F.size("vector")).alias("dim"), F.max("k").alias("k")
    ).first()
    vectors = vectors.drop("k")
    if row["n"] and row["dim"] != meta["dim"]:
        raise RuntimeError(f"query vectors have {row['dim']} dimensions, the index {meta['dim']}")
    nprobe = min(nprobe, quantiser.nlist)
    probes = probe_cells(vectors, quantiser, nprobe)
    rows = index_job.postings(spark, index_dir, meta)
    if quantiser.nlist > index_job.BUCKETS:
        rows = pruned(rows, probes, row["n"] * nprobe)
    hits = cell_neighbours(vectors, rows, quantiser, row["k"] or DEFAULT_K, nprobe, probes)
    best = limit_per_query(hits, asked)
    found = hydrate(best.select("query_id", "rank", "score", "id"), works, latest)
    return found.join(asked.select("query_id", "query"), "query_id")
