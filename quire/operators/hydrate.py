"""Joining hits back to their records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X
from quire.session import broadcast_limit, stable


def works_in(works: DataFrame, hit_ids: DataFrame) -> DataFrame:
    """Records whose short id is among the hits; ``hit_ids`` has a column ``short_id``.

    The distinct ids are written once, as they may be the outcome of a whole search and are used twice. They are
    broadcast while they fit the limit, and shuffled beyond it.
    """
    wanted = stable(hit_ids.select("short_id").where(F.col("short_id").isNotNull()).distinct())
    size = wanted.agg(F.sum(F.length("short_id") + 16)).first()[0] or 0
    if size <= broadcast_limit(works.sparkSession):
        wanted = F.broadcast(wanted)
    return works.withColumn("short_id", X.short_work_id(F.col("id"))).join(
        wanted, "short_id", "left_semi"
    )


def one_per_id(works: DataFrame, latest: list[Column]) -> DataFrame:
    """One record per short id, the last in the given order; copies are merged before the shuffle."""
    fields = [c for c in schemas.HYDRATION.names]
    return works.groupBy("short_id").agg(
        F.max_by(F.struct(*fields), F.struct(*latest)).alias("work")
    )


def hydrate(hits: DataFrame, works: DataFrame, latest: list[str] = ()) -> DataFrame:
    """Every hit with title, abstract, year, doi and link; null where it has no record.

    ``hits`` has ``query_id, rank, score, id``; ``latest`` names columns of ``works`` that
    order several records of one id. The hits are materialised, as they are used three times
    and are the outcome of the whole search.
    """
    keyed = stable(hits.withColumn("short_id", X.short_work_id(F.col("id"))))
    records = one_per_id(
        works_in(works, keyed), [*[F.col(c) for c in latest], F.col("id"), F.col("doi")]
    ).select(
        "short_id",
        F.col("work.title").alias("title"),
        X.reconstruct_abstract(F.col("work.abstract_inverted_index")).alias("abstract"),
        F.col("work.publication_year").alias("publication_year"),
        F.col("work.doi").alias("doi"),
        X.best_url("work").alias("url"),
    )
    return keyed.join(records, "short_id", "left").select(
        "query_id", "rank", "score", F.col("id").alias("work_id"),
        "title", "abstract", "publication_year", "doi", "url",
    )


def coverage(hydrated: DataFrame) -> DataFrame:
    """One row: hits in total and hits with a title."""
    return hydrated.agg(
        F.count("*").alias("n_hits"),
        F.count_if(X.non_empty(F.col("title")).isNotNull()).alias("n_with_title"),
    )


def nest(hydrated: DataFrame) -> DataFrame:
    """One row per query with its number of hits and the ranked list (200 hits at most each)."""
    hit = F.struct(
        "rank", "score", "work_id", "title", "abstract", "publication_year", "doi", "url"
    )
    return hydrated.groupBy("query_id", "query").agg(
        F.count("*").alias("k"), F.sort_array(F.collect_list(hit)).alias("results")
    )
