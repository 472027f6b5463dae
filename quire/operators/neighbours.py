"""Exact and inverted-file nearest-neighbour joins.

Queries are frames ``(query_id, vector)``, corpora ``(id, embedding)``, postings
``(id, cell, embedding)`` or ``(id, cell, codes)``. Hits are ``(query_id, id, score, rank)``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import matrices
from quire.operators.blocks import (
    BLOCK_ROWS, HIT_BYTES, deal, grid, join_blocks, join_lanes, lane_queries, pack, rank_hits, score_pairs, vector_dtype,
)
from quire.operators.quantiser import Quantiser, to_cells
from quire.session import broadcast_limit, new_run_dir, stable

METRICS = ("ip", "l2")


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose ip or l2")
    return metric


def _size(queries: DataFrame) -> tuple[int, int]:
    """Number of queries and bytes of their vectors, at most eight per value."""
    row = queries.agg(F.count("*").alias("n"), F.sum(F.size("vector")).alias("values")).first()
    return row["n"], 8 * (row["values"] or 0)


def flat_scores(metric: str, dtype: str):
    def score(vectors, payload, n):
        block = np.frombuffer(payload, dtype=dtype).astype("float64").reshape(n, -1)
        return matrices.scores(vectors, block, metric)

    return score


def exact_neighbours(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "ip") -> DataFrame:
    """The ``k`` best corpus rows for each query, by scoring all of them.

    The corpus is packed where it lies, and stays there: queries whose vectors are beyond the session's limit for
    broadcasts are dealt to as many passes over the corpus as it takes, and the hits of each pass are written to
    the shared folder. Only if the limit doesn't even hold one vector are corpus blocks shuffled.
    """
    check_metric(metric)
    n, size = _size(queries)
    limit = broadcast_limit(queries.sparkSession)
    if size <= limit or limit < size // n:
        return _one_pass(queries, corpus, k, metric, n, size)
    # Passes are of about equal size; half the limit leaves room for the largest.
    passes = math.ceil(2 * size / limit)
    dealt = stable(queries.withColumn("_pass", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(passes)).cast("int")))
    counts = {r["_pass"]: r["count"] for r in dealt.groupBy("_pass").count().collect()}  # one row per pass
    path = new_run_dir(queries.sparkSession, "hits")
    for number, count in sorted(counts.items()):
        some = dealt.where(F.col("_pass") == number).drop("_pass")
        _one_pass(some, corpus, k, metric, count, math.ceil(size * count / n)).write.parquet(f"{path}/pass={number}")
    return queries.sparkSession.read.parquet(path).drop("pass")


def _one_pass(queries: DataFrame, corpus: DataFrame, k: int, metric: str, n: int, size: int) -> DataFrame:
    """Queries form ``n / BLOCK_ROWS`` groups, and each corpus block meets each group.

    So much work that the tasks of the corpus as it lies would be long is dealt out anew.
    """
    groups = max(1, math.ceil(n / BLOCK_ROWS))
    grouped = queries.withColumn(
        "grp", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")
    ).repartition(groups, "grp")
    query_blocks = pack(grouped, key="grp", id_col="query_id", payload="vector")
    blocks = pack(
        corpus.select(F.lit(0).alias("_all"), "id", F.col("embedding").alias("payload")),
        key="_all", id_col="id", payload="payload",
    )
    lanes, chunks = grid(n, n * corpus.count()) if groups > 1 else (1, 1)
    own = F.explode(F.sequence(F.col("_lane"), F.lit(groups - 1), F.lit(lanes)))
    pairs = join_blocks(query_blocks, deal(blocks, lanes, chunks).withColumn("grp", own), "grp", size)
    score = flat_scores(metric, vector_dtype(corpus, "embedding"))
    scored = score_pairs(pairs, score, k, metric, vector_dtype(queries, "vector"))
    return rank_hits(scored, k, metric)


def probe_cells(queries: DataFrame, quantiser: Quantiser, nprobe: int) -> DataFrame:
    """``(query_id, vector, cell, cell_score)``: the ``nprobe`` best cells of each query."""
    return to_cells(queries, quantiser, vector="vector", n=nprobe)


def cell_neighbours(
    queries: DataFrame,
    postings: DataFrame,
    quantiser: Quantiser,
    k: int,
    nprobe: int,
    probes: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` best postings for each query among the cells it probes.

    Raw vectors are scored directly, codes by one look-up table per query and sub-space. Many queries that probe a
    good share of the cells form lanes, each of which streams all postings; others meet the postings of their cells
    where these lie, or by a shuffle.
    """
    metric, books = quantiser.metric, quantiser.books
    nprobe = min(nprobe, quantiser.nlist)
    n, size = _size(queries)
    coded = "codes" in postings.columns
    residual = coded and quantiser.by_residual
    extra = "cell_score" if residual and metric == "ip" else None
    payload = F.col("codes" if coded else "embedding").alias("payload")

    def probing(some):
        if residual and metric == "l2":
            # Distance to centroid + code equals distance of (query - centroid) to the code.
            return to_cells(some, quantiser, vector="vector", n=nprobe, residual=True)
        return probe_cells(some, quantiser, nprobe)

    if residual and metric == "l2":
        probes = None
    per_cell = n * nprobe / quantiser.nlist
    if per_cell > BLOCK_ROWS and lane_queries(nprobe, quantiser.nlist):
        blocks = stable(pack(postings.select("cell", "id", payload), key="cell", id_col="id", payload="payload"))
        held = blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n"), F.coalesce(F.sum(F.length("payload_block")), F.lit(0)).alias("bytes")).first()
        each = lane_queries(nprobe, quantiser.nlist, held["n"])
        lanes = math.ceil(n / each)
        # Each chunk gives k hits a query: there are as many as the hits of all stay below the candidates in size.
        _, chunks = grid(1, each * nprobe / quantiser.nlist * held["n"])
        chunks = max(1, min(chunks, held["bytes"] // (HIT_BYTES * n * k)))
        lane = F.pmod(F.xxhash64("query_id"), F.lit(lanes)).cast("int")
        # Queries go to their lanes once, and are repeated for the cells they probe there.
        dealt = (queries if probes is None else probes).withColumn("_lane", lane).repartitionById(lanes, "_lane").drop("_lane")
        probes = probing(dealt) if probes is None else dealt
        query_blocks = pack(probes, key="cell", id_col="query_id", payload="vector", extra=extra)
        pairs = join_lanes(query_blocks, blocks, "cell", chunks)
    else:
        if probes is None:
            probes = probing(queries)
        if n * nprobe < quantiser.nlist:
            # Few probes: drop the other cells before anything is packed. One number per cell
            # is far below the size the centroids themselves were checked for.
            postings = postings.join(F.broadcast(probes.select("cell").distinct()), "cell", "left_semi")
        # The queries of a cell are dealt to lanes, if there is work for more tasks than the postings have.
        lanes, chunks = grid(per_cell, per_cell * postings.count()) if per_cell > BLOCK_ROWS else (1, 1)
        # Queries probing one cell are spread over enough tasks for blocks to stay bounded.
        parts = lanes * max(1, math.ceil(n / (16 * BLOCK_ROWS * lanes)))
        placed = probes.withColumn("_part", F.pmod(F.xxhash64("query_id"), F.lit(parts)))
        slot = F.col("cell").cast("bigint") * lanes
        query_blocks = pack(
            placed.repartition("cell", "_part").withColumn("slot", slot + F.col("_part") % lanes),
            key="slot", id_col="query_id", payload="vector", extra=extra,
        )
        blocks = pack(postings.select("cell", "id", payload), key="cell", id_col="id", payload="payload")
        blocks = deal(blocks, lanes, chunks).withColumn("slot", slot + F.col("_lane"))
        pairs = join_blocks(query_blocks, blocks, "slot", size * nprobe)
    if coded:
        shared = postings.sparkSession.sparkContext.broadcast(books)
        dtype = matrices.code_type(books.shape[1])

        def score(vectors, payload, n):
            codes = np.frombuffer(payload, dtype=dtype).reshape(n, -1)
            return matrices.code_scores(vectors, codes, shared.value, metric)

    else:
        score = flat_scores(metric, vector_dtype(postings, "embedding"))
    scored = score_pairs(pairs, score, k, metric, vector_dtype(probes, "vector"))
    return rank_hits(scored, k, metric)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """``(query_id, n_true, n_found, recall)`` of one set of hits against the exact one."""
    matched = truth.select("query_id", "id").join(
        found.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left"
    )
    return (
        matched.groupBy("query_id")
        .agg(F.count("*").alias("n_true"), F.count("_hit").alias("n_found"))
        .withColumn("recall", F.col("n_found") / F.col("n_true"))
    )
