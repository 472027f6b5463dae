"""Searches whose work is dealt to tasks, and what a task leaves out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import blocks, matrices, neighbours
from quire.operators import quantiser as Q
from quire.operators.quantiser import Quantiser


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_better_keeps_all_that_may_be_among_the_best(metric):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 30, size=(40, 900)).astype("float64")  # many equal scores
    met = np.full((40, 5), np.inf)
    found = []
    for at in range(0, 900, 100):
        rows, columns = matrices.better(s[:, at : at + 100], met, 5, metric)
        found += list(zip(rows.tolist(), (columns + at).tolist()))
    want = matrices.best(s, 5, metric)
    kept = set(found)
    assert all((i, c) in kept for i in range(40) for c in want[i].tolist())
    cost = -s if metric == "ip" else s
    assert (np.sort(met, axis=1) == np.sort(cost, axis=1)[:, :5]).all()
    assert len(found) < 40 * 900 / 4


def test_grid():
    full = blocks.BLOCK_ROWS**2 * blocks.TASK_PAIRS
    assert blocks.grid(1e6, full) == (1, 1)
    assert blocks.grid(1e6, 100 * full) == (10, 10)
    assert blocks.grid(100, 100 * full)[0] == 1  # one block of queries: the candidates stay in place


@pytest.mark.parametrize("way", ["exact", "cells", "codes"])
def test_work_is_dealt_to_many_tasks(spark, monkeypatch, way):
    """Candidates of one partition are scored by many tasks, each for some of the queries, with the same hits."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, size=(500, 8)).astype("float32")
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<float>").coalesce(1)
    queries = rows.select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    model = Quantiser(x[:3].copy(), "l2", x[:16].reshape(16, 2, 4).transpose(1, 0, 2).copy() if way == "codes" else None, False)

    def hits():
        if way == "exact":
            return neighbours.exact_neighbours(queries, rows, 4, "l2")
        placed = Q.to_cells(rows, model, vector="embedding").drop("cell_score")
        placed = Q.encode(placed, model) if way == "codes" else placed
        return neighbours.cell_neighbours(queries, placed, model, 4, 2)

    def found(df):
        return sorted((r["query_id"], r["rank"], round(r["score"], 6), r["id"]) for r in df.collect())

    plain = hits()
    want = found(plain)
    for module in (blocks, neighbours):
        monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    monkeypatch.setattr(blocks, "TASK_PAIRS", 1)
    dealt = hits()
    assert "RepartitionByExpression" in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "lane" in dealt._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1].split("\n")[0]
    assert found(dealt) == want


@pytest.mark.parametrize("way", ["vectors", "codes", "residual ip", "residual l2", "given probes"])
def test_many_queries_stream_candidates_without_copies(spark, monkeypatch, way):
    """Lanes of queries read the candidates where they were written: nothing of these is shuffled or broadcast."""
    rng = np.random.default_rng(7)
    x = rng.integers(-9, 10, size=(600, 8)).astype("float32")
    rows = spark.createDataFrame([(f"w{i}", v.tolist()) for i, v in enumerate(x)], "id string, embedding array<float>").repartition(3)
    asked = [(i % 500, v.tolist()) for i, v in enumerate(x)]  # a hundred come twice under one number
    queries = spark.createDataFrame(asked, "query_id long, vector array<float>")
    metric = "l2" if way == "residual l2" else "ip"
    books = None if way in ("vectors", "given probes") else x[:16].reshape(16, 2, 4).transpose(1, 0, 2).copy()
    model = Quantiser(x[:3].copy(), metric, books, way.startswith("residual"))
    placed = Q.to_cells(rows, model, vector="embedding").drop("cell_score")
    placed = placed if books is None else Q.encode(placed, model)
    probes = neighbours.probe_cells(queries, model, 2) if way == "given probes" else None

    def hits():
        return neighbours.cell_neighbours(queries, placed, model, 4, 2, probes)

    def found(df):
        return sorted((r["query_id"], r["rank"], round(r["score"], 5), r["id"]) for r in df.collect())

    want = found(hits())
    for module in (blocks, neighbours):
        monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    monkeypatch.setattr(blocks, "TASK_PAIRS", 1)
    monkeypatch.setattr(neighbours, "HIT_BYTES", 1)
    streamed = hits()
    plan = streamed._jdf.queryExecution().optimizedPlan().toString()
    physical = streamed._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" in physical and "BroadcastHashJoin" not in physical and "SortMergeJoin" not in physical
    candidates = plan.split("Join Inner")[1].split("LogicalRDD")[0]
    assert "MapInArrow" not in candidates and "RepartitionByExpression" not in candidates  # read as they were written
    assert found(streamed) == want


def test_lane_queries():
    assert blocks.lane_queries(3, 10) == 512
    assert blocks.lane_queries(4, 4, 10**5) == 16 * 2048**2 // 10**5  # few candidates: more queries
    assert blocks.lane_queries(10, 10, 10) == 8 * 2048 // 10  # as far as a lane's blocks stay few
    assert blocks.lane_queries(32, 65_536) == 0  # a lane would skip nearly all it reads
