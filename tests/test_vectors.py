import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import vectors as V
from quire.operators import matrices
from quire.operators import neighbours as N
from quire.operators import quantiser as Q

RNG = np.random.default_rng(0)


def frame(spark, x, names=("id", "embedding"), prefix=None):
    ids = [f"{prefix}{i}" for i in range(len(x))] if prefix else list(range(len(x)))
    kind = "string" if prefix else "bigint"
    rows = [(i, [float(v) for v in row]) for i, row in zip(ids, x)]
    return spark.createDataFrame(rows, f"{names[0]} {kind}, {names[1]} array<float>").repartition(5)


def queries(spark, x):
    return frame(spark, x, ("query_id", "vector"))


def brute(q, x, k, metric):
    """``(query, rank, id)`` by full sort, ties to the lower id."""
    q, x = q.astype("float64"), x.astype("float64")
    s = q @ x.T if metric == "ip" else ((q[:, None] - x[None]) ** 2).sum(2)
    cost = -s if metric == "ip" else s
    out = {}
    for i in range(len(q)):
        order = np.lexsort((np.arange(len(x)), cost[i]))[:k]
        out[i] = [(int(j), round(float(s[i, j]), 6)) for j in order]
    return out


def found(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["id"], round(r["score"], 6)))
    return out


@pytest.fixture(scope="module")
def data():
    x = RNG.standard_normal((700, 16)).astype("float32")
    return x, RNG.standard_normal((40, 16)).astype("float32")


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_exact_neighbours(spark, data, metric):
    x, q = data
    assert found(N.exact_neighbours(queries(spark, q), frame(spark, x), 7, metric)) == brute(q, x, 7, metric)


def test_exact_neighbours_over_many_blocks(spark, data, monkeypatch, no_broadcast):
    from quire.operators import blocks

    x, q = data
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 64)
    monkeypatch.setattr(N, "BLOCK_ROWS", 9)
    hits = N.exact_neighbours(queries(spark, q), frame(spark, x), 7)
    assert "BroadcastHashJoin" not in hits._jdf.queryExecution().executedPlan().toString()
    assert found(hits) == brute(q, x, 7, "ip")


def test_equal_scores_go_to_the_lower_id(spark):
    x = np.repeat(np.eye(4, dtype="float32"), 200, axis=0)  # four groups of copies
    q = np.eye(4, dtype="float32")
    assert found(N.exact_neighbours(queries(spark, q), frame(spark, x), 5)) == {
        i: [(200 * i + j, 1.0) for j in range(5)] for i in range(4)
    }


def test_fewer_candidates_than_k(spark, data):
    x, q = data
    hits = found(N.exact_neighbours(queries(spark, q), frame(spark, x[:3]), 50))
    assert {len(v) for v in hits.values()} == {3}


def test_unknown_metric(spark, data):
    with pytest.raises(ValueError, match="metric"):
        N.exact_neighbours(queries(spark, data[1]), frame(spark, data[0]), 3, "cosine")


def postings(spark, x, model):
    placed = Q.to_cells(frame(spark, x), model, vector="embedding").drop("cell_score")
    return placed if model.books is None else Q.encode(placed, model)


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_all_cells_probed_is_exact(spark, data, metric):
    x, q = data
    model = Q.Quantiser(x[:12].astype("float64"), metric)
    hits = N.cell_neighbours(queries(spark, q), postings(spark, x, model), model, 9, 12)
    assert found(hits) == brute(q, x, 9, metric)


def test_shuffled_cells_agree_with_broadcast(spark, data, no_broadcast):
    x, q = data
    model = Q.Quantiser(x[:12].astype("float64"), "ip")
    hits = N.cell_neighbours(queries(spark, q), postings(spark, x, model), model, 9, 12)
    assert "BroadcastHashJoin" not in hits._jdf.queryExecution().executedPlan().toString()
    assert found(hits) == brute(q, x, 9, "ip")


def test_recall_of_few_probes(spark, data):
    x, q = data
    model = Q.Quantiser(x[:12].astype("float64"), "l2")
    exact = N.exact_neighbours(queries(spark, q), frame(spark, x), 10, "l2")
    some = N.cell_neighbours(queries(spark, q), postings(spark, x, model), model, 10, 6)
    rows = N.recall(some, exact).collect()
    assert len(rows) == len(q) and np.mean([r["recall"] for r in rows]) > 0.6


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("residual", [True, False])
@pytest.mark.parametrize("n_codes", [16, 300])
def test_coded_scores_are_those_of_decoded_vectors(spark, data, metric, residual, n_codes):
    x, q = data
    books = np.stack([x[:n_codes, 4 * j : 4 * j + 4].astype("float64") for j in range(4)])
    model = Q.Quantiser(x[:5].astype("float64"), metric, books, residual)
    x64 = x.astype("float64")
    cells = matrices.nearest(x64, model.centroids, metric)[0][:, 0]
    base = model.centroids[cells] if residual else 0.0
    decoded = base + matrices.decode(matrices.encode(x64 - base, books), books)
    hits = found(N.cell_neighbours(queries(spark, q), postings(spark, x, model), model, 6, 5))
    want = brute(q, decoded, 6, metric)
    assert {k: [s for _, s in v] for k, v in hits.items()} == {k: [s for _, s in v] for k, v in want.items()}


def test_code_numbers_of_wide_codes(spark, data):
    x, _ = data
    books = np.stack([x[:300, 4 * j : 4 * j + 4].astype("float64") for j in range(4)])
    model = Q.Quantiser(x[:1].astype("float64"), "l2", books, False)
    rows = Q.code_numbers(Q.encode(frame(spark, x), model), model).collect()
    want = matrices.encode(x.astype("float64"), books)
    assert all(want[r["id"], r["m"]] == r["code"] for r in rows) and len(rows) == want.size


def test_best_columns():
    s = RNG.integers(0, 5, size=(50, 30)).astype("float64")
    for metric in ("ip", "l2"):
        for n in (1, 4, 30, 40):
            cost = -s if metric == "ip" else s
            want = [np.lexsort((np.arange(30), row))[:n] for row in cost]
            assert (matrices.best(s, n, metric) == np.array(want)).all()


def test_lloyd_step_means(spark, data):
    x, _ = data
    books = np.stack([x[:6, :8], x[:6, 8:]]).astype("float64")
    for r in Q.lloyd_step(frame(spark, x), books).collect():
        part = x[:, 8 * r["m"] : 8 * r["m"] + 8].astype("float64")
        labels = matrices.nearest(part, books[r["m"]], "l2")[0][:, 0]
        mine = part[labels == r["code"]]
        assert r["n"] == len(mine) and np.allclose(r["mean"], mine.mean(axis=0))


def test_training_finds_clusters(spark):
    centres = 10 * np.eye(8, dtype="float32")
    x = np.repeat(centres, 50, axis=0) + 0.1 * RNG.standard_normal((400, 8)).astype("float32")
    books = Q.train_books(frame(spark, x), 1, 64, iterations=5)
    cost = matrices.nearest(x.astype("float64"), books[0].astype("float64"), "l2")[1]
    assert len(books[0]) == 64 and cost.max() < 5
    copies = np.repeat(centres, 100, axis=0)
    assert Q.train_books(frame(spark, copies), 1, 64).shape == (1, 8, 8)  # distinct rows only
    with pytest.raises(ValueError, match="split"):
        Q.train_books(frame(spark, x), 3, 4)


def test_model_beyond_the_limit_is_refused(spark, data):
    spark.conf.set("quire.broadcast.maxBytes", "100")
    try:
        with pytest.raises(ValueError, match="limit"):
            Q.train_books(frame(spark, data[0]), 1, 16)
        with pytest.raises(ValueError, match="limit"):
            Q.model_matrix(frame(spark, data[0]), ["id"], "embedding")
    finally:
        spark.conf.unset("quire.broadcast.maxBytes")


def test_normalize_keeps_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>").coalesce(1)
    rows = df.select(V.l2_normalize(F.col("v"))).collect()
    assert np.allclose(rows[0][0], [0.6, 0.8]) and rows[1][0] == [0.0, 0.0]


def test_uneven_vectors_fail(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "id bigint, embedding array<float>")
    model = Q.Quantiser(np.eye(2))
    with pytest.raises(Exception, match="differ in length"):
        Q.to_cells(df.coalesce(1), model, vector="embedding").collect()


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_exact_search_in_passes(spark, data, metric):
    """Queries beyond the limit take passes over a corpus that isn't shuffled, with the same hits."""
    x, q = data
    rows, asked = frame(spark, x), queries(spark, q)
    want = found(N.exact_neighbours(asked, rows, 5, metric))
    spark.conf.set("quire.broadcast.maxBytes", str(8 * q.size // 3))
    try:
        assert found(N.exact_neighbours(asked, rows, 5, metric)) == want
        plan = N._one_pass(asked.limit(3), rows, 5, metric, 3, 100)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("quire.broadcast.maxBytes")


def test_few_probes_drop_other_cells_first(spark, data):
    x, q = data
    model = Q.Quantiser(x[:100].astype("float64"), "l2")
    rows = postings(spark, x, model)
    few = queries(spark, q[:4])
    hits = N.cell_neighbours(few, rows, model, 5, 20)
    assert "LeftSemi" in hits._jdf.queryExecution().executedPlan().toString()
    cells = matrices.nearest(x.astype("float64"), model.centroids, "l2")[0][:, 0]
    probed = matrices.nearest(q[:4].astype("float64"), model.centroids, "l2", 20)[0]
    for i, best in found(hits).items():
        mine = np.flatnonzero(np.isin(cells, probed[i]))
        dist = ((x[mine].astype("float64") - q[i].astype("float64")) ** 2).sum(1)
        assert [j for j, _ in best] == [int(mine[k]) for k in np.argsort(dist, kind="stable")[:5]]
