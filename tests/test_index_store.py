"""Cells in groups, training, and what an index keeps on record: ledger, hidden postings, compaction."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import matrices
from quire.operators import quantiser as Q
from quire.operators.neighbours import cell_neighbours, exact_neighbours, recall
from quire.plans import index_job
from quire.plans.index_job import IndexOptions
from quire.sources import file_order, shards

FLAT = IndexOptions(metric="l2", nlist=4, pq_m=0, iterations=3)


def clusters(n, dim, centres, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((centres, dim))[rng.integers(0, centres, n)] + 0.3 * rng.standard_normal((n, dim))).astype("float32")


def frame(spark, x, name="embedding"):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], f"id int, {name} array<float>")


def write_vectors(spark, path, ids, x):
    rows = [(f"W{i}", *[None] * 5, "", [float(a) for a in v]) for i, v in zip(ids, x, strict=True)]
    shards.write_shards(spark.createDataFrame(rows, schemas.SHARD).coalesce(1), str(path))


# Groups of cells


def test_nearest_in_groups_by_brute_force():
    rng = np.random.default_rng(1)
    c, leaders = rng.standard_normal((60, 6)), rng.standard_normal((5, 6))
    own = np.sort(rng.integers(0, 5, 60))
    starts, x = np.searchsorted(own, np.arange(6)), rng.standard_normal((80, 6))
    for metric in ("l2", "ip"):
        for n, probe in ((1, 1), (1, 2), (3, 2), (40, 1), (70, 5)):
            cells, values = matrices.nearest_in_groups(x, c, leaders, starts, metric, n, probe)
            sign = -1 if metric == "ip" else 1
            least = next(p for p in range(1, 6) if np.sort(np.diff(starts))[:p].sum() >= min(n, 60))
            for row, got, score in zip(x, cells, values, strict=True):
                groups = np.argsort(sign * matrices.scores(row[None], leaders, metric)[0], kind="stable")[: max(probe, least)]
                allowed = np.flatnonzero(np.isin(own, groups))
                cost = sign * matrices.scores(row[None], c[allowed], metric)[0]
                want = allowed[np.argsort(cost, kind="stable")][:n]
                assert got.tolist() == want.tolist() and np.allclose(sign * score, np.sort(cost)[:n])


def test_shares():
    assert Q.share_out(np.array([0.0, 5.0, 95.0]), 10).tolist() == [0, 1, 9]
    assert Q.share_out(np.array([1.0, 1.0, 1.0]), 3).tolist() == [1, 1, 1]


@pytest.fixture(scope="module")
def many_cells(spark):
    """4,096 cells in 64 groups, trained on 12,000 vectors."""
    x = clusters(12_000, 16, 500)
    sample = frame(spark, x).repartition(8).persist()
    leaders, cells, starts, inertia = Q.train_tree(sample, 4096, 64, iterations=3)
    yield x, sample, Q.Quantiser(cells, "l2", leaders=leaders, starts=starts), inertia
    sample.unpersist()


def test_many_cells(many_cells):
    x, _, model, inertia = many_cells
    assert model.nlist == 4096 and model.starts[-1] == 4096 and (np.diff(model.starts) > 0).all()
    assert all(b <= a * (1 + 1e-6) for a, b in zip(inertia, inertia[1:], strict=False))
    some = x[:3000]
    found, cost = model.nearest(some)
    true, least = matrices.nearest(some, model.centroids, "l2")
    assert (found == true).mean() > 0.97 and cost.sum() < 1.01 * least.sum()
    # A flat model of as many cells is no better by more than a little.
    flat = x[np.random.default_rng(0).permutation(len(x))[:4096]]
    assert matrices.nearest(some, model.centroids, "l2")[1].sum() < matrices.nearest(some, flat, "l2")[1].sum()


def test_recall_with_many_cells(spark, many_cells):
    x, sample, model, _ = many_cells
    postings = Q.to_cells(sample, model, vector="embedding").drop("cell_score")
    queries = frame(spark, x[:100] + 0.01, "vector").withColumnRenamed("id", "query_id")
    exact = exact_neighbours(queries, sample, 10, "l2")
    hits = cell_neighbours(queries, postings, model, 10, 64)
    assert np.mean([r["recall"] for r in recall(hits, exact).collect()]) > 0.9


def test_idle_codes_move(spark):
    x = clusters(600, 4, 8, seed=2)
    starts = np.repeat(x[:1], 8, axis=0)[None] + 1000.0 * np.arange(8)[None, :, None]
    made = Q.train(frame(spark, x), starts.astype("float32"), iterations=12)
    assert all(b <= a * (1 + 1e-6) for a, b in zip(made.inertia, made.inertia[1:], strict=False))
    assert len(np.unique(matrices.nearest(x, made.books[0], "l2")[0])) == 8
    # fewer distinct rows than codes: what can't be used stays idle
    few = Q.train(frame(spark, np.repeat(x[:2], 10, axis=0)), starts.astype("float32"), iterations=6)
    assert len(np.unique(matrices.nearest(x[:2], few.books[0], "l2")[0])) == 2


def test_index_with_groups(spark, tmp_path):
    x = clusters(1500, 8, 20, seed=3)
    write_vectors(spark, tmp_path / "s" / "a", range(1000), x[:1000])
    options = IndexOptions(metric="l2", nlist=40, pq_m=4, pq_nbits=4, iterations=3, groups=6, probe_groups=3)
    built = index_job.run(spark, str(tmp_path / "s"), str(tmp_path / "i"), options)
    model = index_job.load_quantiser(spark, str(tmp_path / "i"), built)
    assert len(model.leaders) == 6 and model.probe == 3 and model.nlist == built["nlist"] == 40
    write_vectors(spark, tmp_path / "s" / "b", range(1000, 1500), x[1000:])
    grown = index_job.run(spark, str(tmp_path / "s"), str(tmp_path / "i"))
    cells = model.nearest(x)[0][:, 0]
    rows = index_job.postings(spark, str(tmp_path / "i"), grown).select("id", "cell").collect()
    assert {int(r["id"][1:]): r["cell"] for r in rows} == dict(enumerate(cells.tolist()))
    assert IndexOptions(nlist=65_536).n_groups == 256 and IndexOptions(nlist=100).n_groups == 0


# Ledger, hidden postings, compaction


def hits(spark, index, meta, x, k=5):
    model = index_job.load_quantiser(spark, index, meta)
    queries = frame(spark, x, "vector").withColumnRenamed("id", "query_id")
    found = cell_neighbours(queries, index_job.postings(spark, index, meta), model, k, model.nlist)
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 4)) for r in found.collect())


def test_ledger_is_read_instead_of_postings(spark, tmp_path):
    root, index = tmp_path / "s", str(tmp_path / "i")
    write_vectors(spark, root / "a", range(50), clusters(50, 8, 3))
    meta = index_job.run(spark, str(root), index, FLAT)
    shards.write_shards(spark.createDataFrame([], schemas.SHARD), str(root / "none"))
    assert index_job.run(spark, str(root), index) is None
    rows = {r["n_vectors"]: r for r in index_job.shard_ledger(spark, index, meta).collect()}
    assert set(rows) == {0, 50} and rows[50]["length"] > 0 and rows[0]["added_at"] is not None
    # Postings need not be there for an update to know that nothing is new.
    shutil.move(f"{index}/build=000001/postings", tmp_path / "away")
    assert index_job.run(spark, str(root), index) is None
    assert all("/shards/" in f for f in index_job.shard_ledger(spark, index, meta).inputFiles())


def test_an_uncommitted_ledger_row_does_not_count(spark, tmp_path):
    root, index = tmp_path / "s", str(tmp_path / "i")
    write_vectors(spark, root / "a", range(50), clusters(50, 8, 3))
    meta = index_job.run(spark, str(root), index, FLAT)
    stray = spark.createDataFrame([("junk.parquet", 1, 9, 1, None, None)], schemas.SHARD_LEDGER)
    stray.write.parquet(f"{index}/build=000001/shards/commit=0001")
    assert index_job.shard_ledger(spark, index, meta).count() == 1
    write_vectors(spark, root / "b", range(50, 60), clusters(10, 8, 3, seed=1))
    grown = index_job.run(spark, str(root), index)
    assert sorted(r["n_vectors"] for r in index_job.shard_ledger(spark, index, grown).collect()) == [10, 50]


def test_many_batches_become_one(spark, tmp_path):
    root, index = tmp_path / "s", str(tmp_path / "i")
    x = clusters(120, 8, 5, seed=4)
    write_vectors(spark, root / "0", range(25), x[:25])
    index_job.run(spark, str(root), index, FLAT)
    for i in range(7):
        write_vectors(spark, root / str(i + 1), range(25 + 5 * i, 30 + 5 * i), x[25 + 5 * i : 30 + 5 * i])
        index_job.run(spark, str(root), index)
    before = index_job.check_integrity(spark, index)
    assert len(index_job.live_batches(before)) == 8
    want = hits(spark, index, before, x[:10])
    small = index_job.compact(spark, index, at_most=10)
    assert index_job.live_batches(small) == [0, 8] and hits(spark, index, small, x[:10]) == want
    after = index_job.compact(spark, index)
    assert index_job.live_batches(after) == [9] and after["n_vectors"] == 60
    assert hits(spark, index, after, x[:10]) == want
    assert hits(spark, index, before, x[:10]) == want  # a reader of the old generation
    assert index_job.compact(spark, index) is None
    assert index_job.run(spark, str(root), index) is None  # all shards are still on record
    assert index_job.check_integrity(spark, index)["n_vectors"] == 60


def test_a_crashed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    root, index = tmp_path / "s", str(tmp_path / "i")
    x = clusters(60, 8, 5, seed=5)
    for i in range(2):
        write_vectors(spark, root / str(i), range(30 * i, 30 * i + 30), x[30 * i : 30 * i + 30])
        meta = index_job.run(spark, str(root), index, FLAT)
    commit = index_job._commit
    monkeypatch.setattr(index_job, "_commit", lambda *a: (_ for _ in ()).throw(OSError("driver gone")))
    with pytest.raises(OSError):
        index_job.compact(spark, index)
    monkeypatch.setattr(index_job, "_commit", commit)
    assert index_job.check_integrity(spark, index) == meta
    write_vectors(spark, root / "2", range(60, 62), x[:2])  # takes the number of the crashed batch
    grown = index_job.run(spark, str(root), index)
    assert grown["n_vectors"] == index_job.check_integrity(spark, index)["n_vectors"] == 62


def test_a_shard_shipped_again(spark, tmp_path):
    root, index = tmp_path / "s", str(tmp_path / "i")
    x, y = clusters(60, 8, 5, seed=6), clusters(20, 8, 5, seed=7)
    for i in range(2):
        write_vectors(spark, root / str(i), range(30 * i, 30 * i + 30), x[30 * i : 30 * i + 30])
        before = index_job.run(spark, str(root), index, FLAT)
    (old,) = (root / "1").glob("*.parquet")

    def ship(ids, vectors):
        write_vectors(spark, tmp_path / "new", ids, vectors)
        (made,) = (tmp_path / "new").glob("*.parquet")
        (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
        shutil.move(made, old)

    ship(range(30, 50), y)
    assert index_job.run(spark, str(root), index) is None  # by name it is on record
    again = index_job.run(spark, str(root), index, replace_changed=True)
    assert (again["n_vectors"], again["shard_count"], again["last_update_added_vectors"]) == (50, 2, 20)
    assert index_job.check_integrity(spark, index)["n_vectors"] == 50
    found = hits(spark, index, again, y, 1)
    assert [h[2] for h in found] == [f"W{i}" for i in range(30, 50)] and all(h[3] < 1e-6 for h in found)
    assert index_job.run(spark, str(root), index, replace_changed=True) is None
    assert len(hits(spark, index, before, x[30:], 1)) == 30  # the old generation still has the old vectors
    merged = index_job.compact(spark, index)
    assert hits(spark, index, merged, y, 1) == found and index_job.hidden_shards(spark, index, merged) is None
    ship(range(30, 30), y[:0])  # and once more, without vectors
    empty = index_job.run(spark, str(root), index, replace_changed=True)
    assert (empty["n_vectors"], empty["shard_count"]) == (30, 1)
    assert index_job.check_integrity(spark, index)["n_vectors"] == 30


# Order of rows in files


def test_file_order(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "i int, s string"
    rows = [(i * 7 % 500, f"s{i}") for i in range(500)]
    spark.createDataFrame(rows, schema).repartition(7, "i").write.option("maxRecordsPerFile", 30).parquet(path)
    files = sorted((tmp_path / "t").glob("*.parquet"))
    laid = [r["i"] for f in files for r in spark.read.parquet(str(f)).collect()]
    numbered = file_order.in_file_order(spark, path, schema, ["i"])
    assert [r["i"] for r in numbered.orderBy("ordinal").collect()] == laid
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort " not in plan.split("Window")[0]
    for n in (0, 1, 29, 31, 250, 500, 600):
        assert sorted(r["i"] for r in file_order.first_rows(spark, path, schema, ["i"], n).collect()) == sorted(laid[:n])
    few = file_order.first_rows(spark, path, schema, ["i"], 31)
    assert len(few.inputFiles()) < len(files)
    batches = file_order.with_batches(spark, path, schema, ["i"], 64).collect()
    assert all(laid.index(r["i"]) // 64 == r["batch_no"] for r in batches)


def test_file_order_without_broadcast(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    got = file_order.in_file_order(spark, path, "id bigint", ["id"]).collect()
    assert sorted(r["ordinal"] for r in got) == list(range(100))


def test_hash_sample_is_spread(spark):
    rows = spark.range(4000).select(F.col("id"))
    n = Q.hash_sample(rows, 0.25).count()
    assert 850 < n < 1150 and Q.hash_sample(rows, 1.0).count() == 4000
