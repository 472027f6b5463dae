import gzip
import json
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.embedders import HashingEmbedder, Retrying
from quire.operators.embedding import embed
from quire.operators.hydrate import nest
from quire.plans import embed_job, index_job, search_job
from quire.plans.index_job import IndexOptions
from quire.sources import shards
from quire.streaming.ingest import index_batches, ingest_parts

EMBED = HashingEmbedder(16)


def work(i, concept="C71924100", **more):
    tokens = f"study {i} of topic {i % 5} results".split()
    index = {t: [p for p, x in enumerate(tokens) if x == t] for t in tokens}
    return {"id": f"https://x.example/W{i}", "title": f"Title {i}", "publication_year": 2000 + i % 20,
            "concepts": [{"id": concept}], "abstract_inverted_index": index, **more}


class Snapshot:
    """Parts on disk with a manifest of ``s3://`` URLs."""

    def __init__(self, root):
        self.root, self.urls = root, []

    def add(self, date, works):
        folder = self.root / f"updated_date={date}"
        folder.mkdir(parents=True)
        lines = "\n".join(json.dumps(w) for w in works)
        (folder / "part_000.gz").write_bytes(gzip.compress(lines.encode()))
        self.urls.append(f"s3://bucket/works/updated_date={date}/part_000.gz")
        (self.root / "manifest.json").write_text(json.dumps({"entries": [{"url": u} for u in self.urls]}))

    def embed(self, spark, out, embed_fn=EMBED, **kwargs):
        def resolve(url):
            return url.replace("s3://bucket/works", str(self.root))

        return embed_job.run(spark, str(self.root / "manifest.json"), str(out), embed_fn, resolve=resolve, **kwargs)


@pytest.fixture
def snap(tmp_path):
    snap = Snapshot(tmp_path / "works")
    snap.add("2024-01-01", [work(i) for i in range(30)])
    snap.add("2024-01-02", [work(i, concept="C1") for i in range(30, 35)])
    snap.add("2024-01-03", [work(i) for i in range(40, 60)])
    return snap


def shard_ids(spark, out):
    paths = embed_job.committed_shards(spark, str(out))
    return sorted(int(r["id"].rsplit("W", 1)[1]) for r in spark.read.parquet(*paths).select("id").collect())


def test_embed_job_is_incremental(spark, snap, tmp_path):
    out = tmp_path / "out"
    first = snap.embed(spark, out, rows_per_file=20)
    assert (first.n_batches, first.n_parts, first.n_works) == (1, 3, 50)
    assert first.works_per_second > 0
    again = snap.embed(spark, out)
    assert (again.n_batches, again.n_parts) == (0, 0)
    snap.add("2024-02-01", [work(3), work(99)])  # work 3 is shipped again
    assert snap.embed(spark, out).n_works == 2
    assert shard_ids(spark, out) == sorted([*range(30), *range(40, 60), 3, 99])
    rows = spark.read.parquet(*embed_job.committed_shards(spark, str(out)))
    assert rows.columns == schemas.SHARD.names
    row = rows.where(F.col("id").endswith("/W7")).first()
    assert row["text"] == "Title 7\n\nstudy 7 of topic 2 results"
    assert np.allclose(row["embedding"], EMBED([row["text"]])[0])


def test_embed_job_overwrites_an_unrecorded_batch(spark, snap, tmp_path):
    out = tmp_path / "out"
    leftover = spark.createDataFrame([("junk",)], "id string")
    leftover.write.parquet(str(out / "shards" / "batch=000000"))
    assert embed_job.committed_shards(spark, str(out)) == []
    snap.embed(spark, out)
    assert len(shard_ids(spark, out)) == 50


def test_embed_job_soft_limit(spark, snap, tmp_path):
    out = tmp_path / "out"
    run = snap.embed(spark, out, max_works=10)
    assert (run.n_parts, run.n_works) == (1, 30)
    assert snap.embed(spark, out, max_works=10).n_works == 20  # the empty part comes along
    assert snap.embed(spark, out).n_batches == 0


def test_embed_job_goes_on_after_a_crash(spark, snap, tmp_path):
    out = tmp_path / "out"

    def fails_on_the_last_part(texts):
        if any(t.startswith("Title 4") and len(t.split()[1]) == 2 for t in texts):
            raise OSError("embedding service gone")
        return EMBED(texts)

    with pytest.raises(Exception, match="service gone"):
        snap.embed(spark, out, embed_fn=fails_on_the_last_part, parts_per_batch=1)
    assert shard_ids(spark, out) == list(range(30))
    rest = snap.embed(spark, out, parts_per_batch=1)
    assert (rest.n_batches, rest.n_works) == (1, 20)
    assert shard_ids(spark, out) == [*range(30), *range(40, 60)]


def test_embed_job_cuts_batches_by_size(spark, snap, tmp_path):
    """A batch closes at the first part end past the size, whatever is parsed at a time; the rest makes the last one."""
    for i in range(5):
        snap.add(f"2024-02-0{i + 1}", [work(100 * i + j + 1000) for j in range(7)])
    for name, at_a_time in (("a", 1), ("b", 3), ("c", 100)):
        out = tmp_path / name
        run = snap.embed(spark, out, shard_size=20, parts_at_a_time=at_a_time)
        done = embed_job.ledger.read_completed(spark, str(out / "parts")).collect()
        parts = {}
        for r in done:
            parts.setdefault(r["batch_id"], []).append(r["part"].split("updated_date=2024-")[1][:5])
        # 30 | 0 + 20 | 7 + 7 + 7 | 7 + 7
        assert [sorted(parts[i]) for i in range(4)] == [["01-01"], ["01-02", "01-03"], ["02-01", "02-02", "02-03"], ["02-04", "02-05"]]
        assert (run.n_batches, run.n_parts, run.n_works) == (4, 8, 85) and len(set(shard_ids(spark, out))) == 85
    assert snap.embed(spark, tmp_path / "a", shard_size=20).n_batches == 0


def test_embed_job_goes_on_after_a_crash_between_commits(spark, snap, tmp_path, monkeypatch):
    out = tmp_path / "out"
    commit, seen = embed_job.ledger.commit_parts, []

    def fails_once(parts, path, batch_id):
        seen.append(batch_id)
        if len(seen) == 2:
            raise OSError("driver gone")
        commit(parts, path, batch_id)

    monkeypatch.setattr(embed_job.ledger, "commit_parts", fails_once)
    with pytest.raises(OSError):
        snap.embed(spark, out, shard_size=10)
    assert shard_ids(spark, out) == list(range(30))  # the second batch is written, but not on record
    rest = snap.embed(spark, out, shard_size=10)
    assert (rest.n_batches, rest.n_works, seen) == (1, 20, [0, 1, 1])
    assert shard_ids(spark, out) == [*range(30), *range(40, 60)]


def test_embed_job_reads_each_part_once(spark, snap, tmp_path, monkeypatch):
    from quire.sources import snapshot

    read, real = [], snapshot.read_lines
    monkeypatch.setattr(snapshot, "read_lines", lambda s, paths, **kw: read.append(paths) or real(s, paths, **kw))
    before = len(list((tmp_path).rglob("texts-*")))
    snap.embed(spark, tmp_path / "out", max_works=40, parts_at_a_time=2, shard_size=1)
    assert sum(map(len, read)) == 3 and len(list((tmp_path).rglob("texts-*"))) == before


def test_a_part_named_twice(spark, snap, tmp_path):
    snap.urls.append(snap.urls[0])
    snap.add("2024-04-01", [])
    assert snap.embed(spark, tmp_path / "out", shard_size=1).n_works == 80


def test_embed_checks(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="1 texts gave a matrix"):
        embed(df, lambda texts: np.zeros((2, 4))).collect()
    assert embed(df.where("text = 'b'"), EMBED).collect() == []
    seen = []

    def failing(texts):
        seen.append(1)
        if len(seen) < 4:
            raise OSError("busy")
        return np.zeros((len(texts), 2), dtype="float32")

    waits = []
    assert Retrying(failing, sleep=waits.append)(["x"]).shape == (1, 2)
    assert waits == [2.0, 4.0, 8.0]
    with pytest.raises(OSError):
        Retrying(lambda texts: (_ for _ in ()).throw(OSError()), retries=2, sleep=waits.append)(["x"])


def write_vectors(spark, path, ids, dim=16, seed=0):
    x = np.random.default_rng(seed).standard_normal((len(ids), dim))
    rows = [(f"https://x.example/W{i}", *[None] * 5, "", [float(v) for v in r]) for i, r in zip(ids, x)]
    shards.write_shards(spark.createDataFrame(rows, schemas.SHARD).coalesce(1), str(path))
    return x


FLAT = IndexOptions(metric="l2", nlist=4, pq_m=0, iterations=3)


def test_index_job_life(spark, tmp_path):
    root, index = tmp_path / "shards", str(tmp_path / "index")
    write_vectors(spark, root / "a", range(100))
    built = index_job.run(spark, str(root), index, FLAT)
    assert (built["n_vectors"], built["batch"], built["nlist"], built["shard_count"]) == (100, 0, 4, 1)
    assert built["trained_at"] is not None and built["last_update_at"] is None
    assert index_job.run(spark, str(root), index, FLAT) is None  # nothing new

    write_vectors(spark, root / "b", range(100, 130), seed=1)
    # Leftovers of a crashed update are not part of the index and do not survive.
    stray = f"{index}/build=000001/postings/batch=0001/bucket=0"
    index_job.postings(spark, index, built).drop("batch", "bucket").write.parquet(stray)
    assert index_job.check_integrity(spark, index)["n_vectors"] == 100
    grown = index_job.run(spark, str(root), index)
    assert (grown["n_vectors"], grown["batch"], grown["last_update_added_vectors"]) == (130, 1, 30)
    assert len(grown["last_update_added_shards"]) == 1 and grown["trained_at"] == built["trained_at"]
    assert index_job.check_integrity(spark, index)["n_vectors"] == 130
    old, new = (index_job.load_quantiser(spark, index, m).centroids for m in (built, grown))
    assert (old == new).all()

    # Growing in two steps places every vector as the frozen model places all of them at once.
    model = index_job.load_quantiser(spark, index, grown)
    rows = index_job.postings(spark, index, grown)
    once = index_job.make_postings(shards.read_vectors(spark, str(root)), model)
    key = ["shard", "id", "cell"]
    assert rows.select(key).exceptAll(once.select(key)).isEmpty()
    assert index_job.indexed_shards(rows).agg(F.sum("n_vectors")).first()[0] == 130

    with pytest.raises(ValueError, match="built otherwise"):
        index_job.run(spark, str(root), index, IndexOptions(metric="ip", nlist=4, pq_m=0))
    rebuilt = index_job.run(spark, str(root), index, FLAT, force_rebuild=True)
    assert (rebuilt["build"], rebuilt["n_vectors"], rebuilt["batch"]) == ("000002", 130, 0)

    write_vectors(spark, root / "c", range(5), dim=8)
    with pytest.raises(RuntimeError, match="the index takes"):
        index_job.run(spark, str(root), index)


def test_index_job_errors(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        index_job.run(spark, str(tmp_path / "none"), str(tmp_path / "index"), FLAT)
    assert index_job.current_meta(spark, str(tmp_path / "index")) is None
    with pytest.raises(FileNotFoundError):
        index_job.check_integrity(spark, str(tmp_path / "index"))
    write_vectors(spark, tmp_path / "s", range(10))
    shutil.copytree(tmp_path / "s", tmp_path / "copy" / "t")
    shutil.copytree(tmp_path / "s", tmp_path / "copy" / "u")
    with pytest.raises(ValueError, match="share a file name"):
        index_job.run(spark, str(tmp_path / "copy"), str(tmp_path / "index"), FLAT)
    with pytest.raises(ValueError, match="sub-spaces"):
        index_job.run(spark, str(tmp_path / "s"), str(tmp_path / "index"), IndexOptions(nlist=2, pq_m=5))


@pytest.mark.parametrize("sample", ["hash", "head"])
def test_coded_index(spark, tmp_path, sample):
    x = write_vectors(spark, tmp_path / "s", range(300))
    options = IndexOptions(nlist=4, pq_m=8, pq_nbits=6, iterations=4, sample=sample)
    meta = index_job.run(spark, str(tmp_path / "s"), str(tmp_path / "index"), options)
    model = index_job.load_quantiser(spark, str(tmp_path / "index"), meta)
    assert model.books.shape[0] == 8 and model.books.shape[2] == 2
    rows = index_job.postings(spark, str(tmp_path / "index"), meta)
    assert "embedding" not in rows.columns and len(rows.first()["codes"]) == 8
    from quire.operators.neighbours import cell_neighbours, exact_neighbours, recall

    qs = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(20)], "query_id int, vector array<float>")
    corpus = shards.read_vectors(spark, str(tmp_path / "s"))
    exact = exact_neighbours(qs, corpus, 10)
    coded = cell_neighbours(qs, rows, model, 10, 4)
    assert np.mean([r["recall"] for r in recall(coded, exact).collect()]) > 0.5


def test_search_end_to_end(spark, snap, tmp_path):
    out, index = tmp_path / "out", str(tmp_path / "index")
    snap.embed(spark, out)
    options = IndexOptions(normalize=True, nlist=4, pq_m=0, iterations=3)
    index_job.run(spark, embed_job.committed_shards(spark, str(out)), index, options)
    records = [
        (f"https://x.example/W{i}", f"d{i}", f"Title {i}", 2000 + i, {"found": [0], str(i): [1]}, None, None, None)
        for i in range(50)
    ]
    works = spark.createDataFrame(records, schemas.HYDRATION)
    queries = spark.createDataFrame(
        [(1, "  Title 7 study 7 of topic 2 results\n", 3), (2, " \t", 5), (3, "topic 4", None), (4, "topic", 0)],
        schemas.QUERIES,
    )
    hits = search_job.run(spark, queries, index, works, EMBED, nprobe=4).collect()
    by_query = {}
    for h in sorted(hits, key=lambda h: (h["query_id"], h["rank"])):
        by_query.setdefault(h["query_id"], []).append(h)
    assert {k: len(v) for k, v in by_query.items()} == {1: 3, 3: 50, 4: 1}
    best = by_query[1][0]
    assert best["work_id"].endswith("/W7") and best["title"] == "Title 7" and best["abstract"] == "found 7"
    assert best["url"] == "d7" and best["rank"] == 1 and best["query"] == "Title 7 study 7 of topic 2 results"
    missing = [h for h in by_query[3] if int(h["work_id"].rsplit("W", 1)[1]) >= 50]
    assert missing and all(h["title"] is None and h["url"] is None for h in missing)
    nested = nest(search_job.run(spark, queries, index, works, EMBED, nprobe=4)).collect()
    assert {r["query_id"]: r["k"] for r in nested} == {1: 3, 3: 50, 4: 1}
    assert [r["rank"] for r in nested[0]["results"]] == list(range(1, nested[0]["k"] + 1))
    with pytest.raises(RuntimeError, match="dimensions"):
        search_job.run(spark, queries, index, works, HashingEmbedder(8))


def test_probed_buckets_are_pruned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_job, "BUCKETS", 8)
    write_vectors(spark, tmp_path / "s", range(400))
    index = str(tmp_path / "index")
    meta = index_job.run(spark, str(tmp_path / "s"), index, IndexOptions(nlist=16, pq_m=0, iterations=2))
    rows = index_job.postings(spark, index, meta)
    probes = spark.createDataFrame([(3,), (11,)], "cell int")
    few = search_job.pruned(rows, probes, 2)
    assert {r["bucket"] for r in few.select("bucket").distinct().collect()} == {3}
    assert "PartitionFilters: [isnotnull(bucket" in few._jdf.queryExecution().executedPlan().toString()
    assert search_job.pruned(rows, probes, 9) is rows


def test_several_records_of_one_id(spark):
    from quire.operators.hydrate import hydrate

    hits = spark.createDataFrame([(1, 1, 0.5, "https://x/W1"), (1, 2, 0.4, "odd")], "query_id int, rank int, score double, id string")
    records = [(f"https://{h}/W1", "d", t, 1, None, None, None, None) for h, t in (("a", "old"), ("b", "new"))]
    works = spark.createDataFrame(records, schemas.HYDRATION).withColumn(
        "updated", F.when(F.col("title") == "new", 2).otherwise(1)
    )
    rows = {r["rank"]: r for r in hydrate(hits, works, ["updated"]).collect()}
    assert len(rows) == 2 and rows[1]["title"] == "new" and rows[2]["title"] is None


def test_hits_are_searched_once(spark):
    """The works of hits are found without a second search for their ids."""
    from quire.operators.hydrate import works_in

    seen = spark.sparkContext.accumulator(0)

    def searched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = spark.createDataFrame([(f"W{i % 7}",) for i in range(20)] + [(None,)], "short_id string")
    works = spark.createDataFrame([(f"https://x/W{i}", "d") for i in (2, 3, 3, 9)], "id string, doi string")
    found = works_in(works, ids.mapInArrow(searched, ids.schema)).collect()
    assert sorted(r["id"] for r in found) == ["https://x/W2", "https://x/W3", "https://x/W3"]
    assert seen.value == 21


def test_streams(spark, snap, tmp_path):
    out, index = tmp_path / "out", str(tmp_path / "index")

    def ingest():
        ingest_parts(spark, str(snap.root), str(out), EMBED).awaitTermination()
        index_batches(spark, str(out), index, IndexOptions(nlist=2, pq_m=0, iterations=2)).awaitTermination()

    ingest()
    assert len(shard_ids(spark, out)) == 50
    assert index_job.check_integrity(spark, index)["n_vectors"] == 50
    done = embed_job.ledger.read_completed(spark, str(out / "parts"))
    assert done.count() == 3  # the part without works is on record too
    ingest()
    assert len(shard_ids(spark, out)) == 50
    snap.add("2024-03-01", [work(200), work(201)])
    ingest()
    assert len(shard_ids(spark, out)) == 52
    meta = index_job.check_integrity(spark, index)
    assert (meta["n_vectors"], meta["batch"]) == (52, 1)


def test_limit_counts_parts_by_place(spark, tmp_path):
    """Two parts whose last folders and names agree, in a folder with a space."""
    root = tmp_path / "a b"
    urls = []
    for side in ("x", "y"):
        folder = root / side / "updated_date=2024-01-01"
        folder.mkdir(parents=True)
        lines = "\n".join(json.dumps(work(i)) for i in range(20))
        (folder / "part_000.gz").write_bytes(gzip.compress(lines.encode()))
        urls.append(f"s3://bucket/{side}/updated_date=2024-01-01/part_000.gz")
    (root / "manifest.json").write_text(json.dumps({"entries": [{"url": u} for u in urls]}))

    def folder_of(url):
        return url.replace("s3://bucket", str(root)).rsplit("/", 1)[0]

    run = embed_job.run(spark, str(root / "manifest.json"), str(tmp_path / "out"), EMBED, resolve=folder_of, max_works=10)
    assert (run.n_parts, run.n_works) == (1, 20)
    assert embed_job.run(spark, str(root / "manifest.json"), str(tmp_path / "out"), EMBED, resolve=folder_of).n_works == 20


def test_url_concept_in_any_spelling(spark, tmp_path):
    snap = Snapshot(tmp_path / "works")
    snap.add("2024-01-01", [work(1, concept="https://x.org/C1"), work(2)])
    part = snap.root / "updated_date=2024-01-01" / "part_000.gz"
    part.write_bytes(gzip.compress(gzip.decompress(part.read_bytes()).replace(b"https://x.org/C1", b"https:\\/\\/x.org\\/C1")))
    assert snap.embed(spark, tmp_path / "out", concept_id="https://x.org/C1").n_works == 1


def test_title_mode_leaves_abstracts_alone(spark, snap):
    from quire.sources import snapshot

    lines = snapshot.read_lines(spark, str(snap.root))
    rows = embed_job.corpus_rows(lines, mode="title")
    assert "transform" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r["text"] for r in rows.where("id LIKE '%/W7'").collect()} == {"Title 7"}


def test_shards_without_vectors_are_no_news(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.SHARD)
    index, root = str(tmp_path / "index"), tmp_path / "s"
    shards.write_shards(empty, str(root / "none"))
    assert index_job.run(spark, str(root), index, FLAT) is None
    write_vectors(spark, root / "a", range(50))
    assert index_job.run(spark, str(root), index, FLAT)["shard_count"] == 1
    assert index_job.run(spark, str(root), index, FLAT) is None
    write_vectors(spark, root / "b", range(50, 60))
    grown = index_job.run(spark, [str(root / "none"), str(root / "b")], index, FLAT)
    assert (grown["n_vectors"], grown["shard_count"], len(grown["last_update_added_shards"])) == (60, 2, 1)


def test_a_repeated_stream_batch_is_indexed_once(spark, snap, tmp_path):
    out, index = tmp_path / "out", str(tmp_path / "index")
    options = IndexOptions(nlist=2, pq_m=0, iterations=2)
    ingest_parts(spark, str(snap.root), str(out), EMBED).awaitTermination()
    index_batches(spark, str(out), index, options).awaitTermination()
    (out / "stream" / "commits" / "0").unlink()  # the stream's own commit is lost
    (out / "stream" / "commits" / ".0.crc").unlink()
    ingest_parts(spark, str(snap.root), str(out), EMBED).awaitTermination()
    snap.add("2024-03-01", [work(300, concept="C1")])  # a batch without works
    ingest_parts(spark, str(snap.root), str(out), EMBED).awaitTermination()
    index_batches(spark, str(out), index, options).awaitTermination()
    assert index_job.check_integrity(spark, index)["n_vectors"] == 50
    assert len(shard_ids(spark, out)) == 50


def test_job_and_stream_keep_apart(spark, snap, tmp_path):
    ingest_parts(spark, str(snap.root), str(tmp_path / "s"), EMBED).awaitTermination()
    with pytest.raises(ValueError, match="belongs to a stream"):
        snap.embed(spark, tmp_path / "s")
    snap.embed(spark, tmp_path / "j")
    with pytest.raises(ValueError, match="belongs to a job"):
        ingest_parts(spark, str(snap.root), str(tmp_path / "j"), EMBED)


def test_copies_do_not_shrink_a_model(spark):
    from quire.operators.quantiser import train_books

    rows = [(f"c{i}", [1.0, 1.0]) for i in range(3000)] + [(f"d{i}", [float(i), 0.0]) for i in range(100)]
    sample = spark.createDataFrame(rows, "id string, embedding array<float>")
    assert train_books(sample, 1, 64, iterations=1).shape == (1, 64, 2)
