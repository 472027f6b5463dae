"""Embedding, shards, index tables, search and streams, run as whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.embedders import HashingEmbedder
from quire.operators.embedding import embed
from quire.operators.hydrate import nest
from quire.operators.neighbours import cell_neighbours
from quire.plans import embed_job, index_job, search_job
from quire.session import new_run_dir, remove_dir
from quire.sources import shards, snapshot
from quire.streaming.ingest import index_batches, ingest_parts
from registry import derive as D
from registry.base import query, staged, table
from registry.text_queries import SQL_QUERIES, search_queries

WITH = f"WITH {D.SQL_WORKS}"
EMBED = HashingEmbedder(64)


def sql_hashed(source: str, key: str) -> str:
    """``slots(key, d, x)``: signed feature hashing of ``source(key, text)`` in 64 dimensions."""
    return f"""
tokens AS (
  SELECT {key}, unnest(regexp_split_to_array(text, '{D.SQL_WS}+')) AS token FROM {source}
),
hashed AS (
  SELECT {key}, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS d,
         CASE WHEN CAST('0x' || substr(md5(token), 9, 1) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS sign
  FROM tokens WHERE token <> ''
),
slots AS (SELECT {key}, d, CAST(sum(sign) AS DOUBLE) AS x FROM hashed GROUP BY {key}, d)"""


@query("embed_batch", f"WITH {sql_hashed('documents', 'doc_id')} SELECT doc_id, d, x FROM slots WHERE x <> 0")
def embed_batch(spark, sf):
    rows = embed(table(spark, sf, "documents").select("doc_id", "text"), EMBED, spread=True)
    flat = rows.select("doc_id", F.posexplode("embedding").alias("d", "x"))
    return flat.where("x <> 0").select(
        "doc_id", F.col("d").cast("bigint").alias("d"), F.col("x").cast("double").alias("x")
    )


SQL_ETL = f"""{WITH} SELECT id, doi, title, language, publication_year, type, text
    FROM t WHERE in_corpus AND text IS NOT NULL"""


@query("etl_works", SQL_ETL)
def etl_works(spark, sf):
    """Snapshot files to texts: everything of the embed job before the vectors."""
    rows = embed_job.corpus_rows(snapshot.read_lines(spark, D.snapshot_root(spark, sf)))
    return rows.select("id", "doi", "title", "language", "publication_year", "type", "text")


SQL_SHARDS = f"""{WITH} SELECT id, doi, title, language, publication_year, type, text, CAST(64 AS BIGINT) AS dim
    FROM t WHERE in_corpus AND text IS NOT NULL"""


def _with_dim(rows):
    return rows.withColumn("dim", F.size("embedding").cast("bigint")).drop("embedding")


@query("shard_projection", SQL_SHARDS)
def shard_projection(spark, sf):
    rows = snapshot.with_text(snapshot.map_works(D.works(spark, sf)))
    return _with_dim(shards.shard_rows(embed(rows, EMBED)))


def _written_shards(spark, sf):
    """Folder with the embedded corpus, fifty rows to a file."""

    def write(path):
        rows = snapshot.with_text(snapshot.map_works(D.works(spark, sf)))
        shards.write_shards(embed(rows, EMBED, spread=True), path, rows_per_file=50)

    return staged(spark, sf, "shards", write)


@query("shard_write", SQL_SHARDS)
def shard_write(spark, sf):
    return _with_dim(spark.read.schema(D.schemas.SHARD).parquet(_written_shards(spark, sf)))


@query("list_shards", """
    SELECT CASE WHEN vec_id % 4 < 2 THEN 'old' ELSE 'new' END AS half, vec_id % 5 AS slot, true AS named, true AS sized, count(*) > 0 AS listed
    FROM embeddings GROUP BY ALL UNION ALL SELECT 'none', 0, true, true, true""")
def list_shards(spark, sf):
    """Shard files by folder; the names end as Parquet files do and every file has a length and a time."""
    listed = shards.list_shards(spark, vector_shards(spark, sf))
    folders = F.split("path", "/")
    return listed.groupBy(
        F.element_at(folders, -3).alias("half"), F.substring_index(F.element_at(folders, -2), "=", -1).cast("bigint").alias("slot")
    ).agg(
        F.bool_and(F.endswith("shard", F.lit(".parquet")) & F.endswith("path", F.col("shard"))).alias("named"),
        F.bool_and((F.col("length") > 0) & F.col("modified").isNotNull()).alias("sized"), (F.count("*") > 0).alias("listed"),
    )


@query("embed_job", SQL_SHARDS)
def run_embed_job(spark, sf):
    """The job over the manifest, then once more, which finds nothing to do."""
    root, out = D.snapshot_root(spark, sf), new_run_dir(spark, "embedded")
    prefix = D.BUCKET + "data/works/"

    def resolve(url):
        return url.replace(prefix, root + "/").rsplit("/", 1)[0]

    for _ in range(2):
        embed_job.run(spark, D.manifest_path(spark, sf), out, EMBED, resolve=resolve, shard_size=100)
    paths = embed_job.committed_shards(spark, out)
    return _with_dim(spark.read.schema(D.schemas.SHARD).parquet(*paths))


BATCH_ROWS = 100


@query("embed_batches", f"""
    WITH RECURSIVE {D.SQL_WORKS},
    n AS (SELECT part, count(*) FILTER (in_corpus AND text IS NOT NULL) AS n, row_number() OVER (ORDER BY part) - 1 AS pos FROM t GROUP BY part),
    walk AS (
      SELECT pos, part, n, CAST(0 AS BIGINT) AS batch_id, n AS filled FROM n WHERE pos = 0
      UNION ALL
      SELECT n.pos, n.part, n.n, walk.batch_id + CASE WHEN walk.filled >= {BATCH_ROWS} THEN 1 ELSE 0 END,
             CASE WHEN walk.filled >= {BATCH_ROWS} THEN n.n ELSE walk.filled + n.n END
      FROM walk JOIN n ON n.pos = walk.pos + 1)
    SELECT replace(part, '{D.BUCKET}', 'https://corpus-bucket.s3.amazonaws.com/') AS part, batch_id,
           CAST(sum(n) OVER (PARTITION BY batch_id) AS BIGINT) AS n_rows FROM walk""")
def embed_batches(spark, sf):
    """Batches the job cuts at the first part end past so many rows, as its record and its shards have them."""
    root, out = D.snapshot_root(spark, sf), new_run_dir(spark, "embedded")
    prefix = D.BUCKET + "data/works/"
    embed_job.run(
        spark, D.manifest_path(spark, sf), out, EMBED, shard_size=BATCH_ROWS, parts_at_a_time=5,
        resolve=lambda url: url.replace(prefix, root + "/").rsplit("/", 1)[0],
    )
    done = embed_job.ledger.read_completed(spark, f"{out}/parts")
    rows = spark.read.option("basePath", f"{out}/shards").schema(D.schemas.SHARD).parquet(*embed_job.committed_shards(spark, out))
    counts = rows.groupBy(F.regexp_extract(F.col("_metadata.file_path"), "batch=([0-9]+)", 1).cast("bigint").alias("batch_id")).agg(F.count("*").alias("n_rows"))
    return done.join(counts, "batch_id", "left").select("part", "batch_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


# --------------------------------------------------------------------------- index
SMALL = index_job.IndexOptions(nlist=8, pq_m=8, pq_nbits=4, iterations=3)


def _write_vector_shards(spark, sf, path):
    """One file for each 200 vectors of a fifth of the ids, and a file without any."""
    rows = D.vectors(spark, sf)
    for name, wanted in (("old", F.col("vec_id") % 4 < 2), ("new", F.col("vec_id") % 4 >= 2)):
        for slot in range(5):
            chosen = rows.where(wanted & (F.col("vec_id") % 5 == slot)).repartition(1 + slot % 2, "vec_id")
            shards.write_shards(D.as_shard_rows(chosen), f"{path}/{name}/slot={slot}", rows_per_file=200)
    shards.write_shards(D.as_shard_rows(rows.where("vec_id IS NULL").limit(0)), f"{path}/none/slot=0")


def vector_shards(spark, sf):
    """Folder with all vectors as shards, half of them in ``old`` and half in ``new``."""
    return staged(spark, sf, "vector-shards", lambda p: _write_vector_shards(spark, sf, p))


def grown_index(spark, sf):
    """Index built on the old shards and extended by the new ones."""

    def write(path):
        root = vector_shards(spark, sf)
        index_job.run(spark, f"{root}/old", path, SMALL)
        index_job.run(spark, root, path)

    return staged(spark, sf, "index", write)


@query("index_write", "SELECT label AS label, count(*) AS n FROM embeddings GROUP BY label")
def index_write(spark, sf):
    """Every vector has exactly one posting."""
    path = grown_index(spark, sf)
    rows = index_job.postings(spark, path, index_job.current_meta(spark, path))
    return rows.join(D.vectors(spark, sf).select("id", "label"), "id").groupBy("label").agg(F.count("*").alias("n"))


@query("index_integrity", "SELECT count(*) AS n_vectors, count(*) AS n_postings, true AS intact FROM embeddings")
def index_integrity(spark, sf):
    path = grown_index(spark, sf)
    meta = index_job.check_integrity(spark, path)
    return index_job.postings(spark, path, meta).agg(
        F.lit(meta["n_vectors"]).alias("n_vectors"),
        F.count("*").alias("n_postings"),
        (F.count("*") == meta["n_vectors"]).alias("intact"),
    )


@query("indexed_shards", """
    SELECT CASE WHEN vec_id % 4 < 2 THEN 'old' ELSE 'new' END AS half, count(*) AS n_vectors,
           CASE WHEN vec_id % 4 < 2 THEN 0 ELSE 1 END AS batch FROM embeddings GROUP BY ALL
    UNION ALL SELECT 'none', 0, 1""")
def indexed_shards(spark, sf):
    """The shard ledger, which has the shard without vectors too."""
    path, root = grown_index(spark, sf), vector_shards(spark, sf)
    done = index_job.shard_ledger(spark, path, index_job.current_meta(spark, path))
    listed = shards.list_shards(spark, root).select("shard", F.element_at(F.split("path", "/"), -3).alias("half"))
    return done.join(listed, "shard").groupBy("half", F.col("batch").cast("bigint").alias("batch")).agg(F.sum("n_vectors").alias("n_vectors"))


@query("index_meta", """
    SELECT len(any_value(embedding)) AS dim, count(*) AS n_vectors, CAST(8 AS BIGINT) AS nlist, CAST(8 AS BIGINT) AS pq_m,
           'ip' AS metric, false AS normalized, count(*) FILTER (vec_id % 4 >= 2) AS last_update_added_vectors,
           CAST(1 AS BIGINT) AS batch FROM embeddings""")
def index_meta(spark, sf):
    history = index_job.meta_history(spark, grown_index(spark, sf))
    current = history.orderBy(F.desc("build"), F.desc("batch")).limit(1)
    return current.select(
        F.col("dim").cast("bigint"), "n_vectors", F.col("nlist").cast("bigint"), F.col("pq_m").cast("bigint"),
        "metric", "normalized", "last_update_added_vectors", F.col("batch").cast("bigint"),
    )


@query("index_totals", """
    SELECT count(*) AS n_vectors, count(*) AS n_in_ledger, count(DISTINCT vec_id % 4) AS shard_count,
           string_agg(DISTINCT CASE WHEN vec_id % 4 >= 2 THEN 'corpus_00000' || vec_id % 4 || '.parquet' END, ',' ORDER BY
             CASE WHEN vec_id % 4 >= 2 THEN 'corpus_00000' || vec_id % 4 || '.parquet' END) AS added_shards,
           count(*) FILTER (vec_id % 4 >= 2) AS added_vectors, true AS shards_agree, true AS added_agree
    FROM embeddings""")
def index_totals(spark, sf):
    """Totals of the index as its meta, its ledger and its postings have them, and whether they name the same shards."""
    path = grown_index(spark, sf)
    meta = index_job.current_meta(spark, path)
    ledger = index_job.shard_ledger(spark, path, meta).where("n_vectors > 0")
    added = F.array_sort(F.collect_set(F.when(F.col("batch") == meta["batch"], F.col("shard"))))  # one name per file
    totals = ledger.agg(
        F.lit(meta["n_vectors"]).alias("n_vectors"),
        F.sum("n_vectors").alias("n_in_ledger"),
        F.sum(F.when(F.col("batch") == meta["batch"], F.col("n_vectors"))).alias("added_vectors"),
        (F.count("*") == meta["shard_count"]).alias("shards_agree"),
        (added == F.array(*map(F.lit, meta["last_update_added_shards"]))).alias("added_agree"),
    )
    # The postings by the shard the corpus names for their vector, and the batch that brought them.
    number = (F.substring_index("id", "/W", -1).cast("bigint") % 4).cast("int")
    rows = index_job.postings(spark, path, meta).select("batch", shards.shard_name(number, "corpus").alias("shard"))
    per_shard = index_job.indexed_shards(rows.where("batch = 0")).withColumn("new", F.lit(False)).unionByName(
        index_job.indexed_shards(rows.where("batch > 0")).withColumn("new", F.lit(True))
    )
    named = per_shard.agg(
        F.count_distinct("shard").alias("shard_count"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("new"), F.col("shard")))), ",").alias("added_shards"),  # one name per shard
    )
    return totals.crossJoin(named).select(
        "n_vectors", "n_in_ledger", "shard_count", "added_shards", "added_vectors", "shards_agree", "added_agree"
    )


def batched_index(spark, sf):
    """Index of raw vectors in ten batches, one for each folder of shards; no batch but the first is large."""

    def write(path):
        root = vector_shards(spark, sf)
        options = index_job.IndexOptions(nlist=4, pq_m=0, iterations=2, metric="ip")
        for half in ("old", "new"):
            for slot in range(5):
                index_job.run(spark, f"{root}/{half}/slot={slot}", path, options)

    return staged(spark, sf, "batched-index", write)


def _exact_hits(spark, sf, index, meta):
    """Every vector's best five by a search of all cells."""
    model = index_job.load_quantiser(spark, index, meta)
    hits = cell_neighbours(D.all_queries(spark, sf), index_job.postings(spark, index, meta), model, 5, model.nlist)
    return hits.select("query_id", F.substring_index("id", "/W", -1).cast("bigint").alias("id"), F.col("rank").cast("bigint").alias("rank"), F.round("score", 4).alias("score"))


SQL_FIVE = f"""WITH {D.SQL_VECTORS}, {D.sql_exact('ip', 5)}
    SELECT query_id, rank, round(score, 4) AS score"""


@query("index_compact", f"{SQL_FIVE}, CAST(1 AS BIGINT) AS n_batches, true AS same FROM hits")
def index_compact(spark, sf):
    """Hits of an index of ten batches, merged into one; a reader of the old meta row finds the same."""
    path = batched_index(spark, sf)
    history = index_job.meta_history(spark, path).orderBy(F.desc("batch")).collect()  # one row per commit
    before = next(r.asDict() for r in history if len(r["live_batches"]) == 10)
    after = index_job.compact(spark, path) or index_job.current_meta(spark, path)
    old = _exact_hits(spark, sf, path, before).select("query_id", "rank", F.col("score").alias("was"))
    hits = _exact_hits(spark, sf, path, after).drop("id").join(old, ["query_id", "rank"], "left")
    return hits.select("query_id", "rank", "score", F.lit(len(index_job.live_batches(after))).cast("bigint").alias("n_batches"), (F.col("was") == F.col("score")).alias("same"))


def _ship_again(spark, path, rows, scratch):
    """Put one file with ``rows`` in the place of the shard at ``path``, under its name."""
    shards.write_shards(rows.coalesce(1), scratch, rows_per_file=1 << 40)
    (made,) = [r["path"] for r in shards.list_shards(spark, scratch).collect()]
    jvm = spark._jvm
    target, source = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(made)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, False)
    files.rename(source, target)


def _reshipped(spark, sf):
    """Index of shards, one of which is then shipped again with every vector turned round."""

    def write(path):
        root = f"{path}/shards"
        rows = D.as_shard_rows(D.vectors(spark, sf))
        one = F.substring_index("id", "/W", -1).cast("bigint") % 10 == 1
        shards.write_shards(rows.where(~one), f"{root}/others", rows_per_file=500)
        shards.write_shards(rows.where(one).coalesce(1), f"{root}/one", rows_per_file=1 << 40)
        options = index_job.IndexOptions(nlist=4, pq_m=0, iterations=2, metric="ip")
        index_job.run(spark, root, f"{path}/index", options)
        turned = rows.where(one).withColumn("embedding", F.transform("embedding", lambda x: -x))
        _ship_again(spark, shards.list_shards(spark, f"{root}/one").first()["path"], turned, f"{path}/scratch")
        index_job.run(spark, root, f"{path}/index", replace_changed=True)

    return staged(spark, sf, "reshipped-index", write) + "/index"


@query("reshipped_shard", f"""WITH {D.SQL_VECTORS}
    SELECT vec_id, round(v[1] * CASE WHEN vec_id % 10 = 1 THEN -1 ELSE 1 END, 5) AS first, CAST(1 AS BIGINT) AS n FROM e""")
def reshipped_shard(spark, sf):
    """After a shard was shipped again only its new vectors are found."""
    path = _reshipped(spark, sf)
    meta = index_job.check_integrity(spark, path)
    rows = index_job.postings(spark, path, meta).select(F.substring_index("id", "/W", -1).cast("bigint").alias("vec_id"), "embedding")
    return rows.groupBy("vec_id").agg(F.round(F.max(F.col("embedding")[0].cast("double")), 5).alias("first"), F.count("*").alias("n"))


@query("index_stats", """
    SELECT true AS ready, count(*) AS ntotal, len(any_value(embedding)) AS dim, CAST(4 AS BIGINT) AS nprobe,
           'hashing-64' AS model FROM embeddings""")
def index_stats(spark, sf):
    meta = index_job.current_meta(spark, grown_index(spark, sf))
    row = index_job.statistics(meta, nprobe=4, model="hashing-64")
    return spark.createDataFrame([row], "ready boolean, ntotal bigint, dim bigint, nprobe bigint, model string")


@query("index_job", f"SELECT '{D.BASE}W' || vec_id AS id, CAST(1 AS BIGINT) AS n FROM embeddings")
def run_index_job(spark, sf):
    """Build, extend, and a third run that has nothing to add."""
    path, root = new_run_dir(spark, "index"), vector_shards(spark, sf)
    options = index_job.IndexOptions(metric="l2", normalize=True, nlist=8, pq_m=0, iterations=2)
    index_job.run(spark, f"{root}/old", path, options)
    meta = index_job.run(spark, root, path, options)
    if index_job.run(spark, root, path, options) is not None:
        raise AssertionError("a covered index was extended")
    return index_job.postings(spark, path, meta).groupBy("id").agg(F.count("*").alias("n"))


# --------------------------------------------------------------------------- search
def text_index(spark, sf):
    """Index over the embedded corpus, raw vectors kept."""

    def write(path):
        options = index_job.IndexOptions(normalize=True, nlist=8, pq_m=0, iterations=2)
        index_job.run(spark, _written_shards(spark, sf), path, options)

    return staged(spark, sf, "text-index", write)


def _searched(spark, sf):
    """All cells are probed, so the approximate search is exact."""
    index, works = text_index(spark, sf), D.works(spark, sf)
    return search_job.run(spark, search_queries(spark, sf), index, works, EMBED, nprobe=8)


SQL_SEARCH = f"""{WITH}, {SQL_QUERIES},
texts AS (
  SELECT 'd' || doc_id AS key, text FROM t WHERE in_corpus AND text IS NOT NULL
  UNION ALL SELECT 'q' || query_id, query FROM queries
),
{sql_hashed('texts', 'key')},
unit AS (SELECT key, d, CAST(CAST(x / sqrt(sum(x * x) OVER (PARTITION BY key)) AS FLOAT) AS DOUBLE) AS x
  FROM slots WHERE x <> 0),
scored AS (
  SELECT q.query_id, t.id, coalesce(sum(a.x * b.x), 0) AS score
  FROM queries q CROSS JOIN (SELECT * FROM t WHERE in_corpus AND text IS NOT NULL) t
  LEFT JOIN unit a ON a.key = 'q' || q.query_id
  LEFT JOIN unit b ON b.key = 'd' || t.doc_id AND b.d = a.d
  GROUP BY q.query_id, t.id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS rank FROM scored)"""


@query("search", f"""{SQL_SEARCH}
    SELECT query_id, rank, round(score, 5) AS score FROM ranked JOIN queries USING (query_id) WHERE rank <= k""")
def search(spark, sf):
    """Ranks and scores; the SQL rounds unit vectors to float32 as the index does."""
    return _searched(spark, sf).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 5).alias("score")
    )


@query("search_nested", f"""{SQL_SEARCH}
    SELECT query_id, any_value(query) AS query, count(*) AS k, round(max(score), 5) AS best_score
    FROM ranked JOIN queries USING (query_id) WHERE rank <= queries.k GROUP BY query_id""")
def search_nested(spark, sf):
    return nest(_searched(spark, sf)).select(
        "query_id", "query", "k", F.round(F.col("results")[0]["score"], 5).alias("best_score")
    )


# --------------------------------------------------------------------------- streams
@query("stream_ingest", SQL_SHARDS)
def stream_ingest(spark, sf):
    out = new_run_dir(spark, "stream")
    ingest_parts(spark, D.snapshot_root(spark, sf), out, EMBED).awaitTermination()
    return _with_dim(spark.read.schema(D.schemas.SHARD).parquet(*embed_job.committed_shards(spark, out)))


@query("stream_commit", f"""{WITH} SELECT updated_date, CAST(1 AS BIGINT) AS n_records
    FROM w GROUP BY updated_date""")
def stream_commit(spark, sf):
    """Runs of the stream, one of which loses its own commit; each part folder is on record in one batch only."""
    out = new_run_dir(spark, "stream")
    ingest_parts(spark, D.snapshot_root(spark, sf), out, EMBED).awaitTermination()
    remove_dir(spark, f"{out}/stream/commits")
    for _ in range(2):
        ingest_parts(spark, D.snapshot_root(spark, sf), out, EMBED).awaitTermination()
    done = embed_job.ledger.read_completed(spark, f"{out}/parts")
    day = snapshot.updated_date(F.col("part")).cast("string").alias("updated_date")
    return done.groupBy(day).agg(F.count_distinct("batch_id").alias("n_records"))


@query("stream_admission", f"{WITH} SELECT count(DISTINCT updated_date) AS n_days, true AS few_files, true AS many_batches FROM w")
def stream_admission(spark, sf):
    """With a limit on files no batch takes more of them, and all get on record."""
    out = new_run_dir(spark, "stream")
    ingest_parts(spark, D.snapshot_root(spark, sf), out, EMBED, max_files=5).awaitTermination()
    done = embed_job.ledger.read_completed(spark, f"{out}/parts")
    day = snapshot.updated_date(F.col("part"))
    batches = done.groupBy("batch_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.count("*").alias("batches"))
    days = done.agg(F.count_distinct(day).alias("n_days"))
    return days.crossJoin(batches).select("n_days", (F.col("most") <= 5).alias("few_files"), (F.col("batches") > 1).alias("many_batches"))


@query("stream_index_add", f"{WITH} SELECT id, CAST(1 AS BIGINT) AS n FROM t WHERE in_corpus AND text IS NOT NULL")
def stream_index_add(spark, sf):
    out, index = new_run_dir(spark, "stream"), new_run_dir(spark, "index")
    options = index_job.IndexOptions(nlist=8, pq_m=0, iterations=2)
    ingest_parts(spark, D.snapshot_root(spark, sf), out, EMBED).awaitTermination()
    for _ in range(2):
        index_batches(spark, out, index, options).awaitTermination()
    rows = index_job.postings(spark, index, index_job.current_meta(spark, index))
    return rows.groupBy("id").agg(F.count("*").alias("n"))
