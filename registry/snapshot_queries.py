"""Snapshot scans, parts and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import parts as P
from quire.plans.embed_job import observed
from quire.session import new_run_dir
from quire.sources import file_order, ledger, shards, snapshot
from registry import derive as D
from registry.base import query, staged, table

HTTPS_PART = f"replace(part, '{D.BUCKET}', 'https://corpus-bucket.s3.amazonaws.com/')"


@query("manifest_parts", f"""
    SELECT row_number() OVER (ORDER BY part) + 1 AS pos, part AS url, {HTTPS_PART} AS part
    FROM (SELECT DISTINCT {D.SQL_PART} AS part FROM documents)""")
def manifest_parts(spark, sf):
    listed = snapshot.manifest_parts(snapshot.read_manifest(spark, D.manifest_path(spark, sf)))
    return listed.withColumn("pos", F.col("pos").cast("bigint"))


@query("part_https", r"""
    WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url
                 WHEN 1 THEN regexp_replace(url, '^https?://', 's3://')
                 ELSE regexp_replace(url, '^https?://([^/]+)/', 's3://\1///') END AS url FROM pages)
    SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN url ELSE
        'https://' || string_split(substr(url, 6), '/')[1] || '.s3.amazonaws.com/' ||
        ltrim(string_split(string_split(substr(url, 6 + length(string_split(substr(url, 6), '/')[1])), '?')[1], '#')[1], '/')
        END AS https FROM u""")
def part_https(spark, sf):
    url, page = F.col("url"), F.col("page_id") % 3
    shaped = (
        F.when(page == 0, url)
        .when(page == 1, F.regexp_replace(url, "^https?://", "s3://"))
        .otherwise(F.regexp_replace(url, "^https?://([^/]+)/", "s3://$1///"))
    )
    pages = table(spark, sf, "pages").select("page_id", shaped.alias("url"))
    return pages.withColumn("https", X.part_https(url))


@query("scan_jsonl", f"""
    WITH {D.SQL_WORKS}
    SELECT id, doi, raw_title AS title, display_name, language, publication_year, type,
           CAST(CASE doc_id % 4 WHEN 0 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS BIGINT) AS n_concepts,
           CAST(n_positions AS BIGINT) AS n_positions FROM w""")
def scan_jsonl(spark, sf):
    works = snapshot.read_works(spark, D.snapshot_root(spark, sf))
    return works.select(
        "id", "doi", "title", "display_name", "language", "publication_year", "type",
        F.coalesce(F.size("concepts"), F.lit(0)).cast("bigint").alias("n_concepts"),
        X.position_count(F.col("abstract_inverted_index")).cast("bigint").alias("n_positions"),
    ).withColumn("n_concepts", F.greatest("n_concepts", F.lit(0))).withColumn(
        "n_positions", F.when(F.col("n_positions") >= 0, F.col("n_positions"))
    )


@query("bad_lines", """
    SELECT '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS updated_date, count(*) AS n_bad
    FROM documents WHERE doc_id % 17 IN (3, 4, 5, 7) GROUP BY 1""")
def bad_lines(spark, sf):
    found = snapshot.bad_lines(snapshot.read_lines(spark, D.snapshot_root(spark, sf)))
    day = snapshot.updated_date(F.col("part")).cast("string").alias("updated_date")
    return found.groupBy(day).agg(F.sum("n_bad").alias("n_bad"))


@query("scan_by_updated_date", f"""
    WITH {D.SQL_WORKS} SELECT updated_date, count(*) AS n, max(id) AS last_id FROM w
    WHERE updated_date BETWEEN '2024-01-10' AND '2024-01-20' GROUP BY updated_date""")
def scan_by_updated_date(spark, sf):
    works = snapshot.read_works_since(spark, D.snapshot_root(spark, sf), "2024-01-10", "2024-01-20")
    return works.groupBy(F.col("updated_date").cast("string").alias("updated_date")).agg(
        F.count("*").alias("n"), F.max("id").alias("last_id")
    )


@query("works_for_part", f"""
    WITH {D.SQL_WORKS} SELECT id, title, abstract FROM w WHERE in_corpus AND updated_date = '2024-01-05'""")
def works_for_part(spark, sf):
    path = f"{D.snapshot_root(spark, sf)}/updated_date=2024-01-05"
    works = snapshot.read_works(spark, path, concept_id=X.DEFAULT_CONCEPT)
    return snapshot.map_works(works).select("id", "title", "abstract")


@query("works_by_part", f"""
    WITH {D.SQL_WORKS} SELECT updated_date, count(*) AS n, CAST(sum(length(abstract)) AS BIGINT) AS n_chars
    FROM w WHERE in_corpus GROUP BY updated_date""")
def works_by_part(spark, sf):
    root = D.snapshot_root(spark, sf)
    works = snapshot.map_works(snapshot.read_works(spark, root, concept_id=X.DEFAULT_CONCEPT))
    return works.groupBy(snapshot.updated_date(F.col("part")).cast("string").alias("updated_date")).agg(
        F.count("*").alias("n"), F.sum(F.length("abstract")).alias("n_chars")
    )


def corpus_works(spark, sf):
    return D.works(spark, sf).where(X.has_concept(F.col("concepts")))


@query("part_done", f"""
    WITH {D.SQL_WORKS}
    SELECT part, id, doc_id = max(doc_id) OVER (PARTITION BY part) AS part_done, false AS sentinel
    FROM w WHERE in_corpus
    UNION ALL
    SELECT part, NULL, true, true FROM w GROUP BY part HAVING NOT bool_or(in_corpus)""")
def part_done(spark, sf):
    works = corpus_works(spark, sf).select("part", "id", "doc_id")
    return P.mark_part_ends(D.parts(spark, sf), works, "doc_id").select(
        "part", "id", "part_done", "sentinel"
    )


@query("part_counts", f"""
    WITH {D.SQL_WORKS} SELECT part, count(*) FILTER (in_corpus) AS n FROM w GROUP BY part""")
def part_counts(spark, sf):
    return P.part_counts(D.parts(spark, sf), corpus_works(spark, sf)).select("part", "n")


# Parts of even position are on record as done.
SQL_PARTS = f"""
p AS (SELECT part, row_number() OVER (ORDER BY part) - 1 AS pos
      FROM (SELECT DISTINCT {D.SQL_PART} AS part FROM documents))"""


def _done_parts(spark, sf):
    return D.parts(spark, sf).where(F.col("pos") % 2 == 0)


@query("parts_todo", f"WITH {SQL_PARTS} SELECT pos, part FROM p WHERE pos % 2 = 1")
def parts_todo(spark, sf):
    todo = ledger.not_done(D.parts(spark, sf), _done_parts(spark, sf), "part")
    return todo.select(F.col("pos").cast("bigint").alias("pos"), "part")


@query("run_counts", f"""
    WITH {SQL_PARTS} SELECT count(*) AS n_total, count(*) FILTER (pos % 2 = 1) AS n_todo,
    count(*) FILTER (pos % 2 = 0) AS n_done FROM p""")
def run_counts(spark, sf):
    return P.run_counts(D.parts(spark, sf), _done_parts(spark, sf))


@query("completed_parts", f"""
    WITH {SQL_PARTS} SELECT part, CASE WHEN pos % 2 = 0 THEN 0 ELSE 1 END AS batch_id FROM p""")
def completed_parts(spark, sf):
    """Two batches committed, the second one twice as after a crash."""
    path = new_run_dir(spark, "ledger")
    all_parts, done = D.parts(spark, sf), _done_parts(spark, sf)
    ledger.commit_parts(done, path, 0)
    for _ in range(2):
        todo = ledger.not_done(all_parts, ledger.read_completed(spark, path).where("batch_id = 0"), "part")
        ledger.commit_parts(todo, path, 1)
    return ledger.read_completed(spark, path).select("part", F.col("batch_id").cast("int")).distinct()


@query("ledger_union", f"WITH {SQL_PARTS} SELECT part FROM p WHERE pos % 2 = 0 OR pos % 3 = 0")
def ledger_union(spark, sf):
    listed = D.parts(spark, sf)
    return ledger.ledger_union(_done_parts(spark, sf), listed.where(F.col("pos") % 3 == 0), "part")


def _counts(spark, sf):
    return P.part_counts(D.parts(spark, sf), corpus_works(spark, sf))


SHARD_SIZE = 100


@query("shard_plan", f"""
    WITH RECURSIVE {D.SQL_WORKS},
    n AS (SELECT part, count(*) FILTER (in_corpus) AS n, row_number() OVER (ORDER BY part) - 1 AS pos
          FROM w GROUP BY part),
    walk AS (
      SELECT pos, part, n, CAST(0 AS BIGINT) AS shard_idx,
             CASE WHEN n >= {SHARD_SIZE} THEN 0 ELSE n END AS filled, n >= {SHARD_SIZE} AS closed
      FROM n WHERE pos = 0
      UNION ALL
      SELECT n.pos, n.part, n.n, walk.shard_idx + CASE WHEN walk.closed THEN 1 ELSE 0 END,
             CASE WHEN walk.filled + n.n >= {SHARD_SIZE} THEN 0 ELSE walk.filled + n.n END,
             walk.filled + n.n >= {SHARD_SIZE}
      FROM walk JOIN n ON n.pos = walk.pos + 1)
    SELECT part, n, shard_idx,
           'corpus_' || lpad(shard_idx::VARCHAR, 6, '0') || '.parquet' AS shard FROM walk""")
def shard_plan(spark, sf):
    planned = P.plan_shards(_counts(spark, sf), SHARD_SIZE)
    return planned.select(
        "part", "n", F.col("shard_idx").cast("bigint").alias("shard_idx"),
        shards.shard_name(F.col("shard_idx"), "corpus").alias("shard"),
    )


@query("limit_soft", f"""
    WITH {D.SQL_WORKS}, n AS (SELECT part, count(*) FILTER (in_corpus) AS n FROM w GROUP BY part),
    b AS (SELECT *, sum(n) OVER (ORDER BY part) - n AS before FROM n)
    SELECT part, n FROM b WHERE before < {SHARD_SIZE}""")
def limit_soft(spark, sf):
    return P.soft_limit(_counts(spark, sf), SHARD_SIZE).select("part", "n")


@query("limit_hard", f"""
    WITH {D.SQL_WORKS} SELECT id, part FROM w WHERE in_corpus ORDER BY part, doc_id LIMIT {SHARD_SIZE}""")
def limit_hard(spark, sf):
    """The first rows of files that hold the works by part and document."""

    def write(path):
        works = corpus_works(spark, sf).select("part", "doc_id", "id")
        works.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id").write.option("maxRecordsPerFile", 40).parquet(path)

    path = staged(spark, sf, "ordered-works", write)
    return file_order.first_rows(spark, path, "part string, doc_id bigint, id string", ["id", "part"], SHARD_SIZE)


@query("observed_counts", f"""
    WITH {D.SQL_WORKS} SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars
    FROM t WHERE in_corpus AND text IS NOT NULL""")
def observed_counts(spark, sf):
    """Counts taken on the side while the rows are written."""
    rows = snapshot.with_text(snapshot.map_works(D.works(spark, sf)))
    seen_rows, seen = observed(rows)
    seen_rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get], "n_rows bigint, n_chars bigint")
