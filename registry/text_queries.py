"""Projections, filters and text functions over works."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.plans import search_job
from quire.sources import snapshot
from registry import derive as D
from registry.base import query, table
from registry.snapshot_queries import corpus_works

WITH = f"WITH {D.SQL_WORKS}"
INDEX = "abstract_inverted_index"


@query("concept_filter", f"{WITH} SELECT id, part FROM w WHERE in_corpus")
def concept_filter(spark, sf):
    return corpus_works(spark, sf).select("id", "part")


@query("concept_filter_param", f"{WITH} SELECT id FROM w WHERE doc_id % 4 = 0")
def concept_filter_param(spark, sf):
    return D.works(spark, sf).where(X.has_concept(F.col("concepts"), "C777")).select("id")


@query("map_work", f"""{WITH} SELECT part, id, doi, title, language, publication_year, type, abstract FROM w""")
def map_work(spark, sf):
    raw = D.works(spark, sf).select("part", *[c for c in D.schemas.RAW_WORK.names])
    return snapshot.map_works(raw, concept_id=None)


@query("title_fallback", f"{WITH} SELECT id, title FROM w")
def title_fallback(spark, sf):
    return D.works(spark, sf).select(
        "id", X.work_title(F.col("title"), F.col("display_name")).alias("title")
    )


@query("reconstruct_abstract", f"{WITH} SELECT id, abstract FROM w")
def reconstruct_abstract(spark, sf):
    return D.works(spark, sf).select("id", X.reconstruct_abstract(F.col(INDEX)).alias("abstract"))


@query("abstract_stats", f"""{WITH} SELECT w.id,
    CAST((len(string_split(d.text, ' ')) - 1) * CASE WHEN w.doc_id % 7 = 2 THEN 2 ELSE 1 END AS BIGINT) AS max_position,
    CAST(n_positions AS BIGINT) AS n_positions
    FROM w JOIN documents d USING (doc_id) WHERE w.doc_id % 11 <> 0""")
def abstract_stats(spark, sf):
    index = F.col(INDEX)
    return D.works(spark, sf).where(index.isNotNull()).select(
        "id",
        X.max_position(index).cast("bigint").alias("max_position"),
        X.position_count(index).cast("bigint").alias("n_positions"),
    )


@query("slot_last_wins", f"""
    SELECT doc_id, CAST(p * CASE WHEN doc_id % 7 = 2 THEN 2 ELSE 1 END AS BIGINT) AS p,
           CASE WHEN p = 0 AND doc_id % 13 = 5 THEN '¤' ELSE token END AS token
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token,
                 generate_subscripts(string_split(text, ' '), 1) - 1 AS p
          FROM documents WHERE doc_id % 11 <> 0)""")
def slot_last_wins(spark, sf):
    """Each position with the token that holds it, found within the row: nothing is shuffled."""
    slots = D.works(spark, sf).select("doc_id", F.explode(X.slot_tokens(INDEX)).alias("s"))
    return slots.select("doc_id", "s.p", "s.token")


def _texts(mode, column):
    @query(f"build_text_{mode.replace('title_abstract', 'both')}", f"{WITH} SELECT id, {column} AS text FROM t")
    def build(spark, sf):
        mapped = snapshot.map_works(D.works(spark, sf), concept_id=None)
        return mapped.select("id", X.build_text(F.col("title"), F.col("abstract"), mode).alias("text"))

    return build


build_text_title = _texts("title", "text_title")
build_text_abstract = _texts("abstract", "abstract")
build_text_both = _texts("title_abstract", "text")


@query("drop_no_text", f"{WITH} SELECT id, abstract AS text FROM t WHERE abstract IS NOT NULL")
def drop_no_text(spark, sf):
    mapped = snapshot.map_works(D.works(spark, sf), concept_id=None)
    return snapshot.with_text(mapped, "abstract").select("id", "text")


@query("keep_no_text", f"{WITH} SELECT id, coalesce(abstract, '') AS text FROM t")
def keep_no_text(spark, sf):
    mapped = snapshot.map_works(D.works(spark, sf), concept_id=None)
    return snapshot.with_text(mapped, "abstract", skip_no_text=False).select("id", "text")


@query("short_work_id", """
    SELECT page_id, doc, CASE WHEN page_id % 3 = 0 THEN 'W' || page_id END AS short_id
    FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || '/W' || page_id
                 WHEN 1 THEN url || '/xW' || page_id ELSE '' END AS doc FROM pages)""")
def short_work_id(spark, sf):
    p, url = F.col("page_id"), F.col("url")
    doc = (
        F.when(p % 3 == 0, F.concat(url, F.lit("/W"), p.cast("string")))
        .when(p % 3 == 1, F.concat(url, F.lit("/xW"), p.cast("string")))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "pages").select("page_id", doc.alias("doc")).withColumn(
        "short_id", X.short_work_id(F.col("doc"))
    )


@query("best_url", f"{WITH} SELECT id, url FROM w")
def best_url(spark, sf):
    return D.works(spark, sf).select("id", X.best_url().alias("url"))


def search_queries(spark, sf):
    """The benchmark texts as queries: some padded, some blank, with all kinds of ``k``."""
    i = F.col("item_id")
    return table(spark, sf, "benchmark").select(
        i.alias("query_id"),
        F.when(i % 5 == 0, F.concat(F.lit("  "), "text", F.lit(" \n")))
        .when(i % 5 == 1, F.lit(" \t "))
        .otherwise(F.col("text"))
        .alias("query"),
        F.when(i % 4 == 1, 0).when(i % 4 == 2, 50).when(i % 4 == 3, 500).cast("int").alias("k"),
    )


SQL_QUERIES = f"""
queries AS (
  SELECT item_id AS query_id, regexp_replace(text, '^{D.SQL_WS}+|{D.SQL_WS}+$', '', 'g') AS query,
         CAST(CASE item_id % 4 WHEN 0 THEN 50 WHEN 1 THEN 1 WHEN 2 THEN 50 ELSE 200 END AS INTEGER) AS k
  FROM benchmark WHERE item_id % 5 <> 1
)"""


@query("valid_queries", f"WITH {SQL_QUERIES} SELECT query_id, query, k FROM queries")
def valid_queries(spark, sf):
    return search_job.valid_queries(search_queries(spark, sf))


@query("rejected_queries", "SELECT item_id AS query_id FROM benchmark WHERE item_id % 5 = 1")
def rejected_queries(spark, sf):
    return search_job.rejected_queries(search_queries(spark, sf)).select("query_id")
