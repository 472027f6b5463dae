"""Work records, snapshot files and vector tables derived from the test tables by Spark.

Every column is plain arithmetic on ``doc_id`` or ``vec_id``, so SQL can repeat it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import schemas
from quire.functions import text as X
from quire.operators.embedding import by_bytes
from quire.operators.quantiser import Quantiser, model_matrix
from quire.sources import shards
from registry.base import staged, table

BASE = "https://works.example.org/"
BUCKET = "s3://corpus-bucket/"


def _when(*cases):
    """``coalesce`` of conditional values, null when none applies."""
    return F.coalesce(*[F.when(condition, value) for condition, value in cases])


INDEX_TYPE = pa.map_(pa.string(), pa.list_(pa.int32()))
#: Text indexed at a time: an index takes many times its text in lists and numbers of Python.
INDEXED_BYTES = 1 << 20
#: Files a writing task may have open at a time; beyond them it sorts.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _with_index(docs: DataFrame) -> DataFrame:
    """``docs`` with the inverted index of ``text``, made where the rows lie.

    Every seventh document has gaps between its positions; in every thirteenth a late
    token takes position 0 from the first one; every eleventh has no index.
    """

    def entries(doc_id, text):
        if doc_id % 11 == 0:
            return None
        step = 2 if doc_id % 7 == 2 else 1
        places: dict[str, list[int]] = {}
        for p, token in enumerate(text.split(" ")):
            places.setdefault(token, []).append(p * step)
        if doc_id % 13 == 5:
            places["¤"] = [0]
        return list(places.items())

    def run(batches):
        for whole in batches:
            for batch in by_bytes(whole, "text", INDEXED_BYTES):
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                index = pa.array([entries(i, t) for i, t in zip(ids, texts)], type=INDEX_TYPE)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, index], names=[*batch.schema.names, "abstract_inverted_index"]
                )

    field = T.StructField("abstract_inverted_index", schemas.INVERTED_INDEX)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, field]))


def _write_works(spark: SparkSession, sf_dir: str, path: str) -> None:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = F.col("doc_id")
    ident = F.concat(F.lit(BASE + "W"), d.cast("string"))

    def concept(url, name):
        return F.struct(F.lit(url).alias("id"), F.lit(name).alias("display_name"))

    def link(value):
        return F.concat(F.lit(value), d.cast("string"))

    day = F.format_string("2024-01-%02d", (d % 28 + 1).cast("int"))
    # Ranged by date and document while the rows are narrow: what is made from the works needs no shuffle of its own.
    works = _with_index(docs.repartitionByRange(day, "doc_id")).select(
        "doc_id",
        "abstract_inverted_index",
        ident.alias("id"),
        F.when(d % 3 != 0, link("https://doi.org/10.1/")).alias("doi"),
        _when(
            (d % 10 == 0, F.lit("")),
            (d % 10 > 1, F.array_join(F.slice(F.split("text", " "), 1, 8), " ")),
        ).alias("title"),
        F.when(d % 20 != 1, link("Doc ")).alias("display_name"),
        F.col("lang").alias("language"),
        (d % 35 + 1990).cast("int").alias("publication_year"),
        F.col("source").alias("type"),
        _when(
            (d % 4 == 0, F.array(concept(BASE + X.DEFAULT_CONCEPT, "A"), concept(BASE + "C777", "B"))),
            (d % 4 == 1, F.array(concept(X.DEFAULT_CONCEPT, "A"))),
            (d % 4 == 2, F.array(concept(BASE + "C778", "C"))),
        ).alias("concepts"),
        F.struct(
            F.when(d % 3 == 1, link("https://landing.example.org/")).alias("landing_page_url")
        ).alias("primary_location"),
        F.when(
            d % 5 != 4,
            F.struct(
                _when((d % 4 == 0, link("https://oa.example.org/")), (d % 4 == 1, F.lit(""))).alias(
                    "landing_page_url"
                ),
                F.when(d % 4 == 1, link("https://pdf.example.org/")).alias("pdf_url"),
            ),
        ).alias("best_oa_location"),
        F.struct(
            _when((d % 5 == 0, link("https://open.example.org/")), (d % 5 == 1, F.lit(""))).alias("oa_url")
        ).alias("open_access"),
        F.concat(F.lit(BUCKET + "data/works/updated_date="), day, F.lit("/part_000.gz")).alias("part"),
        day.alias("updated_date"),
    )
    works.write.parquet(path)


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw works with ``doc_id``, ``part`` and the fields hits are joined back to."""
    path = staged(spark, sf_dir, "works", lambda p: _write_works(spark, sf_dir, p))
    return spark.read.parquet(path)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pos, part)``: the parts the documents lie in, in manifest order (one row per file)."""
    listed = works(spark, sf_dir).select("part").distinct()
    return listed.agg(F.sort_array(F.collect_list("part")).alias("p")).select(
        F.posexplode("p").alias("pos", "part")
    )


def _write_snapshot(spark: SparkSession, sf_dir: str, path: str) -> None:
    rows = works(spark, sf_dir)
    d = F.col("doc_id")
    record = F.to_json(F.struct(*schemas.RAW_WORK.names))
    junk = _when(
        (d % 17 == 3, F.lit("not json")),
        (d % 17 == 4, F.substring(record, 1, 20)),
        (d % 17 == 5, F.lit('[{"id": "listed"}]')),
        (d % 17 == 6, F.lit(" \t ")),
        (d % 17 == 7, F.lit("123")),
    )
    # Works lie by date and document, so a task meets few dates, and a date that has most rows lies in many files.
    # One open file for each date of a task takes the place of a sort of all its lines.
    lines = rows.select("updated_date", F.explode(F.array_compact(F.array(record, junk))).alias("value"))
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, "64")
    try:
        lines.write.partitionBy("updated_date").option("compression", "gzip").text(path)
    finally:
        spark.conf.set(OPEN_FILES, before)


def snapshot_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of gzip JSON-Lines parts below ``updated_date=``, with some broken lines."""
    return staged(spark, sf_dir, "snapshot", lambda p: _write_snapshot(spark, sf_dir, p))


def _write_manifest(spark: SparkSession, sf_dir: str, path: str) -> None:
    urls = parts(spark, sf_dir).select(F.col("part").alias("url"))
    odd = urls.limit(1).select(F.explode(F.array(F.lit(""), F.lit(None).cast("string"))).alias("url"))
    entries = urls.unionByName(odd).agg(
        F.sort_array(F.collect_list(F.struct("url"))).alias("entries")
    )
    entries.select(F.to_json(F.struct("entries")).alias("value")).write.text(path)


def manifest_path(spark: SparkSession, sf_dir: str) -> str:
    """Manifest document of the parts, with an entry without URL and one with an empty one."""
    return staged(spark, sf_dir, "manifest", lambda p: _write_manifest(spark, sf_dir, p))


# --------------------------------------------------------------------------- vectors
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, vec_id, embedding, label, shard)``: every vector, in one of four shards."""
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit(BASE + "W"), v.cast("string")).alias("id"),
        "vec_id",
        "embedding",
        "label",
        F.format_string("corpus_%06d.parquet", (v % 4).cast("int")).alias("shard"),
    )


def _write_in_order(spark: SparkSession, sf_dir: str, path: str) -> None:
    order = (F.col("vec_id") % 4, F.desc("vec_id"))
    rows = vectors(spark, sf_dir).repartitionByRange(4, *order).sortWithinPartitions(*order)
    shards.write_shards(as_shard_rows(rows), path, rows_per_file=100)


def ordered_shards(spark: SparkSession, sf_dir: str) -> str:
    """Shards whose rows lie, file by file, in the order of vec_id modulo 4, then of falling vec_id."""
    return staged(spark, sf_dir, "ordered-shards", lambda p: _write_in_order(spark, sf_dir, p))


def as_shard_rows(rows: DataFrame) -> DataFrame:
    """Vectors as embedded works without any other field."""
    missing = [F.lit(None).cast("string").alias(c) for c in ("doi", "title", "language")]
    return rows.select(
        "id", *missing, F.lit(None).cast("int").alias("publication_year"), F.lit(None).cast("string").alias("type"),
        F.lit("").alias("text"), "embedding",
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select(F.col("vec_id").alias("id"), "embedding")


def all_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a query."""
    return vectors(spark, sf_dir).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cell, centroid)``: mean vector of each label, rounded so that both engines agree."""
    values = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("d", "x"))
    means = values.groupBy("label", "d").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    return means.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("d", "x"))).alias("xs")
    ).select(F.col("label").cast("int").alias("cell"), F.col("xs.x").alias("centroid"))


def quantiser(spark: SparkSession, sf_dir: str, *, metric="ip", pq_m=0, by_residual=False) -> Quantiser:
    """The label means as centroids, and their ``pq_m`` slices as code books."""
    centroids = model_matrix(label_means(spark, sf_dir), ["cell"], "centroid")
    books = None
    if pq_m:
        books = centroids.reshape(len(centroids), pq_m, -1).transpose(1, 0, 2).copy()
    return Quantiser(centroids, metric, books, by_residual)


# --------------------------------------------------------------------------- SQL
#: White space of the corpus, for RE2.
SQL_WS = (
    r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
SQL_PART = (
    f"'{BUCKET}data/works/updated_date=2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || '/part_000.gz'"
)

#: Works as a common table expression over ``documents``.
SQL_WORKS = f"""
w AS (
  SELECT doc_id, '{BASE}W' || doc_id AS id,
         CASE WHEN doc_id % 3 <> 0 THEN 'https://doi.org/10.1/' || doc_id END AS doi,
         CASE WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 10 > 1
              THEN array_to_string(list_slice(string_split(text, ' '), 1, 8), ' ') END AS raw_title,
         CASE WHEN doc_id % 20 <> 1 THEN 'Doc ' || doc_id END AS display_name,
         lang AS language, CAST(1990 + doc_id % 35 AS INTEGER) AS publication_year, source AS type,
         doc_id % 4 IN (0, 1) AS in_corpus, {SQL_PART} AS part,
         '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS updated_date,
         CASE WHEN doc_id % 10 = 0 OR doc_id % 10 = 1
              THEN CASE WHEN doc_id % 20 <> 1 THEN 'Doc ' || doc_id END
              ELSE nullif(array_to_string(list_slice(string_split(text, ' '), 1, 8), ' '), '') END AS title,
         CASE WHEN doc_id % 11 <> 0 THEN len(string_split(text, ' ')) + CASE WHEN doc_id % 13 = 5 THEN 1 ELSE 0 END
              END AS n_positions,
         CASE WHEN doc_id % 11 <> 0 THEN nullif(trim(regexp_replace(
              CASE WHEN doc_id % 13 = 5 THEN '¤' || substr(text, length(string_split(text, ' ')[1]) + 1)
                   ELSE text END, '{SQL_WS}+', ' ', 'g')), '') END AS abstract,
         CASE WHEN doc_id % 5 = 0 THEN 'https://open.example.org/' || doc_id
              WHEN doc_id % 5 <> 4 AND doc_id % 4 = 0 THEN 'https://oa.example.org/' || doc_id
              WHEN doc_id % 5 <> 4 AND doc_id % 4 = 1 THEN 'https://pdf.example.org/' || doc_id
              WHEN doc_id % 3 = 1 THEN 'https://landing.example.org/' || doc_id
              WHEN doc_id % 3 <> 0 THEN 'https://doi.org/10.1/' || doc_id
              ELSE '{BASE}W' || doc_id END AS url
  FROM documents
),
c AS (
  SELECT *, nullif(regexp_replace(title, '^{SQL_WS}+|{SQL_WS}+$', '', 'g'), '') AS text_title FROM w
),
t AS (
  SELECT *, CASE WHEN text_title IS NOT NULL AND abstract IS NOT NULL
                 THEN text_title || chr(10) || chr(10) || abstract
                 ELSE coalesce(text_title, abstract) END AS text
  FROM c
)"""

#: Label means ``cent(cell, v)`` and vectors ``e(vec_id, id, v, label, shard)`` in double.
SQL_VECTORS = f"""
e AS (
  SELECT vec_id, '{BASE}W' || vec_id AS id, embedding::DOUBLE[] AS v, label,
         'corpus_' || lpad((vec_id % 4)::VARCHAR, 6, '0') || '.parquet' AS shard
  FROM embeddings
),
means AS (
  SELECT label, d, round(avg(x), 6) AS x
  FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM e) GROUP BY label, d
),
cent AS (SELECT label AS cell, list(x ORDER BY d) AS v FROM means GROUP BY label)"""


def sql_dot(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def sql_l2(a: str, b: str) -> str:
    """Squared Euclidean distance."""
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def sql_hits(metric: str, pairs: str, k: int) -> str:
    """``hits`` from ``pairs(query_id, id, score)``."""
    way = "DESC" if metric == "ip" else "ASC"
    return f"""
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {way}, id) AS rank
                 FROM ({pairs})) WHERE rank <= {k}
)"""


def sql_exact(metric: str, k: int) -> str:
    score = sql_dot("q.v", "e.v") if metric == "ip" else sql_l2("q.v", "e.v")
    return sql_hits(
        metric, f"SELECT q.vec_id AS query_id, e.vec_id AS id, {score} AS score FROM e AS q, e", k
    )


def sql_cells(metric: str) -> str:
    """``assigned(vec_id, cell)`` and ``ranked(vec_id, cell, cell_score, r)`` over all cells."""
    score = sql_dot("e.v", "cent.v") if metric == "ip" else sql_l2("e.v", "cent.v")
    way = "DESC" if metric == "ip" else "ASC"
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cell_score {way}, cell) AS r
  FROM (SELECT e.vec_id, cent.cell, {score} AS cell_score FROM e, cent)
),
assigned AS (SELECT vec_id, cell FROM ranked WHERE r = 1)"""
