"""What a task holds must not grow with the batches of a table."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quire.operators.embedding import by_bytes, embed
from registry import derive


def test_by_bytes():
    batch = pa.record_batch({"id": [1, 2, 3, 4, 5], "text": ["ab", "cd", None, "x" * 9, ""]})
    assert [p.column(0).to_pylist() for p in by_bytes(batch, "text", 4)] == [[1, 2, 3], [4], [5]]
    assert list(by_bytes(batch.slice(0, 0), "text", 4)) == []


def test_index_is_made_of_few_texts_at_a_time(spark):
    """Rows leave by about a megabyte of text, however large the batches of the table are."""
    docs = spark.range(0, 64, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 50_000).alias("text"))
    made = _batches_of(derive._with_index, docs)
    assert sum(made) == 64 and max(made) <= 4


class _Held:
    """A frame that hands its function of Arrow batches back."""

    def __init__(self, docs):
        self.schema = docs.schema

    def mapInArrow(self, run, schema):
        return run


def _batches_of(make, docs):
    """Rows in each batch that is made of the whole of ``docs`` as one batch."""
    whole = docs.toArrow().combine_chunks().to_batches()[0]
    return [b.num_rows for b in make(_Held(docs))(iter([whole]))]


def test_embed_gives_the_vectors_of_one_call_at_a_time(spark):
    docs = spark.range(0, 200, 1, 1).select("id", F.col("id").cast("string").alias("text"))

    def made(df):
        return embed(df, lambda texts: np.array([[float(t)] for t in texts]), batch_size=64)

    assert _batches_of(made, docs) == [64, 64, 64, 8]
    assert [(r["id"], r["embedding"]) for r in made(docs).collect()] == [(i, [float(i)]) for i in range(200)]


def test_snapshot_is_written_without_a_shuffle_of_its_own(spark, tmp_path, monkeypatch):
    docs = spark.range(1, 57).selectExpr("id AS doc_id", "concat('some words ', id) AS text", "'en' AS lang", "'web' AS source")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = derive.works(spark, str(tmp_path))
    before = spark.conf.get(derive.OPEN_FILES)

    def refused(*_):
        raise AssertionError("whole works are shuffled")

    monkeypatch.setattr(type(rows), "repartitionByRange", refused)
    monkeypatch.setattr(type(rows), "repartition", refused)
    derive._write_snapshot(spark, str(tmp_path), f"{tmp_path}/snapshot")
    assert spark.conf.get(derive.OPEN_FILES) == before
    lines = spark.read.text(f"{tmp_path}/snapshot").where("value LIKE '{%}'")
    assert lines.count() == 56 and lines.select("updated_date").distinct().count() == 28
