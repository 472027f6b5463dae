"""The corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.decontaminate import drop_contaminated
from quire.llm.minhash_dedup import minhash_dedup
from quire.llm.mixing import keep_mix
from quire.llm.token_files import read_tokens, write_tokens
from quire.llm.toxicity import drop_toxic, train
from quire.session import new_run_dir
from registry.base import ship_package, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Shares of the languages, in parts of a hundred; the sources of a language share alike.
WEIGHTS = {f"web/{lang}": share for lang, share in (("en", 55), ("de", 20), ("fr", 15), ("es", 10))}
#: The mixture holds so much of the tokens that are left.
SHARE = (8, 10)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that models learnt from all labels of these documents reject."""
    ship_package(spark)
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group, of the smallest id; rows with equal or null ids are judged by text too."""
    ship_package(spark)
    path = new_run_dir(spark, "numbered")
    row = "_row" + "_" * max(map(len, docs.columns))  # no column of the documents has this name
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    groups = minhash_dedup(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    stay = groups.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min_by(row, order).alias(row))
    return rows.join(stay.select(row), row, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of ``benchmark``."""
    ship_package(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each source and language what the target weights ask for, at most one epoch."""
    return keep_mix(docs, WEIGHTS, F.lit("web"), share=SHARE)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they say of each document."""
    ship_package(spark)
    path = new_run_dir(spark, "tokens")
    write_tokens(docs, path, TOKENIZER)
    return read_tokens(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: Near duplicates, models and tokens can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_run_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
