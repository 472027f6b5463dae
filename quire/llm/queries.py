"""Queries over the corpus tables, one per operator, and the SQL some of them agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.collocations import collocations
from quire.llm.decontaminate import find_items
from quire.llm.embedding_dedup import embedding_dedup
from quire.llm.hmm_lm import hmm_scores
from quire.llm.html_text import extract_text
from quire.llm.minhash_dedup import minhash_dedup
from quire.llm.mixing import select_mix
from quire.llm.mixing_sql import mixture_sql
from quire.llm.oracles import PHRASES, SHINGLES, SUBSTRINGS, VECTORS
from quire.llm.periodic_runs import periodic_runs
from quire.llm.secret_scan import KINDS, find_secrets, listed
from quire.llm.substring_dedup import substring_dedup
from quire.llm.suffix_dedup import suffix_dedup
from quire.llm.token_files import read_tokens, write_tokens
from quire.llm.toxicity import score_documents, train
from quire.operators.columns import with_once
from quire.session import new_run_dir
from registry.base import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Sources by number make three domains; the weights are in parts of a hundred.
DOMAIN = "concat('d', CAST(coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS int), 0) % 3 AS string))"
WEIGHTS = {"d0": 50, "d1": 30, "d2": 20} | {f"d{i}/{lang}": w for i in range(3) for lang, w in (("en", 55), ("de", 20), ("fr", 15), ("es", 10))}
MIX = {"share": (6, 10), "max_epochs": 2, "seed": "mix"}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_substring_dedup", SUBSTRINGS)
def op1(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op2_decontaminate")
def op2(spark, sf_dir):
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = train(docs, table(spark, sf_dir, "labels").where(remainder != 1))
    return score_documents(docs, model).select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op4_hmm_lm")
def op4(spark, sf_dir):
    return hmm_scores(table(spark, sf_dir, "documents"))


@query("op5_token_files")
def op5(spark, sf_dir):
    path = new_run_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return read_tokens(spark, path)


@query("op6_html_text")
def op6(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@query("op7_embedding_dedup", VECTORS)
def op7(spark, sf_dir):
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


@query("op8_minhash_dedup", SHINGLES)
def op8(spark, sf_dir):
    return minhash_dedup(table(spark, sf_dir, "documents"), width=4)


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op10_mixing",
    mixture_sql(WEIGHTS, "'d' || CAST(coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS INT), 0) % 3 AS VARCHAR)", **MIX),
)
def op10(spark, sf_dir):
    return select_mix(table(spark, sf_dir, "documents"), WEIGHTS, F.expr(DOMAIN), **MIX)


@query("op11_secret_scan")
def op11(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    counts = (F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS)
    return found.select("doc_id", *counts, F.sha2(listed("spans", KINDS[:3]), 256).alias("base_sha256"), listed("spans").alias("spans"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, one in ten (by its id) with the rest of its words from some place on repeating."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"), F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) div 10").alias("g"))
    words = with_once(chosen, "words", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))))
    sized = words.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    placed = sized.withColumn("a", F.expr("CAST(g % greatest(n, 1) AS INT)")).withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("CAST((n - a + p - 1) div p AS INT)")))
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), F.col("n").cast("int"))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    better = lambda x, y: (  # noqa: E731  by length / period exactly, then start, then period
        F.when(x["length"] * y["period"] != y["length"] * x["period"], F.signum(y["length"] * x["period"] - x["length"] * y["period"]).cast("int"))
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int"))
        .otherwise(F.signum(x["period"] - y["period"]).cast("int"))
    )
    best = F.get(F.array_sort("runs", better), F.lit(0))
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", best.alias("best")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_collocations", PHRASES)
def op13(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
