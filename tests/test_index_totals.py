"""Totals of an index, by the shards its vectors are named for."""

import __spark_entry__ as entry


def write_vectors(spark, path, ids):
    rows = [(i, [float((i * 7 + d * d) % 11 - 5) for d in range(8)], i % 10) for i in ids]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_index_totals_names_the_shards(spark, tmp_path):
    sf = write_vectors(spark, tmp_path, [i for i in range(300) if i % 4 != 3])
    (row,) = entry.queries()["index_totals"](spark, sf).collect()
    assert (row["n_vectors"], row["shard_count"], row["added_shards"]) == (225, 3, "corpus_000002.parquet")
    assert row["n_in_ledger"] == 225 and row["added_vectors"] == 75 and row["shards_agree"] and row["added_agree"]
