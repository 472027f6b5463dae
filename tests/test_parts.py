import random

from pyspark.sql import functions as F

from quire.operators import parts as P
from quire.operators.ordinals import head, with_batches, with_ordinal
from quire.sources import ledger


def frame(spark, counts):
    return spark.createDataFrame(
        [(i, f"p{i}", n) for i, n in enumerate(counts)], "pos int, part string, n bigint"
    )


def test_shards_close_at_part_boundaries(spark):
    rows = P.plan_shards(frame(spark, [10, 0, 20, 5, 40, 3]).repartition(4), 25).orderBy("pos").collect()
    assert [r["shard_idx"] for r in rows] == [0, 0, 0, 1, 1, 2]


def test_soft_limit_keeps_the_part_that_reaches_it(spark):
    counts = frame(spark, [10, 0, 20, 5, 40, 3])
    assert [r["pos"] for r in P.soft_limit(counts, 25).orderBy("pos").collect()] == [0, 1, 2]
    assert [r["pos"] for r in P.soft_limit(counts, 10).orderBy("pos").collect()] == [0]
    assert P.soft_limit(counts, 1000).count() == 6


def test_not_done_keeps_repeats(spark):
    parts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "c")], "pos int, part string")
    done = spark.createDataFrame([("b",), ("b",)], "part string")
    assert [r["pos"] for r in ledger.not_done(parts, done, "part").orderBy("pos").collect()] == [0, 2, 3]


def test_ledger_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "parts")
    assert ledger.read_completed(spark, path).count() == 0
    assert ledger.next_batch(ledger.read_completed(spark, path)) == 0
    parts = spark.createDataFrame([("a",), ("b",)], "part string")
    for _ in range(2):
        ledger.commit_parts(parts, path, 0)
    ledger.commit_parts(parts.where("part = 'b'"), path, 1)
    done = ledger.read_completed(spark, path)
    assert sorted((r["part"], r["batch_id"]) for r in done.collect()) == [("a", 0), ("b", 0), ("b", 1)]
    assert ledger.next_batch(done) == 2


def test_part_ends_and_sentinels(spark):
    parts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, part string")
    works = spark.createDataFrame([("a", 1), ("a", 5), ("a", 3), ("c", 9)], "part string, line bigint")
    rows = P.mark_part_ends(parts, works, "line").collect()
    assert sorted((r["part"], r["line"] or -1, r["part_done"], r["sentinel"]) for r in rows) == [
        ("a", 1, False, False), ("a", 3, False, False), ("a", 5, True, False),
        ("b", -1, True, True), ("c", 9, True, False),
    ]


def test_counts_include_zero(spark):
    parts = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, part string")
    works = spark.createDataFrame([("a",), ("a",)], "part string")
    assert {r["part"]: r["n"] for r in P.part_counts(parts, works).collect()} == {"a": 2, "b": 0}


def test_ordinals_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"s{rng.randint(0, 5)}", i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "shard string, i int").repartition(7)
    numbered = with_ordinal(df, "shard", "i").collect()
    assert [(r["shard"], r["i"]) for r in sorted(numbered, key=lambda r: r["ordinal"])] == sorted(rows)
    assert sorted(r["ordinal"] for r in numbered) == list(range(3000))
    first = head(df, 700, "shard", "i").collect()
    assert sorted((r["shard"], r["i"]) for r in first) == sorted(rows)[:700]
    sizes = with_batches(df, 64, "shard", "i").groupBy("batch_no").count().collect()
    assert sorted(r["count"] for r in sizes) == [3000 % 64] + [64] * (3000 // 64)


def test_run_counts(spark):
    parts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, part string")
    done = spark.createDataFrame([("a",), ("a",), ("gone",)], "part string")
    assert tuple(P.run_counts(parts, done).first()) == (3, 2, 1)
    assert ledger.ledger_union(done, parts.where(F.col("pos") > 0), "part").count() == 4
