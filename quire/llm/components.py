"""Connected components of a link table: parents are raised to theirs, and a node's parents linked, in turns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.session import new_run_dir

#: Links that a task joins at once.
AT_ONCE = 1 << 17


def local_roots(pairs) -> dict:
    """Smallest member of each node's component, for (a, b) pairs that fit in memory."""
    parent: dict = {}

    def find(x):
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def _thin(links: DataFrame) -> DataFrame:
    """Replace some links at a time by one from every node to its smallest reachable one.

    No more links than before come out. Links next to each other with the same first end are taken together.
    """

    def forest(pairs):
        rows = [(a, b) for a, b in local_roots(pairs).items() if a != b]
        return pa.record_batch([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64())], names=["a", "b"])

    def thin(batches):
        held: list = []
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            if len(held) >= AT_ONCE:
                cut = next((i for i, x in enumerate(pairs) if x[0] != held[-1][0]), len(pairs))
                held += pairs[:cut]
                pairs = pairs[cut:]
                if pairs:
                    yield forest(held)
                    held = []
            held += pairs
        yield forest(held)

    return links.mapInArrow(thin, "a long, b long")


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it reaches.

    Null ends and links from a node to itself are ignored. Each round is written to the shared
    folder. Only sums come to the driver. Each task joins its own links before the first round.

    A round takes three shuffles. Every link leads from a node to a smaller one, its parent. First each
    parent gives way to its own least parent; then all links of a node meet in one task, where its
    parents are linked with the least. Either step lowers the number of links, or else the sum of
    their ends, unless every node has one parent that has none: so equal sums end the rounds.
    """
    spark = links.sparkSession

    def written(df):
        """The links, and how many there are with the sum of their ends."""
        path, sums = new_run_dir(spark, "links"), Observation()
        ends = F.col("a").cast("decimal(20,0)") + F.col("b").cast("decimal(20,0)")
        df.observe(sums, F.count("*").alias("n"), F.sum(ends).alias("ends")).write.parquet(path)
        return spark.read.schema("a long, b long").parquet(path), sums.get

    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    stars, before = written(_thin(links))
    if not before["n"]:
        return _with_roots(stars)
    for _ in range(most_rounds):
        above = stars.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("least"))
        raised = stars.join(above, "b", "left").select("a", F.coalesce("least", "b").alias("b"))
        stars, now = written(_thin(raised.repartition("a").sortWithinPartitions("a")))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return _with_roots(stars)


def _with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
