"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the vectors by random directions again and again; those near a cut go to both sides.
Vectors that share a leaf of any tree are compared, a pair only in the first leaf it shares. The
trees are fitted on a bounded sample, every vector is put into their leaves. Equal vectors are
one node throughout. A leaf with many vectors is compared chunk against chunk, and of what is found
only each vector's number of links and a spanning set of links leave a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.session import new_run_dir


@dataclass
class Options:
    threshold: float = 0.9
    trees: int = 4
    #: Vectors of the whole table that a leaf should hold.
    leaf: int = 1024
    #: Share of a node's vectors on each side of a cut that go to the other side as well.
    spill: float = 0.08
    #: Vectors the trees are fitted on.
    sample: int = 65_536
    #: Vectors of a leaf that are compared with as many others in one task.
    chunk: int = 2048
    seed: int = 7


class Tree:
    """Cuts in depth-first order: (direction, low, high, left, right) or the number of a leaf."""

    def __init__(self, sample: np.ndarray, total: int, first_leaf: int, options: Options, rng: np.random.Generator):
        self.nodes: list = []
        self.leaves = first_leaf
        dimension = sample.shape[1]
        # half the spread, along a random direction, of two vectors just similar enough
        self.least = 0.5 * np.sqrt(2 * (1 - options.threshold) / dimension)
        self.options = options
        self._grow(sample, total / max(len(sample), 1), rng)

    def _grow(self, rows: np.ndarray, weight: float, rng: np.random.Generator) -> int:
        number = len(self.nodes)
        self.nodes.append(None)
        if len(rows) * weight > self.options.leaf and len(rows) >= 16:
            direction = rng.standard_normal(rows.shape[1])
            direction /= np.linalg.norm(direction)
            along = rows @ direction
            middle, low, high = np.quantile(along, [0.5, 0.5 - self.options.spill, 0.5 + self.options.spill])
            low, high = min(low, middle - self.least), max(high, middle + self.least)
            left, right = rows[along <= high], rows[along >= low]
            if max(len(left), len(right)) < 0.9 * len(rows):
                self.nodes[number] = (direction, low, high, self._grow(left, weight, rng), self._grow(right, weight, rng))
                return number
        self.nodes[number] = self.leaves
        self.leaves += 1
        return number

    def place(self, rows: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """(places of rows, leaf) of every leaf that gets some."""
        found, todo = [], [(0, np.arange(len(rows)))]
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            if not isinstance(node, tuple):
                if len(at):
                    found.append((at, node))
                continue
            direction, low, high, left, right = node
            along = rows[at] @ direction
            todo += [(left, at[along <= high]), (right, at[along >= low])]
        return found


def forest(sample: np.ndarray, total: int, options: Options, first: int = 0) -> list[Tree]:
    rng = np.random.default_rng(options.seed)
    trees = []
    for _ in range(options.trees):
        trees.append(Tree(sample, total, first, options, rng))
        first = trees[-1].leaves
    return trees


def unit(vectors: list) -> np.ndarray:
    rows = np.array(vectors, dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def embedding_dedup(vectors: DataFrame, options: Options | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows with cosine >= threshold, in double precision, are linked; component_id is the smallest
    vec_id reachable, and the row with that id is kept. Null vectors, those of zeros, with null or
    non-finite components link with nothing, others with those of their dimension. Equal vectors are
    linked with each other; a repeated id is one row for each vector. Other columns are ignored.
    """
    options = options or Options()
    spark = vectors.sparkSession

    def written(df):
        path = new_run_dir(spark, "vectors")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.expr("v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)")
    usable = rows.where(whole)
    classes = written(usable.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("node", F.monotonically_increasing_id()))
    # by dimension: a forest, or the one leaf that holds all
    planted: dict[int, list[Tree] | int] = {}
    first = 0
    for n, total in sorted(map(tuple, classes.groupBy(F.size("v")).count().collect())):
        if total <= options.leaf:
            planted[n], first = first, first + 1
            continue
        sample = classes.where(F.size("v") == n).orderBy(F.xxhash64("node"), "node").limit(options.sample).select("v").collect()
        planted[n] = forest(unit([r[0] for r in sample]), total, options, first)
        first = planted[n][-1].leaves
    trees = spark.sparkContext.broadcast(planted)

    def put(batches):
        for batch in batches:
            if not len(batch):
                continue
            vectors = batch.column("v").to_pylist()
            own: list = [None] * len(vectors)
            leaves: list[list] = [[] for _ in vectors]
            sizes = np.array([len(x) for x in vectors])
            for n in np.unique(sizes).tolist():
                where = np.flatnonzero(sizes == n)
                rows = unit([vectors[i] for i in where.tolist()])
                for i, x in zip(where.tolist(), rows, strict=True):
                    own[i] = x
                known = trees.value[n]
                placed = [(np.arange(len(rows)), known)] if isinstance(known, int) else [y for tree in known for y in tree.place(rows)]
                for at, leaf in placed:
                    for i in where[at].tolist():
                        leaves[i].append(leaf)
            yield pa.record_batch(
                [batch.column("node"), batch.column("copies"), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([sorted(x) for x in leaves], pa.list_(pa.int32()))],
                names=["node", "copies", "v", "leaves"],
            )

    placed = written(classes.select("node", "copies", "v").mapInArrow(put, "node long, copies long, v binary, leaves array<int>"))
    apart = placed.select("*", F.explode("leaves").alias("leaf"))
    chunks = apart.groupBy("leaf").agg(F.ceil(F.count("*") / options.chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    pairs = apart.join(chunks, "leaf").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    pairs = pairs.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "v", "leaves")

    def compare(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        v = np.frombuffer(b"".join(table.column("v").to_pylist()), np.float64).reshape(len(node), -1)
        leaf, i, j = (table.column(x)[0].as_py() for x in ("leaf", "i", "j"))
        side = table.column("own").to_numpy() == i
        before = [[y for y in x if y < leaf] for x in table.column("leaves").to_pylist()]
        width = max(map(len, before), default=0)
        # places without a leaf get numbers that never agree
        earlier = np.array([x + [-1 - k] * (width - len(x)) for k, x in enumerate(before)], dtype=np.int64).reshape(len(node), width)
        left = np.flatnonzero(side)
        right = left if i == j else np.flatnonzero(~side)
        low, high = [], []
        for at in range(0, len(left), 256):
            some = left[at:at + 256]
            a, b = np.nonzero(v[some] @ v[right].T >= options.threshold)
            a, b = some[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            for x in range(width):
                for y in range(width):
                    if len(a):
                        new = earlier[a, x] != earlier[b, y]
                        a, b = a[new], b[new]
            low.append(a)
            high.append(b)
        low, high = np.concatenate(low), np.concatenate(high)
        links = np.bincount(low, weights=copies[high], minlength=len(node)) + np.bincount(high, weights=copies[low], minlength=len(node))
        label = np.arange(len(node))
        while True:
            least = label.copy()
            np.minimum.at(least, low, label[high])
            np.minimum.at(least, high, label[low])
            least = least[least]
            if (least == label).all():
                break
            label = least
        linked, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(node)))
        return pa.table({
            "node": pa.array(np.concatenate([node[linked], node[tied]])),
            "links": pa.array(np.concatenate([links[linked], np.zeros(len(tied))]).astype(np.int64)),
            "to": pa.array(np.concatenate([np.zeros(len(linked), np.int64), node[label[tied]]]), mask=np.arange(len(linked) + len(tied)) < len(linked)),
        })

    found = written(pairs.groupBy("leaf", "i", "j").applyInArrow(compare, "node long, links long, to long"))
    roots = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(first, "root").select("v", "copies", "links", "component_id")
    out = rows.join(named, "v", "left")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
