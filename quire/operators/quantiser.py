"""Vector quantisers: centroids and code books as tables, training, assignment, encoding."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import matrices
from quire.operators.embedding import arrow_to_matrix, vectors_to_arrow
from quire.session import broadcast_limit


@dataclass
class Quantiser:
    """A trained model: its size is set by its parameters, not by the corpus."""

    centroids: np.ndarray  # (nlist, dim)
    metric: str = "ip"
    books: np.ndarray | None = None  # (pq_m, codes, dim / pq_m)
    by_residual: bool = True
    #: With two levels the leaders of groups of cells, and where each group of ``centroids`` begins (and the last ends).
    leaders: np.ndarray | None = None
    starts: np.ndarray | None = None
    #: Groups that are looked into for a vector's cell. One that looks for more cells looks into as many groups more.
    probe: int = 8

    def nearest(self, x: np.ndarray, n: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """``(cells, scores)`` of the ``n`` best cells for each row, ties to the lower cell."""
        if self.leaders is None:
            return matrices.nearest(x, self.centroids, self.metric, n)
        return matrices.nearest_in_groups(
            x, self.centroids, self.leaders, self.starts, self.metric, n, self.probe + n - 1
        )

    @property
    def nlist(self) -> int:
        return len(self.centroids)

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]


def model_matrix(df: DataFrame, order: list[str], vector: str) -> np.ndarray:
    """The vectors of a model table in key order and in its own precision.

    A table beyond the session's limit is refused before anything is collected.
    """
    double = isinstance(df.schema[vector].dataType.elementType, T.DoubleType)
    size = df.agg(F.sum(F.size(vector)).alias("n")).first()["n"] or 0
    check_model_size(df.sparkSession, (8 if double else 4) * size)
    table = df.orderBy(*order).select(vector).toArrow()
    return arrow_to_matrix(
        table.column(0).combine_chunks(), "float64" if double else "float32"
    )


def check_model_size(spark: SparkSession, size: int) -> None:
    limit = broadcast_limit(spark)
    if size > limit:
        raise ValueError(
            f"the model takes {size} bytes and the limit is {limit};"
            " raise quire.broadcast.maxBytes or train fewer centroids"
        )


def load_books(codebooks: DataFrame) -> np.ndarray:
    """``(m, code, subvector)`` rows as one ``(m, codes, width)`` array."""
    flat = model_matrix(codebooks, ["m", "code"], "subvector")
    m = codebooks.agg(F.max("m")).first()[0] + 1
    return flat.reshape(m, -1, flat.shape[1])


def centroid_table(spark: SparkSession, centroids: np.ndarray, starts: np.ndarray | None = None) -> DataFrame:
    """``(cell, centroid)``, with ``grp`` where the cells form groups."""
    columns = {"cell": pa.array(np.arange(len(centroids), dtype="int32")), "centroid": vectors_to_arrow(centroids.astype("float32"))}
    if starts is not None:
        columns["grp"] = pa.array(np.repeat(np.arange(len(starts) - 1, dtype="int32"), np.diff(starts)))
    return spark.createDataFrame(pa.table(columns))


def codebook_table(spark: SparkSession, books: np.ndarray) -> DataFrame:
    m, n_codes, width = books.shape
    return spark.createDataFrame(
        pa.table({"m": pa.array(np.repeat(np.arange(m, dtype="int32"), n_codes)),
                  "code": pa.array(np.tile(np.arange(n_codes, dtype="int32"), m)),
                  "subvector": vectors_to_arrow(books.reshape(-1, width).astype("float32"))})
    )


# --------------------------------------------------------------------------- use
def to_cells(
    df: DataFrame, quantiser: Quantiser, *, vector: str, n: int = 1, residual: bool = False
) -> DataFrame:
    """Repeat each row for its ``n`` best cells, adding ``cell`` and ``cell_score``.

    With ``residual`` the vector becomes its difference from the centroid. Rows stay in
    their partition; ties go to the lower cell.
    """
    model = df.sparkSession.sparkContext.broadcast(replace(quantiser, books=None))
    n = min(n, quantiser.nlist)
    names = df.columns
    at = names.index(vector)
    fields = [
        T.StructField(f.name, T.ArrayType(T.DoubleType()) if residual and f.name == vector else f.dataType)
        for f in df.schema
    ]
    schema = T.StructType(
        [*fields, T.StructField("cell", T.IntegerType()), T.StructField("cell_score", T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            centroids = model.value.centroids
            x = arrow_to_matrix(batch.column(at), centroids.dtype)
            if x.shape[1] != centroids.shape[1]:
                raise ValueError(f"vectors differ in length: {x.shape[1]}, model {centroids.shape[1]}")
            cells, values = model.value.nearest(x, n)
            rows = np.repeat(np.arange(len(x)), n)
            columns = [c if n == 1 else c.take(pa.array(rows)) for c in batch.columns]
            if residual:
                columns[at] = vectors_to_arrow((x[rows] - centroids[cells.ravel()]).astype("float64"))
            scores = values.ravel().astype("float64")
            columns += [pa.array(cells.ravel().astype("int32")), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, quantiser: Quantiser, *, vector: str = "embedding") -> DataFrame:
    """Replace the vector by ``codes``, one code number per sub-space.

    With ``by_residual`` the difference from the centroid of the row's ``cell`` is coded.
    """
    context = df.sparkSession.sparkContext
    books = context.broadcast(quantiser.books)
    centroids = context.broadcast(quantiser.centroids if quantiser.by_residual else None)
    kept = [c for c in df.columns if c != vector]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("codes", T.BinaryType())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrow_to_matrix(batch.column(batch.schema.get_field_index(vector)))
            if centroids.value is not None:
                cells = batch.column(batch.schema.get_field_index("cell")).to_numpy()
                x = x - centroids.value[cells]
            codes = matrices.encode(x, books.value)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns.append(pa.array([row.tobytes() for row in codes], type=pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def place(df: DataFrame, quantiser: Quantiser, *, vector: str = "embedding") -> DataFrame:
    """Add ``cell`` and, with code books, replace the vector by ``codes``: :func:`to_cells` and :func:`encode` in one pass."""
    model = df.sparkSession.sparkContext.broadcast(quantiser)
    coded = quantiser.books is not None
    kept = [c for c in df.columns if not (coded and c == vector)]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("cell", T.IntegerType())])
    if coded:
        schema.add("codes", T.BinaryType())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            model_ = model.value
            x = arrow_to_matrix(batch.column(batch.schema.get_field_index(vector)), model_.centroids.dtype)
            if x.shape[1] != model_.dim:
                raise ValueError(f"vectors differ in length: {x.shape[1]}, model {model_.dim}")
            cells = model_.nearest(x)[0][:, 0]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns.append(pa.array(cells.astype("int32")))
            if coded:
                codes = matrices.encode(x - model_.centroids[cells] if model_.by_residual else x, model_.books)
                columns.append(pa.array([row.tobytes() for row in codes], type=pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def code_numbers(df: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Unpack ``codes`` into rows ``(m, code)``."""
    width = 1 if quantiser.books.shape[1] <= 256 else 2
    digits = F.hex("codes")

    def number(j):
        low = F.substr(digits, j * 2 * width + 1, F.lit(2))
        if width == 1:
            return F.conv(low, 16, 10).cast("int")
        high = F.substr(digits, j * 2 * width + 3, F.lit(2))
        return F.conv(F.concat(high, low), 16, 10).cast("int")

    indexes = F.sequence(F.lit(0), F.lit(len(quantiser.books) - 1))
    rest = [c for c in df.columns if c != "codes"]
    return df.select(*rest, F.posexplode(F.transform(indexes, number)).alias("m", "code"))


def coding_error(df: DataFrame, quantiser: Quantiser, *, vector: str = "embedding") -> DataFrame:
    """Add ``error``, the squared distance between a vector and what its codes decode to."""
    context = df.sparkSession.sparkContext
    books = context.broadcast(quantiser.books)
    centroids = context.broadcast(quantiser.centroids if quantiser.by_residual else None)
    schema = T.StructType([*df.schema.fields, T.StructField("error", T.DoubleType())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrow_to_matrix(batch.column(batch.schema.get_field_index(vector)))
            if centroids.value is not None:
                cells = batch.column(batch.schema.get_field_index("cell")).to_numpy()
                x = x - centroids.value[cells]
            delta = x - matrices.decode(matrices.encode(x, books.value), books.value)
            columns = [*batch.columns, pa.array((delta * delta).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


# --------------------------------------------------------------------------- training
def hash_sample(df: DataFrame, fraction: float, key: str = "id", seed: int = 0) -> DataFrame:
    """Rows whose key hashes below ``fraction``: spread over the whole table, no sort."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(fraction * (1 << 32)) + 1)


#: Fixed value: rows a cell below which k-means is known to train poorly.
LEAST_ROWS_A_CELL = 39


def training_rows(nlist: int, rows_a_cell: int = 64) -> int:
    """How many rows ``nlist`` cells are trained on."""
    return nlist * max(rows_a_cell, LEAST_ROWS_A_CELL)


def _partial_sums(run, df: DataFrame) -> DataFrame:
    """``(m, code, n, mean, error)`` from the rows ``(m, code, n, total, error)`` that ``run`` gives of each batch."""
    partial = df.mapInArrow(run, "m int, code int, n bigint, total array<double>, error double")
    merged = partial.groupBy("m", "code").agg(
        F.sum("n").alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
        F.sum("error").alias("error"),
    )
    return merged.select("m", "code", "n", F.transform("total", lambda t: t / F.col("n")).alias("mean"), "error")


def _sums(m: int, part: np.ndarray, labels: np.ndarray, cost: np.ndarray) -> pa.RecordBatch:
    present, counts, sums = matrices.sums_by_label(part, labels)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(present), m, dtype="int32")),
            pa.array(present.astype("int32")),
            pa.array(counts.astype("int64")),
            vectors_to_arrow(sums.astype("float64")),
            pa.array(np.bincount(labels, cost)[present].astype("float64")),
        ],
        names=["m", "code", "n", "total", "error"],
    )


def lloyd_step(df: DataFrame, books: np.ndarray, *, vector: str = "embedding") -> DataFrame:
    """``(m, code, n, mean, error)``: of the sub-vectors nearest to each code the mean, and their summed squared distance.

    Each batch sends one partial sum per code it met, and the sums are merged before and
    after the shuffle, so a code near most rows costs no more than any other. Plain
    k-means is the case of one sub-space.
    """
    shared = df.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrow_to_matrix(batch.column(0), shared.value.dtype)
            width = shared.value.shape[2]
            for j, book in enumerate(shared.value):
                part = x[:, j * width : (j + 1) * width]
                labels, cost = matrices.nearest(part, book, "l2")
                yield _sums(j, part, labels[:, 0], cost[:, 0])

    return _partial_sums(run, df.select(vector))


def group_step(df: DataFrame, centroids: np.ndarray, starts: np.ndarray, *, vector: str = "embedding", group: str = "grp") -> DataFrame:
    """:func:`lloyd_step` of all groups of cells at once; a row meets the cells of its own group only."""
    shared = df.sparkSession.sparkContext.broadcast((centroids, starts))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c, begins = shared.value
            x = arrow_to_matrix(batch.column(0), c.dtype)
            groups = batch.column(1).to_numpy()
            order = np.argsort(groups, kind="stable")
            cuts = np.searchsorted(groups[order], np.arange(len(begins)))
            labels, cost = np.empty(len(x), np.int64), np.empty(len(x))
            for g in np.flatnonzero(np.diff(cuts)):
                rows = order[cuts[g] : cuts[g + 1]]
                cells, values = matrices.nearest(x[rows], c[begins[g] : begins[g + 1]], "l2")
                labels[rows], cost[rows] = cells[:, 0] + begins[g], values[:, 0]
            yield _sums(0, x, labels, cost)

    return _partial_sums(run, df.select(vector, group))


def _farthest(df: DataFrame, books: np.ndarray, wanted: dict[tuple[int, int], None], *, vector: str) -> dict:
    """``{(m, code): sub-vector}``: of each wanted code the sub-vector that is farthest from it."""
    shared = df.sparkSession.sparkContext.broadcast((books, sorted(wanted)))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            books, wanted = shared.value
            width = books.shape[2]
            x = arrow_to_matrix(batch.column(0), books.dtype)
            for j in sorted({m for m, _ in wanted}):
                part = x[:, j * width : (j + 1) * width]
                labels, cost = (a[:, 0] for a in matrices.nearest(part, books[j], "l2"))
                codes = [c for m, c in wanted if m == j and (labels == c).any()]
                rows = [int(np.where(labels == c, cost, -1.0).argmax()) for c in codes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j] * len(codes), pa.int32()), pa.array(codes, pa.int32()), pa.array(cost[rows].astype("float64")),
                     vectors_to_arrow(part[rows].astype("float64"))],
                    names=["m", "code", "cost", "v"],
                )

    found = df.select(vector).mapInArrow(run, "m int, code int, cost double, v array<double>")
    best = found.groupBy("m", "code").agg(F.max(F.struct("cost", "v")).alias("x")).select("m", "code", "x.*")
    return {(r["m"], r["code"]): (r["cost"], r["v"]) for r in best.collect()}  # at most one row a code


@dataclass
class Training:
    """What training gives: the code books, and the summed squared distance of each round before its codes moved."""

    books: np.ndarray
    inertia: list[float]


def _lloyd(sample: DataFrame, books: np.ndarray, iterations: int, step, revive=None) -> Training:
    """Rounds of k-means, in the precision of ``books``. The driver holds the model only."""
    element = "double" if books.dtype == np.float64 else "float"
    inertia: list[float] = []
    for _ in range(iterations):
        table = step(books).select("m", "code", "error", F.col("mean").cast(f"array<{element}>")).toArrow()
        m, code = table["m"].to_numpy(), table["code"].to_numpy()
        inertia.append(float(table["error"].to_numpy().sum()))
        moved = books.copy()
        moved[m, code] = arrow_to_matrix(table["mean"].combine_chunks(), str(books.dtype))
        dead = np.ones(books.shape[:2], bool)
        dead[m, code] = False
        if revive is not None and dead.any():
            revive(books, moved, dead, m, code, table["error"].to_numpy())
        shift = np.abs(moved - books).max()
        books = moved
        if shift < 1e-7:
            break
    return Training(books, inertia)


def train(
    sample: DataFrame, starts: np.ndarray, *, iterations: int = 10, vector: str = "embedding"
) -> Training:
    """Distributed k-means in each sub-space from given codes ``(m, codes, width)``.

    A code that no row is nearest to moves to the row farthest from the code with the largest error that
    no other has taken, so no code stays idle while another has more than one distinct row. The inertia never rises.
    """

    def revive(books, moved, dead, m, code, error):
        wanted: dict[tuple[int, int], None] = {}
        for j in np.flatnonzero(dead.any(axis=1)).tolist():
            mine = np.flatnonzero((m == j) & (error > 0))
            worst = mine[np.argsort(-error[mine], kind="stable")][: int(dead[j].sum())]
            wanted |= dict.fromkeys((j, int(code[i])) for i in worst)
        if not wanted:
            return
        found = _farthest(sample, books, wanted, vector=vector)
        for j in {j for j, _ in wanted}:
            idle = np.flatnonzero(dead[j]).tolist()
            rows = [found[k][1] for k in wanted if k[0] == j and k in found and found[k][0] > 0]
            for place, row in zip(idle, rows, strict=False):
                moved[j, place] = row

    return _lloyd(sample, starts, iterations, lambda books: lloyd_step(sample, books, vector=vector), revive)


def train_books(
    sample: DataFrame, m: int, n_codes: int, *, iterations: int = 10, seed: int = 0,
    vector: str = "embedding", key: str = "id",
) -> np.ndarray:
    """``(m, codes, width)`` code books by distributed k-means in each sub-space, see :func:`train`.

    Fewer distinct rows than codes give fewer codes.
    """
    row = sample.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("dim")).first()
    n, dim = row["n"], row["dim"]
    if not n:
        raise RuntimeError("nothing to train on")
    if dim % m:
        raise ValueError(f"{dim} dimensions do not split into {m} sub-spaces")
    check_model_size(sample.sparkSession, 4 * n_codes * dim)
    # Start from distinct vectors with the lowest hashes. They are chosen by two numbers a
    # row; only the chosen vectors are sent to the driver.
    # Copies leave fewer distinct ones; then more of the sample is looked at.
    share = 4 * n_codes / n
    while True:
        candidates = hash_sample(sample, min(1.0, share), key, seed).select(
            F.col(vector).cast("array<float>").alias("v"),
            F.xxhash64(F.col(key), F.lit(seed)).alias("h"),
            F.xxhash64(vector).alias("vh"),
        )
        chosen = candidates.groupBy("vh").agg(F.min("h").alias("h")).orderBy("h", "vh").limit(n_codes)
        if share >= 1 or chosen.count() >= n_codes:
            break
        share *= 8
    starts = (
        candidates.join(F.broadcast(chosen), ["vh", "h"])
        .dropDuplicates(["vh"])
        .orderBy("h", "vh")
        .select("v")
        .toArrow()
    )
    rows = arrow_to_matrix(starts.column("v").combine_chunks(), "float32")
    books = rows.reshape(len(rows), m, dim // m).transpose(1, 0, 2).copy()
    return train(sample, books, iterations=iterations, vector=vector).books


# --------------------------------------------------------------------------- two levels
def share_out(weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` cells for groups by weight: one for each group that has any, the rest by largest remainder."""
    out = (weights > 0).astype(np.int64)
    rest = n - int(out.sum())
    if rest > 0:
        exact = weights / weights.sum() * rest
        out += exact.astype(np.int64)
        left = n - int(out.sum())
        out[np.argsort(-(exact - np.floor(exact)), kind="stable")[:left]] += 1
    return out


def train_groups(
    grouped: DataFrame, centroids: np.ndarray, starts: np.ndarray, *, iterations: int = 10, vector: str = "embedding", group: str = "grp"
) -> Training:
    """k-means within each group of given cells, all groups in the same passes; rows carry their group."""
    return _lloyd(grouped, centroids[None], iterations, lambda c: group_step(grouped, c[0], starts, vector=vector, group=group))


def train_tree(
    sample: DataFrame, nlist: int, n_groups: int, *, iterations: int = 10, seed: int = 0,
    vector: str = "embedding", key: str = "id",
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[float]]:
    """``(leaders, centroids, starts, inertia)``: cells in groups, trained for all groups in the same passes.

    A flat model compares every row with all ``nlist`` cells in each round. Here ``n_groups`` leaders are trained
    first, each group gets cells by its share of the rows, and a row then meets the cells of its own group only:
    with about sqrt(nlist) groups some 2 sqrt(nlist) comparisons instead. Fewer distinct rows give fewer cells.
    """
    spark = sample.sparkSession
    check_model_size(spark, 4 * (nlist + n_groups) * (sample.select(F.max(F.size(vector))).first()[0] or 0))
    leaders = train_books(sample, 1, n_groups, iterations=iterations, seed=seed, vector=vector, key=key)[0]
    grouped = to_cells(sample.select(key, vector), Quantiser(leaders, "l2"), vector=vector)
    grouped = grouped.drop("cell_score").withColumnRenamed("cell", "grp").persist()
    try:
        # Distinct vectors of each group, numbered by hash; one row a group says how many are wanted.
        marks = grouped.select("grp", F.xxhash64(vector).alias("vh"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"))
        marks = marks.groupBy("grp", "vh").agg(F.min("h").alias("h"), F.count("*").alias("n"))
        sizes = marks.groupBy("grp").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).toArrow()
        weights, distinct = np.zeros(len(leaders)), np.zeros(len(leaders), np.int64)
        weights[sizes["grp"].to_numpy()] = sizes["n"].to_numpy()
        distinct[sizes["grp"].to_numpy()] = sizes["distinct"].to_numpy()
        wanted = np.minimum(share_out(weights, nlist), distinct)
        asked = spark.createDataFrame([(g, int(w)) for g, w in enumerate(wanted)], "grp int, wanted int")
        place = F.row_number().over(Window.partitionBy("grp").orderBy("h", "vh"))
        chosen = marks.withColumn("place", place).where(F.col("place") <= int(wanted.max()))
        chosen = chosen.join(F.broadcast(asked), "grp").where("place <= wanted").select("grp", "vh", "place")
        rows = grouped.select("grp", F.xxhash64(vector).alias("vh"), F.col(vector).cast("array<float>").alias("v"))
        rows = rows.join(chosen, ["grp", "vh"]).groupBy("grp", "place").agg(F.first("v").alias("v"))
        begin = rows.orderBy("grp", "place").select("v").toArrow()
        centroids = arrow_to_matrix(begin.column("v").combine_chunks(), "float32")
        starts = np.concatenate(([0], np.cumsum(wanted)))
        made = train_groups(grouped, centroids, starts, iterations=iterations, vector=vector)
        kept = wanted > 0
        return leaders[kept], made.books[0], np.concatenate(([0], np.cumsum(wanted[kept]))), made.inertia
    finally:
        grouped.unpersist()
