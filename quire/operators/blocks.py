"""Rows packed into bounded blocks, so that neighbours are scored block against block.

A join of queries with candidates would emit every pair as a row. Here both sides are
packed first, at most ``BLOCK_ROWS`` vectors to a row, and the join emits pairs of
blocks. Each pair is one matrix product; a task merges the best hits of its pairs, so that at
most ``k`` rows for each query it scored leave it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.embedding import arrow_to_matrix
from quire.operators.matrices import better
from quire.session import broadcast_limit

#: Vectors in a block: a pair of blocks scores in 32 MB.
BLOCK_ROWS = 2048
#: Queries of a block that are scored at a time: 8 MB of scores.
SCORED_ROWS = 512
#: Hits a task holds before it merges them, and half of what it sends on early.
HELD_ROWS = 1 << 18
#: Pairs of full blocks for a task, from which work is dealt out anew.
TASK_PAIRS = 16
#: Copies of the query blocks, and classes of the candidate blocks, in a shuffled join.
SALTS = 16
#: Blocks of probing queries a lane holds at most, queries of it that should meet each candidate, and that must.
LANE_BLOCKS, LANE_WANTED, LANE_LEAST = 8, 64, 16
#: Of a hit in a shuffle, about.
HIT_BYTES = 64


def pack(
    df: DataFrame, *, key: str, id_col: str, payload: str, extra: str | None = None
) -> DataFrame:
    """Rows ``(key, ids, payload, extra)`` of up to ``BLOCK_ROWS`` input rows with one key.

    Vectors are packed as bytes of their own precision, codes as they are. Rows are packed
    where they lie, without a shuffle; a key with many rows becomes many blocks.
    """
    coded = isinstance(df.schema[payload].dataType, T.BinaryType)
    dtype = None if coded else vector_dtype(df, payload)
    names = [key, id_col, payload] + ([extra] if extra else [])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = _block_starts(keys)
            bounds = np.append(starts, len(keys)).astype("int32")
            if coded:
                rows = np.array(batch.column(2).to_pylist(), dtype=object)[order]
                blobs = [b"".join(rows[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            else:
                x = arrow_to_matrix(batch.column(2), dtype)[order]
                blobs = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            take = pa.array(order)
            offsets = pa.array(bounds)
            columns = [
                pa.array(keys[starts], type=batch.schema.field(0).type),
                pa.ListArray.from_arrays(offsets, batch.column(1).take(take)),
                pa.array(blobs, type=pa.binary()),
            ]
            if extra:
                columns.append(pa.ListArray.from_arrays(offsets, batch.column(3).take(take)))
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    fields = [
        T.StructField(key, df.schema[key].dataType),
        T.StructField(f"{id_col}s", T.ArrayType(df.schema[id_col].dataType)),
        T.StructField(f"{payload}_block", T.BinaryType()),
    ]
    if extra:
        fields.append(T.StructField(f"{extra}s", T.ArrayType(df.schema[extra].dataType)))
    out = T.StructType(fields)
    return df.select(*names).mapInArrow(run, out)


def vector_dtype(df: DataFrame, column: str) -> str:
    """numpy name of the element type of a vector column."""
    element = df.schema[column].dataType.elementType
    return "float32" if isinstance(element, T.FloatType) else "float64"


def _block_starts(keys: np.ndarray) -> np.ndarray:
    """First positions of blocks in sorted keys: where the key changes or a block is full."""
    changes = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    ends = np.append(changes[1:], len(keys))
    return np.concatenate([np.arange(a, b, BLOCK_ROWS) for a, b in zip(changes, ends)])


def grid(queries: float, pairs: float) -> tuple[int, int]:
    """Lanes of queries and chunks of candidates whose products make tasks of about ``TASK_PAIRS`` pairs of blocks.

    ``queries`` share a key, ``pairs`` of vectors are scored in all. Lanes copy the candidates and chunks the hits, so
    there are about as many of both; a lane has a block of queries at least. One lane leaves candidates in place.
    """
    tasks = math.ceil(pairs / (TASK_PAIRS * BLOCK_ROWS**2))
    lanes = max(1, min(math.ceil(queries / BLOCK_ROWS), math.ceil(math.sqrt(tasks))))
    return lanes, math.ceil(tasks / lanes)


def deal(blocks: DataFrame, lanes: int, chunks: int) -> DataFrame:
    """A copy of each block for each ``_lane``, the blocks of a lane dealt over ``chunks`` tasks."""
    if lanes == 1:
        return blocks.withColumn("_lane", F.lit(0))
    chunk = F.pmod(F.xxhash64("ids"), F.lit(chunks))
    copies = blocks.withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return copies.repartitionById(lanes * chunks, (F.col("_lane") * chunks + chunk).cast("int"))


def join_blocks(query_blocks: DataFrame, blocks: DataFrame, key: str, query_bytes: int) -> DataFrame:
    """Pairs of query and candidate blocks with the same key; ``query_block`` tells the query blocks apart.

    Query blocks within the session's limit are broadcast and candidates stay in place.
    Beyond it both are shuffled; salting spreads a key that holds most candidates.
    """
    query_blocks = query_blocks.withColumn("query_block", F.monotonically_increasing_id())
    if query_bytes <= broadcast_limit(blocks.sparkSession):
        return blocks.join(F.broadcast(query_blocks), key)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        blocks.withColumn("_salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int"))
        .join(query_blocks.withColumn("_salt", salts), [key, "_salt"])
        .drop("_salt")
    )


def lane_queries(nprobe: int, nlist: int, candidates: int | None = None) -> int:
    """Queries of a lane that reads all candidates; 0 if too few of them would meet each candidate.

    With the number of candidates known, a lane gets the work of a task of :data:`TASK_PAIRS` pairs, as far as its
    blocks stay few.
    """
    work = 0 if candidates is None else TASK_PAIRS * BLOCK_ROWS**2 * nlist // (max(1, candidates) * nprobe)
    each = min(max(BLOCK_ROWS // 4, math.ceil(LANE_WANTED * nlist / nprobe), work), LANE_BLOCKS * BLOCK_ROWS // nprobe)
    return each if each * nprobe >= LANE_LEAST * nlist else 0


def join_lanes(lanes: DataFrame, blocks: DataFrame, key: str, chunks: int) -> DataFrame:
    """Pairs of query and candidate blocks with the same key, when most keys are in every lane.

    A partition of ``lanes`` is held by a task that streams a chunk of ``blocks`` past it. ``blocks`` are files that
    all tasks read, so neither side is copied to a disk or broadcast, however many lanes there are.
    """
    lanes = lanes.withColumn("query_block", F.monotonically_increasing_id())
    return blocks.coalesce(chunks).join(lanes.hint("shuffle_replicate_nl"), key)


def score_pairs(pairs: DataFrame, score, k: int, metric: str, dtype: str) -> DataFrame:
    """``(query_id, id, score)``: the ``k`` best candidates of each task per query.

    ``score(vectors, payload, n)`` gives the score matrix of float64 query vectors and the
    ``n`` candidates of a block; ``dtype`` is how the query vectors were packed. Ties go to
    the lower id, as in the final cut. What is worse than the ``k`` best a query block met before is left out.
    """
    based = "cell_scores" in pairs.columns
    names = ["query_block", "query_ids", "vector_block", "ids", "payload_block"] + (
        ["cell_scores"] if based else []
    )
    query_type = pairs.schema["query_ids"].dataType.elementType
    id_type = pairs.schema["ids"].dataType.elementType

    def run(batches):
        held, n = [], 0
        met: dict[int, np.ndarray] = {}  # the best costs of each query block's queries so far
        for batch in batches:
            for i in range(batch.num_rows):
                block, query_ids, ids = batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(3)[i].values
                order = ids.to_numpy(zero_copy_only=False)
                order = np.argsort(order.astype(str) if order.dtype == object else order)
                base = batch.column(5)[i].values.to_numpy()[:, None] if based else None
                vectors = np.frombuffer(batch.column(2)[i].as_py(), dtype=dtype).reshape(len(query_ids), -1)
                payload = batch.column(4)[i].as_py()
                if block not in met:
                    met[block] = np.full((len(query_ids), k), np.inf)
                for at in range(0, len(query_ids), SCORED_ROWS):
                    some = slice(at, at + SCORED_ROWS)
                    s = score(vectors[some].astype("float64"), payload, len(ids))[:, order]
                    if based:
                        s += base[some]
                    rows, columns = better(s, met[block][some], k, metric)
                    if not len(rows):
                        continue
                    held.append(pa.RecordBatch.from_arrays(
                        [query_ids.take(pa.array(rows + at)), ids.take(pa.array(order[columns])), pa.array(s[rows, columns])],
                        names=["query_id", "id", "score"],
                    ))
                    n += len(rows)
                    if n > HELD_ROWS:
                        held = merged(held, k, metric)
                        n = sum(x.num_rows for x in held)
                        if n > HELD_ROWS // 2:  # of so many queries that merging saves little
                            yield from held
                            held, n = [], 0
        yield from merged(held, k, metric)

    schema = T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return pairs.select(*names).mapInArrow(run, schema)


def merged(hits: list[pa.RecordBatch], k: int, metric: str) -> list[pa.RecordBatch]:
    """The ``k`` best hits of each query."""
    if not hits:
        return []
    order = "descending" if metric == "ip" else "ascending"
    table = pa.Table.from_batches(hits).sort_by([("query_id", "ascending"), ("score", order), ("id", "ascending")])
    queries = table.column("query_id").combine_chunks().dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero(np.append(True, queries[1:] != queries[:-1]))
    rank = np.arange(len(queries)) - np.repeat(starts, np.diff(np.append(starts, len(queries))))
    return table.filter(pa.array(rank < k)).combine_chunks().to_batches()


def score_order(metric: str) -> list[Column]:
    """Better scores first, then the lower id."""
    score = F.col("score")
    return [score.desc() if metric == "ip" else score.asc(), F.col("id")]


def rank_hits(hits: DataFrame, k: int, metric: str) -> DataFrame:
    """The ``k`` best hits per query with their 1-based ``rank``; cut per task before the shuffle."""
    by_query = Window.partitionBy("query_id").orderBy(*score_order(metric))
    return hits.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
