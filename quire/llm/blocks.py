"""Documents packed into blocks, and questions that blocks put to each other through buckets.

A block is some megabytes of whole documents in one row. To find what repeats between blocks, each
block sends fingerprints, already reduced to one per distinct value, to the buckets of their
leading bits; a bucket answers every block with one bit per fingerprint sent. A value that a
third of all documents holds is thus at most one fingerprint per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import new_run_dir

BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block long, n_docs long, n_bytes long, payload binary"
REPLY_SCHEMA = "block long, bucket long, answer binary"
ASK_SCHEMA = "bucket long, block long, sent binary"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the documents as numbered blocks to the shared folder and return that table.

    The written table fixes which rows a block holds, so that a block computed again after
    a lost executor is the same. Null texts become empty ones; null ids stay null.
    """
    spark = docs.sparkSession
    path = new_run_dir(spark, "blocks")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"))

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list = []
        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(key)
                texts.append(text)
                size += len(text) + 8
                if size >= block_bytes:
                    yield _block(number, ids, texts, size)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield _block(number, ids, texts, size)

    rows.mapInArrow(to_blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def _block(number: int, ids: list, texts: list, size: int) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    data = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.large_binary())], names=["id", "text"])
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, data.schema, options=options) as out:
        out.write_batch(data)
    return pa.record_batch(
        [pa.array([number], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
        names=["block", "n_docs", "n_bytes", "payload"],
    )


def unpack(payload: bytes) -> tuple[list, list[bytes]]:
    """Ids and texts of a block."""
    with pa.ipc.open_stream(payload) as reader:
        batch = reader.read_all()
    return batch.column("id").to_pylist(), batch.column("text").to_pylist()


def bucket_bits(blocks: DataFrame, sent_per_byte: float, per_bucket: int = 1 << 20, least: int = 8) -> int:
    """Leading bits that make buckets of about ``per_bucket`` fingerprints, however large the input."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(least, int(np.ceil(np.log2(max(total * sent_per_byte / per_bucket, 1)))))


def ask(blocks: DataFrame, fingerprints: Callable, bits: int, dtype: str) -> DataFrame:
    """Rows (bucket, block, sent): the block's distinct fingerprints by leading bits, in order.

    ``fingerprints(payload, answers)`` gives sorted distinct 64-bit values. ``dtype`` 'u4' sends
    the 32 bits after the leading ones, 'u8' all.
    """
    columns = [c for c in ("block", "payload", "answers") if c in blocks.columns]

    def send(batches):
        for batch in batches:
            data = batch.to_pydict()
            for i, block in enumerate(data["block"]):
                values = fingerprints(data["payload"][i], *([data["answers"][i]] if "answers" in data else []))
                yield from _sent(block, values, bits, dtype)

    return blocks.select(*columns).mapInArrow(send, ASK_SCHEMA)


def cuts(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted values, and where the values of each begin (and the last ends)."""
    buckets = (values >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(values) else np.zeros(0, np.int64)
    return buckets[starts], np.append(starts, len(values))


def _sent(block: int, values: np.ndarray, bits: int, dtype: str):
    if not len(values):
        return
    buckets, at = cuts(values, bits)
    body = ((values << np.uint64(bits)) >> np.uint64(32)).astype("<u4") if dtype == "u4" else values.astype("<u8")
    yield pa.record_batch(
        [pa.array(buckets, pa.int64()), pa.array(np.full(len(buckets), block), pa.int64()),
         pa.array([body[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())],
        names=["bucket", "block", "sent"],
    )


def answer_repeats(asked: DataFrame, dtype: str) -> DataFrame:
    """One row per block and bucket that sent something another block sent too: a bit per value."""

    def reply(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy()
        sent = [np.frombuffer(x, dtype=f"<{dtype}") for x in table.column("sent").to_pylist()]
        every = np.concatenate(sent)
        order = np.sort(every)
        again = order[1:][order[1:] == order[:-1]]
        again = again[np.concatenate(([True], again[1:] != again[:-1]))] if len(again) else again
        out = []
        for block, values in zip(blocks, sent, strict=True):
            place = np.searchsorted(again, values)
            hit = again[np.minimum(place, len(again) - 1)] == values if len(again) else np.zeros(len(values), bool)
            if hit.any():
                out.append((block, np.packbits(hit).tobytes()))
        bucket = table.column("bucket")[0].as_py()
        return pa.table({
            "block": pa.array([x[0] for x in out], pa.int64()),
            "bucket": pa.array([bucket] * len(out), pa.int64()),
            "answer": pa.array([x[1] for x in out], pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(reply, REPLY_SCHEMA)


def with_answers(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """The blocks with their answers, a list of (bucket, answer), in column ``answers``."""
    kept = [c for c in blocks.columns if c != "answers"]
    lists = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
    return blocks.select(*kept).join(lists, "block", "left")


def flags(values: np.ndarray, bits: int, answers: list | None) -> np.ndarray:
    """The answered bit of each of the sorted values a block sent."""
    out = np.zeros(len(values), dtype=bool)
    if not answers or not len(values):
        return out
    buckets, at = cuts(values, bits)
    where = dict(zip(buckets.tolist(), range(len(buckets)), strict=True))
    for x in answers:
        i = where[x["bucket"]]
        n = at[i + 1] - at[i]
        out[at[i]:at[i + 1]] = np.unpackbits(np.frombuffer(x["answer"], np.uint8), count=n).astype(bool)
    return out
