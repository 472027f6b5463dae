"""Toxicity of texts from two Kneser-Ney language models, one of toxic and one of ordinary texts.

Each model mixes discounted bigram counts of its class with continuation counts of its class (how
many different words a word follows), and these with continuation counts that both classes
share, so that a rare expression says little: words outside the vocabulary are equally likely in
both. The score weighs the length-normalised difference of the two log-likelihoods over the whole
text, and that of the continuation probabilities of its few most telling words.

The difference of the log-likelihoods is a sum of one number for each word as context, one for each
word as continuation and one for each bigram with a share of its own. The model is a table of these
by 64-bit hash, and as large as the labelled texts make it. It is broadcast if it is small; if not,
the texts are packed into blocks, and each block asks for the numbers of its words and bigrams.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.hashing import BASE, mix
from quire.llm.memory import tidy
from quire.session import broadcast_limit, new_run_dir

WORD = re.compile(r"\w+")
DISCOUNT = 0.75
#: Bigrams lose more, as a few copies of a text repeat all of its bigrams; rarer ones back off. So much
#: in the smaller class and as large a share of the larger one, so that its size is no sign of a class.
BIGRAM_DISCOUNT = 3.0
#: Share of all words that a context must make up for its bigrams to weigh as much as their backoff.
CONTEXT = 0.05
#: Continuations of the smaller class that the even backoff, the same for both classes, is worth to a word.
EVEN = 5.0
#: Words that occur as often get probabilities of their own: overall, or in toxic texts.
LEAST, LEAST_TOXIC = 10, 4
#: Different words that are looked at by themselves.
TELLING = 3
#: Words handled before counts leave a task.
FLUSH = 1 << 20
#: Words whose hashes are kept.
REMEMBERED = 1 << 18
#: Bytes of texts in a block.
BLOCK = 4 << 20


class Hashes(dict):
    """64-bit hashes by word, kept for words that come again."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
        return value


#: No word holds a space.
START, END = Hashes()[" start"], Hashes()[" end"]


@dataclass
class Options:
    """Rows on which the weights are fitted; the models themselves take every labelled row."""

    #: Labelled rows, those of least hash, on which the weights of the two differences are fitted.
    calibration_rows: int = 20_000


@dataclass
class Model:
    #: key, a, b: of a word what it adds as context and as continuation; of a bigram what it adds, and null.
    table: DataFrame
    n_rows: int
    weights: np.ndarray

    @property
    def n_bytes(self) -> int:
        return self.n_rows * 24


def ids_of(text: str, hashes: Hashes) -> np.ndarray:
    return np.array([START, *map(hashes.__getitem__, WORD.findall(text.lower())), END], dtype=np.int64)


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(before.astype(np.uint64) * BASE + after.astype(np.uint64)).astype(np.int64)


def differences(texts: list[np.ndarray], find: Callable) -> list[tuple[float, float]]:
    """Mean log-likelihood ratio of each text's words, and that of its most telling words alone.

    ``find(keys)`` gives columns a and b of the model, 0 for what it doesn't have.
    """
    out = []
    for ids in texts:
        before, after = ids[:-1], ids[1:]
        context, told = find(before)[0], find(after)[1]
        ratio = context + told + find(pair_keys(before, after))[0]
        _, first = np.unique(after, return_index=True)
        most = np.sort(told[first])[-TELLING:]
        out.append((float(ratio.mean()), float(np.maximum(most, 0).sum() / TELLING)))
    return out


def finder(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> Callable:
    """``find`` of :func:`differences` over sorted keys."""

    def find(wanted):
        if not len(keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return np.where(hit, a[at], 0.0), np.where(hit, b[at], 0.0)

    return find


def train(docs: DataFrame, labels: DataFrame, options: Options | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Count both models over every labelled document and fit the weights; None without both classes.

    A document with several labels takes the highest; null labels and ids don't count. The weights
    are fitted on at most ``calibration_rows`` documents, a quarter at most, by models counted
    without these; then the models take all labelled documents.
    """
    options = options or Options()
    spark = docs.sparkSession
    known = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    n_known = known.count()
    if n_known * 64 <= broadcast_limit(spark):
        known = F.broadcast(known)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = F.crc32(F.concat(F.lit("fit"), F.col("id").cast("string")))
    path = new_run_dir(spark, "labelled")
    bound = int(min(1.0, 4 * options.calibration_rows / max(n_known, 1)) * (1 << 32))
    rows.join(known, "id").select("text", "toxic", order.alias("hash")).withColumn("held", F.expr(f"hash % 4 = 0 AND hash < {bound}")).write.parquet(path)
    labelled = spark.read.parquet(path)
    counts = _counts(labelled)
    # without the rows kept out, and with them
    part, whole = (_model(counts, m) for m in (0, 1))
    if part is None:
        return None
    fit = labelled.where("held")
    if {r[0] for r in fit.select("toxic").distinct().collect()} != {0, 1}:
        fit = labelled.where("NOT held")
    chosen = fit.orderBy("hash", "text").limit(options.calibration_rows).select("text", "toxic")

    def measured(batch, found):
        return pa.record_batch([batch.column(1), pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.float64())], names=["toxic", "mean", "told"])

    data = np.array([tuple(r) for r in _measure(chosen, part, "text", measured, "toxic int, mean double, told double").collect()])
    whole.weights = fit_logistic(data[:, 1:], data[:, 0])
    return whole


def _counts(labelled: DataFrame) -> DataFrame:
    """Occurrences and continuations by class of every word, and occurrences of every bigram that keeps some after the discount.

    ``model`` is 0 for what the rows not held out give, 1 for all; ``before`` and ``pair`` are null for words.
    """
    spark = labelled.sparkSession
    n_bytes = labelled.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(32, n_bytes >> 22)

    def bigrams(batches):
        hashes = Hashes()
        held, size = [[], [], [], []], 0
        for batch in batches:
            for text, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[code].append(ids := ids_of(text, hashes))
                size += len(ids)
                if size > FLUSH:
                    yield from _packed(held, buckets)
                    held, size = [[], [], [], []], 0
        yield from _packed(held, buckets)

    def merge(table: pa.Table) -> pa.Table:
        sent = [[np.frombuffer(x, kind) for x in table.column(name).to_pylist()] for name, kind in (("before", "<i8"), ("after", "<i8"), ("times", "<i4"))]
        code = np.repeat(table.column("code").to_numpy(), [len(x) for x in sent[0]])
        before, after, times = map(np.concatenate, sent)
        pair, first, where = np.unique(pair_keys(before, after), return_index=True, return_inverse=True)
        before, after = before[first], after[first]
        each = [np.bincount(where, weights=times * (code == k), minlength=len(pair)).astype(np.int64) for k in range(4)]
        words, of = np.unique(after, return_inverse=True)
        out = []
        for m, counts in enumerate((each[:2], [each[0] + each[2], each[1] + each[3]])):
            sums = [np.bincount(of, weights=x, minlength=len(words)).astype(np.int64) for c in counts for x in (c, c > 0)]
            out.append(_rows(m, None, None, words, sums[0], sums[2], sums[1], sums[3]))
            kept = np.flatnonzero(np.maximum(*counts) > BIGRAM_DISCOUNT)
            out.append(_rows(m, pair[kept], before[kept], after[kept], counts[0][kept], counts[1][kept], None, None))
        return pa.concat_tables(out)

    path = new_run_dir(spark, "counts")
    coded = labelled.select("text", F.expr("toxic + IF(held, 2, 0)").alias("code"))
    sent = coded.mapInArrow(tidy(bigrams), "bucket long, code int, before binary, after binary, times binary")
    sent.groupBy("bucket").applyInArrow(merge, "model int, pair long, before long, word long, ordinary long, toxic long, follows0 long, follows1 long").write.parquet(path)
    return spark.read.parquet(path)


def _rows(model: int, *columns) -> pa.Table:
    n = len(columns[2])
    names = ["pair", "before", "word", "ordinary", "toxic", "follows0", "follows1"]
    return pa.table({"model": pa.array(np.full(n, model), pa.int32())} | {k: pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64()) for k, x in zip(names, columns, strict=True)})


def _packed(held: list[list[np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct bigrams of each class, dealt by their second word."""
    for code, texts in enumerate(held):
        if not texts:
            continue
        before, after = (np.concatenate([x[cut] for x in texts]) for cut in (slice(None, -1), slice(1, None)))
        _, first, times = np.unique(pair_keys(before, after), return_index=True, return_counts=True)
        before, after = before[first], after[first]
        bucket = (mix(after.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((after, bucket))
        bucket = bucket[order]
        at = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
        cut = [pa.array([x[order[a:b]].astype(kind).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()) for x, kind in ((before, "<i8"), (after, "<i8"), (times, "<i4"))]
        yield pa.record_batch([pa.array(bucket[at[:-1]], pa.int64()), pa.array(np.full(len(at) - 1, code), pa.int32()), *cut], names=["bucket", "code", "before", "after", "times"])


def _model(counts: DataFrame, number: int) -> Model | None:
    """What each word and bigram adds to the difference of the log-likelihoods; None without both classes."""
    spark = counts.sparkSession
    counts = counts.where(F.col("model") == number)
    words = counts.where("pair IS NULL").withColumn("own", F.expr(f"ordinary + toxic >= {LEAST} OR toxic >= {LEAST_TOXIC} OR word = {END}"))
    sums = words.agg(
        F.count_if("own").alias("n"),
        *[F.sum(F.when(F.col("word") == END, F.col(c))).alias(f"docs{k}") for k, c in enumerate(("ordinary", "toxic"))],
        *[F.sum(c).alias(f"seen{k}") for k, c in enumerate(("ordinary", "toxic"))],
        *[F.sum(f"follows{k}").alias(f"types{k}") for k in (0, 1)],
        *[F.coalesce(F.sum(F.when(~F.col("own"), F.col(f"follows{k}"))), F.lit(0)).alias(f"rare{k}") for k in (0, 1)],
        *[F.count_if(F.col("own") & (F.col(f"follows{k}") > 0)).alias(f"with{k}") for k in (0, 1)],
    ).first()
    if not sums.docs0 or not sums.docs1:
        return None
    n_words = sums.n + 2
    types = (sums.types0, sums.types1)
    even = min(0.5, EVEN * n_words / min(types))
    shared = (F.col("follows0") + F.col("follows1") + 1) / (sum(types) + n_words)
    shared_rare = (sums.rare0 + sums.rare1 + 1) / (sum(types) + n_words)
    chances = []
    for k in (0, 1):
        spread = DISCOUNT * (sums[f"with{k}"] + (sums[f"rare{k}"] > 0))
        rare = (1 - even) * (max(sums[f"rare{k}"] - DISCOUNT, 0) + spread * shared_rare) / types[k] + even / n_words
        own = (1 - even) * (F.greatest(F.col(f"follows{k}") - DISCOUNT, F.lit(0.0)) + spread * shared) / types[k] + even / n_words
        chances.append((own * ((1 - shared_rare) / (1 - rare))).alias(f"p{k}"))
    vocabulary = words.where("own").select("word", F.col("ordinary").alias("n0"), F.col("toxic").alias("n1"), *chances)
    # the start is never a continuation
    vocabulary = vocabulary.unionByName(spark.range(1).select(F.lit(START).alias("word"), F.lit(sums.docs0).alias("n0"), F.lit(sums.docs1).alias("n1"), F.lit(1.0).alias("p0"), F.lit(1.0).alias("p1")))
    pairs = counts.where("pair IS NOT NULL").select("pair", "before", F.col("word").alias("after"), "ordinary", "toxic")
    pairs = pairs.join(vocabulary.select(F.col("word").alias("before"), "n0", "n1"), "before").join(vocabulary.select(F.col("word").alias("after"), "p0", "p1"), "after")
    least = min(sums.seen0, sums.seen1)
    share = [(F.greatest(F.col(c) - BIGRAM_DISCOUNT * sums[f"seen{k}"] / least, F.lit(0.0)) / (F.col(f"n{k}") + sums[f"seen{k}"] * CONTEXT)).alias(f"share{k}") for k, c in enumerate(("ordinary", "toxic"))]
    path = new_run_dir(spark, "bigrams")
    pairs.select("pair", "before", "p0", "p1", *share).where("share0 > 0 OR share1 > 0").write.parquet(path)
    pairs = spark.read.parquet(path)
    left = pairs.groupBy("before").agg(*[(1 - F.sum(f"share{k}")).alias(f"left{k}") for k in (0, 1)])
    # with p and s the continuation's chance and the bigram's share: log(left1 * p1 + s1) - log(left0 * p0 + s0)
    context = vocabulary.join(left, vocabulary.word == left.before, "left").fillna(1.0, ["left0", "left1"])
    of_words = context.select(F.col("word").alias("key"), F.log(F.col("left1") / F.col("left0")).alias("a"), F.log(F.col("p1") / F.col("p0")).alias("b"))
    with_share = F.expr("ln((left1 * p1 + share1) / (left1 * p1)) - ln((left0 * p0 + share0) / (left0 * p0))")
    of_pairs = pairs.join(left, "before").select(F.col("pair").alias("key"), with_share.alias("a"), F.lit(None).cast("double").alias("b"))
    path = new_run_dir(spark, "model")
    of_words.unionByName(of_pairs).write.parquet(path)
    table = spark.read.parquet(path)
    return Model(table, table.count(), np.zeros(3))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Intercept and weights of a logistic regression, by Newton steps on standardised features."""
    middle, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 0, spread, 1.0)
    z = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge + 1e-9 * np.eye(len(w)), z.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / spread
    return np.concatenate(([w[0] - (slopes * middle).sum()], slopes))


def _measure(docs: DataFrame, model: Model, text_col: str, finish: Callable, schema) -> DataFrame:
    """``finish(batch, differences)`` of all rows: the model is broadcast if small, else asked block by block."""
    spark = docs.sparkSession
    column = docs.columns.index(text_col)

    def texts_of(batch, hashes):
        return [ids_of(x or "", hashes) for x in batch.column(column).to_pylist()]

    # the driver holds it some times over while it is sent
    if model.n_bytes * 4 <= broadcast_limit(spark):
        found = model.table.toArrow()
        keys = found.column("key").to_numpy()
        order = np.argsort(keys)
        sent = spark.sparkContext.broadcast((keys[order], found.column("a").to_numpy()[order], np.nan_to_num(found.column("b").to_numpy())[order]))

        def run(batches):
            hashes, find = Hashes(), finder(*sent.value)
            for batch in batches:
                for part in _pieces(batch, column):
                    yield finish(part, differences(texts_of(part, hashes), find))

        return docs.mapInArrow(tidy(run), schema)

    path = new_run_dir(spark, "blocks")

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _pieces(batch, column):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
                    out.write_batch(part)
                yield pa.record_batch([pa.array([number], pa.int64()), pa.array([sum(map(len, part.column(column).cast(pa.large_binary()).drop_null().to_pylist()))], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "n_bytes", "payload"])
                number += 1

    docs.mapInArrow(pack, "block long, n_bytes long, payload binary").write.option("compression", "none").parquet(path)
    blocks = spark.read.parquet(path)
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = 1 << max(5, int(max(n_bytes, model.n_bytes) >> 22).bit_length())

    def unpacked(payload):
        with pa.ipc.open_stream(payload) as reader:
            return reader.read_next_batch()

    def ask(batches):
        hashes = Hashes()
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = texts_of(unpacked(payload), hashes)
                keys = np.unique(np.concatenate([y for x in ids for y in (x, pair_keys(x[:-1], x[1:]))]))
                bucket = keys & (buckets - 1)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                at = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
                yield pa.record_batch([pa.array(bucket[at[:-1]], pa.int64()), pa.array(np.full(len(at) - 1, block), pa.int64()), pa.array([keys[order[a:b]].astype("<i8").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["bucket", "block", "sent"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy()
        order = np.argsort(keys)
        keys, values = keys[order], np.stack([np.nan_to_num(known.column(x).to_numpy())[order] for x in ("a", "b")], axis=1)
        out = []
        for block, wanted in zip(asked.column("block").to_pylist(), asked.column("sent").to_pylist(), strict=True):
            wanted = np.frombuffer(wanted, "<i8")
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            if hit.any():
                out.append((block, wanted[hit].tobytes(), values[at[hit]].tobytes()))
        return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), "keys": pa.array([x[1] for x in out], pa.binary()), "values": pa.array([x[2] for x in out], pa.binary())})

    def score(batches):
        hashes = Hashes()
        for batch in batches:
            for payload, answers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = unpacked(payload)
                keys = np.frombuffer(b"".join(x["keys"] for x in answers or ()), "<i8")
                values = np.frombuffer(b"".join(x["values"] for x in answers or ()), "<f8").reshape(-1, 2)
                order = np.argsort(keys)
                yield finish(part, differences(texts_of(part, hashes), finder(keys[order], values[order, 0], values[order, 1])))

    asked = blocks.select("block", "payload").mapInArrow(ask, "bucket long, block long, sent binary")
    known = model.table.withColumn("bucket", F.col("key").bitwiseAND(F.lit(buckets - 1).cast("long")))
    answered = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answer, "block long, keys binary, values binary")
    lists = answered.groupBy("block").agg(F.collect_list(F.struct("keys", "values")).alias("answers"))
    return blocks.join(lists, "block", "left").select("payload", "answers").mapInArrow(score, schema)


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most ``BLOCK`` bytes of text, or one row."""
    start, size = 0, 0
    for i, x in enumerate(batch.column(column).to_pylist()):
        n = len(x or "")
        if i > start and size + n > BLOCK:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _scored(docs: DataFrame, model: Model | None, text_col: str, finish: Callable, schema) -> DataFrame:
    if model is None:
        return docs.mapInArrow(lambda batches: (finish(x, [0.0] * x.num_rows) for x in batches), schema)
    a, b, c = map(float, model.weights)

    def run(batch, found):
        return finish(batch, [float(1 / (1 + np.exp(-np.clip(a + b * mean + c * told, -500, 500)))) for mean, told in found])

    return _measure(docs, model, text_col, run, schema)


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1, higher: toxic) and predicted (1 from ``threshold`` on) of every row.

    Whole texts are scored; null texts count as empty and get the score of a text of no words;
    repeated rows get equal scores; without a model all scores are 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def finish(batch, scores):
        return pa.record_batch([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32())], names=["doc_id", "score", "predicted"])

    return _scored(rows, model, "text", finish, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""

    def finish(batch, scores):
        return batch.filter(pa.array([x < threshold for x in scores], pa.bool_()))

    return _scored(docs, model, text_col, finish, docs.schema)
