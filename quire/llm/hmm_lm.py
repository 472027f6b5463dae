"""Text likelihoods from a hidden Markov model trained by Baum-Welch.

A word belongs to a class: a frequent word to that of its hash, the others to that of their ending. The
states of the chain emit classes, a class emits its words by their counts, and the end of a text
is a class of its own, so all texts together have probability one. Word counts are exact and cover
every training text; each round of Baum-Welch adds up expected counts over all of
them, one sum per task. Only the model, whose size the options fix, comes to the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import blocks as B
from quire.llm.hashing import mix, word_hashes
from quire.llm.minhash_dedup import UPPER
from quire.session import new_run_dir

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: The end of a text, as a word.
END = np.uint64(0xE0D0F0E0D0F0E0D1)
CHUNK_BYTES = 1 << 20
SLICE = 4096


@dataclass
class Options:
    states: int = 8
    rounds: int = 4
    #: Bits of the classes of frequent words, and of those of endings.
    word_bits: int = 15
    ending_bits: int = 15
    #: Count from which a word is frequent.
    frequent: int = 30
    #: Texts are trained on in runs of so many words.
    run: int = 256
    #: Training texts, those of least hash, from which the starting point is made.
    start_texts: int = 300
    #: Words' worth of the common distribution that is added to each state's emissions.
    prior: float = 2000.0
    block_bytes: int = 8 << 20
    seed: int = 11

    @property
    def classes(self) -> int:
        return (1 << self.word_bits) + (1 << self.ending_bits) + 1


@dataclass
class Model:
    start: np.ndarray
    within: np.ndarray  # the states in which a later run begins
    moves: np.ndarray
    emits: np.ndarray  # class, state


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending of each token, texts one after the other with their ends, and the tokens per text."""
    hashes, endings, counts = [], [], []
    at = 0
    while at < len(texts):
        stop, size, some = at, 0, []
        while stop < len(texts) and (stop == at or size < CHUNK_BYTES):
            words = b" ".join(texts[stop].translate(UPPER).split())
            some.append(words)
            size += len(words)
            stop += 1
        own = [w.count(b" ") + 1 if w else 0 for w in some]
        joined = b" ".join(w for w in some if w)
        value = word_hashes(joined)
        data = np.concatenate(([32, 32, 32], np.frombuffer(joined, np.uint8))).astype(np.uint64)
        last = np.append(np.flatnonzero(data[3:] == 32), len(joined)) + 2 if joined else np.zeros(0, np.int64)
        a, b, c = data[last], data[last - 1], data[last - 2]
        b = np.where(a == 32, 32, b)
        c = np.where(b == 32, 32, c)
        tail = mix(a << np.uint64(16) | b << np.uint64(8) | c)
        place = np.cumsum(own)
        hashes.append(np.insert(value, place, END))
        endings.append(np.insert(tail, place, END))
        counts += [n + 1 for n in own]
        at = stop
    none = np.zeros(0, np.uint64)
    return np.concatenate(hashes or [none]), np.concatenate(endings or [none]), np.array(counts, np.int64)


def classes_of(hashes: np.ndarray, endings: np.ndarray, counts: np.ndarray, options: Options) -> np.ndarray:
    frequent = (hashes >> np.uint64(64 - options.word_bits)).astype(np.int64)
    rare = (endings >> np.uint64(64 - options.ending_bits)).astype(np.int64) + (1 << options.word_bits)
    return np.where(hashes == END, options.classes - 1, np.where(counts >= options.frequent, frequent, rare))


def hmm_scores(docs: DataFrame, options: Options | None = None, modulus: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every whole text.

    Trains on rows whose crc32(doc_id as text) modulo ``modulus`` isn't ``held_out``, null ids
    among them. Texts are lower-cased in A-Z, tokens are the words ``[^\\x20\\x09-\\x0D]+`` and one
    end; null texts count as empty. base_score is the add-one unigram score. Repeated rows
    count and are scored apart; an empty table gives no rows; other columns are ignored. Training
    runs are at most ``options.run`` tokens long; scores are exact for the trained model.
    """
    options = options or Options()
    spark = docs.sparkSession
    blocks = B.pack(docs, id_col, text_col, options.block_bytes)
    bits = B.bucket_bits(blocks, 1 / 30)

    def trains(ids):
        return np.array([x is None or zlib.crc32(str(x).encode()) % modulus != held_out for x in ids], dtype=bool)

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, texts = B.unpack(row["payload"])
                hashes, endings, n = tokens(texts)
                values, first, where = np.unique(hashes, return_index=True, return_inverse=True)
                times = np.bincount(where, weights=np.repeat(trains(ids), n), minlength=len(values)).astype("<u4")
                ends = (endings[first] >> np.uint64(64 - options.ending_bits)).astype("<u4")
                buckets, at = B.cuts(values, bits)
                sent = [b"".join(x[a:b].tobytes() for x in (values.astype("<u8"), times, ends)) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.record_batch([pa.array(buckets, pa.int64()), pa.array([row["block"]] * len(sent), pa.int64()), pa.array(sent, pa.binary())], names=["bucket", "block", "sent"])

    def count(table: pa.Table) -> pa.Table:
        parts = []
        for x in table.column("sent").to_pylist():
            n = len(x) // 16
            parts.append((np.frombuffer(x, "<u8", n), np.frombuffer(x, "<u4", n, 8 * n), np.frombuffer(x, "<u4", n, 12 * n)))
        values, first, where = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([p[1] for p in parts]).astype(np.float64)).astype(np.uint64)
        ends = np.concatenate([p[2] for p in parts])[first].astype(np.uint64) << np.uint64(64 - options.ending_bits)
        of = classes_of(values, ends, total, options)[total > 0]
        held = np.bincount(of, weights=total[total > 0].astype(np.float64), minlength=options.classes)
        kinds = np.bincount(of, minlength=options.classes)
        some = np.flatnonzero(kinds)
        stats = np.array([some, held[some], kinds[some]], dtype="<i8").tobytes()
        cut = np.cumsum([0] + [len(p[0]) for p in parts])
        press = zstandard.ZstdCompressor(level=1)
        answers = [press.compress(total[where[a:b]].astype("<u8").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"), "answer": pa.array(answers, pa.binary()),
            "stats": pa.array([stats] + [None] * (len(parts) - 1), pa.binary()),
        })

    asked = blocks.select("block", "payload").mapInArrow(send, B.ASK_SCHEMA)
    path = new_run_dir(spark, "counts")
    asked.groupBy("bucket").applyInArrow(count, B.REPLY_SCHEMA + ", stats binary").write.parquet(path)
    replies = spark.read.parquet(path)
    held, kinds = _class_counts(replies.where("stats IS NOT NULL").select("stats"), options)
    n_train, n_kinds = int(held.sum()), int(kinds.sum())
    within_class = np.log10(held + kinds + 1)
    base = np.log10(float(n_train + n_kinds + 1))

    def code(batches):
        """Classes and known tokens of each text, and the scores that need no model."""
        for batch in batches:
            for row in batch.to_pylist():
                ids, texts = B.unpack(row["payload"])
                hashes, endings, n = tokens(texts)
                values, where = np.unique(hashes, return_inverse=True)
                total = np.zeros(len(values), np.uint64)
                buckets, at = B.cuts(values, bits)
                place = dict(zip(buckets.tolist(), range(len(buckets)), strict=True))
                for x in row["answers"] or []:
                    i = place[x["bucket"]]
                    total[at[i]:at[i + 1]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(x["answer"]), "<u8")
                own = total[where]
                of = classes_of(hashes, endings, own, options)
                first = np.cumsum(n) - n
                logs = np.log10(own.astype(np.float64) + 1)
                sums = [np.add.reduceat(x, first) if len(n) else x for x in (logs, within_class[of], (own > 0).astype(np.int64))]
                yield pa.record_batch(
                    [pa.array([ids], pa.list_(pa.int64())), pa.array([trains(ids).tolist()], pa.list_(pa.bool_())), pa.array([n]), pa.array([sums[2]]),
                     pa.array([sums[0] - n * base]), pa.array([sums[0] - sums[1]]), pa.array([zstandard.ZstdCompressor(level=1).compress(of.astype("<u4").tobytes())], pa.binary())],
                    names=["ids", "trains", "n", "known", "base", "inner", "codes"],
                )

    coded = "ids array<long>, trains array<boolean>, n array<long>, known array<long>, base array<double>, inner array<double>, codes binary"
    path = new_run_dir(spark, "codes")
    B.with_answers(blocks.select("block", "payload"), replies).select("payload", "answers").mapInArrow(code, coded).write.option("compression", "none").parquet(path)
    codes = spark.read.schema(coded).parquet(path)
    model = train(codes, held, options)
    sent = spark.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.array(row["n"], np.int64)
                logs = forward(sent.value, codes_of(row), n) / np.log(10) + np.array(row["inner"])
                held_rows = [not x for x in row["trains"]]
                yield pa.record_batch(
                    [pa.array(row["ids"], pa.int64()), pa.array(held_rows, pa.bool_()), pa.array(n), pa.array(row["known"], pa.int64()), pa.array([n_train] * len(n), pa.int64()),
                     pa.array(row["base"], pa.float64()), pa.array(logs, pa.float64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return codes.mapInArrow(score, SCORES)


def codes_of(row) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row["codes"]), "<u4").astype(np.int64)


def _class_counts(stats: DataFrame, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words of each class."""

    def opened(batches):
        total = np.zeros((2, options.classes), np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                some = np.frombuffer(x, "<i8").reshape(3, -1)
                np.add.at(total[0], some[0], some[1])
                np.add.at(total[1], some[0], some[2])
        some = np.flatnonzero(total[1])
        yield pa.record_batch([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["class", "held", "kinds"])

    out = np.zeros((2, options.classes), np.float64)
    for r in stats.mapInArrow(opened, "class long, held long, kinds long").groupBy("class").agg(F.sum("held").alias("held"), F.sum("kinds").alias("kinds")).collect():
        out[:, r["class"]] = r["held"], r["kinds"]
    return out[0], out[1]


def _start(codes: DataFrame, common: np.ndarray, options: Options) -> Model:
    """States that emit like clusters of some training texts and seldom change."""
    k = options.states
    size = 2048

    def some(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, at = codes_of(row), 0
                for key, n, use in zip(row["ids"], row["n"], row["trains"], strict=True):
                    if use and n > 20:
                        order = zlib.crc32(f"{options.seed}:{key}".encode())
                        yield pa.record_batch([pa.array([order], pa.int64()), pa.array([own[at:at + n].astype("<u4").tobytes()], pa.binary())], names=["hash", "codes"])
                    at += n

    rng = np.random.default_rng(options.seed)
    emits = common[:, None] * np.exp(0.1 * rng.standard_normal((options.classes, k)))
    texts = [np.frombuffer(r.codes, "<u4") for r in codes.mapInArrow(some, "hash long, codes binary").orderBy("hash", "codes").limit(options.start_texts).collect()]
    if texts:
        # rare classes weigh more; the end and the commonest words say little
        rarity = np.log(1 / np.maximum(common, 1e-12))
        bags = np.array([np.bincount(mix(x.astype(np.uint64)) % np.uint64(size), weights=rarity[x], minlength=size) for x in texts])
        bags = np.sqrt(bags)
        bags /= np.linalg.norm(bags, axis=1, keepdims=True)
        centres = bags[:1]
        while len(centres) < min(k, len(bags)):
            centres = np.vstack([centres, bags[(bags @ centres.T).max(axis=1).argmin()]])
        for _ in range(15):
            of = (bags @ centres.T).argmax(axis=1)
            centres = np.array([bags[of == i].sum(axis=0) if (of == i).any() else centres[i] for i in range(len(centres))])
            centres /= np.linalg.norm(centres, axis=1, keepdims=True)
        of = (bags @ centres.T).argmax(axis=1)
        for i in range(len(centres)):
            found = np.bincount(np.concatenate([x for x, y in zip(texts, of, strict=True) if y == i] or [np.zeros(0, np.int64)]).astype(np.int64), minlength=options.classes)
            emits[:, i] = found + emits[:, i] * options.prior
    moves = np.full((k, k), 0.05 / max(k - 1, 1))
    np.fill_diagonal(moves, 0.95)
    return Model(np.full(k, 1 / k), np.full(k, 1 / k), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def train(codes: DataFrame, held: np.ndarray, options: Options) -> Model:
    """Rounds of Baum-Welch over all training texts."""
    spark = codes.sparkSession
    common = (held + 1) / (held + 1).sum()
    model = _start(codes, common, options)
    k = options.states
    for _ in range(options.rounds):
        sent = spark.sparkContext.broadcast(model)

        def expect(batches, sent=sent):
            total = np.zeros((options.classes + k + 3) * k)
            for batch in batches:
                for row in batch.to_pylist():
                    add_expected(total, sent.value, codes_of(row), np.array(row["n"], np.int64), np.array(row["trains"], bool), options)
            for at in range(0, len(total), SLICE):
                if total[at:at + SLICE].any():
                    yield pa.record_batch([pa.array([at // SLICE], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(total[at:at + SLICE].astype("<f4").tobytes())], pa.binary())], names=["slice", "sums"])

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    own = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), "<f4").astype(np.float64)
                    sums[at] = sums[at] + own if at in sums else own
            yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "sums"])

        parts = codes.select("n", "trains", "codes").mapInArrow(expect, "slice long, sums binary").repartition("slice").mapInArrow(add, "slice long, sums binary").collect()
        sent.destroy()
        total = np.zeros((options.classes + k + 3) * k)
        for r in parts:
            own = np.frombuffer(r.sums, np.float64)
            total[r.slice * SLICE:r.slice * SLICE + len(own)] = own
        total = total.reshape(-1, k)
        emits = total[:options.classes] + options.prior * common[:, None]
        moves = total[options.classes:options.classes + k] + 1.0
        start, within = total[options.classes + k] + 1.0, total[options.classes + k + 1] + 1.0
        model = Model(start / start.sum(), within / within.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
    return model


def add_expected(total: np.ndarray, model: Model, codes: np.ndarray, n: np.ndarray, trains: np.ndarray, options: Options) -> None:
    """Add the expected counts of the training texts, cut into runs: emissions, moves, starts, and the log-likelihood."""
    k = options.states
    first = np.cumsum(n) - n
    runs = -(-n // options.run) * trains
    text = np.repeat(np.arange(len(n)), runs)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = first[text] + nth * options.run
    size = np.minimum(options.run, n[text] - nth * options.run)
    for at in range(0, len(text), 2048):
        some = slice(at, at + 2048)
        _expect_runs(total.reshape(-1, k), model, codes, start[some], size[some], nth[some] == 0, options.classes)


def _expect_runs(total, model, codes, start, size, begins, classes):
    order = np.argsort(-size, kind="stable")
    start, size, begins = start[order], size[order], begins[order]
    steps, k = int(size[0]), len(model.start)
    live = np.searchsorted(-size, -np.arange(steps), "left")  # runs longer than t
    offset = np.concatenate(([0], np.cumsum(live)))
    seen = np.concatenate([codes[start[:m] + t] for t, m in enumerate(live)])
    emit = model.emits[seen]
    alpha = np.empty((offset[-1], k))
    scale = np.empty(offset[-1])
    now = np.where(begins[:, None], model.start, model.within) * emit[:live[0]]
    for t, m in enumerate(live):
        if t:
            now = (now[:m] @ model.moves) * emit[offset[t]:offset[t + 1]]
        s = now.sum(axis=1)
        now /= s[:, None]
        alpha[offset[t]:offset[t + 1]] = now
        scale[offset[t]:offset[t + 1]] = s
    beta = np.ones((0, k))
    moves = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        m = live[t]
        own = np.ones((m, k))
        if len(beta):
            later = beta * emit[offset[t + 1]:offset[t + 2]] / scale[offset[t + 1]:offset[t + 2], None]
            moves += alpha[offset[t]:offset[t] + len(later)].T @ later
            own[:len(later)] = later @ model.moves.T
        beta = own
        alpha[offset[t]:offset[t + 1]] *= beta
    for i in range(k):
        total[:classes, i] += np.bincount(seen, weights=alpha[:, i], minlength=classes)
    total[classes:classes + k] += moves * model.moves
    total[classes + k] += alpha[:live[0]][begins].sum(axis=0)
    total[classes + k + 1] += alpha[:live[0]][~begins].sum(axis=0)
    total[classes + k + 2, 0] += np.log(scale).sum()


def forward(model: Model, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each whole text, by the scaled forward recursion."""
    order = np.argsort(-n, kind="stable")
    first = (np.cumsum(n) - n)[order]
    size = n[order]
    logs = np.zeros(len(n))
    if not len(n):
        return logs
    now = model.start * model.emits[codes[first]]
    ends = len(size)
    turns = np.searchsorted(-size, -np.arange(int(size[0])), "left")
    for t in range(int(size[0])):
        if t:
            if turns[t] < ends:
                ends = int(turns[t])
                now = now[:ends]
            now = (now @ model.moves) * model.emits[codes[first[:ends] + t]]
        s = now.sum(axis=1)
        now /= s[:, None]
        logs[:ends] += np.log(s)
    out = np.empty(len(n))
    out[order] = logs
    return out
