"""Phrases whose words keep together, from one count of the longest windows.

Every place of a text gives one window: its word and the words that lead on from it within the same
piece, padded where the piece ends. Only these windows are counted. A shorter phrase is the head
of a window, so its occurrences are the windows that begin with it: ROLLUP sums the counted windows by ever
shorter prefixes, down to the words of a language, and no shorter n-grams are made.

Most long windows of a corpus occur once or twice and could be no phrase. Blocks of documents therefore ask first
which of their windows and prefixes reach ``least`` occurrences, by fingerprints (see ``blocks``), and
cut the others down to the longest prefix that does. A cut window still counts for all its prefixes, and
a fingerprint shared by two phrases only spares one from the cut, so every count that is used is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.blocks import ASK_SCHEMA, REPLY_SCHEMA, bucket_bits, cuts, flags, with_answers
from quire.llm.hashing import mix, word_hashes
from quire.session import new_run_dir

#: Stands where a window has no word, or none that makes a phrase often enough; no word is empty.
PAD = ""
#: A byte that UTF-8 doesn't have, for the end of a piece.
END = b"\xff"
#: Letters to lower case, what parts pieces to END, tab to space.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + END * 10 + b" ")
STEP = np.uint64(0x9E3779B97F4A7C15)
#: The score of a phrase whose parts occur nowhere else.
SCALE = 1_000_000
BLOCK_BYTES = 4 << 20
#: Into which the phrases of a language are dealt to find its best.
SHARES = 16
CODEC = "zstd"
BLOCK_SCHEMA = "block long, n_bytes long, lang string, sizes array<long>, payload binary"


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row of sorted columns differs from the one before; the first does."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def count_windows(texts: list[bytes], longest: int) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """The words of some texts, the different windows as columns of word numbers (0: none) in order, and their counts."""
    tokens = END.join([*texts, b""]).translate(PLAIN).replace(END, b" \xff ").split()
    numbers: dict = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[END]  # is number 0
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
    del tokens
    at = np.flatnonzero(ids)
    ids = np.append(ids, np.zeros(longest, np.int32))
    columns = [ids[at]]
    for i in range(1, longest):
        columns.append(np.where(columns[-1] > 0, ids[at + i], 0))
    if len(numbers) ** longest < 1 << 62:
        keys = columns[0].astype(np.int64)
        for c in columns[1:]:
            keys *= len(numbers)
            keys += c
        order = np.argsort(keys)
    else:
        order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    starts = np.flatnonzero(_changes(columns))
    return list(numbers)[1:], [c[starts] for c in columns], np.diff(np.append(starts, len(at)))


def window_blocks(docs: DataFrame, longest: int, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the counted windows of some megabytes of whole texts of a language a row, and return that table."""
    spark = docs.sparkSession
    path = new_run_dir(spark, "windows")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)

        def block(lang: str) -> pa.RecordBatch:
            nonlocal number
            words, columns, counts = count_windows(held.pop(lang), longest)
            words = b" ".join(words)
            # Of the sorted first words the differences, which are mostly 0.
            parts = [words, np.diff(columns[0], prepend=0).astype("<u4").tobytes(), *(c.astype("<u4").tobytes() for c in columns[1:]), counts.astype("<u4").tobytes()]
            packed = pa.compress(b"".join(parts), CODEC, asbytes=True)
            row = [number, sizes.pop(lang), lang, [len(words), len(counts)], packed]
            number += 1
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
            return pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[lang].append(text.as_py())
                sizes[lang] += len(held[lang][-1]) + 1
                if sizes[lang] >= block_bytes:
                    yield block(lang)
        for lang in list(held):
            yield block(lang)

    rows.mapInArrow(to_blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


class Block:
    """A row of :func:`window_blocks`: fingerprints of the phrases that begin its windows."""

    def __init__(self, row: dict, longest: int):
        size, n = row["sizes"]
        data = pa.decompress(row["payload"], size + 4 * n * (longest + 1), CODEC, asbytes=True)
        words = data[:size]
        self.words = words.split(b" ") if words else []
        *columns, counts = np.frombuffer(data, "<u4", offset=size).reshape(longest + 1, n)
        self.f = counts.astype(np.int64)
        self.columns = [np.cumsum(columns[0], dtype=np.int64), *(c.astype(np.int64) for c in columns[1:])]
        hashes = np.concatenate((np.zeros(1, np.uint64), word_hashes(words) if words else np.zeros(0, np.uint64)))
        language = word_hashes(row["lang"].replace(" ", "\n").encode() or b"\n")[0]
        prints, counts, self.places = [], [], []
        total = 0
        for n in range(2, longest + 1):
            new = _changes(self.columns[:n])
            starts = np.flatnonzero(new)
            found = np.full(len(starts), language + np.uint64(n))
            for c in self.columns[:n]:
                found = mix((found + hashes[c[starts]]) * STEP)
            whole = self.columns[n - 1][starts] > 0
            place = np.where(whole, total + np.cumsum(whole) - 1, -1)
            self.places.append(place[np.cumsum(new) - 1])  # of each window's phrase of n words, -1 where it has none
            prints.append(found[whole])
            counts.append((np.add.reduceat(self.f, starts) if len(starts) else self.f)[whole])
            total += int(whole.sum())
        every = np.concatenate(prints)
        self.order = np.argsort(every)
        self.prints = every[self.order]
        self.counts = np.concatenate(counts)[self.order]

    def cut(self, enough: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The different windows once they end before the first phrase that isn't frequent; ``enough`` as ``prints``."""
        kept = np.zeros(len(enough) + 1, bool)
        kept[self.order] = enough
        columns, stays = [self.columns[0]], True
        for place, column in zip(self.places, self.columns[1:], strict=True):
            stays = stays & kept[place]
            columns.append(np.where(stays, column, 0))
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        starts = np.flatnonzero(_changes(columns))
        return [c[starts] for c in columns], np.add.reduceat(self.f[order], starts) if len(starts) else self.f


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one after the other; a batch may hold many blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _kind(least: int) -> np.dtype:
    return np.dtype("u1" if least < 256 else "<u4")


def _ask(blocks: DataFrame, longest: int, least: int, bits: int) -> DataFrame:
    """Rows (bucket, block, sent): fingerprints in order, then their counts, which need not go beyond ``least``."""

    def send(batches):
        for row in _each(batches):
            block = Block(row, longest)
            if not len(block.prints):
                continue
            buckets, at = cuts(block.prints, bits)
            short = ((block.prints << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
            few = np.minimum(block.counts, least).astype(_kind(least))
            yield pa.record_batch(
                [pa.array(buckets, pa.int64()), pa.array(np.full(len(buckets), row["block"]), pa.int64()),
                 pa.array([short[a:b].tobytes() + few[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                names=["bucket", "block", "sent"],
            )

    return blocks.mapInArrow(send, ASK_SCHEMA)


def _answer(asked: DataFrame, least: int) -> DataFrame:
    """A bit for every fingerprint sent: whether all blocks together have it ``least`` times."""
    kind = _kind(least)

    def reply(table: pa.Table) -> pa.Table:
        sent, counts = [], []
        for x in table.column("sent").to_pylist():
            n = len(x) // (4 + kind.itemsize)
            sent.append(np.frombuffer(x, "<u4", n))
            counts.append(np.frombuffer(x, kind, n, 4 * n))
        every = np.concatenate(sent)
        order = np.argsort(every)
        new = _changes([every[order]])
        enough = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), np.flatnonzero(new)) >= least
        hit = np.empty(len(every), bool)
        hit[order] = enough[np.cumsum(new) - 1]
        ends = np.cumsum([len(x) for x in sent])
        out = [(b, np.packbits(hit[e - len(x):e]).tobytes()) for b, x, e in zip(table.column("block").to_pylist(), sent, ends, strict=True) if hit[e - len(x):e].any()]
        return pa.table({
            "block": pa.array([x[0] for x in out], pa.int64()),
            "bucket": pa.array([table.column("bucket")[0].as_py()] * len(out), pa.int64()),
            "answer": pa.array([x[1] for x in out], pa.binary()),
        })

    return asked.groupBy("bucket").applyInArrow(reply, REPLY_SCHEMA)


def _cut(blocks: DataFrame, longest: int, bits: int) -> DataFrame:
    """The windows of every block, cut down to what is frequent, with their counts in the block."""
    names = [f"w{i}" for i in range(1, longest + 1)]

    def send(batches) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = Block(row, longest)
            columns, f = block.cut(flags(block.prints, bits, row["answers"]))
            words = pa.array([PAD.encode(), *block.words], pa.binary()).cast(pa.string())
            yield pa.record_batch(
                [pa.array([row["lang"]] * len(f), pa.string()), *(words.take(pa.array(c)) for c in columns), pa.array(f, pa.int64())],
                names=["lang", *names, "f"],
            )

    return blocks.mapInArrow(send, ", ".join(["lang string", *(f"{w} string" for w in names), "f long"]))


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts of the longest phrases, and what ROLLUP makes of all windows for shorter ones.

    Both have ``lang``, ``w1`` … and ``f``, for the phrases that occur ``least`` times. In the second, nulls stand
    after a phrase's words, and for each language the row without words counts all of its words.
    """
    spark = docs.sparkSession
    names = [f"w{i}" for i in range(1, longest + 1)]
    blocks = window_blocks(docs, longest, text_col, lang_col)
    bits = bucket_bits(blocks, 0.1 * longest, least=5)
    answered = with_answers(blocks, _answer(_ask(blocks, longest, least, bits), least))
    path = new_run_dir(spark, "counted")
    _cut(answered, longest, bits).groupBy("lang", *names).agg(F.sum("f").alias("f")).write.parquet(path)
    counted = spark.read.parquet(path)
    shorter = counted.rollup("lang", *names[:-1]).agg(F.sum("f").alias("f"))
    shorter = shorter.where(F.col("lang").isNotNull() & ((F.col("f") >= least) | F.col("w1").isNull()))
    for w in names[:-1]:
        shorter = shorter.where(F.col(w).isNull() | (F.col(w) != PAD))
    return counted.where((F.col(names[-1]) != PAD) & (F.col("f") >= least)), shorter


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, best: int = 2000, absorb: int = 50, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words that occurs ``a`` >= ``least`` times is cut after its first k words into
    parts with ``l`` and ``r`` occurrences; its score is floor(SCALE * a * a / (l * r)) for the cut where that is lowest (the
    first such). Phrases inside a longer one that has ``absorb`` hundredths of their occurrences are dropped.
    ``n`` counts the words of the language. Null texts are empty, null languages ``und``; rows that repeat
    count again; without words there are no rows. Other columns are ignored.
    """
    counted, shorter = phrase_counts(docs, longest, least, text_col, lang_col)
    names = [f"w{i}" for i in range(1, longest + 1)]
    path = new_run_dir(docs.sparkSession, "phrases")
    phrase = F.concat_ws(" ", *names)
    size = sum(F.col(w).isNotNull().cast("int") for w in names)
    every = shorter.withColumn(names[-1], F.lit(None).cast("string")).unionByName(counted)
    every.select("lang", F.array_compact(F.array(*names)).alias("words"), size.alias("size"), phrase.alias("phrase"), "f").write.partitionBy("size").parquet(path)
    table = docs.sparkSession.read.schema("lang string, words array<string>, phrase string, f long, size int").parquet(path)
    totals = table.where("size = 0").select("lang", F.col("f").alias("n"))
    parts = table.where("size > 0").select("lang", "size", "phrase", "f")
    found = table.where("size > 1").select("lang", "words", "size", "phrase", F.col("f").alias("a"))

    cut = found.select("lang", "phrase", "size", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        cut = cut.join(parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    # decimal(38) holds the products up to 10^15 occurrences of a phrase
    a, left, right = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    scored = cut.withColumn("score", F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"), (left * right).cast("decimal(38,0)")))
    scored = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x")).select("lang", "phrase", "x.*")

    inside = found.where("size > 2").select(
        "lang", "words", "size", "a", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.struct(i.alias("i"), n.alias("n")))))).alias("at")
    ).select("lang", F.array_join(F.slice("words", F.col("at.i"), F.col("at.n")), " ").alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorb))
    # A language may have most phrases: the best of each share of them first, so that few rows of it meet in one task.
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    shares = kept.withColumn("share", F.pmod(F.hash("phrase"), F.lit(SHARES)))
    leading = shares.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= best)
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
