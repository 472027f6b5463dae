"""Token ids of a corpus in files: one concatenated array, document boundaries in Elias-Fano code.

A file is a row of the written table: its number (files in ascending order hold ascending ids),
the ids side by side in as few bytes each as the vocabulary needs, the boundaries of its
documents and their doc_ids, both in Elias-Fano code.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm import elias_fano
from quire.session import broadcast_limit

FILE_SCHEMA = "file long, width int, n_docs long, n_nulls long, first_id long, n_ids long, ids binary, bounds binary, doc_ids binary"
FILE_BYTES = 8 << 20
#: Text coded at a time.
CHUNK_BYTES = 4 << 20
#: Coded pieces a worker remembers before it forgets those not met since it last forgot some.
REMEMBERED = 500_000
SPACE = re.compile(r"\s")
OTHER_SPACE = re.compile(r"[^\S\n]")
#: A space that other white space stands beside begins no piece of its own.
WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN = rf"^ | $| {WHITE}|{WHITE} "
PIECE = re.compile(r"(?<=\S)(?= \S)")
#: Latin letters, and marks after them that begin no contraction: two pieces by the rule of byte-level vocabularies.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")

_coders: dict[str, Coder] = {}


class Coder:
    """Ids of whole texts.

    The splitting rule of byte-level vocabularies always begins a new piece at a space between
    two other characters, so equal pieces are coded once and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model, splitter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.letters: dict[int, str] | None = None
        if (isinstance(splitter, pre_tokenizers.ByteLevel) and splitter.use_regex and not splitter.add_prefix_space
                and isinstance(self.model, models.BPE) and self.tokenizer.normalizer is None):
            self.letters = {ord(x): splitter.pre_tokenize_str(x)[0][0] for x in [" ", *re.findall(f"[{LETTERS}]", "".join(map(chr, range(0x250))))]}
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.feed = self._direct("\n")
        self.line = int(np.frombuffer(self.feed, self.dtype)[0])
        self.after: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, dict[str, bytes]] = {"": {}, " ": {}}

    def _learn(self, known: dict, wanted: Iterable[str], before: str) -> None:
        """Add the ids of the wanted pieces, none of them known yet, each coded as it is after ``before``.

        A line feed between two other characters is a piece of its own, and so separates others.
        """
        old, new = self.older[before], []
        for x in wanted:
            if x in old:
                known[x] = old[x]
            else:
                new.append(x)
        lines = {x: x.split("\n") for x in new if "\n" in x}
        lines = {x: parts for x, parts in lines.items() if all(parts) and not OTHER_SPACE.search(x)}
        if lines:
            self._learn(self.pieces, {p for parts in lines.values() for p in parts[not not before:] if p not in self.pieces}, "")
            self._learn(known, {parts[0] for parts in lines.values() if parts[0] not in known}, before)
            for x, parts in lines.items():
                known[x] = known[parts[0]] + b"".join(self.feed + self.pieces[p] for p in parts[1:])
            new = [x for x in new if x not in lines]
        if self.letters:
            new = self._learn_plain(known, new, before)
        plain = [x for x in new if x]
        if SPACE.search(" ".join(plain).replace(" ", "")):
            plain = [x for x in plain if not SPACE.search(x)]
        for i in range(0, len(plain), 4096):
            some = plain[i:i + 4096]
            joined = before + f"\n{before}".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.append(np.flatnonzero(ids == self.line), len(ids)).tolist()
            raw, width, at = ids.tobytes(), int(self.dtype[2]), 0
            if len(ends) != len(some):
                raise ValueError("the vocabulary doesn't keep line feeds apart")
            for piece, end in zip(some, ends, strict=True):
                known[piece] = raw[at * width:end * width]
                at = end + 1
        for x in new:
            if x not in known:
                known[x] = self._direct(before + x)

    def _learn_plain(self, known: dict, new: list[str], before: str) -> list[str]:
        """Of ``new``, learn those of letters and marks: the letters need no splitting, the vocabulary's model codes them as they are.

        The others are returned.
        """
        plain: list[str] = []
        bare: list[str] = []
        after: list[str] = []
        others: list[str] = []
        words: dict[str, bytes] = {}
        for x in new:
            if m := PLAIN.fullmatch(x):
                word, marks = m.groups()
                plain.append(x)
                bare.append(word)
                after.append(marks)
                if not marks or word not in known:
                    words[word] = b""
            else:
                others.append(x)
        if not plain:
            return others
        self._learn(self.pieces, {marks for marks in after if marks and marks not in self.pieces}, "")
        first = before.translate(self.letters)
        ids: list[int] = []
        ends = [0]
        for word in words:
            ids += [x.id for x in self.model.tokenize(first + (word if word.isascii() else word.translate(self.letters)))]
            ends.append(len(ids))
        raw, width = np.array(ids, dtype=self.dtype).tobytes(), int(self.dtype[2])
        for word, a, b in zip(words, ends, ends[1:], strict=False):
            words[word] = raw[a * width:b * width]
        for x, word, marks in zip(plain, bare, after, strict=True):
            known[x] = (words.get(word) or known[word]) + self.pieces[marks] if marks else words[word]
        return others

    def _codes(self, known: dict, pieces: list[str], before: str) -> list[bytes]:
        """The ids of each piece as it is coded after ``before``; ``known`` gets those it lacks."""
        codes = list(map(known.get, pieces))
        new = [i for i, code in enumerate(codes) if code is None]
        if new:
            self._learn(known, [pieces[i] for i in new], before)
            for i in new:
                codes[i] = known[pieces[i]]
        return codes

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, side by side."""
        whole = pc.match_substring_regex(texts, UNEVEN)
        for x in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, x))
        whole = whole.to_numpy(zero_copy_only=False)
        out = [b""] * len(texts)
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._uneven(texts[i].as_py())
        even = np.flatnonzero(~whole)
        if len(even):
            for i, code in zip(even.tolist(), self._even(texts.take(pa.array(even))), strict=True):
                out[i] = code
        if len(self.after) + len(self.pieces) > REMEMBERED:
            self.older = {"": self.pieces, " ": self.after}
            self.pieces, self.after = {}, {}
        return out

    def _uneven(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self._direct(text)
        return b"".join(self._codes(self.pieces, PIECE.split(text), ""))

    def _even(self, texts: pa.Array) -> list[bytes]:
        """Texts in which every space begins a piece: all words are numbered, each different one is coded once."""
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        words = split.flatten()
        begin = words.take(pa.array(first)).to_pylist()
        coded = words.dictionary_encode()
        number = coded.indices.to_numpy()
        later = np.ones(len(number), dtype=bool)
        later[first] = False
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[number[later]] = True
        different = coded.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        number = (np.cumsum(used) - 1)[number]
        number[first] = len(different) + np.arange(len(begin))
        codes = self._codes(self.after, different, " ") + self._codes(self.pieces, begin, "")
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // int(self.dtype[2])
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(codes), dtype=self.dtype)
        n = sizes[number]
        ends = np.cumsum(n)
        ids = ids[np.repeat(starts[number] - (ends - n), n) + np.arange(ends[-1])]
        cuts = (ends - n)[first].tolist() + [len(ids)]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def _coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.repartitionByRange(F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"), "text")


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending order of doc_id.

    Null texts count as empty and give the end id alone. Null doc_ids come first; rows with the same
    doc_id come in the order of their texts. An empty table gives no files. Other columns are ignored.
    """

    def to_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer_file)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        number = TaskContext.get().partitionId() << 32
        keys: list = []
        codes: list[bytes] = []
        size = 0
        for batch in batches:
            at = 0
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            while at < len(batch):
                stop, some = at, 0
                while stop < len(batch) and (stop == at or some < CHUNK_BYTES):
                    some += int(sizes[stop])
                    stop += 1
                part = batch.slice(at, stop - at)
                keys += part.column(0).to_pylist()
                for code in coder.encode(part.column(1)):
                    codes.append(code + end)
                    size += len(code)
                at = stop
                if size >= FILE_BYTES:
                    yield _file(number, keys, codes, coder.dtype)
                    number, keys, codes, size = number + 1, [], [], 0
        if keys:
            yield _file(number, keys, codes, coder.dtype)

    _ordered(docs, id_col, text_col).mapInArrow(to_files, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def _file(number: int, keys: list, codes: list[bytes], dtype: str) -> pa.RecordBatch:
    width = int(dtype[2])
    ends = np.cumsum([len(x) // width for x in codes])
    known = np.array([x for x in keys if x is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    apart = (known.astype(np.uint64) - np.uint64(first & (1 << 64) - 1)) if len(known) else np.zeros(0, np.uint64)
    row = [number, width, len(keys), len(keys) - len(known), first, int(ends[-1]), b"".join(codes), elias_fano.encode(ends), elias_fano.encode(apart)]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3]
    return pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in FILE_SCHEMA.split(", ")])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian 32-bit numbers) and, if asked for, ids (an array of int)."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    starts = files.select("file", F.coalesce(F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    if starts.count() * 16 <= broadcast_limit(spark):
        starts = F.broadcast(starts)

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}")
                ends = elias_fano.Reader(row["bounds"]).all().astype(np.int64)
                begin = np.concatenate(([0], ends[:-1]))
                keys = elias_fano.Reader(row["doc_ids"]).all() + np.uint64(row["first_id"] & (1 << 64) - 1)
                own = [ids[a:b].astype("<u4") for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
                columns = [
                    pa.array([None] * row["n_nulls"] + keys.astype(np.int64).tolist(), pa.int64()), pa.array(begin + row["before"], pa.int64()),
                    pa.array(ends - begin, pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return files.join(starts, "file").mapInArrow(documents, schema)


def token_at(file_row, i: int) -> np.ndarray:
    """Ids of the i-th document of one file, found by select, without decoding the others' bounds."""
    bounds = elias_fano.Reader(file_row["bounds"])
    begin = bounds[i - 1] if i else 0
    return np.frombuffer(file_row["ids"], dtype=f"<u{file_row['width']}")[begin:bounds[i]]
