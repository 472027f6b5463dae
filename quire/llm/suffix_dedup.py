"""Removal of byte strings that an earlier document holds, by groups of suffixes with equal heads.

A string of 50 bytes is removed from a document if a document of smaller id holds it too. No
longest-previous-factor array is built: only whether the longest match reaches 50 bytes counts, and
for that it is enough to sort suffixes by their first 50 bytes and to take the smallest id of
each group of equal ones. Suffixes that agree in 50 bytes hold the same minimizer, so suffixes are
dealt to buckets by their minimizer, in runs of neighbouring suffixes that share it, and every
bucket sorts its own. Only suffixes around a context that occurs in more than one document are
dealt at all.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from quire.llm import blocks as B
from quire.llm.hashing import BYTE, between, mix, prefix, rolling

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,length:long>>"
#: Bytes handled at a time; a longer text is cut into overlapping pieces.
CHUNK_BYTES = 1 << 18
POSITION = np.uint64((1 << 24) - 1)
NO_ID = -(1 << 63)


def suffix_dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the bytes covered by a ``length``-byte string that starts in a document of smaller id too.

    One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (the other bytes) and spans
    (start and length of each removed run, in bytes). Null texts count as empty; texts shorter
    than ``length`` and an empty table lose nothing. Rows with the same id don't remove each
    other's bytes; a null id is smaller than any other. Other columns are ignored.
    """
    if length < 12:
        raise ValueError("strings shorter than 12 bytes have no room for a minimizer")
    k = max(4, length // 3)
    span = length - k + 1
    half = (span - 1) // 2
    context = length - (span - 1 - half)
    blocks = B.pack(docs, id_col, text_col)
    context_bits = B.bucket_bits(blocks, 4 / span)
    piece_bits = B.bucket_bits(blocks, 1.0, per_bucket=4 << 20)

    def chunks(texts):
        """Runs of pieces: (owner, offset) of each piece, first byte of each, and the bytes."""
        pieces, size = [], 0
        for owner, text in enumerate(texts):
            for at in range(0, max(len(text) - length + 1, 0), CHUNK_BYTES):
                piece = text[at:at + CHUNK_BYTES + length - 1]
                pieces.append((owner, at, piece))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    yield pieces
                    pieces, size = [], 0
        if pieces:
            yield pieces

    def scan(pieces):
        """Runs of neighbouring windows within a piece that have the same minimizer and context.

        First window, number of windows, place of the minimizer, minimizer and context hash of each run.
        """
        data = np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8)
        ends = np.cumsum([len(p[2]) for p in pieces])
        sums = prefix(BYTE[data])
        grams = (rolling(sums, k) & ~POSITION) | np.arange(len(data) - k + 1, dtype=np.uint64)
        least, width = grams, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width:])
        at = np.flatnonzero(np.repeat(ends, np.diff(np.concatenate(([0], ends))))[: len(least)] - np.arange(len(least)) >= length)
        least = least[at]
        place = (least & POSITION).astype(np.int64)
        late = place - at > half
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1]) | (late[1:] != late[:-1])
        first = np.flatnonzero(new)
        place = place[first]
        around = np.where(late[first], place - (context - k), place)
        return at[first], np.diff(np.append(first, len(at))), place, least[first] >> np.uint64(24), between(sums, around, around + context)

    def block_runs(texts):
        """The runs of all texts: owner, first window and number of them, place of the minimizer in the text, minimizer, context hash."""
        found = []
        for pieces in chunks(texts):
            at, count, place, least, seen = scan(pieces)
            begin = np.cumsum([0] + [len(p[2]) for p in pieces])
            piece = np.searchsorted(begin, at, "right") - 1
            shift = (np.array([p[1] for p in pieces]) - begin[:-1])[piece]
            own = np.array([p[0] for p in pieces])[piece]
            found.append((*(x.astype(np.int32) for x in (own, at + shift, count, place + shift)), least, seen))
        if not found:
            return *(np.zeros(0, np.int32) for _ in range(4)), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def block_contexts(own, seen):
        """The block's distinct context hashes, which of them two of its documents share, and the number of each run's."""
        if not len(seen):
            return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
        order = np.argsort(seen)
        found, owners = seen[order], own[order]
        new = np.concatenate(([True], found[1:] != found[:-1]))
        start = np.flatnonzero(new)
        number = np.empty(len(seen), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return found[start], np.maximum.reduceat(owners, start) != np.minimum.reduceat(owners, start), number

    def block_pieces(payload, answers):
        """The block's ids and texts, its distinct pieces and its runs of windows that share a minimizer."""
        ids, texts = B.unpack(payload)
        keys = np.array([NO_ID if x is None else x for x in ids], dtype=np.int64)
        own, start, count, place, least, seen = block_runs(texts)
        values, shared, number = block_contexts(own, seen)
        keep = (shared | B.flags(values, context_bits, answers))[number]
        own, start, count, place, least = (x[keep] for x in (own, start, count, place, least))
        end = start + count
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (start[1:] != end[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        own, start, least = own[first], start[first], least[first]
        count = end[np.append(first[1:], len(end)) - 1] - start if len(first) else count
        cut_out = [texts[o][a:e] for o, a, e in zip(own.tolist(), start.tolist(), (start + count + length - 1).tolist(), strict=True)]
        pieces = list(dict.fromkeys(cut_out))
        number = dict(zip(pieces, range(len(pieces)), strict=True))
        number = np.fromiter(map(number.__getitem__, cut_out), np.int64, len(cut_out))
        smallest = np.full(len(pieces), np.iinfo(np.int64).max)
        np.minimum.at(smallest, number, keys[own])
        buckets = np.zeros(len(pieces), dtype=np.int64)
        buckets[number] = mix(least) >> np.uint64(64 - piece_bits)
        return ids, texts, Pieces(pieces, smallest, buckets), Runs(own, start, count, number, keys[own] > smallest[number])

    def send(batches):
        for batch in batches:
            for row in batch.select(["block", "payload", "answers"]).to_pylist():
                own = block_pieces(row["payload"], row["answers"])[2]
                buckets, groups = own.by_bucket()
                if buckets:
                    sent = [_message([own.pieces[i] for i in group.tolist()], own.smallest[group]) for group in groups]
                    yield pa.record_batch(
                        [pa.array(buckets, pa.int64()), pa.array([row["block"]] * len(sent), pa.int64()), pa.array(sent, pa.binary())],
                        names=["bucket", "block", "sent"],
                    )

    def reply(table: pa.Table) -> pa.Table:
        answers = earlier([_opened(x) for x in table.column("sent").to_pylist()], length)
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"), "answer": pa.array(answers, pa.binary()),
        })

    def cut(batches):
        for batch in batches:
            for row in batch.select(["payload", "contexts", "answers"]).to_pylist():
                yield _kept(*block_pieces(row["payload"], row["contexts"]), row["answers"] or [], length)

    def contexts(payload):
        own, *_, seen = block_runs(B.unpack(payload)[1])
        return block_contexts(own, seen)[0]

    asked = B.ask(blocks, contexts, context_bits, "u4")
    near = B.with_answers(blocks, B.answer_repeats(asked, "u4"))
    replies = near.select("block", "payload", "answers").mapInArrow(send, B.ASK_SCHEMA).groupBy("bucket").applyInArrow(reply, B.REPLY_SCHEMA)
    both = B.with_answers(near.withColumnRenamed("answers", "contexts"), replies)
    return both.select("payload", "contexts", "answers").mapInArrow(cut, OUT)


class Pieces(NamedTuple):
    """Distinct pieces of a block, the smallest id that has each, and the bucket of each."""

    pieces: list[bytes]
    smallest: np.ndarray
    buckets: np.ndarray

    def by_bucket(self) -> tuple[list[int], list[np.ndarray]]:
        """The buckets, and the numbers of the pieces of each."""
        order = np.argsort(self.buckets, kind="stable")
        ranked = self.buckets[order]
        first = np.flatnonzero(np.diff(ranked, prepend=-1))
        return ranked[first].tolist(), np.split(order, first[1:]) if len(first) else []


class Runs(NamedTuple):
    """Of each run the owner, its first window, the number of windows, the number of its piece, and whether a smaller id of the block has that."""

    own: np.ndarray
    start: np.ndarray
    count: np.ndarray
    piece: np.ndarray
    later: np.ndarray


def _message(pieces: list[bytes], smallest: np.ndarray) -> bytes:
    sizes = np.array([len(x) for x in pieces], dtype="<u4").tobytes()
    ids = smallest.astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(pieces)) + sizes + ids + b"".join(pieces))


def _opened(message: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(message)
    n = struct.unpack_from("<I", raw)[0]
    return np.frombuffer(raw, "<u4", n, 4).astype(np.int64), np.frombuffer(raw, "<i8", n, 4 + 4 * n), raw[4 + 12 * n:]


def earlier(messages: list, length: int) -> list[bytes]:
    """For each message a bit per suffix of its pieces: does a smaller id hold its first bytes?

    ``messages`` are (sizes, ids, joined pieces). Equal pieces are sorted once, under the smallest
    id that has them.
    """
    distinct: dict[bytes, int] = {}
    owner: list[int] = []
    which = []
    for sizes, ids, text in messages:
        numbers = np.empty(len(sizes), dtype=np.int64)
        at = 0
        for j, (size, key) in enumerate(zip(sizes.tolist(), ids.tolist(), strict=True)):
            number = distinct.setdefault(text[at:at + size], len(owner))
            if number == len(owner):
                owner.append(key)
            elif key < owner[number]:
                owner[number] = key
            numbers[j] = number
            at += size
        which.append(numbers)
    owners = np.array(owner, dtype=np.int64)
    by_id = np.argsort(owners, kind="stable")
    pieces = list(distinct)
    sizes = np.array([len(x) for x in pieces], dtype=np.int64)
    counts = sizes - length + 1
    text = np.frombuffer(b"".join(pieces[i] for i in by_id.tolist()), dtype=np.uint8)
    # the suffixes, those of smaller ids first
    starts = np.cumsum(sizes[by_id]) - sizes[by_id]
    total = np.cumsum(counts[by_id])
    suffix = np.repeat(starts - (total - counts[by_id]), counts[by_id]) + np.arange(total[-1])
    smallest = previous_smaller(text, suffix, np.repeat(owners[by_id], counts[by_id]), length)
    begin = np.empty(len(pieces), dtype=np.int64)
    begin[by_id] = total - counts[by_id]
    out = []
    for (_, ids, _), numbers in zip(messages, which, strict=True):
        n = counts[numbers]
        place = np.repeat(begin[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(np.packbits(smallest[place] < np.repeat(ids, n)).tobytes())
    return out


def previous_smaller(text: np.ndarray, suffix: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """The smallest id of a suffix that agrees with each suffix in its first ``length`` bytes.

    ``suffix`` comes in the order of ``ids``. The sort is stable, so suffixes that agree in
    ``length`` bytes stand in the order of their ids, and the first of them has the smallest.
    """
    head = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[suffix]).view(f"S{length}").ravel()
    order = np.argsort(head, kind="stable")
    ranked = head[order]
    group = np.cumsum(np.concatenate(([True], ranked[1:] != ranked[:-1]))) - 1
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    out = np.empty(len(suffix), dtype=np.int64)
    out[order] = ids[order][first][group]
    return out


def _kept(ids: list, texts: list[bytes], own: Pieces, runs: Runs, answers: list, length: int) -> pa.RecordBatch:
    told = {x["bucket"]: x["answer"] for x in answers}
    counts = np.fromiter(map(len, own.pieces), np.int64, len(own.pieces)) - (length - 1)
    # a bit for each window of each piece, those of a bucket side by side
    begin = np.zeros(len(counts), dtype=np.int64)
    bits, at = [np.zeros(0, np.uint8)], 0
    for b, group in zip(*own.by_bucket(), strict=True):
        ends = np.cumsum(counts[group])
        begin[group] = at + ends - counts[group]
        n = int(ends[-1])
        bits.append(np.unpackbits(np.frombuffer(told[b], np.uint8), count=n) if b in told else np.zeros(n, np.uint8))
        at += n
    bit = np.concatenate(bits)
    total = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
    hits = (total[begin + counts] - total[begin])[runs.piece]
    # the texts stand in one line, with a place between each two
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    place = np.cumsum(sizes + 1) - (sizes + 1)
    start = place[runs.own] + runs.start
    whole = runs.later | (hits == runs.count)
    part = np.flatnonzero(~whole & (hits > 0))
    n = runs.count[part]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    hit = bit[np.repeat(begin[runs.piece[part]], n) + inside] > 0
    alone = (np.repeat(start[part], n) + inside)[hit]
    begins = np.concatenate((start[whole], alone))
    order = np.argsort(begins)
    begins, ends = begins[order], np.maximum.accumulate(np.concatenate(((start + runs.count)[whole] - 1, alone))[order]) + length
    new = np.ones(len(begins), dtype=bool)
    new[1:] = begins[1:] > ends[:-1]
    first, last = begins[new], ends[np.append(new[1:], True)] if len(ends) else ends
    owner = np.searchsorted(place, first, "right") - 1
    first, last = first - place[owner], last - place[owner]
    n_spans = np.bincount(owner, minlength=len(texts))
    removed = np.bincount(owner, last - first, len(texts)).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(n_spans)))
    kept = list(texts)
    froms, tos = first.tolist(), last.tolist()
    for i in np.flatnonzero(n_spans).tolist():
        a, b = offsets[i], offsets[i + 1]
        kept[i] = b"".join([texts[i][x:y] for x, y in zip([0, *tos[a:b]], [*froms[a:b], len(texts[i])], strict=True)])
    spans = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(last - first, pa.int64())], names=["start", "length"])
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
         pa.array(kept, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
    )
