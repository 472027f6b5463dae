"""Removal of word passages that occur more than once, by difference-cover anchors.

Two runs of 35 equal words, wherever they start, share an offset at which both are at a position
that the cover holds modulo its period; the 15 words from there on lie within the run. So only
windows at cover positions are hashed. What shares an anchor is then extended: every 35-word
window that holds a repeated anchor at such an offset is compared as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import blocks as B
from quire.llm.hashing import prefix, rolling, word_hashes

#: Perfect difference sets: every residue modulo the period is a difference of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
OUT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,length:long>>"
#: Words of the documents handled at a time.
CHUNK_WORDS = 1 << 18


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of the window."""
    return max([p for p in COVERS if window - p + 1 >= max(1, window // 3)], default=0)


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove the words covered by a ``window``-word sequence that starts anywhere else too.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. One row per input row: doc_id, n_words,
    n_removed, kept (the other words, joined by one space) and spans (start and length of each
    removed run, in words). Null texts count as empty; empty texts, texts shorter than the window and
    an empty table lose nothing; equal rows are separate documents, so each loses its
    repeated windows; other columns are ignored. Sequences are compared by 64-bit hashes.
    """
    period = period_for(window)
    if not period:
        raise ValueError("the window is too short for a difference cover")
    anchor = window - period + 1
    cover = np.zeros(period, dtype=bool)
    cover[list(COVERS[period])] = True
    blocks = B.pack(docs, id_col, text_col)
    anchor_bits = B.bucket_bits(blocks, cover.mean() / 6)
    window_bits = B.bucket_bits(blocks, 1 / 6)

    def chunks(payload):
        """Hashes of the words and the first word of each document, some documents at a time."""
        ids, texts = B.unpack(payload)
        at = 0
        while at < len(ids):
            words, counts, end = [], [], at
            total = 0
            while end < len(ids) and (end == at or total < CHUNK_WORDS):
                split = texts[end].split()
                words.append(split)
                counts.append(len(split))
                total += len(split)
                end += 1
            joined = b" ".join(b" ".join(x) for x in words if x)
            yield ids[at:end], words, word_hashes(joined), np.concatenate(([0], np.cumsum(counts)))
            at = end

    def starts(first, width):
        """Whether ``width`` words of one document start at each word."""
        room = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
        return room >= width

    def anchors_of(hashes, first):
        own = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
        at = np.flatnonzero(starts(first, anchor) & cover[own % period])
        return at, rolling(prefix(hashes), anchor)[at]

    def block_anchors(payload):
        found = [anchors_of(h, first)[1] for _, _, h, first in chunks(payload)]
        return np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)

    def candidates(payload, answers):
        """Of each chunk: its parts, the positions worth comparing, and the windows there."""
        values, counts = block_anchors(payload)
        repeated = values[B.flags(values, anchor_bits, answers) | (counts > 1)]
        for ids, words, hashes, first in chunks(payload):
            at, found = anchors_of(hashes, first)
            place = np.minimum(np.searchsorted(repeated, found), max(len(repeated) - 1, 0))
            hit = at[repeated[place] == found] if len(repeated) else at[:0]
            near = np.zeros(first[-1] + 1, dtype=np.int64)
            np.add.at(near, np.maximum(hit - (period - 1), 0), 1)
            np.add.at(near, hit + 1, -1)
            where = np.flatnonzero((np.cumsum(near[:-1]) > 0) & starts(first, window))
            yield ids, words, first, where, rolling(prefix(hashes), window)[where] if len(where) else np.zeros(0, np.uint64)

    def block_windows(payload, answers):
        found = [x[4] for x in candidates(payload, answers)]
        return np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)

    asked = B.ask(blocks, lambda payload: block_anchors(payload)[0], anchor_bits, "u4")
    first_answers = B.with_answers(blocks, B.answer_repeats(asked, "u4"))
    asked = B.ask(first_answers, lambda payload, answers: block_windows(payload, answers)[0], window_bits, "u8")
    replies = B.answer_repeats(asked, "u8")
    both = B.with_answers(first_answers.withColumnRenamed("answers", "anchors"), replies)

    def cut(batches):
        for batch in batches:
            for row in batch.select(["payload", "anchors", "answers"]).to_pylist():
                values, counts = block_windows(row["payload"], row["anchors"])
                repeated = values[B.flags(values, window_bits, row["answers"]) | (counts > 1)]
                for ids, words, first, where, found in candidates(row["payload"], row["anchors"]):
                    yield _kept(ids, words, first, where[np.isin(found, repeated)], window)

    return both.select("payload", "anchors", "answers").mapInArrow(cut, OUT)


def _kept(ids, words, first, where, window):
    edge = np.zeros(first[-1] + 1, dtype=np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + window, -1)
    gone = np.cumsum(edge[:-1]) > 0
    total = np.concatenate(([0], np.cumsum(gone)))
    rows = {"doc_id": ids, "n_words": np.diff(first), "n_removed": total[first[1:]] - total[first[:-1]], "kept": [], "spans": []}
    for i, own in enumerate(words):
        a, b = first[i], first[i + 1]
        mask = gone[a:b]
        spans = []
        if rows["n_removed"][i]:
            turns = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
            spans = [{"start": int(s), "length": int(e - s)} for s, e in zip(turns[::2], turns[1::2], strict=True)]
            own = [w for w, lost in zip(own, mask.tolist(), strict=True) if not lost]
        rows["kept"].append(b" ".join(own).decode())
        rows["spans"].append(spans)
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(rows["n_words"], pa.int64()), pa.array(rows["n_removed"], pa.int64()), pa.array(rows["kept"], pa.string()),
         pa.array(rows["spans"], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
        names=["doc_id", "n_words", "n_removed", "kept", "spans"],
    )
