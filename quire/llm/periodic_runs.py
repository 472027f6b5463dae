"""Runs of words that repeat with a period, by longest common extensions over a difference cover.

The longest common extension (LCE) of two places is how many words follow alike from both. Only suffixes
that begin at places of a difference cover are sorted. Any two places are both carried to covered
places by one shift below the cover's modulus; so an LCE compares those few words first, and if they are
all equal, takes the smallest common prefix between the two suffixes in sorted order from a sparse table.

A run of period p is a stretch where every word equals the one p places on. Such a stretch is at least so
long that it holds a point of a grid whose step grows with p, so that the points of all periods make a harmonic
sum. At each point the LCE of the point and the one p on gives the end, and a search with
further LCEs its begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Every number below 31 is the difference of two of these modulo 31.
COVER, MODULUS = (0, 1, 3, 8, 12, 18), 31
#: Documents are searched together up to so many words; a longer one alone.
TOGETHER = 1 << 18
#: Grid points looked at together.
POINTS = 1 << 20


def _shifts() -> np.ndarray:
    """For each pair of remainders the least shift that carries both into the cover."""
    covered = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(d for d in range(MODULUS) if covered[i + d] and covered[j + d])
    return out


SHIFTS = _shifts()


class Extensions:
    """LCEs within documents. ``words`` holds their words as numbers above 0, each document followed by a 0."""

    def __init__(self, words: np.ndarray, modulus: int = MODULUS):
        if modulus != MODULUS:
            raise ValueError("the cover belongs to its modulus")
        self.words = np.append(words, np.zeros(2 * MODULUS, words.dtype))
        self.table: list[np.ndarray] | None = None

    def _sort(self) -> None:
        """Sort the covered suffixes, each document's apart, and prepare the minima of their common prefixes."""
        size = len(self.words) - MODULUS
        document = np.cumsum(np.append(0, self.words[:-1] == 0))
        places = np.flatnonzero(np.isin(np.arange(size) % MODULUS, COVER))
        self.number = np.full(len(self.words), -1, np.int64)
        self.number[places] = np.arange(len(places))
        # The first words of each suffix, and its document before them, as one string of bytes.
        first = np.empty((len(places), MODULUS + 1), ">u4")
        first[:, 0] = document[places]
        for i in range(MODULUS):
            first[:, i + 1] = self.words[places + i]
        rank = np.unique(first.view(f"V{4 * (MODULUS + 1)}").ravel(), return_inverse=True)[1].astype(np.int64)
        levels, step = [rank], MODULUS
        longest = int(np.bincount(document).max())
        while step < longest and rank.max() + 1 < len(places):
            after = places + step
            far = np.where(after < size, self.number[np.minimum(after, size - 1)], -1)
            key = rank * (len(places) + 1) + np.where(far >= 0, rank[far] + 1, 0)
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
            levels.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.rank = np.empty(len(places), np.int64)
        self.rank[order] = np.arange(len(places))
        # Common prefixes of neighbours: whole steps by the ranks of each level, then single words.
        a, b = places[order[:-1]], places[order[1:]]
        same = document[a] == document[b]
        common = np.zeros(len(a), np.int64)
        for level in reversed(range(len(levels))):
            step = MODULUS << level
            x, y = np.minimum(a + common, size - 1), np.minimum(b + common, size - 1)
            i, j = self.number[x], self.number[y]
            equal = same & (i >= 0) & (j >= 0) & (levels[level][i] == levels[level][j])
            common += np.where(equal, step, 0)
        left = np.flatnonzero(same)
        for _ in range(MODULUS):
            x, y = np.minimum(a[left] + common[left], size - 1), np.minimum(b[left] + common[left], size - 1)
            left = left[(self.words[x] == self.words[y]) & (self.words[x] > 0)]
            common[left] += 1
        self.table = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are alike from i and from j on; i and j are different places of one document."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        for t in range(int(shift.max(initial=0))):
            there = shift[open_] > t
            x, y = self.words[i[open_] + t], self.words[j[open_] + t]
            equal = (x == y) & (x > 0)
            out[open_[there & equal]] += 1
            open_ = open_[~there | equal]
        if len(open_):
            out[open_] += self._ranked(i[open_] + shift[open_], j[open_] + shift[open_])
        return out

    def _ranked(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The LCE of covered places: the least common prefix of neighbours between them."""
        if self.table is None:
            self._sort()
        a, b = self.rank[self.number[i]], self.rank[self.number[j]]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(i), np.int64)
        for n in np.unique(level).tolist():
            these = np.flatnonzero(level == n)
            row = self.table[n]
            out[these] = np.minimum(row[a[these]], row[b[these] - (1 << n)])
        return out


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = 24, repeats: int = 3) -> tuple[np.ndarray, ...]:
    """Runs of some documents: document, start, length and period, in order of document, start and period.

    ``words`` holds the documents' words as numbers above 0, each document followed by a 0; ``sizes`` their
    counts. A run is at least ``least`` words and ``repeats`` (3 or more) of its smallest period long.
    """
    if repeats < 3:
        raise ValueError("runs of fewer than three periods are not searched")
    sizes = np.asarray(sizes, np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    extensions = Extensions(words)
    found = [np.zeros((4, 0), np.int64)]
    longest = np.minimum(sizes // repeats, np.where(sizes >= least, sizes, 0))
    # Every pair of a document and a period, some at a time.
    pairs = np.cumsum(longest)
    total = int(pairs[-1]) if len(pairs) else 0
    at = 0
    while at < total:
        number = np.arange(at, min(total, at + POINTS // 8))
        document = np.searchsorted(pairs, number, side="right")
        period = number - (pairs[document] - longest[document]) + 1
        # A stretch where words equal those a period on is at least this long, and so holds a point.
        step = np.maximum(least - period, (repeats - 1) * period)
        points = (sizes[document] - period + step - 1) // step
        ends = np.cumsum(points)
        stop = max(1, int(np.searchsorted(ends, POINTS, side="right")))
        number, document, period, step, points, ends = (x[:stop] for x in (number, document, period, step, points, ends))
        at = int(number[-1]) + 1
        found.append(_at_points(extensions, begins, document, period, step, points, ends, least, repeats))
    document, start, length, period = np.concatenate(found, axis=1)
    # A stretch found for several periods has the smallest of them; the others are its multiples.
    order = np.lexsort((period, length, start, document))
    document, start, length, period = (x[order] for x in (document, start, length, period))
    new = np.ones(len(document), bool)
    new[1:] = (document[1:] != document[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    document, start, length, period = (x[new] for x in (document, start, length, period))
    order = np.lexsort((period, start, document))
    return document[order], start[order] - begins[document[order]], length[order], period[order]


def _at_points(extensions, begins, document, period, step, points, ends, least, repeats) -> np.ndarray:
    pair = np.repeat(np.arange(len(points)), points)
    place = begins[document[pair]] + (np.arange(len(pair)) - (ends - points)[pair]) * step[pair]
    words = extensions.words
    hit = np.flatnonzero(words[place] == words[place + period[pair]])
    pair, place = pair[hit], place[hit]
    if not len(pair):
        return np.zeros((4, 0), np.int64)
    far = extensions.lce(place, place + period[pair])
    # Of the points in one stretch the first is taken: from it the stretch goes on, to the next it reaches.
    same = np.zeros(len(pair), bool)
    same[1:] = (pair[1:] == pair[:-1]) & (place[1:] - place[:-1] == step[pair[1:]]) & (far[:-1] >= step[pair[:-1]])
    pair, place, far = pair[~same], place[~same], far[~same]
    p, end = period[pair], place + far
    # The stretch begins after the point before, or with the document: a search by halves, with LCEs.
    low, high = np.maximum(begins[document[pair]], place - step[pair] + 1), place.copy()
    # What could not be long enough even then need not be searched.
    wide = np.flatnonzero(end - low >= np.maximum(least - p, (repeats - 1) * p))
    pair, place, p, end, low, high = (x[wide] for x in (pair, place, p, end, low, high))
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        reaches = extensions.lce(middle, middle + p[open_]) >= place[open_] - middle
        high[open_[reaches]] = middle[reaches]
        low[open_[~reaches]] = middle[~reaches] + 1
        open_ = open_[low[open_] < high[open_]]
    length = end - high + p
    long = np.flatnonzero(length >= np.maximum(least, repeats * p))
    return np.stack([document[pair[long]], high[long], length[long], p[long]])


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Documents' words as numbers above 0, a 0 after each document, and the documents' sizes."""
    names: dict[bytes, int] = {}
    for words in texts:
        for word in words:
            if word not in names:
                names[word] = len(names) + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros(int(sizes.sum()) + len(texts), np.uint32)
    at = 0
    for words in texts:
        out[at:at + len(words)] = np.fromiter(map(names.__getitem__, words), np.uint32, len(words))
        at += len(words) + 1
    return out, sizes


def periodic_runs(docs: DataFrame, least: int = 24, repeats: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, ``runs`` (start, length, period of each, by start and period) and ``collapsed``.

    Words are what lies between spaces and control white space. ``collapsed`` is the text without the words that a
    run holds after its first period, joined by one space. Null texts count as empty: no words, no
    runs, an empty ``collapsed``. Null ids stay, rows with equal ids are separate, other columns are ignored.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(key)
                texts.append(text.as_py().split())
                size += len(texts[-1])
                if size >= TOGETHER:
                    yield _rows(keys, texts, least, repeats)
                    keys, texts, size = [], [], 0
            if keys:
                yield _rows(keys, texts, least, repeats)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(search, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _rows(keys: list, texts: list[list[bytes]], least: int, repeats: int) -> pa.RecordBatch:
    words, sizes = numbered(texts)
    document, start, length, period = find_runs(words, sizes, least, repeats)
    cuts = np.searchsorted(document, np.arange(len(texts) + 1))
    kept = []
    for i, text in enumerate(texts):
        if cuts[i] < cuts[i + 1]:
            # +1 where a run's first period ends, -1 where the run ends: what lies between goes.
            a, b = slice(cuts[i], cuts[i + 1]), len(text) + 1
            depth = np.cumsum(np.bincount(start[a] + period[a], minlength=b) - np.bincount(start[a] + length[a], minlength=b))
            text = [text[k] for k in np.flatnonzero(depth[:-1] == 0).tolist()]
        kept.append(b" ".join(text))
    runs = pa.ListArray.from_arrays(
        pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"])
    ).cast(RUNS)
    return pa.record_batch(
        [pa.array([k.as_py() for k in keys], pa.int64()), pa.array(sizes, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )
