"""Documents that hold test items, by pigeonhole pieces and Myers' bit-parallel edit distance.

An item is split into one piece more than it may have errors, so an occurrence with that many
errors holds one piece unchanged. All pieces are looked for at once; where one is hit, the item
is compared with the text around it.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import broadcast_limit

HITS = "doc_id long, item_id long, distance int, start long, end long"


def normal(text: str) -> str:
    """Lower case, every run of white space one space, trimmed."""
    return " ".join(text.lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces that together make up the item, with the place of each."""
    at = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(at, at[1:], strict=False) if b > a]


def nearest(pattern: str, text: str, errors: int) -> list[tuple[int, int]]:
    """(end, distance) of every end in ``text`` of a string within ``errors`` of ``pattern``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, score = full, 0, len(pattern)
    out = []
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        vertical = equal | down
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical
        if score <= errors:
            out.append((j + 1, score))
    return out


class Finder:
    """Occurrences of a set of items, each a list of (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = []
        found: dict[str, list] = {}
        for key, text in items:
            text = normal(text or "")
            if not text:
                continue
            errors = int(len(text) * error_rate)
            number = len(self.items)
            self.items.append((key, text, errors))
            for at, piece in pieces(text, errors):
                found.setdefault(piece, []).append((number, at))
        self.search = ahocorasick.Automaton()
        for piece, where in found.items():
            self.search.add_word(piece, (len(piece), where))
        if found:
            self.search.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """The nearest occurrence of each item: (item_id, distance, start, end), the leftmost of equals."""
        if not self.items:
            return []
        text = normal(text)
        windows: dict[int, list] = {}
        for end, (size, where) in self.search.iter(text):
            for number, at in where:
                _, item, errors = self.items[number]
                begin = end + 1 - size - at
                own = windows.setdefault(number, [])
                low, high = max(0, begin - errors), min(len(text), begin + len(item) + errors)
                if own and low <= own[-1][1] and own[-1][0] <= high:
                    own[-1] = (min(low, own[-1][0]), max(high, own[-1][1]))
                else:
                    own.append((low, high))
        out = []
        for number, own in windows.items():
            key, item, errors = self.items[number]
            best = None
            for low, high in own:
                for end, distance in nearest(item, text[low:high], errors):
                    if best is None or (distance, low + end) < best:
                        best = (distance, low + end)
            if best:
                distance, end = best
                back = text[max(0, end - len(item) - errors):end][::-1]
                start = end - max((n for n, d in nearest(item[::-1], back, errors) if d == distance), default=len(item))
                out.append((key, distance, start, end))
        return out


def _parts(benchmark: DataFrame, id_col: str, text_col: str):
    """The items in parts small enough to send to every task."""
    limit = broadcast_limit(benchmark.sparkSession) // 16
    part, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).orderBy(*benchmark.select(id_col, text_col).columns)
    for key, text in rows.toLocalIterator():
        part.append((key, text))
        size += len(text) + 64
        if size > limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def find_items(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every item a document holds: doc_id, item_id, distance, start and end in the normalised text.

    Texts and items are lower-cased, white space runs become one space, and an item is found
    where a part of the whole text is within ``error_rate`` of its length, rounded down, in edits. The nearest
    occurrence of each item counts, the leftmost end of equals. Items without text are never found;
    null and empty texts hold none; repeated documents and items are each reported. More items
    than fit in a task's memory are looked for part by part, each over all documents.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    out = None
    for items in _parts(benchmark, item_id, item_text):
        found = rows.mapInArrow(_searcher(docs, items, error_rate), HITS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], HITS)


def _searcher(docs, items, error_rate):
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        finder = Finder(sent.value, error_rate)
        for batch in batches:
            hits = [(key, *hit) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for hit in finder.find(text)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array([x[i] for x in hits], k) for i, k in enumerate(kinds)], names=["doc_id", "item_id", "distance", "start", "end"])

    return search


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, text_col: str = "text", **names) -> DataFrame:
    """The rows, with all their columns, whose text holds none of the items."""
    out = docs
    for items in _parts(benchmark, names.get("item_id", "item_id"), names.get("item_text", "text")):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def clean(batches, sent=sent):
            finder = Finder(sent.value, error_rate)
            for batch in batches:
                texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
                yield batch.filter(pa.array([not finder.find(x or "") for x in texts], pa.bool_()))

        out = out.mapInArrow(clean, out.schema)
    return out
