"""Secrets in texts: by their form, and by how badly a tokenizer's vocabulary fits them.

Names, words and paths are made of pieces that a byte-pair vocabulary knows, so a token covers several
of their characters. Random strings fall apart into one or two characters a token. Long runs of key
characters are therefore encoded, and those of few characters a token reported, unless they are known digests
(hex of a digest's length, or labelled as one) or identifiers (UUIDs, numbers, dates, names of short parts).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The forms of secrets, by kind, in the order in which spans that start together are listed.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
#: Hex digits and base64 characters of MD5 and the SHA families.
DIGEST = re.compile(r"[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}", re.I)
LABELLED = re.compile(r"(?:md5|sha-?[0-9]{1,3})[-=:](?:[0-9a-f]{32,128}|[A-Za-z0-9+/]{22,86}={0,2})", re.I)
LABEL = re.compile(r"(?:md5|sha-?[0-9]{1,3})[\"']?\x20?[-=:]\x20?[\"']?\Z", re.I)
SEPARATORS = re.compile(r"[-_/=+]+")
SPAN_SCHEMA = "array<struct<kind:string,start:int,end:int,chars_per_token:double>>"


@dataclass(frozen=True)
class Options:
    """Which runs of key characters count as random.

    ``min_chars``: shorter runs are not judged. ``max_ratio``: most characters a token. ``min_part``: a run without
    a part of so many characters between separators is a name, a date or a number.
    """

    min_chars: int = 20
    max_ratio: float = 1.8
    min_part: int = 13


class Scanner:
    """Finds the spans of a text with one vocabulary, given as a file of base64 tokens and ranks."""

    def __init__(self, vocabulary: str, pattern: str, options: Options):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("secret-scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.options = options
        self.runs = re.compile(rf"[A-Za-z0-9+/_=-]{{{options.min_chars},}}")

    def is_known(self, text: str, start: int, end: int) -> bool:
        """Whether a run is a digest or an identifier."""
        run = text[start:end]
        if DIGEST.fullmatch(run) or UUID.fullmatch(run) or LABELLED.fullmatch(run) or LABEL.search(text[max(0, start - 16):start]):
            return True
        return run.isdigit() or max(map(len, SEPARATORS.split(run))) < self.options.min_part

    def ratio(self, run: str) -> float:
        """Characters a token."""
        return len(run) / len(self.encoding.encode_ordinary(run))

    def spans(self, text: str) -> list[tuple[str, int, int, float | None]]:
        """Spans (kind, start, end, characters a token if judged) by start, then kind; places are code points."""
        found = [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text)]
        found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
        formal = sorted((start, end) for _, start, end, _ in found)
        at, reach = 0, 0
        for m in self.runs.finditer(text):
            start, end = m.span()
            while at < len(formal) and formal[at][0] < end:
                reach = max(reach, formal[at][1])
                at += 1
            if reach > start or self.is_known(text, start, end):
                continue
            ratio = self.ratio(m.group())
            if ratio <= self.options.max_ratio:
                found.append(("random", start, end, ratio))
        found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
        return found


_scanners: dict[tuple, Scanner] = {}


def find_secrets(
    docs: DataFrame, vocabulary: str, pattern: str, options: Options | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: doc_id and ``spans``, an array of (kind, start, end, chars_per_token).

    Places are code points of the whole text, the end exclusive. Kinds ``assign``, ``access`` and ``hex`` are
    found by their form, leftmost first and without overlap within a kind. ``random`` are runs of key characters
    outside of those that the vocabulary fits badly; only they have ``chars_per_token``. Null texts
    count as empty and have no spans; null ids stay; rows with equal ids are separate; other columns are ignored.
    """
    options = options or Options()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (vocabulary, pattern, options)
        if key not in _scanners:
            _scanners[key] = Scanner(*key)
        scanner = _scanners[key]
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "chars_per_token"), s, strict=True)) for s in scanner.spans(text.as_py())] for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(spans, ARROW_SPANS)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, spans {SPAN_SCHEMA}")


ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("chars_per_token", pa.float64())]))


def listed(spans, kinds: tuple[str, ...] = KINDS):
    """A column of spans of some kinds as ``kind:start:end``, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
