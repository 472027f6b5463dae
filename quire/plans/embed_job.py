"""Snapshot to vector shards, incrementally."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X
from quire.functions.embedders import EmbedFn
from quire.operators.embedding import embed
from quire.operators.parts import part_counts, plan_shards, soft_limit
from quire.session import exists, new_run_dir, remove_dir
from quire.sources import ledger, shards, snapshot

#: Parts that are parsed in one Spark job, before anything is embedded.
PARTS_AT_A_TIME = 32
#: Columns of the texts that wait to be embedded.
TEXTS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SHARD if f.name != "embedding")


@dataclass
class EmbedRun:
    """What one run did."""

    n_batches: int
    n_parts: int
    n_works: int
    seconds: float = 0.0

    @property
    def works_per_second(self) -> float:
        return self.n_works / max(1.0, self.seconds)


def corpus_rows(
    lines: DataFrame,
    *,
    concept_id: str = X.DEFAULT_CONCEPT,
    mode: str = "title_abstract",
    skip_no_text: bool = True,
) -> DataFrame:
    """Lines parsed, filtered, mapped and given a text: all of the job but the vectors."""
    works = snapshot.parse_works(lines, concept_id=concept_id)
    return snapshot.with_text(snapshot.map_works(works, concept_id, mode != "title"), mode, skip_no_text)


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with its row and character counts taken while it is written."""
    seen = Observation(name)
    return df.observe(
        seen, F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars")
    ), seen


def run(
    spark: SparkSession,
    manifest_path: str,
    out_dir: str,
    embed_fn: EmbedFn,
    *,
    concept_id: str = X.DEFAULT_CONCEPT,
    mode: str = "title_abstract",
    skip_no_text: bool = True,
    max_works: int | None = None,
    shard_size: int = shards.SHARD_ROWS,
    parts_per_batch: int | None = None,
    parts_at_a_time: int = PARTS_AT_A_TIME,
    rows_per_file: int = shards.SHARD_ROWS,
    resolve=lambda url: url,
) -> EmbedRun:
    """Embed the parts of the manifest that ``out_dir`` has no record of.

    Parts are parsed ``parts_at_a_time``, once each, and their texts kept in the shared folder, which tells how
    many each has. A batch closes with the first part that brings it to ``shard_size`` rows (or to
    ``parts_per_batch`` parts), is embedded, and goes to ``shards/batch=N``; then its parts go on record. What is
    left over waits for the parts that follow, and at the end makes the last batch. After a crash batch ``N`` is written
    again over its leftovers, so one batch is what a crash can cost. With nothing new the call writes nothing.
    ``max_works`` ends the run after the part that reaches it; of later parts no more are read than were parsed
    along with it. A folder that a stream writes to is refused. ``resolve`` maps the URL of an entry to a path
    Spark can read.
    """
    X.check_mode(mode)
    if exists(spark, f"{out_dir}/stream"):
        raise ValueError(f"{out_dir!r} belongs to a stream")
    began = time.monotonic()
    manifest = snapshot.read_manifest(spark, manifest_path)
    completed = ledger.read_completed(spark, f"{out_dir}/parts")
    todo = ledger.not_done(snapshot.manifest_parts(manifest), completed, "part").orderBy("pos")
    batch_id = first = ledger.next_batch(completed)
    listed = [(r["pos"], r["part"], resolve(r["url"])) for r in todo.collect()]  # one row per file
    if not listed:
        return EmbedRun(0, 0, 0)
    manifest.write.mode("overwrite").json(f"{out_dir}/manifests/batch={batch_id:06d}")

    def rows_of(paths):
        return corpus_rows(
            snapshot.read_lines(spark, paths),
            concept_id=concept_id, mode=mode, skip_no_text=skip_no_text,
        )

    n_parts = n_works = 0
    for batch in _batches(spark, listed, rows_of, max_works, shard_size, parts_per_batch, parts_at_a_time):
        waiting = [f"{part.texts}/pos={part.pos}" for part in batch if part.n]
        rows = spark.read.schema(TEXTS).parquet(*waiting) if waiting else spark.createDataFrame([], TEXTS)
        embedded = embed(rows, embed_fn, spread=True)
        shards.write_shards(embedded, f"{out_dir}/shards/batch={batch_id:06d}", rows_per_file)
        done = spark.createDataFrame([(part.name,) for part in batch], "part string")
        ledger.commit_parts(done, f"{out_dir}/parts", batch_id)
        batch_id, n_parts, n_works = batch_id + 1, n_parts + len(batch), n_works + sum(part.n for part in batch)
    return EmbedRun(batch_id - first, n_parts, n_works, time.monotonic() - began)


@dataclass(frozen=True)
class _Part:
    """A part whose texts lie in ``texts``."""

    pos: int
    name: str
    n: int
    texts: str


def _batches(spark, listed, rows_of, max_works, shard_size, parts_per_batch, parts_at_a_time) -> Iterator[list[_Part]]:
    """Parts that are embedded together, in order. Their texts are deleted once no batch needs the folder."""
    waiting: list[_Part] = []
    total, folders = 0, []
    for at in range(0, len(listed), parts_at_a_time):
        some = listed[at : at + parts_at_a_time]
        folder = new_run_dir(spark, "texts")
        folders.append(folder)
        rows = [rows_of([path]).select(*_text_columns(), F.lit(pos).alias("pos")) for pos, _, path in some]
        reduce(DataFrame.unionByName, rows).write.partitionBy("pos").parquet(folder)
        names = {pos: name for pos, name, _ in some}
        # Parts go by their place in the manifest, which may name one twice. Counting reads footers only.
        parts = spark.createDataFrame([(pos, str(pos)) for pos in names], "pos int, part string")
        works = spark.read.schema(f"{TEXTS}, pos int").parquet(folder).select(F.col("pos").cast("string").alias("part"))
        counts = part_counts(parts, works)
        if max_works is not None:
            counts = soft_limit(counts, max_works - total)
        found = [_Part(r["pos"], names[r["pos"]], r["n"], folder) for r in counts.orderBy("pos").collect()]  # one row per part
        total += sum(part.n for part in found)
        waiting += found
        full, waiting = _closed(spark, waiting, shard_size, parts_per_batch)
        for batch in full:
            yield batch
        folders = _without_idle(spark, folders, waiting)
        if max_works is not None and total >= max_works:
            break
    if waiting:
        yield waiting
    _without_idle(spark, folders, [])


def _text_columns() -> list[str]:
    return [f.name for f in schemas.SHARD if f.name != "embedding"]


def _closed(spark, waiting: list[_Part], shard_size: int, parts_per_batch: int | None) -> tuple[list[list[_Part]], list[_Part]]:
    """Batches that are full, and the parts of the one that isn't."""
    counts = spark.createDataFrame([(p.pos, p.name, p.n) for p in waiting], "pos int, part string, n bigint")
    number = {r["pos"]: r["shard_idx"] for r in plan_shards(counts, shard_size).collect()}  # one row per part
    full: list[list[_Part]] = []
    batch: list[_Part] = []
    for i, part in enumerate(waiting):
        batch.append(part)
        last = i + 1 == len(waiting)
        filled = sum(p.n for p in batch) >= shard_size if last else number[waiting[i + 1].pos] != number[part.pos]
        if filled or len(batch) == parts_per_batch:
            full.append(batch)
            batch = []
    return full, batch


def _without_idle(spark, folders: list[str], waiting: list[_Part]) -> list[str]:
    """Delete the folders no waiting part has texts in; the others are returned."""
    needed = {part.texts for part in waiting}
    for folder in folders:
        if folder not in needed:
            remove_dir(spark, folder)
    return [f for f in folders if f in needed]


def committed_shards(spark: SparkSession, out_dir: str) -> list[str]:
    """Shard folders whose batch is on record; a half-written batch is not among them."""
    done = ledger.read_completed(spark, f"{out_dir}/parts").select("batch_id").distinct()
    return [f"{out_dir}/shards/batch={r[0]:06d}" for r in done.orderBy("batch_id").collect()]
