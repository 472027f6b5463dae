"""The snapshot: a manifest naming gzip JSON-Lines parts below ``updated_date=`` folders."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X
from quire.operators.columns import with_once

#: Reader options that reject what a strict JSON parser rejects.
_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
#: Every field may have any type here, so only broken syntax marks a line.
_SYNTAX_ONLY = "_any string, _corrupt_record string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest document; anything that is not JSON fails the read."""
    return (
        spark.read.option("multiLine", True)
        .option("mode", "FAILFAST")
        .schema(schemas.MANIFEST)
        .json(path)
    )


def manifest_parts(manifest: DataFrame) -> DataFrame:
    """``(pos, url, part)`` per entry with a URL, ``pos`` being the manifest order."""
    return (
        manifest.select(F.posexplode("entries").alias("pos", "entry"))
        .select("pos", F.col("entry.url").alias("url"))
        .where(X.non_empty(F.col("url")).isNotNull())
        .withColumn("part", X.part_https(F.col("url")))
    )


def read_lines(
    spark: SparkSession, paths, *, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """``(part, line, value)`` per non-blank line; invalid UTF-8 bytes are replaced.

    ``line`` grows in reading order within a part. A gzip part is one task, which is also
    what keeps the order; a truncated part fails its task, hence the job.
    """
    reader = spark.readStream if streaming else spark.read
    source = reader.format("text")
    if streaming:
        source = source.option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz")
        if max_files:
            source = source.option("maxFilesPerTrigger", max_files)
    raw = source.load(paths)
    columns = [
        F.col("_metadata.file_path").alias("part"),
        F.make_valid_utf8(F.col("value")).alias("value"),
    ]
    if not streaming:
        columns.append(F.monotonically_increasing_id().alias("line"))
    return _non_blank(raw.select(*columns))


def _non_blank(lines: DataFrame) -> DataFrame:
    return with_once(lines, "value", X.strip(F.col("value"))).where(F.col("value") != "")


def is_json_object(value: Column) -> Column:
    """True when a stripped line is one JSON object, whatever the types of its fields."""
    syntax = F.from_json(value, _SYNTAX_ONLY, _JSON)["_corrupt_record"]
    return F.startswith(value, F.lit("{")) & F.endswith(value, F.lit("}")) & syntax.isNull()


def last_key_wins(m: Column) -> Column:
    """Keep a repeated map key at its first place with its last value."""
    keys = F.array_distinct(F.map_keys(m))

    def last_value(k):
        return F.element_at(F.filter(F.map_entries(m), lambda e: e["key"] == k), -1)["value"]

    return F.when(F.size(keys) == F.size(F.map_keys(m)), m).otherwise(
        F.map_from_arrays(keys, F.transform(keys, last_value))
    )


def may_carry(value: Column, concept_id: str) -> Column:
    """False only for lines that cannot have the concept: neither its id nor an escaped letter.

    JSON can spell a letter or digit in no other way than plainly or as ``\\u00XX``; of an id with
    other characters, which have more spellings, only what follows the last of them is looked for.
    """
    plain = re.search(r"[A-Za-z0-9]*$", concept_id).group()
    if not plain:
        return F.lit(True)
    return F.contains(value, F.lit(plain)) | F.contains(value, F.lit("\\u00"))


def parse_works(
    lines: DataFrame, schema=schemas.RAW_WORK, concept_id: str | None = None
) -> DataFrame:
    """Raw works of the lines that are JSON objects.

    A field of an unexpected type becomes null and its work is kept. Only lines on which
    the typed parse found fault are parsed a second time, for their syntax alone. With
    ``concept_id``, lines that cannot have the concept are dropped before parsing; the
    concept filter itself is still to be applied.
    """
    if concept_id is not None:
        lines = lines.where(may_carry(F.col("value"), concept_id))
    typed = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, _corrupt_record string"
    value = F.col("value")
    framed = lines.where(F.startswith(value, F.lit("{")) & F.endswith(value, F.lit("}")))
    parsed = with_once(framed, "w", F.from_json(value, typed, _JSON)).where(
        F.col("w._corrupt_record").isNull() | is_json_object(value)
    )
    fields = [F.col(f"w.{f.name}").alias(f.name) for f in schema]
    kept = [c for c in lines.columns if c != "value"]
    works = parsed.select(*kept, *fields)
    if "abstract_inverted_index" in works.columns:
        works = works.withColumn(
            "abstract_inverted_index", last_key_wins(F.col("abstract_inverted_index"))
        )
    return works


def bad_lines(lines: DataFrame) -> DataFrame:
    """``(part, n_bad)``: how many lines of each part are not JSON objects."""
    return (
        lines.where(~is_json_object(F.col("value")))
        .groupBy("part")
        .agg(F.count("*").alias("n_bad"))
    )


def read_works(
    spark: SparkSession, paths, schema=schemas.RAW_WORK, concept_id: str | None = None
) -> DataFrame:
    """Raw works of the given parts or folders; for ``concept_id`` see :func:`parse_works`."""
    return parse_works(read_lines(spark, paths), schema, concept_id)


def updated_date(part: Column) -> Column:
    """Date folder a part lies in."""
    return F.to_date(F.regexp_extract(part, r"updated_date=(\d{4}-\d{2}-\d{2})", 1))


def read_works_since(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Raw works of the date folders ``first..last``; other folders are never opened."""
    lines = (
        spark.read.format("text")
        .option("basePath", root)
        .load(root)
        .where(F.col("updated_date").between(first, last))
        .select(
            F.col("_metadata.file_path").alias("part"),
            "updated_date",
            F.make_valid_utf8(F.col("value")).alias("value"),
        )
    )
    return parse_works(_non_blank(lines))


def map_works(works: DataFrame, concept_id: str | None = X.DEFAULT_CONCEPT, with_abstract: bool = True) -> DataFrame:
    """Works with the concept, projected to the corpus columns plus ``abstract``.

    Without ``with_abstract`` that is null, and the inverted index isn't read. Columns the raw work does not have, such as ``part``, are carried along.
    """
    if concept_id is not None:
        works = works.where(X.has_concept(F.col("concepts"), concept_id))
    raw = {f.name for f in schemas.RAW_WORK}
    abstract = X.reconstruct_abstract(F.col("abstract_inverted_index"))
    if not with_abstract:
        works = works.drop("abstract_inverted_index")
        abstract = F.lit(None).cast("string")
    return with_once(works, "abstract", abstract).select(
        *[c for c in works.columns if c not in raw],
        "id",
        "doi",
        X.work_title(F.col("title"), F.col("display_name")).alias("title"),
        "language",
        "publication_year",
        "type",
        "abstract",
    )


def with_text(mapped: DataFrame, mode: str = "title_abstract", skip_no_text: bool = True) -> DataFrame:
    """Add ``text``; works without any are dropped, or kept with an empty text."""
    out = with_once(mapped, "text", X.build_text(F.col("title"), F.col("abstract"), mode))
    if skip_no_text:
        return out.where(F.col("text").isNotNull())
    return out.withColumn("text", F.coalesce("text", F.lit("")))
