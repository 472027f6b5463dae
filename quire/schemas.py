"""Schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
BOOL, TIME = T.BooleanType(), T.TimestampType()
INVERTED_INDEX = T.MapType(STRING, T.ArrayType(INT))


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


MANIFEST = struct(entries=T.ArrayType(struct(url=STRING)))

RAW_WORK = struct(
    id=STRING,
    doi=STRING,
    title=STRING,
    display_name=STRING,
    language=STRING,
    publication_year=INT,
    type=STRING,
    concepts=T.ArrayType(struct(id=STRING, display_name=STRING)),
    abstract_inverted_index=INVERTED_INDEX,
)

#: Fields a hit is joined back to.
HYDRATION = struct(
    id=STRING,
    doi=STRING,
    title=STRING,
    publication_year=INT,
    abstract_inverted_index=INVERTED_INDEX,
    primary_location=struct(landing_page_url=STRING),
    best_oa_location=struct(landing_page_url=STRING, pdf_url=STRING),
    open_access=struct(oa_url=STRING),
)

#: Columns every mapped work carries, before text and vector are added.
WORK_COLUMNS = ["id", "doi", "title", "language", "publication_year", "type"]

SHARD = struct(
    id=STRING,
    doi=STRING,
    title=STRING,
    language=STRING,
    publication_year=INT,
    type=STRING,
    text=STRING,
    embedding=T.ArrayType(T.FloatType()),
)

COMPLETED_PARTS = struct(part=STRING, batch_id=LONG, committed_at=TIME)

INDEX_META = struct(
    build=STRING,
    batch=INT,
    dim=INT,
    n_vectors=LONG,
    nlist=INT,
    pq_m=INT,
    pq_nbits=INT,
    metric=STRING,
    normalized=BOOL,
    by_residual=BOOL,
    shard_count=INT,
    trained_at=TIME,
    last_update_added_shards=T.ArrayType(STRING),
    last_update_added_vectors=LONG,
    last_update_at=TIME,
    probe_groups=INT,
    live_batches=T.ArrayType(INT),
)

#: One row per shard and batch that indexed it; shards without vectors are on record with 0.
SHARD_LEDGER = struct(shard=STRING, batch=INT, n_vectors=LONG, length=LONG, modified=TIME, added_at=TIME)

#: Postings of ``shard`` in batches before ``batch`` no longer count.
HIDDEN = struct(shard=STRING, batch=INT)

#: Cells of an index; ``grp`` is null where they form no groups.
CENTROIDS = struct(cell=INT, centroid=T.ArrayType(T.FloatType()), grp=INT)

QUERIES = struct(query_id=LONG, query=STRING, k=INT)
