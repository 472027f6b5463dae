"""Near-duplicate documents by HyperMinHash.

A document's set of word shingles is reduced to registers. A hash picks a register; the register keeps
the smallest hash it got, as the count of its leading zeros and some bits of the mantissa. Bands
of registers find candidates, the share of equal registers, corrected for those that agree by
chance, estimates their similarity, and what is left is compared on full sets.

Documents with equal sets are one node throughout. A band with few nodes gives all their
pairs. Of bands with many, each node first takes the one that most nodes share and is compared with its
centres; once components are known, each band's components with its commonest; and last the nodes that are still
apart with all that bands connect them to. So a group of many near copies is linked by a few pairs
of each, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.llm.hashing import mix, prefix, rolling, word_hashes
from quire.llm.memory import tidy
from quire.session import new_run_dir

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
EMPTY = 0xFFFF
#: Nodes of a band that are all compared; of more, first the centres, then those still apart.
FEW = 24
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 4.5
GROUP = 128
#: Nodes of a cluster that are compared with as many others in one task.
CHUNK = 512
SETS = "group long, part long, node long, root long, main long, members binary"
#: For each register the order in which an empty one looks for a full one.
LENDERS = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(1)).reshape(REGISTERS, REGISTERS), axis=1)
LENDERS = np.concatenate([np.arange(REGISTERS)[:, None], LENDERS], axis=1)
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _written(df: DataFrame) -> DataFrame:
    path = new_run_dir(df.sparkSession, "near")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` words; of all words if there are fewer."""
    words = text.translate(UPPER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(b" ".join(words))
    return np.unique(rolling(prefix(hashes), min(width, len(words))) ^ np.uint64(min(width, len(words))))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa of the smallest hash of each register; EMPTY where there is none."""
    own = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    place = ((own >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    value = mix(own)
    order = np.argsort(place, kind="stable")
    place, value = place[order], value[order]
    start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    out = np.full(REGISTERS, EMPTY, dtype=np.uint16)
    if not len(hashes):
        return out
    least = np.minimum.reduceat(value, start)
    size = np.floor(np.log2(np.maximum(least >> np.uint64(11), 1).astype(np.float64))).astype(np.int64) + 11
    zeros = np.minimum(63 - size, 62)
    after = (least << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out[place[start]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | after).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of rows of registers, less the share that would agree by chance."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    # two unlike values agree if both lie in one class: leading zeros z with chance 2^-2(z+1), mantissa 2^-10
    chance = 2.0**-MANTISSA / 3
    share = equal / np.maximum(either, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1)


def _node(hashes: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        both = mix(mix(hashes).sum(keepdims=True) ^ mix(np.array([len(hashes)], np.uint64)))
    return int(both.view(np.int64)[0])


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, node (a hash of the set; null if empty) and registers of every row."""

    def sketch(batches):
        for batch in batches:
            own = [shingles(x, width) for x in batch.column(1).to_pylist()]
            full = [len(x) > 0 for x in own]
            yield pa.record_batch(
                [batch.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([_node(x) if f else None for x, f in zip(own, full, strict=True)], pa.int64()),
                 pa.array([registers(x).astype("<u2").tobytes() if f else None for x, f in zip(own, full, strict=True)], pa.binary())],
                names=["doc_id", "n_shingles", "node", "registers"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(sketch), "doc_id long, n_shingles long, node long, registers binary")


def filled(own: np.ndarray) -> np.ndarray:
    """Rows of registers in which each empty one takes the value of the first full one in an order of its own.

    Else the bands of a short text would hold one register each, and agree for all that share a phrase.
    """
    out = own.copy()
    for i in range(0, len(own), 64):
        full = own[i:i + 64] != EMPTY
        out[i:i + 64] = np.take_along_axis(own[i:i + 64], LENDERS[np.arange(REGISTERS), full[:, LENDERS].argmax(axis=2)], axis=1)
    return out


def _bands(nodes: DataFrame) -> DataFrame:
    """(band, node, n): one row for each band of a node."""

    def bands(batches):
        for batch in batches:
            if not len(batch):
                continue
            own = filled(np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(len(batch), REGISTERS)).reshape(len(batch), BANDS, ROWS)
            key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(batch), 1))
            for i in range(ROWS):
                key = mix(key + own[:, :, i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            yield pa.record_batch(
                [pa.array(key.view(np.int64).ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)), pa.array(np.repeat(batch.column("n_shingles").to_numpy(), BANDS))],
                names=["band", "node", "n"],
            )

    return nodes.select("node", "n_shingles", "registers").mapInArrow(bands, "band long, node long, n long")


def _few_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs of each band that may be similar by size."""
    a, b = members.toDF("band", "a", "na"), members.toDF("band", "b", "nb")
    near = f"a < b AND na * 100 >= nb * {percent} AND nb * 100 >= na * {percent}"
    return a.join(b, "band").where(near).select("a", "b")


def _sized(members: DataFrame, percent: int) -> DataFrame:
    """Each member with its two classes of size, whose bounds lie half a class apart.

    Nodes of a class are near enough in size to be similar, and a group that spreads over some classes of one
    kind is held together by those of the other.
    """
    place = F.log(F.col("n")) / float(np.log(100 / percent))
    return members.withColumns({"low": (F.floor(place) * 2).cast("long"), "high": (F.floor(place + 0.5) * 2 + 1).cast("long")})


def _by_size(sized: DataFrame, percent: int | None = None) -> DataFrame:
    """Each row twice, once in either class; rows that share both are best summed up before. With ``percent`` the classes are named first."""
    sized = sized if percent is None else _sized(sized, percent)
    return sized.withColumn("size", F.explode(F.array("low", "high"))).drop("low", "high")


def _first_pairs(large: DataFrame, percent: int) -> DataFrame:
    """For each node of a large band its pairs with the centres of the band that most nodes share: two at most."""
    least = F.min_by("node", F.struct(F.xxhash64("node"), "node"))
    centres = _sized(large, percent).groupBy("band", "low", "high").agg(least.alias("node"))
    centres = _by_size(centres).groupBy("band", "size").agg(least.alias("centre"))
    own = large.groupBy("node").agg(F.max_by(F.struct("band", "n"), F.struct("members", "band")).alias("x")).select("node", "x.band", "x.n")
    pairs = _by_size(_sized(own, percent)).join(centres, ["band", "size"]).where("node <> centre")
    return pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _next_pairs(large: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """In each large band, for each component but the commonest, the pair of a node of both.

    A component is one row for a band and class of sizes, and is counted before anything of the band meets.
    """
    named = large.join(roots, "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("root"))
    node = F.min_by("node", F.struct(F.xxhash64("node"), "node")).alias("node")
    parts = _sized(named, percent).groupBy("band", "low", "high", "root").agg(node, F.count("*").alias("held"))
    parts = _by_size(parts).groupBy("band", "size", "root").agg(node, F.sum("held").alias("held"))
    main = parts.groupBy("band", "size").agg(F.max_by(F.struct("root", "node"), F.struct("held", "root")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    pairs = parts.join(main, ["band", "size"]).where("root <> main.root")
    return pairs.select(F.least("node", "main.node").alias("a"), F.greatest("node", "main.node").alias("b")).distinct()


def _similar(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose estimate doesn't rule them out."""
    own = nodes.select("node", "registers")

    def near(batches):
        for batch in batches:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(len(batch), REGISTERS) for i in (2, 3))
            either = np.maximum(((a != EMPTY) | (b != EMPTY)).sum(axis=1), 1)
            goal = percent / 100
            keep = estimate(a, b) >= goal - MARGIN * np.sqrt(goal * (1 - goal) / either) - 1.0 / either
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    both = pairs.join(own.toDF("a", "ra"), "a").join(own.toDF("b", "rb"), "b").select("a", "b", "ra", "rb")
    return both.mapInArrow(near, "a long, b long")


def _with_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(group, part, node, root, main, members): each node's full set for each group it is in.

    ``wanted`` has group, part, node, root and main. The set is made anew from the text of one of the node's documents.
    """
    lists = wanted.groupBy("node").agg(F.collect_list(F.struct("group", "part", "root", "main")).alias("groups")).join(nodes.select("node", "doc_id"), "node")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def sets(batches):
        for batch in batches:
            for node, groups, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = shingles(text, width)
                if not len(own) or _node(own) != node:  # another row with the same doc_id
                    continue
                for i in range(0, len(groups), GROUP):
                    some = groups[i:i + GROUP]
                    columns = [[x[c] for x in some] for c in ("group", "part", "root", "main")]
                    columns.insert(2, [node] * len(some))
                    yield pa.record_batch([*(pa.array(x, pa.int64()) for x in columns), pa.array([own.astype("<u8").tobytes()] * len(some), pa.binary())], names=["group", "part", "node", "root", "main", "members"])

    return lists.join(rows, "doc_id").select("node", "groups", "text").mapInArrow(tidy(sets), SETS)


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs that are similar on their full sets; those of a node are compared in parts of about GROUP others."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("parts"))
    numbered = pairs.join(parts, "a").select(F.col("a").alias("group"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.col("b").alias("node"))
    wanted = numbered.unionByName(numbered.select("group", "part", F.col("group").alias("node")).distinct())
    wanted = wanted.withColumn("root", F.lit(0).cast("long")).withColumn("main", F.lit(0).cast("long"))

    def compare(table: pa.Table) -> pa.Table:
        key = table.column("group")[0].as_py()
        own = _members(table)
        hub = own.pop(key)
        found = []
        for node, other in own.items():
            common = np.intersect1d(hub, other, assume_unique=True).size
            if 100 * common >= percent * (len(hub) + len(other) - common):
                found.append(node)
        return pa.table({"a": pa.array([key] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return _with_sets(wanted, nodes, docs, width, id_col, text_col).groupBy("group", "part").applyInArrow(compare, "a long, b long")


def _members(table: pa.Table) -> dict[int, np.ndarray]:
    return {n: np.frombuffer(x, "<u8") for n, x in zip(table.column("node").to_pylist(), table.column("members").to_pylist(), strict=True)}


def _rest(large: DataFrame, roots: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """The links between nodes of large bands that are still apart, all compared on full sets.

    Bands that share nodes make a cluster, whose nodes are compared chunk against chunk; only links
    leave a task. Nodes of the cluster's commonest component aren't compared with each other. The nodes
    that are apart, and their clusters, are written once each, as the driver keeps all stages of a plan.
    """
    apart = large.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = apart.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("hub")).where("low <> high").select("band", "hub")
    apart = _written(apart.join(mixed, "band").select("node", "root", "hub").distinct())
    clusters = components(apart.select(F.col("node").alias("a"), F.col("hub").alias("b"))).select("node", F.col("root").alias("group"))
    members = _written(apart.select("node", "root").distinct().join(clusters, "node"))
    main = members.groupBy("group", "root").count().groupBy("group").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.ceil(F.sum("count") / CHUNK).cast("long").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks"))
    pairs = members.join(main, "group").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
    # the part holds both chunks, and in its last bit the one the node is in
    part = (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")) * 2 + (F.col("own") > F.col("other")).cast("long")
    wanted = pairs.select("group", part.alias("part"), "node", "root", "main")

    def compare(table: pa.Table) -> pa.Table:
        root, main = table.column("root").to_numpy(), table.column("main")[0].as_py()
        node, side = table.column("node").to_numpy(), table.column("part").to_numpy() & 1
        sets = [np.frombuffer(x, "<u8") for x in table.column("members").to_pylist()]
        found = []
        for this in np.unique(side).tolist():
            at = np.flatnonzero(side == this)
            others = np.flatnonzero(side != this) if len(np.unique(side)) > 1 else at
            values = np.concatenate([sets[i] for i in others])
            owner = np.repeat(np.arange(len(others)), [len(sets[i]) for i in others])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            size = np.array([len(sets[i]) for i in others])
            for i in at[root[at] != main].tolist():
                low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
                n = high - low
                common = np.bincount(owner[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())], minlength=len(others))
                near = (100 * common >= percent * (size + len(sets[i]) - common)) & (root[others] != root[i])
                found += [(node[i], x) for x in node[others[near]].tolist()]
        return pa.table({"a": pa.array([int(x[0]) for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    sent = _with_sets(wanted, nodes, docs, width, id_col, text_col).withColumn("pair", F.expr("part div 2"))
    return sent.groupBy("group", "pair").applyInArrow(compare, "a long, b long")


def minhash_dedup(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are lower-cased in A-Z, words are ``[^\\x20\\x09-\\x0D]+``, a document's set holds its
    distinct ``width``-word shingles, or all its words as one if there are fewer. Documents are linked if
    100 * intersection >= percent * union; component_id is the smallest doc_id reachable, and the
    document with that id is kept. Null and empty texts have an empty set and stand alone, as do
    rows with a null doc_id (their component_id is null, they are kept). Rows that share a
    doc_id are one component, of which each row with the smallest id is kept. Other columns are ignored.
    """
    every = _written(sketches(docs, width, id_col, text_col))
    full = every.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = _written(full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")))
    bands = _bands(nodes)
    counts = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    shared = _written(bands.join(counts, "band"))
    same_id = full.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id")
    same_id = full.join(same_id, "doc_id").join(full.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))
    few, large = shared.where(f"members <= {FEW}").drop("members"), shared.where(f"members > {FEW}")

    def confirmed(pairs):
        return _written(_confirmed(_written(_similar(_written(pairs), nodes, percent)), nodes, docs, percent, width, id_col, text_col))

    roots = components(confirmed(_few_pairs(few, percent).unionByName(_first_pairs(large, percent)).distinct()).unionByName(same_id))

    def joined(links):
        """The components when these links are added."""
        return components(roots.toDF("a", "b").unionByName(links))

    if large.limit(1).count():
        roots = joined(confirmed(_next_pairs(large, roots, percent)))
        roots = joined(_written(_rest(large, roots, nodes, docs, percent, width, id_col, text_col)))
    named = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.join(first, "root").select("node", "component_id")
    out = every.select("doc_id", "n_shingles", "node").join(found, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
