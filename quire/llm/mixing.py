"""Mixing of sources to target weights by hierarchical budgeting, in DataFrame operations only.

A token budget goes down a tree of domain, language and source. At each node it is shared among the
children by weight; a child that holds fewer tokens than its share gives what it can, and the
rest goes to its siblings by weight. A node's supply is that of all leaves below it, so a shortage
leaves a node for the node's own siblings only when everything below the node is used up. Each
leaf then gives a token prefix of its epochs, each a seeded shuffle of its documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.session import new_run_dir

LEVELS = ("domain", "lang", "source")
#: Leading hex digits of the shuffle key that cut a leaf's order into ranges.
RANGE_DIGITS = 3


def word_count(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, without Python."""
    return F.size(F.regexp_extract_all(text, F.lit("[^ \\t-\\r]+"), F.lit(0))).cast("long")


def sizes(docs: DataFrame, domain) -> DataFrame:
    """Tokens of each document and leaf; rows that agree in id and leaf count as one document."""
    tokens = F.coalesce(word_count(F.col("text")), F.lit(0))
    named = [F.coalesce(x.cast("string"), F.lit("")).alias(n) for n, x in zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *named, tokens.alias("n_tokens")).groupBy("doc_id", *LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Give every node its part of its parent's ``budget`` by weight, none more than its ``supply``.

    The children that are used up come first in the order of supply by weight, so one running sum
    tells them apart from those that share what is left. Shares are rounded down.
    """
    order = [F.expr("IF(weight = 0, NULL, supply / weight)").asc_nulls_last(), F.asc("node")]
    group = Window.partitionBy(*parent)
    running = group.orderBy(*order)
    before = running.rowsBetween(Window.unboundedPreceding, -1)
    after = running.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.expr("weight > 0 AND (budget - gone) * weight >= supply * rest")
    return (
        nodes.withColumn("gone", F.coalesce(F.sum("supply").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(after))
        .withColumn("full", full)
        .withColumn("gone", F.sum(F.expr("IF(full, supply, 0)")).over(group))
        .withColumn("rest", F.sum(F.expr("IF(full, 0, weight)")).over(group))
        .withColumn("quota", F.expr("IF(full, supply, IF(rest = 0, 0, (budget - gone) * weight div rest))"))
        .drop("gone", "rest", "full", "budget")
    )


def budgets(leaves: DataFrame, weights: dict[str, int], total: int | None, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """Quota in tokens of each leaf (domain, lang, source, tokens).

    ``weights`` has whole numbers by path ("web", "web/en", "web/en/src1"); others weigh 1. The
    budget is ``total``, or the fraction ``share`` of all tokens.
    """
    asked = F.lit(total).cast("long") if total is not None else F.expr(f"sum(tokens) * {share[0]} div {share[1]}").cast("long")
    above = leaves.agg(F.coalesce(asked, F.lit(0)).alias("quota")).withColumn("root", F.lit(0))
    supply = leaves.select(*LEVELS, (F.col("tokens") * max_epochs).alias("supply"), F.lit(0).alias("root"))
    parent = ["root"]
    for depth, level in enumerate(LEVELS):
        path = F.concat_ws("/", *LEVELS[: depth + 1])
        weight = F.lit(1).cast("long")
        named = {k: v for k, v in weights.items() if k.count("/") == depth}
        for k, v in named.items():
            weight = F.when(path == k, F.lit(v).cast("long")).otherwise(weight)
        keys = [*parent, level]
        nodes = supply.groupBy(*keys).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", weight).withColumn("node", F.col(level)).join(above.select(*parent, F.col("quota").alias("budget")), parent)
        above = share_out(nodes, parent).drop("node")
        parent = keys
    return above.select(*LEVELS, "quota")


def select_mix(
    docs: DataFrame, weights: dict[str, int], domain, total: int | None = None, share: tuple[int, int] = (6, 10), max_epochs: int = 1, seed: str = "mix"
) -> DataFrame:
    """The documents each leaf contributes: doc_id, domain, lang, source, epoch, n_tokens, n_taken.

    Tokens are words of whole texts; null texts have none, null domain, lang and source are "". A
    leaf's documents are taken in the order of md5(seed, epoch, doc_id), epoch after epoch, as long as
    the tokens before them are below the leaf's quota; n_taken tokens of the last one lie
    within it. At most ``max_epochs`` epochs are given. Rounding leaves less than one token
    for each node unspent. Weight 0 gives nothing. An empty table gives none.
    """
    spark = docs.sparkSession

    def written(df, label):
        path = new_run_dir(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    own = written(sizes(docs, domain), "sizes")
    leaves = own.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    # a row for each leaf, written as two branches of the plan ask for it
    quotas = written(budgets(leaves, weights, total, share, max_epochs).join(leaves, list(LEVELS)).where("quota > 0"), "quotas")
    epochs = quotas.withColumn("epoch", F.explode(F.expr("sequence(0L, (quota - 1) div tokens)"))).withColumn("left", F.expr("quota - epoch * tokens"))
    # epochs that a leaf gives in full need no order
    columns = ["doc_id", *LEVELS, "epoch", "n_tokens", "n_taken"]
    whole = own.join(epochs.where("left >= tokens"), list(LEVELS)).withColumn("n_taken", F.col("n_tokens"))
    part = own.join(epochs.where("left < tokens"), list(LEVELS))
    part = part.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    part = part.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    leaf = [*LEVELS, "epoch"]
    ranges = part.groupBy(*leaf, "range").agg(F.sum("n_tokens").alias("held"))
    before = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before_range", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    inside = Window.partitionBy(*leaf, "range").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    part = (
        part.join(ranges, [*leaf, "range"])
        .where("before_range < left")
        .withColumn("before", F.col("before_range") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .where("before < left")
        .withColumn("n_taken", F.least("n_tokens", F.expr("left - before")))
    )
    return whole.select(columns).unionByName(part.select(columns))


def keep_mix(docs: DataFrame, weights: dict[str, int], domain, **options) -> DataFrame:
    """The rows of the documents that :func:`select_mix` takes in its first epoch, with all their columns."""
    taken = select_mix(docs, weights, domain, **options).where("epoch = 0").select("doc_id", *LEVELS)
    kept = taken.select(*[F.col(c).alias(f"_{c}") for c in taken.columns])
    on = docs["doc_id"].cast("long").eqNullSafe(kept["_doc_id"])
    for name, x in zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True):
        on = on & (F.coalesce(x.cast("string"), F.lit("")) == kept[f"_{name}"])
    return docs.join(kept, on, "left_semi")
