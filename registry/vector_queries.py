"""Vector functions, exact and inverted-file neighbours, quantisation.

Fixed models are the mean vectors of the ten labels, computed from the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import vectors as V
from quire.operators import neighbours as N
from quire.operators import quantiser as Q
from quire.operators.hydrate import coverage, hydrate, works_in
from quire import schemas
from quire.sources import file_order, ledger, shards
from registry import derive as D
from registry.base import query

WITH = f"WITH {D.SQL_VECTORS}"
K = 10
NPROBE = 3
PQ_M = 8


def rounded(hits):
    """Hits with comparable types: scores to six digits, ranks as bigint."""
    return hits.select(
        "query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


SQL_HITS = "SELECT query_id, id, round(score, 6) AS score, rank FROM hits"


# --------------------------------------------------------------------------- functions
@query("vector_scan", f"{WITH} SELECT vec_id, true AS from_shard, len(v) AS dim, round(sqrt(list_dot_product(v, v)), 6) AS norm FROM e")
def vector_scan(spark, sf):
    """Ids and vectors read back from shard files, with the file each lies in."""
    rows = shards.read_vectors(spark, D.ordered_shards(spark, sf))
    return rows.selectExpr(VEC_ID, "endswith(shard, '.parquet') AS from_shard", "embedding").select(
        "vec_id", "from_shard", F.size("embedding").cast("bigint").alias("dim"), F.round(V.norm(F.col("embedding")), 6).alias("norm")
    )


@query("detect_dim", "SELECT len(embedding) AS dim, count(*) AS n FROM embeddings GROUP BY 1")
def detect_dim(spark, sf):
    dim = shards.detect_dim(D.corpus(spark, sf))
    return D.corpus(spark, sf).agg(F.lit(dim).cast("bigint").alias("dim"), F.count("*").alias("n"))


@query("l2_normalize", f"""{WITH},
    s AS (SELECT vec_id, list_transform(v, lambda x: x * (vec_id % 7)) AS s FROM e)
    SELECT vec_id, round(sqrt(list_dot_product(s, s)), 5) AS norm_before,
           CAST(CASE WHEN vec_id % 7 = 0 THEN 0 ELSE 1 END AS DOUBLE) AS norm_after,
           round(CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE s[1] / sqrt(list_dot_product(s, s)) END, 5) AS first
    FROM s""")
def l2_normalize(spark, sf):
    scaled = D.vectors(spark, sf).select(
        "vec_id", F.transform("embedding", lambda x: x * (F.col("vec_id") % 7)).alias("s")
    )
    unit = scaled.withColumn("u", V.l2_normalize(F.col("s")))
    return unit.select(
        "vec_id",
        F.round(V.norm(F.col("s")), 5).alias("norm_before"),
        F.round(V.norm(F.col("u")), 5).alias("norm_after"),
        F.round(F.col("u")[0].cast("double"), 5).alias("first"),
    )


def _with_mean(spark, sf):
    means = D.label_means(spark, sf).withColumnRenamed("cell", "label")
    return D.vectors(spark, sf).join(means, "label")


@query("inner_product", f"""{WITH} SELECT vec_id, round({D.sql_dot('e.v', 'cent.v')}, 6) AS ip
    FROM e JOIN cent ON label = cell""")
def inner_product(spark, sf):
    ip = V.inner_product(F.col("embedding"), F.col("centroid"))
    return _with_mean(spark, sf).select("vec_id", F.round(ip, 6).alias("ip"))


@query("l2_distance", f"""{WITH} SELECT vec_id, round({D.sql_l2('e.v', 'cent.v')}, 6) AS l2
    FROM e JOIN cent ON label = cell""")
def l2_distance(spark, sf):
    l2 = V.squared_l2(F.col("embedding"), F.col("centroid"))
    return _with_mean(spark, sf).select("vec_id", F.round(l2, 6).alias("l2"))


# --------------------------------------------------------------------------- exact
def exact(spark, sf, metric="ip"):
    return N.exact_neighbours(D.all_queries(spark, sf), D.corpus(spark, sf), K, metric)


@query("knn_exact_ip", f"{WITH}, {D.sql_exact('ip', K)} {SQL_HITS}")
def knn_exact_ip(spark, sf):
    return rounded(exact(spark, sf, "ip"))


@query("knn_exact_l2", f"{WITH}, {D.sql_exact('l2', K)} {SQL_HITS}")
def knn_exact_l2(spark, sf):
    return rounded(exact(spark, sf, "l2"))


@query("knn_small_corpus", f"""{WITH}, {D.sql_hits(
    'ip', f"SELECT vec_id AS query_id, cell AS id, {D.sql_dot('e.v', 'cent.v')} AS score FROM e, cent", 20)} {SQL_HITS}""")
def knn_small_corpus(spark, sf):
    """Fewer candidates than ``k``: each query gets what there is, without padding."""
    small = D.label_means(spark, sf).select(F.col("cell").alias("id"), F.col("centroid").alias("embedding"))
    return rounded(N.exact_neighbours(D.all_queries(spark, sf), small, 20))


@query("hit_ids", f"""{WITH}, {D.sql_exact('ip', K)}
    SELECT query_id, rank, '{D.BASE}W' || id AS work_id FROM hits""")
def hit_ids(spark, sf):
    """The identifier travels with its vector; no position is looked up."""
    rows = D.vectors(spark, sf).select("id", "embedding")
    return N.exact_neighbours(D.all_queries(spark, sf), rows, K).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), F.col("id").alias("work_id")
    )


# --------------------------------------------------------------------------- cells
@query("ivf_assign", f"""{WITH}, {D.sql_cells('ip')}
    SELECT vec_id, cell, round(cell_score, 6) AS cell_score FROM ranked WHERE r = 1""")
def ivf_assign(spark, sf):
    rows = D.vectors(spark, sf).select("vec_id", "embedding")
    placed = Q.to_cells(rows, D.quantiser(spark, sf), vector="embedding")
    return placed.select("vec_id", "cell", F.round("cell_score", 6).alias("cell_score"))


@query("cell_sizes", f"{WITH}, {D.sql_cells('l2')} SELECT cell, count(*) AS n FROM assigned GROUP BY cell")
def cell_sizes(spark, sf):
    return postings(spark, sf, D.quantiser(spark, sf, metric="l2")).groupBy("cell").agg(F.count("*").alias("n"))


@query("probe_cells", f"""{WITH}, {D.sql_cells('ip')}
    SELECT vec_id AS query_id, cell, round(cell_score, 6) AS cell_score FROM ranked WHERE r <= {NPROBE}""")
def probe_cells(spark, sf):
    probes = N.probe_cells(D.all_queries(spark, sf), D.quantiser(spark, sf), NPROBE)
    return probes.select("query_id", "cell", F.round("cell_score", 6).alias("cell_score"))


@query("lloyd_step", f"""{WITH}, {D.sql_cells('l2')}
    SELECT cell, d, round(avg(x), 6) AS mean FROM (
      SELECT cell, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS d FROM e JOIN assigned USING (vec_id))
    GROUP BY cell, d""")
def lloyd_step(spark, sf):
    model = D.quantiser(spark, sf, metric="l2")
    means = Q.lloyd_step(D.corpus(spark, sf), model.centroids[None])
    flat = means.select(F.col("code").alias("cell"), F.posexplode("mean").alias("d", "mean"))
    return flat.select("cell", F.col("d").cast("bigint").alias("d"), F.round("mean", 6).alias("mean"))


def postings(spark, sf, model, which=None):
    """Vectors of the chosen shards as ``(shard, id, cell, embedding | codes)``."""
    rows = D.vectors(spark, sf)
    if which is not None:
        rows = rows.where(which)
    placed = Q.to_cells(
        rows.select("shard", F.col("vec_id").alias("id"), "embedding"), model, vector="embedding"
    ).drop("cell_score")
    return placed if model.books is None else Q.encode(placed, model)


def probed_pairs(metric, score):
    return f"""SELECT q.vec_id AS query_id, e.vec_id AS id, {score} AS score
        FROM ranked p JOIN e q ON q.vec_id = p.vec_id JOIN assigned a ON a.cell = p.cell
        JOIN e ON e.vec_id = a.vec_id WHERE p.r <= {NPROBE}"""


def ivf(spark, sf, metric="ip", **kwargs):
    model = D.quantiser(spark, sf, metric=metric, **kwargs)
    return N.cell_neighbours(D.all_queries(spark, sf), postings(spark, sf, model), model, K, NPROBE)


def _ivf_sql(metric):
    score = D.sql_dot("q.v", "e.v") if metric == "ip" else D.sql_l2("q.v", "e.v")
    return f"{WITH}, {D.sql_cells(metric)}, {D.sql_hits(metric, probed_pairs(metric, score), K)}"


@query("ivf_search", f"{_ivf_sql('ip')} {SQL_HITS}")
def ivf_search(spark, sf):
    return rounded(ivf(spark, sf))


@query("ivf_search_l2", f"{_ivf_sql('l2')} {SQL_HITS}")
def ivf_search_l2(spark, sf):
    return rounded(ivf(spark, sf, "l2"))


@query("recall_at_k", f"""{_ivf_sql('ip')},
    truth AS (SELECT q.vec_id AS query_id, e.vec_id AS id, row_number() OVER (
        PARTITION BY q.vec_id ORDER BY {D.sql_dot('q.v', 'e.v')} DESC, e.vec_id) AS r FROM e AS q, e)
    SELECT t.query_id, count(*) AS n_true, count(h.id) AS n_found,
           CAST(count(h.id) AS DOUBLE) / count(*) AS recall
    FROM truth t LEFT JOIN hits h ON h.query_id = t.query_id AND h.id = t.id WHERE t.r <= {K} GROUP BY t.query_id""")
def recall_at_k(spark, sf):
    return N.recall(ivf(spark, sf), exact(spark, sf))


# --------------------------------------------------------------------------- product quantisation
SQL_PQ = f"""
subs AS (
  SELECT vec_id, m, v[m * width + 1 : (m + 1) * width] AS s
  FROM (SELECT vec_id, v, len(v) // {PQ_M} AS width, unnest(range({PQ_M})) AS m FROM coded)
),
books AS (
  SELECT cell AS code, m, v[m * width + 1 : (m + 1) * width] AS s
  FROM (SELECT cell, v, len(v) // {PQ_M} AS width, unnest(range({PQ_M})) AS m FROM cent)
),
codes AS (
  SELECT vec_id, m, arg_min(code, dist) AS code, min(dist) AS dist FROM (
    SELECT subs.vec_id, subs.m, books.code, {D.sql_l2('subs.s', 'books.s')} AS dist
    FROM subs JOIN books ON books.m = subs.m) GROUP BY vec_id, m
),
decoded AS (
  SELECT vec_id, flatten(list(s ORDER BY m)) AS y FROM codes JOIN books USING (m, code) GROUP BY vec_id
)"""
SQL_RAW = "coded AS (SELECT vec_id, v FROM e)"
SQL_RESIDUAL = """coded AS (
  SELECT e.vec_id, list_transform(list_zip(e.v, cent.v), lambda z: z[1] - z[2]) AS v
  FROM e JOIN assigned USING (vec_id) JOIN cent USING (cell))"""


@query("pq_encode", f"{WITH}, {SQL_RAW}, {SQL_PQ} SELECT vec_id, CAST(m AS BIGINT) AS m, code FROM codes")
def pq_encode(spark, sf):
    model = D.quantiser(spark, sf, pq_m=PQ_M)
    coded = Q.encode(D.vectors(spark, sf).select("vec_id", "embedding"), model)
    return Q.code_numbers(coded, model).withColumn("m", F.col("m").cast("bigint"))


@query("pq_error", f"""{WITH}, {SQL_RAW}, {SQL_PQ}
    SELECT vec_id, round(sum(dist), 6) AS error FROM codes GROUP BY vec_id""")
def pq_error(spark, sf):
    model = D.quantiser(spark, sf, pq_m=PQ_M)
    rows = Q.coding_error(D.vectors(spark, sf).select("vec_id", "embedding"), model)
    return rows.select("vec_id", F.round("error", 6).alias("error"))


def _adc_sql(metric, coded, decoded):
    score = (D.sql_dot if metric == "ip" else D.sql_l2)("q.v", "x.y")
    pairs = f"""SELECT q.vec_id AS query_id, x.vec_id AS id, {score} AS score
        FROM ranked p JOIN e q ON q.vec_id = p.vec_id JOIN assigned a ON a.cell = p.cell
        JOIN ({decoded}) x ON x.vec_id = a.vec_id WHERE p.r <= {NPROBE}"""
    return f"{WITH}, {D.sql_cells(metric)}, {coded}, {SQL_PQ}, {D.sql_hits(metric, pairs, K)}"


_PLUS_CENTROID = """SELECT vec_id, list_transform(list_zip(y, cent.v), lambda z: z[1] + z[2]) AS y
    FROM decoded JOIN assigned USING (vec_id) JOIN cent USING (cell)"""


def _coarse(hits):
    """Coded vectors tie often: compare the scores by rank, not the ids behind equal scores."""
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


SQL_COARSE = "SELECT query_id, rank, round(score, 6) AS score FROM hits"


@query("adc_search", f"{_adc_sql('ip', SQL_RAW, 'SELECT * FROM decoded')} {SQL_COARSE}")
def adc_search(spark, sf):
    return _coarse(ivf(spark, sf, pq_m=PQ_M))


@query("adc_search_residual", f"{_adc_sql('ip', SQL_RESIDUAL, _PLUS_CENTROID)} {SQL_COARSE}")
def adc_search_residual(spark, sf):
    return _coarse(ivf(spark, sf, pq_m=PQ_M, by_residual=True))


@query("adc_search_residual_l2", f"{_adc_sql('l2', SQL_RESIDUAL, _PLUS_CENTROID)} {SQL_COARSE}")
def adc_search_residual_l2(spark, sf):
    return _coarse(ivf(spark, sf, "l2", pq_m=PQ_M, by_residual=True))


@query("knn_exact_passes", f"{WITH}, {D.sql_exact('ip', K)} {SQL_HITS}")
def knn_exact_passes(spark, sf):
    """Exact search whose queries exceed what may be broadcast: some passes over a corpus that stays in place."""
    size = D.vectors(spark, sf).agg(8 * F.sum(F.size("embedding"))).first()[0]
    before = spark.conf.get("quire.broadcast.maxBytes", None)
    spark.conf.set("quire.broadcast.maxBytes", str(size // 2))
    try:
        return rounded(exact(spark, sf))
    finally:
        if before is None:
            spark.conf.unset("quire.broadcast.maxBytes")
        else:
            spark.conf.set("quire.broadcast.maxBytes", before)


# --------------------------------------------------------------------------- shards and growth
OLD = "shard IN ('corpus_000000.parquet', 'corpus_000001.parquet')"
NEW = f"NOT {OLD}"


@query("shards_todo", f"{WITH} SELECT DISTINCT shard FROM e WHERE vec_id % 4 >= 2")
def shards_todo(spark, sf):
    rows = D.vectors(spark, sf).select("shard", "label")
    return ledger.not_done(rows.select("shard").distinct(), rows.where(OLD), "shard")


@query("append_vectors", f"{WITH} SELECT vec_id, shard FROM e UNION ALL SELECT vec_id, shard FROM e WHERE vec_id % 4 >= 2")
def append_vectors(spark, sf):
    """Appending keeps every row, also those whose id is there already."""
    rows = D.vectors(spark, sf).select("vec_id", "shard")
    return rows.unionByName(rows.where(NEW))


@query("ivf_add", f"""{WITH}, {D.sql_cells('ip')}
    SELECT cell, shard, count(*) AS n FROM e JOIN assigned USING (vec_id) GROUP BY cell, shard""")
def ivf_add(spark, sf):
    return postings(spark, sf, D.quantiser(spark, sf)).groupBy("cell", "shard").agg(F.count("*").alias("n"))


@query("incremental_add", f"""{WITH}, {D.sql_cells('ip')} SELECT shard, vec_id AS id, cell FROM e JOIN assigned USING (vec_id)""")
def incremental_add(spark, sf):
    """Old shards, then the new ones under the same model: equal to adding all at once."""
    model = D.quantiser(spark, sf)
    return postings(spark, sf, model, OLD).unionByName(postings(spark, sf, model, NEW)).select("shard", "id", "cell")


#: Order in which the rows of ``D.ordered_shards`` lie in the files.
LAID = "ORDER BY vec_id % 4, vec_id DESC"
VEC_ID = "CAST(substring_index(id, '/W', -1) AS BIGINT) AS vec_id"


@query("vector_ordinals", f"{WITH} SELECT vec_id, row_number() OVER ({LAID}) - 1 AS ordinal FROM e")
def vector_ordinals(spark, sf):
    rows = file_order.in_file_order(spark, D.ordered_shards(spark, sf), schemas.SHARD, ["id"])
    return rows.selectExpr(VEC_ID, "ordinal")


@query("batch_ids", f"""{WITH}, o AS (SELECT vec_id, (row_number() OVER ({LAID}) - 1) // 64 AS batch_no FROM e)
    SELECT batch_no, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id FROM o GROUP BY batch_no""")
def batch_ids(spark, sf):
    rows = file_order.with_batches(spark, D.ordered_shards(spark, sf), schemas.SHARD, ["id"], 64).selectExpr(VEC_ID, "batch_no")
    return rows.groupBy("batch_no").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"))


N_LISTS = 4


@query("train_sample_head", f"{WITH} SELECT vec_id, round(list_sum(v), 4) AS total FROM e {LAID} LIMIT {N_LISTS * 64}")
def train_sample_head(spark, sf):
    rows = file_order.first_rows(spark, D.ordered_shards(spark, sf), schemas.SHARD, ["id", "embedding"], Q.training_rows(N_LISTS))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.withColumn("total", F.round(total, 4)).selectExpr(VEC_ID, "total")


@query("train_sample_hash", f"""{WITH}, n AS (SELECT CAST(floor({N_LISTS * 64} / count(*)::DOUBLE * 4294967296) AS BIGINT) + 1 AS below FROM e)
    SELECT id, vec_id FROM e, n WHERE CAST('0x' || substr(md5('0:' || id), 1, 8) AS BIGINT) < below""")
def train_sample_hash(spark, sf):
    rows = D.vectors(spark, sf).select("id", "vec_id")
    return Q.hash_sample(rows, Q.training_rows(N_LISTS) / rows.count())


# --------------------------------------------------------------------------- training
ROUNDS = 3


def sql_rounds(points: str, codes: str, rounds: int = ROUNDS) -> str:
    """``k0 ... kN(m, code, v)`` and ``a0 ...(m, vec_id, code, dist)``: plain k-means over ``points(m, vec_id, v)``."""
    steps = [f"p AS ({points}), k0 AS ({codes})"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT p.m, p.vec_id, arg_min(k.code, {D.sql_l2('p.v', 'k.v')}) AS code, min({D.sql_l2('p.v', 'k.v')}) AS dist
            FROM p JOIN k{i} k ON k.m = p.m GROUP BY p.m, p.vec_id)""")
        steps.append(f"""k{i + 1} AS (SELECT m, code, list(x ORDER BY d) AS v FROM (
            SELECT m, code, d, avg(x) AS x FROM (
              SELECT m, code, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{i} JOIN p USING (m, vec_id))
            GROUP BY m, code, d) GROUP BY m, code)""")
    return ", ".join(steps)


SQL_WHOLE = ("SELECT 0 AS m, vec_id, v FROM e", "SELECT 0 AS m, cell AS code, v FROM cent")
SQL_SLICES = tuple(
    f"SELECT m, {key}, v[m * (len(v) // {PQ_M}) + 1 : (m + 1) * (len(v) // {PQ_M})] AS v FROM {source}, (SELECT unnest(range({PQ_M})) AS m)"
    for key, source in (("vec_id", "e"), ("cell AS code", "cent"))
)


def trained(spark, sf, m):
    """Code books after some rounds from the label means."""
    means = D.quantiser(spark, sf, pq_m=m, metric="l2").books
    return Q.train(D.corpus(spark, sf), means, iterations=ROUNDS)


def flat_codes(spark, books):
    """``(m, code, d, x)`` of code books, rounded; the model is as large as its parameters make it."""
    m, code, d = (a.ravel() for a in Q.np.indices(books.shape))
    return spark.createDataFrame(Q.pa.table({"m": m, "code": code, "d": d, "x": books.astype("float64").ravel()})).withColumn("x", F.round("x", 6))


SQL_CODES = f"SELECT m, code, unnest(range(len(v))) AS d, round(unnest(v), 6) AS x FROM k{ROUNDS}"


@query("ivf_train", f"{WITH}, {sql_rounds(*SQL_WHOLE)} {SQL_CODES}")
def ivf_train(spark, sf):
    return flat_codes(spark, trained(spark, sf, 1).books)


@query("pq_train", f"{WITH}, {sql_rounds(*SQL_SLICES)} {SQL_CODES}")
def pq_train(spark, sf):
    return flat_codes(spark, trained(spark, sf, PQ_M).books)


@query("train_inertia", f"{WITH}, {sql_rounds(*SQL_WHOLE)}, i AS (" + " UNION ALL ".join(
    f"SELECT {i} AS round, sum(dist) AS inertia, count(DISTINCT code) AS n_used FROM a{i}" for i in range(ROUNDS)) + """)
    SELECT round, round(inertia, 3) AS inertia, inertia > lag(inertia, 1, inertia) OVER (ORDER BY round) AS rose FROM i""")
def train_inertia(spark, sf):
    """Summed squared distance of each round; it never rises."""
    inertia = trained(spark, sf, 1).inertia
    rows = [(i, round(x, 3), x > inertia[max(i - 1, 0)]) for i, x in enumerate(inertia)]
    return spark.createDataFrame(rows, "round bigint, inertia double, rose boolean")


@query("code_use", f"""{WITH} SELECT 16 * {PQ_M} AS n_codes, 0 AS n_idle, {PQ_M} * count(*) AS n_rows FROM e""")
def code_use(spark, sf):
    """After training no code is idle: from starts of which all but one lie far off."""
    starts = D.quantiser(spark, sf, pq_m=PQ_M).books
    far = Q.np.concatenate([starts[:, :1], starts[:, :1] + 1000 * (1 + Q.np.arange(15, dtype="float64"))[None, :, None]], axis=1)
    books = Q.train(D.corpus(spark, sf), far.astype("float32"), iterations=8).books
    used = Q.lloyd_step(D.corpus(spark, sf), books)
    n_codes = books.shape[0] * books.shape[1]
    return used.agg(
        F.lit(n_codes).cast("bigint").alias("n_codes"), (F.lit(n_codes) - F.count("*")).cast("bigint").alias("n_idle"), F.sum("n").alias("n_rows")
    )


# --------------------------------------------------------------------------- two levels of cells
#: Cells by number in three groups, led by their means.
GROUP_STARTS = (0, 4, 7)
SQL_GROUPS = f"""
grouped AS (SELECT cell, v, CASE WHEN cell < {GROUP_STARTS[1]} THEN 0 WHEN cell < {GROUP_STARTS[2]} THEN 1 ELSE 2 END AS grp FROM cent),
leaders AS (SELECT grp, list(x ORDER BY d) AS v FROM (
  SELECT grp, d, avg(x) AS x FROM (SELECT grp, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM grouped) GROUP BY grp, d) GROUP BY grp)"""


def grouped_model(spark, sf, metric, probe):
    model = D.quantiser(spark, sf, metric=metric)
    starts = Q.np.array([*GROUP_STARTS, model.nlist])
    leaders = Q.np.stack([model.centroids[a:b].mean(axis=0) for a, b in zip(starts[:-1], starts[1:], strict=True)])
    return Q.replace(model, leaders=leaders, starts=starts, probe=probe)


@query("tree_assign", f"""{WITH}, {SQL_GROUPS},
    near AS (SELECT vec_id, e.v, arg_min(grp, {D.sql_l2('e.v', 'leaders.v')}) AS grp FROM e, leaders GROUP BY vec_id, e.v)
    SELECT vec_id, arg_min(cell, {D.sql_l2('near.v', 'grouped.v')}) AS cell FROM near JOIN grouped USING (grp) GROUP BY vec_id""")
def tree_assign(spark, sf):
    """The nearest cell of the nearest group."""
    rows = Q.to_cells(D.vectors(spark, sf).select("vec_id", "embedding"), grouped_model(spark, sf, "l2", 1), vector="embedding")
    return rows.select("vec_id", F.col("cell").cast("bigint").alias("cell"))


@query("tree_assign_full", f"{WITH}, {D.sql_cells('ip')} SELECT vec_id, cell FROM assigned")
def tree_assign_full(spark, sf):
    """With every group looked into the cells are those of a model without groups."""
    rows = Q.to_cells(D.vectors(spark, sf).select("vec_id", "embedding"), grouped_model(spark, sf, "ip", 3), vector="embedding")
    return rows.select("vec_id", F.col("cell").cast("bigint").alias("cell"))


SQL_GROUP_POINTS = (
    f"SELECT grp AS m, vec_id, v FROM (SELECT vec_id, e.v, arg_min(grp, {D.sql_l2('e.v', 'leaders.v')}) AS grp FROM e, leaders GROUP BY vec_id, e.v)",
    "SELECT grp AS m, cell AS code, v FROM grouped",
)


@query("tree_train", f"{WITH}, {SQL_GROUPS}, {sql_rounds(*SQL_GROUP_POINTS)} SELECT code, unnest(range(len(v))) AS d, round(unnest(v), 6) AS x FROM k{ROUNDS}")
def tree_train(spark, sf):
    """The cells of all groups trained in the same passes, each by the rows of its own group."""
    model = grouped_model(spark, sf, "l2", 1)
    rows = D.vectors(spark, sf).select("id", "embedding")
    grouped = Q.to_cells(rows, Q.Quantiser(model.leaders, "l2"), vector="embedding").withColumnRenamed("cell", "grp")
    books = Q.train_groups(grouped, model.centroids, model.starts, iterations=ROUNDS).books
    return flat_codes(spark, books).drop("m")


# --------------------------------------------------------------------------- hydration
def named_hits(spark, sf):
    hits = ivf(spark, sf)
    return hits.withColumn("id", F.concat(F.lit(D.BASE + "W"), F.col("id").cast("string")))


SQL_FOUND = f"""{_ivf_sql('ip')}, {D.SQL_WORKS},
found AS (
  SELECT h.query_id, h.rank, round(h.score, 6) AS score, '{D.BASE}W' || h.id AS work_id, raw_title AS title,
         abstract, publication_year, doi, url
  FROM hits h LEFT JOIN w ON w.doc_id = h.id
)"""


@query("hydrate", f"{SQL_FOUND} SELECT query_id, rank, work_id, title, abstract, publication_year, doi, url FROM found")
def hydrated(spark, sf):
    rows = hydrate(named_hits(spark, sf), D.works(spark, sf))
    return rows.withColumn("rank", F.col("rank").cast("bigint")).drop("score")


@query("hydration_coverage", f"""{SQL_FOUND}
    SELECT count(*) AS n_hits, count(*) FILTER (title <> '') AS n_with_title FROM found""")
def hydration_coverage(spark, sf):
    return coverage(hydrate(named_hits(spark, sf), D.works(spark, sf)))


@query("works_in_hits", f"{SQL_FOUND} SELECT DISTINCT w.id, w.doi FROM found JOIN w ON w.id = work_id")
def works_in_hits(spark, sf):
    short = named_hits(spark, sf).select(F.substring_index("id", "/", -1).alias("short_id"))
    return works_in(D.works(spark, sf), short).select("id", "doi")


@query("search_hydrated", f"{SQL_FOUND} SELECT * FROM found")
def search_hydrated(spark, sf):
    rows = hydrate(named_hits(spark, sf), D.works(spark, sf))
    return rows.withColumn("rank", F.col("rank").cast("bigint")).withColumn("score", F.round("score", 6))
