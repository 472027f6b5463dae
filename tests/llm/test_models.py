"""Toxicity, language model and embedding search."""

import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import hmm_lm
from quire.llm.components import components, local_roots
from quire.llm.embedding_dedup import Options, embedding_dedup, forest, unit
from quire.llm.hmm_lm import Model, forward, hmm_scores
from quire.llm.toxicity import drop_toxic, fit_logistic, score_documents, train


def talk(rnd, words, n, extra=()):
    out = rnd.choices(words, k=n)
    for x in extra:
        out.insert(rnd.randrange(len(out)), x)
    return " ".join(out)


@pytest.fixture(scope="module")
def spoken(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(80)]
    bad = ["vile", "nasty", "awful"]
    rows = []
    for i in range(400):
        toxic = i % 5 == 0
        rows.append((i, talk(rnd, words, rnd.randint(20, 60), rnd.sample(bad, 2) if toxic else ()), int(toxic), 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, score double")


def test_toxicity_of_unseen_texts(spark, spoken):
    labels = spoken.where("doc_id < 300").select("doc_id", "toxic")
    model = train(spoken.select("doc_id", "text", "score"), labels.unionByName(labels.limit(5)))
    rest = spoken.where("doc_id >= 300")
    got = {r.doc_id: r for r in score_documents(rest, model).collect()}
    hits = [got[r.doc_id].predicted == r.toxic for r in rest.collect()]
    assert np.mean(hits) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "w1 vile nasty awful w2"), (4, "vile " * 5000), (4, "w3"), (4, "w3")], "doc_id long, text string")
    scores = score_documents(odd, model).collect()
    assert len(scores) == 6 and scores[0].score == scores[1].score < 0.7
    assert scores[2].predicted == 1 and scores[4] == scores[5]
    kept = drop_toxic(rest, model)
    assert kept.columns == rest.columns and kept.count() == sum(r.predicted == 0 for r in got.values())


def test_toxicity_without_a_class(spark, spoken):
    assert train(spoken, spoken.where("toxic = 0").select("doc_id", "toxic")) is None
    none = spoken.limit(0)
    assert train(none, none.select("doc_id", "toxic")) is None
    assert {r.score for r in score_documents(spoken.limit(3), None).collect()} == {0.0}


def told_apart(spark, rows, texts):
    """Scores of ``texts`` by a model learnt from (id, text, toxic) rows."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.score for r in score_documents(asked, model).orderBy("doc_id").collect()]


def kept_out(i):
    return zlib.crc32(f"fit{i}".encode()) % 4 == 0


def test_toxicity_knows_more_words_than_any_fixed_number(spark):
    words = [f"w{i}" for i in range(31_000)]
    # each of them ten times in either class, more often than the toxic word
    rows = [" ".join(words[i::100]) for _ in range(20) for i in range(100)]
    rows = [(i, x, i // 100 % 2) for i, x in enumerate(rows)]
    seen = [i for i, _, toxic in rows if toxic and not kept_out(i)][:4]
    bad = [i for i, _, toxic in rows if toxic]
    rows = [(i, x + " vile" * (i in seen) + " nasty" * (i in bad), toxic) for i, x, toxic in rows]
    vile, unknown = told_apart(spark, rows, ["w1 vile w2", "w1 unheard w2"])
    assert vile > unknown


def test_toxicity_without_broadcasts(spark, spoken, no_broadcast):
    labels = spoken.where("doc_id < 300").select("doc_id", "toxic")
    docs = spoken.withColumn("text", F.expr("IF(doc_id = 7, NULL, text)")).repartition(5)
    asked = train(docs, labels)
    shuffled = sorted(score_documents(docs, asked).collect())
    kept = sorted(drop_toxic(docs, asked).select("doc_id", "score").collect())
    spark.conf.set("quire.broadcast.maxBytes", str(1 << 28))
    sent = train(docs, labels)
    assert shuffled == sorted(score_documents(docs, sent).collect()) and len(shuffled) == 400
    assert kept == sorted(drop_toxic(docs, sent).select("doc_id", "score").collect())
    assert score_documents(docs.limit(0), asked).count() == 0


def test_toxicity_of_phrases_of_ordinary_words(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        own = rnd.choices(words, k=30)
        # both classes hold both words, toxic texts next to each other
        at = rnd.randrange(28)
        own[at:at] = ["go", "home"] if i % 10 == 0 else ["go", "w1", "home"] if i % 10 < 5 else ["home", "w1", "go"]
        rows.append((i, " ".join(own), int(i % 10 == 0)))
    together, apart = told_apart(spark, rows, ["w3 w4 go home w5 w6", "w3 go w4 w5 home w6"])
    assert together > apart


def test_toxicity_counts_what_the_weights_were_fitted_on(spark):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, talk(rnd, words, 20, ["nasty", *["vile"] * kept_out(i)] if toxic else ()), int(toxic)))
    vile, unknown = told_apart(spark, rows, ["w1 vile w2", "w1 unheard w2"])
    assert vile > unknown


def test_logistic_fit_is_stationary():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 2)) * [3, 0.1] + [1, 5]
    y = (rng.random(500) < 1 / (1 + np.exp(-(x[:, 0] - 1)))).astype(float)
    w = fit_logistic(x, y, penalty=1e-9)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    assert abs((y - p).sum()) < 1e-3 and np.abs(x.T @ (y - p)).max() < 1e-2


def brute_forward(model, codes):
    alpha = model.start * model.emits[codes[0]]
    for c in codes[1:]:
        alpha = (alpha @ model.moves) * model.emits[c]
    return math.log(alpha.sum())


def small_model(k=3, classes=5, seed=0):
    rng = np.random.default_rng(seed)
    share = lambda *shape: (x := rng.random(shape) + 0.1) / x.sum(axis=-1, keepdims=True)
    return Model(share(k), share(k), share(k, k), share(k, classes).T)


def test_forward_and_expected_counts():
    model = small_model()
    rng = np.random.default_rng(2)
    n = np.array([1, 4, 2, 7])
    codes = rng.integers(0, 5, n.sum())
    first = np.cumsum(n) - n
    texts = [codes[a:a + m] for a, m in zip(first, n, strict=True)]
    assert np.allclose(forward(model, codes, n), [brute_forward(model, x) for x in texts])
    assert forward(model, codes[:0], n[:0]).shape == (0,)
    options = hmm_lm.Options(states=3, word_bits=1, ending_bits=1, run=100)
    total = np.zeros((options.classes + 6) * 3)
    hmm_lm.add_expected(total, model, codes, n, np.array([True, True, False, True]), options)
    total = total.reshape(-1, 3)
    wanted = np.zeros((5, 3))
    moves = np.zeros((3, 3))
    for x in (texts[0], texts[1], texts[3]):
        whole = math.exp(brute_forward(model, x))
        for path in np.ndindex(*[3] * len(x)):
            p = model.start[path[0]] * model.emits[x[0], path[0]]
            for a, b, c in zip(path, path[1:], x[1:], strict=False):
                p *= model.moves[a, b] * model.emits[c, b]
            for c, s in zip(x, path, strict=True):
                wanted[c, s] += p / whole
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / whole
    assert np.allclose(total[:5], wanted) and np.allclose(total[5:8], moves)
    assert np.isclose(total[10, 0], sum(brute_forward(model, x) for x in (texts[0], texts[1], texts[3])))


def test_language_model(spark):
    rnd = random.Random(9)
    tongues = [[f"{p}{i}" for i in range(50)] for p in ("xa", "yo")]
    rows = [(i, talk(rnd, tongues[i % 2], rnd.randint(30, 60)).title(), "z") for i in range(120)]
    rows += [(200, None, "z"), (201, "", "z"), (202, "xa1 " * 3000, "z"), (None, "xa1 yo2", "z"), (203, "unseen words", "z"), (5, rows[5][1], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    got = hmm_scores(docs, hmm_lm.Options(states=2, prior=10.0, start_texts=40, frequent=5, run=32)).collect()
    assert len(got) == len(rows)
    words = {(k, t): [*(t or "").lower().split(), None] for k, t, _ in rows}
    out = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, *_ in rows}
    count = Counter(w for k, t, _ in rows if not out[k] for w in words[k, t])
    n, v = sum(count.values()), len(count)
    want = Counter((k, out[k], len(words[k, t]), sum(count[w] > 0 for w in words[k, t]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[k, t]), 6)) for k, t, _ in rows)
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    unseen = [r for r in got if r.held_out and r.n_tokens > 20]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert hmm_scores(docs.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(0, x) for x in range(500, 900)]
    want = local_roots(pairs)
    want = {x: r for x, r in want.items() if any(x in p and p[0] != p[1] for p in pairs)}
    links = spark.createDataFrame([*pairs, (None, 3), (7, None)], "a long, b long").repartition(7)
    for split in (1, 7):
        got = [(r.node, r.root) for r in components(links.repartition(split)).collect()]
        assert len(got) == len(set(got)) and dict(got) == want
    assert components(links.limit(0)).count() == 0


def jobs_of(spark, run):
    """What ``run`` returns, and the Spark jobs it took."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        return run(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_components_few_links_at_once(spark, monkeypatch):
    """Links that no task joins by itself are joined over the rounds; ids may be negative."""
    monkeypatch.setattr("quire.llm.components.AT_ONCE", 5)
    rnd = random.Random(8)
    ids = [rnd.randrange(-(1 << 62), 1 << 62) for _ in range(300)]
    pairs = [*zip(ids[:149], ids[1:150], strict=True), *((ids[150], x) for x in ids[151:260]), *((rnd.choice(ids[150:160]), x) for x in ids[200:260:9])]
    want = {x: r for x, r in local_roots(pairs).items()}
    got = [(r.node, r.root) for r in components(spark.createDataFrame(pairs * 2, "a long, b long").repartition(6)).collect()]
    assert len(got) == len(set(got)) and dict(got) == want


def test_rounds_of_components_take_few_jobs(spark):
    """The driver keeps every stage and task of a plan for a while, so a round must not shuffle more often than it has to."""
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, x) for x in range(500, 900)] + [(x, x + 400) for x in range(500, 900, 7)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got, jobs = jobs_of(spark, lambda: {r.node: r.root for r in components(links).collect()})
    assert got == local_roots(pairs)
    assert jobs <= 24


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        middle = rng.standard_normal(16)
        rows += [(middle + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist() for _ in range(rng.integers(1, 25))]
    return rows


def test_embeddings(spark):
    own = vectors()
    rows = [(i, v, "x") for i, v in enumerate(own)] + [(5000 + i, own[0], "x") for i in range(30)]
    odd = [(9001, None, "x"), (9002, [0.0] * 16, "x"), (9003, [float("nan")] * 16, "x"), (9004, [None] + [1.0] * 15, "x"), (9005, [1.0, 2.0], "x"), (9006, [], "x"), (9007, [3e38] * 16, "x")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, node string").repartition(3)
    # all in one leaf, in several chunks: exact
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(table, Options(leaf=4096, chunk=64, trees=3)).collect()}
    good = [r for r in rows + odd[-1:]]
    v = unit([r[1] for r in good])
    near = v @ v.T >= 0.9
    np.fill_diagonal(near, False)
    roots = local_roots((good[a][0], good[b][0]) for a, b in zip(*np.nonzero(near), strict=True))
    want = {r[0]: (int(n), roots.get(r[0], r[0]), roots.get(r[0], r[0]) == r[0]) for r, n in zip(good, near.sum(axis=1), strict=True)}
    want |= {r[0]: (0, r[0], True) for r in odd[:-1]}
    assert got == want
    # many small leaves: nothing false, nearly all found, a pair counted once
    some = embedding_dedup(table, Options(leaf=40, chunk=16, trees=6)).collect()
    assert all(r.n_links <= want[r.vec_id][0] for r in some)
    assert sum(r.n_links for r in some) >= 0.9 * sum(x[0] for x in want.values())
    assert embedding_dedup(table.limit(0)).count() == 0



def test_embeddings_of_several_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(60)] + [(100 + i, rng.standard_normal(8).tolist()) for i in range(50)]
    rows += [(200 + i, [x * 1.5 + 1e-6 for x in v]) for i, (_, v) in enumerate(rows[::10])] + [(300, [1.0, 2.0]), (301, [2.0, 4.0]), (302, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    want = {r[0]: (0, r[0]) for r in rows} | {300: (2, 300), 301: (2, 300), 302: (2, 300)}
    for i, (k, _) in enumerate(rows[:110:10]):
        want |= {k: (1, k), 200 + i: (1, k)}
    for leaf in (4096, 30):
        assert {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(table, Options(leaf=leaf, chunk=64, trees=6)).collect()} == want


def test_trees_hold_every_row():
    rows = unit(vectors(3))
    for tree in forest(rows, len(rows), Options(leaf=50)):
        placed = tree.place(rows)
        assert len(placed) > 1 and set(np.concatenate([at for at, _ in placed]).tolist()) == set(range(len(rows)))
