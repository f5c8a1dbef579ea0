import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.llm import hnsw, mixing, queries, toxicity

VEC = "vec_id long, embedding array<float>, rank int"


def exact(rows, every, k):
    usable = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault(i, np.array(v, np.float32).astype(float))
    out = []
    for q, x in usable.items():
        if q % every == 0:
            scored = sorted((-float(hnsw.product(x[None], y[None])[0]), j) for j, y in usable.items() if j != q and len(y) == len(x))
            out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_nearest_on_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 4)], 0) for i in range(60)]
    rows += [(100 + i, [1.0] * 6, 0) for i in range(40)] + rows[:3]
    rows += [(200, None, 0), (220, [], 0), (240, [0.0] * 6, 0), (260, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (280, [float("nan")] * 6, 0), (300, [float("inf")] * 6, 0), (None, [1.0] * 6, 0),
             (320, [1.0, 2.0], 0), (321, [3.0, 2.0], 0)]
    got = hnsw.nearest(spark.createDataFrame(rows, VEC), every=20, k=5).collect()
    assert sorted(map(tuple, got)) == exact(rows, 20, 5)  # so small a shard is searched whole


def test_few_vectors(spark):
    assert hnsw.nearest(spark.createDataFrame([], VEC)).count() == 0
    assert hnsw.nearest(spark.createDataFrame([(0, [1.0], 0)], VEC)).count() == 0


def test_recall_and_layers():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(50, 32))
    x = (centres[rng.integers(0, 50, 6000)] + 0.4 * rng.normal(size=(6000, 32))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = hnsw.Graph.build(x, hnsw.layer_sizes(len(x)))
    found, _ = graph.search(x[::30], hnsw.SEARCH_WIDTH)
    best = np.argsort(-(x[::30] @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best, found, strict=True)]) >= 0.95
    assert len(graph.layers) == 4 or len(graph.layers) == 3


def test_shards_widen_their_search_until_it_finds_enough():
    """Vectors without clusters: the fixed width misses one in six, the measured one does not."""
    rng = np.random.default_rng(3)
    base, asked = rng.normal(size=(4096, 64)), rng.normal(size=(100, 64))
    square = np.einsum("ij,ij->i", base, base)
    wide = np.concatenate([base, np.sqrt(square.max() - square)[:, None]], 1).astype(np.float32)
    graph = hnsw.Graph.build(wide, hnsw.layer_sizes(len(wide)))
    width = hnsw.search_width(graph, 21)
    true = np.argsort(-(asked @ base.T), axis=1)[:, :21]
    found, _ = graph.search(np.concatenate([asked, np.zeros((100, 1))], 1).astype(np.float32), width)
    assert width > hnsw.SEARCH_WIDTH and np.mean([len(set(a) & set(b)) for a, b in zip(true, found)]) > 0.95 * 21
    assert hnsw.search_width(graph, 21, recall=0.0) == hnsw.SEARCH_WIDTH
    few = hnsw.Graph.build(wide[:3], hnsw.layer_sizes(3))
    same = hnsw.Graph.build(np.repeat(wide[:1], 500, 0), hnsw.layer_sizes(500))
    assert hnsw.search_width(few, 21) == hnsw.search_width(same, 21) == hnsw.SEARCH_WIDTH


def test_shards_are_bounded_by_rows_and_bytes():
    for n in (1, 5000, 10**6, 10**9):
        for dims in (1, 64, 1024, 10**6):
            assert 1 <= hnsw.shard_rows(n, dims) <= 262_144 and hnsw.shard_rows(n, dims) * dims * 8 <= hnsw.SHARD_BYTES
    assert hnsw.shard_rows(10**5, 64) == 4096


def test_a_search_task_holds_few_candidates():
    """The products of 10,000 queries with all their candidates at once took a gigabyte a task."""
    rng = np.random.default_rng(5)
    x, asked = rng.normal(size=(600, 64)).astype(np.float32), rng.normal(size=(10_000, 64)).astype(np.float32)
    parts = list(hnsw.pieces([x[:100].copy(), x[100:].copy()], np.full(600, 2), np.arange(1200), 21))
    opened = hnsw.open_index(64, parts)
    tracemalloc.start()
    row, neg, vec = hnsw.answer(opened, asked, 21, None)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150 << 20
    assert (np.bincount(row) == 21).all()
    true = np.argsort(-(asked[::100].astype(float) @ x.T.astype(float)), axis=1)[:, :10]
    of = {r: vec[row == r][::2] // 2 for r in range(0, 10_000, 100)}  # each vector has two ids, the smaller one first
    assert np.mean([len(set(t) & set(of[r])) for t, r in zip(true, of, strict=True)]) >= 9.5


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_a_shard_goes_through_its_pieces(kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 70)).astype(kind)
    counts = np.arange(3000) % 3 + 1
    parts = list(hnsw.pieces([x[:7].copy(), x[7:].copy()], counts, np.arange(counts.sum()), 21))
    assert len(parts) > 5 and max(len(data) for _, data in parts) <= hnsw.PIECE_BYTES
    graph, given, at, ids, width = hnsw.open_index(70, parts)
    assert given.dtype == kind and np.array_equal(given, x) and np.array_equal(np.diff(at), counts) and np.array_equal(ids, np.arange(counts.sum()))
    assert width >= hnsw.SEARCH_WIDTH and [len(layer) for layer in graph.layers] == hnsw.layer_sizes(3000)
    same = hnsw.Graph.build(graph.x, hnsw.layer_sizes(3000))
    assert all(np.array_equal(a, b) for a, b in zip(graph.layers, same.layers, strict=True))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_shards_in_few_groups(spark, monkeypatch, kind):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5 + i % 2)], 0) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(30)]
    monkeypatch.setattr(hnsw, "shard_rows", lambda n, dims: 3)
    got = hnsw.nearest(spark.createDataFrame(rows, VEC.replace("float", kind)), every=20, k=5).collect()
    assert sorted(map(tuple, got)) == exact(rows, 20, 5)  # so small shards are searched whole


def test_no_row_of_the_index_is_large(spark):
    rng = np.random.default_rng(9)
    base = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(4000, 64)))], "vec_id long, v array<double>")
    index = hnsw.build(base, 1, 21)
    most = index.agg(F.max(F.greatest(*[F.octet_length(c) for c, t in index.dtypes if t == "binary"], F.lit(0)))).first()[0]
    assert 0 < most <= 1 << 20


def test_search_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, got = exact(rows, 20, 20), sorted(map(tuple, queries.op4_hnsw_search(spark, folder).collect()))
    assert len(got) == len(want)
    assert len({(a, c) for a, _, c, _ in got} & {(a, c) for a, _, c, _ in want}) >= 0.9 * len(want)


FILL = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def sentence(i, extra=()):
    rng = np.random.default_rng(i)
    return " ".join([*rng.choice(FILL, 20), *extra])


def test_ordinal_grades(spark, docs_of):
    bad = ["rotten", "vile", "filthy"]
    texts = [sentence(i, bad[: i % 4]) for i in range(240)]
    labels = spark.createDataFrame([(i, i % 4) for i in range(200)], "doc_id long, grade int")
    docs = docs_of(texts)
    model = toxicity.fit(docs, labels, "grade")
    assert set(bad) <= set(model.weights) and list(model.cuts) == sorted(model.cuts) and len(model.cuts) == 3
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = range(200, 240)
    assert np.mean([got[i].grade == i % 4 for i in held]) >= 0.9
    assert all(abs(got[i].expected_severity - i % 4) < 0.7 for i in held)
    assert all(r.at_least == sorted(r.at_least, reverse=True) for r in got.values())


def test_scoring_odd_rows(spark, docs_of):
    model = toxicity.Model({"vile": 9.0}, (3.0, 6.0))
    rows = docs_of([None, "", "clean " * 30_000, "x VILE, vile!", "vile", "vile"]).withColumn("at_least", F.lit(0)).withColumn("grade", F.lit(7))
    got = {r.doc_id: r for r in toxicity.score(rows, model).collect()}
    assert got[0].expected_severity == got[1].expected_severity == got[2].expected_severity < 0.1
    assert got[3] != got[0] and got[3][1:] == got[4][1:] == got[5][1:] and got[4].grade == 2
    s = lambda x: 1 / (1 + np.exp(-x))
    assert abs(got[4].expected_severity - s(6) - s(3)) < 1e-12
    assert toxicity.score(docs_of([]), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(0, 0)], [(0, 1), (None, 0), (1, None)]])
def test_nothing_to_learn(spark, docs_of, labels):
    docs = docs_of(["a b", "c d"])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")
    assert not any(r.expected_severity >= 0.5 for r in toxicity.score(docs, model).collect())
    graded = toxicity.graded_labels(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert graded.count() <= len(labels)


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op7_ordinal_toxicity(spark, folder).collect()}
    assert len(got) == 1000
    hit = np.mean([got[i].rejected for i, t in labels.items() if t])
    # here only English has more toxic labels than LEAST_TEXTS; the next test takes the languages one by one
    assert hit > 0.6 and not any(got[i].rejected for i, t in labels.items() if not t)


def test_toxic_texts_are_found_in_each_language(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, toxicity.graded_labels(docs, labels), "grade")
    judged = docs.join(labels, "doc_id").groupBy("lang", "toxic").agg(
        F.count(F.lit(1)).alias("n"), F.avg(toxicity.rejected(F.col("text"), model).cast("int")).alias("share")).collect()
    assert {r.lang for r in judged if r.toxic and r.n >= 30} == {"de", "en", "es", "fr"}
    assert all(r.share >= 0.85 for r in judged if r.toxic) and all(r.share <= 0.01 for r in judged if not r.toxic)


def test_near_copies_of_one_text_teach_no_word(spark):
    """Copies of a labelled text count once, so that its odd words are no sign."""
    own = lambda i: " ".join(f"w{chr(97 + (i * k) % 23)}{chr(97 + (i + 5 * k) % 19)}" for k in range(1, 15))
    clean = [(i, own(i), 0) for i in range(60)]
    bad = [(100 + i, f"nasty {own(100 + i)}", 1) for i in range(20)]
    copies = [(200 + i, "odd " + own(300) + " x" * i, 1) for i in range(20)]
    train = spark.createDataFrame(clean + bad + copies, "doc_id long, text string, grade int")
    assert "nasty" in toxicity.vocabulary(train) and "odd" not in toxicity.vocabulary(train)


def test_posteriors_and_rates(spark, docs_of):
    low = lambda i: sentence(i).replace(" ", " ||| ")
    texts = [low(i) if i % 3 == 0 else sentence(i) for i in range(300)] + [None, ""]
    docs = docs_of(texts).withColumn("_mix", F.lit("own")).withColumn("rate", F.lit(5))
    labels = spark.createDataFrame([(i, "low" if i % 3 == 0 else "high") for i in range(200)] + [(None, "low"), (5, None)], "doc_id long, domain string")
    model = mixing.train(docs, labels, "domain")
    shares = {"high": 0.5, "low": 0.5}
    rows = mixing.rates(docs, model, shares).collect()
    assert len(rows) == 302
    assert all((r.p_low > 0.5) == (r.doc_id % 3 == 0) for r in rows if r.doc_id < 300)
    high, small = (sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in ("high", "low"))
    assert abs(high / (high + small) - 0.5) < 0.005 and all(r.rate >= 0 and r.copies >= 1 for r in rows)
    out = mixing.resample(docs, model, shares)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)
    assert {r._mix for r in out.select("_mix").distinct().collect()} == {"own"}


def test_rates_equal_plain_projected_gradient(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.3, 0.3], 40).round(4)
    n = rng.integers(1, 100, 40)
    groups = spark.createDataFrame([([float(x) for x in a], int(b)) for a, b in zip(p, n, strict=True)], "p array<double>, tokens long")
    shares = [0.7, 0.29, 0.01]
    history, step, pull = mixing.fit(groups, shares, steps=25, near=0.0)
    got = [r.r for r in groups.select(mixing.rate_of(F.col("p"), history, step, pull).alias("r")).collect()]
    now = (p * n[:, None]).sum(0)
    aims, r = np.array(mixing.targets(list(now), shares)), np.ones(40)
    for _ in range(25):
        g = ((p * (n * r)[:, None]).sum(0) - aims) / now
        r = np.maximum(0, r - step * (p @ g + pull * (r - 1)))
    assert np.allclose(got, r) and len(history) == 25


def test_mixing_without_domains(spark, docs_of):
    docs = docs_of(["a b", None])
    for labels in ([], [(0, "high")]):
        model = mixing.train(docs, spark.createDataFrame(labels, "doc_id long, domain string"), "domain")
        rows = mixing.rates(docs, model, {"high": 1.0}).collect()
        assert [r.rate for r in rows] == [1.0, 1.0] and [r.copies for r in rows] == [1, 1]
    assert mixing.resample(docs_of([]), model, {"high": 1.0}).count() == 0


def test_domains_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = queries.quality_domains(spark.read.parquet(f"{folder}/labels.parquet"))
    model = mixing.train(docs, labels.filter("doc_id % 3 <> 0"), "domain")
    held = mixing.rates(docs, model, queries.SHARES).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    assert np.mean([(r.p_high >= 0.5) == (r.domain == "high") for r in held]) >= 0.85  # the labels are noisy
    assert queries.op6_soft_mixing(spark, folder).count() == 1000


def test_ordinal_solver_equals_plain_descent():
    """Weights, cuts and penalised loss against plain gradient descent with numeric gradients."""
    rng = np.random.default_rng(12)
    rows, truth = [], np.array([2.5, 1.5, -1.0, 0.0])
    for _ in range(400):
        words = np.flatnonzero(rng.random(4) < 0.4).tolist()
        latent = truth[words].sum() + rng.logistic()
        rows.append((words, int(latent > 1.0) + int(latent > 2.5)))
    x = np.array([[w in words for w in range(4)] for words, _ in rows], float)
    y = np.array([g for _, g in rows])

    def loss(p):
        cuts = np.array([p[4], p[4] + np.exp(p[5])])
        above = 1 / (1 + np.exp(cuts[None, :] - (x @ p[:4])[:, None]))
        chance = np.stack([1 - above[:, 0], above[:, 0] - above[:, 1], above[:, 1]], 1)[np.arange(len(y)), y]
        return (-np.log(chance).sum() + 0.05 / 2 * (p[:4] ** 2).sum()) / len(y)

    p = np.zeros(6)
    for _ in range(1500):
        p -= np.array([(loss(p + e) - loss(p - e)) / 2e-5 for e in np.eye(6) * 1e-5])
    w, cuts = toxicity.solve(rows, 4, 3)
    got = np.concatenate([w, cuts[:1], [np.log(cuts[1] - cuts[0])]])
    assert abs(loss(got) - loss(p)) < 1e-4 and np.allclose(got, p, atol=0.05)
