"""Models, metrics and clustering on small fixtures."""

import random

import pytest

from tessera.operators import cluster as clu
from tessera.operators import models as mdl
from tessera.operators import recommend as rec


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(1)
    rows = [(i, float(y) * 3 + rnd.random(), rnd.random(), y) for i, y in
            ((i, i % 2) for i in range(200))]
    return spark.createDataFrame(rows, "id INT, x1 DOUBLE, x2 DOUBLE, y INT")


def test_sweep_separable_auc_one(separable):
    cfg = {"glm": ("glm", {}), "dt": ("dt", {"maxDepth": 3}), "gbt": ("gbt", {"maxIter": 5})}
    res, models = mdl.sweep(separable, separable, cfg, [mdl.assemble(["x1", "x2"])], "y")
    aucs = {r.config: r.auc for r in res.collect()}
    assert all(a == pytest.approx(1.0) for a in aucs.values())
    assert mdl.best_config(res, list(cfg)) == "glm"         # ties → first in order (Q13)
    imp = mdl.importance(models["gbt"], ["x1", "x2"]).collect()
    assert imp[0].feature == "x1"


def test_binary_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.2), (0, 0.6)], "y INT, p DOUBLE")
    m = mdl.binary_metrics(df, "y", "p", threshold=0.5).first()
    assert (m.tp, m.fp, m.tn, m.fn) == (1, 1, 1, 1)
    assert m.misclassification == pytest.approx(0.5)
    assert m.auc == pytest.approx(0.75)


def test_glm_estimates_and_persisted_scoring(spark, separable):
    import tempfile
    m, sc = mdl.fit_score(mdl.make_estimator("glm", "y"), [mdl.assemble(["x2"])], separable, separable, "glm")
    est = {r.term: r for r in mdl.glm_estimates(m, ["x2"]).collect()}
    assert set(est) == {"x2", "(intercept)"} and est["x2"].std_error > 0
    path = tempfile.mkdtemp(prefix="tessera-model-") + "/m"
    mdl.save_model(m, path)
    again = mdl.load_and_score(path, separable, "glm", "id")
    a = {r.id: r.score for r in sc.select("id", "score").collect()}
    assert all(a[r.id] == pytest.approx(r.score) for r in again.collect())


def test_kmodes_recovers_groups(spark):
    rows = [(i, "a" if i < 50 else "b", "x" if i < 50 else "y", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id INT, c1 STRING, c2 STRING, c3 INT")
    assigned, modes = clu.kmodes(df, "id", ["c1", "c2", "c3"], 2, 7)
    groups = {r.cluster: set() for r in assigned.collect()}
    for r in assigned.collect():
        groups[r.cluster].add(r.c1)
    assert all(len(v) == 1 for v in groups.values())


def test_kmeans_gap_picks_clusters(spark):
    rnd = random.Random(2)
    rows = [(i, [c * 10.0 + rnd.gauss(0, 0.3), c * -10.0 + rnd.gauss(0, 0.3)])
            for i, c in ((i, i % 3) for i in range(150))]
    df = spark.createDataFrame(rows, "id INT, v ARRAY<DOUBLE>")
    f = clu.standardized_features(df, vector="v")
    table, k = clu.kmeans_choose_k(f, 2, 5, 1, refs=2, key="id")
    assert k == 3


def test_kmeans_costs_are_those_of_spark_ml_in_few_jobs(spark):
    """Every k's cost is that of a KMeans fit of its own, but the iterations of all k and sets are common jobs."""
    import math

    from pyspark.ml.clustering import KMeans
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(900)], "id INT, v ARRAY<DOUBLE>")
    f = clu.materialize(clu.standardized_features(df, vector="v"))
    spark.sparkContext.setJobGroup("kmeans-one", "one fit")
    KMeans(k=7, seed=3, maxIter=100).fit(f)
    alone = len(spark.sparkContext.statusTracker().getJobIdsForGroup("kmeans-one"))
    spark.sparkContext.setJobGroup("kmeans-all", "choice")
    table, _ = clu.kmeans_choose_k(f, 2, 9, 3, refs=3, key="id")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("kmeans-all"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for r in table.collect():
        fit = KMeans(k=r.k, seed=3, maxIter=100).fit(f)
        assert r.log_w == pytest.approx(math.log(fit.summary.trainingCost), abs=1e-9)
    assert jobs < 32 * alone * 0.6          # 8 numbers of clusters on 4 sets


def test_als_grid_smoke(spark):
    rows = [(u, i, 1 + (u * i) % 5) for u in range(12) for i in range(10) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user_id INT, item_id INT, plays INT")
    pos = train.filter("item_id < 3").select("user_id", "item_id")
    neg = train.filter("item_id >= 7").select("user_id", "item_id")
    g = rec.als_grid(train, pos, neg, "user_id", "item_id", "plays", [2], [1.0], [0.1, 1.0], max_iter=3)
    assert g.count() == 2
    assert rec.best_params(g).count() == 1


def test_grid_fits_take_fewer_item_blocks_and_score_the_same(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [(u, i, rnd.randint(1, 50)) for u in range(400) for i in rnd.sample(range(90), 14)]
    every = spark.createDataFrame(rows, "user_id INT, item_id INT, plays INT")
    train, held = clu.materialize(every.filter("(user_id + item_id) % 5 > 0")), every.filter("(user_id + item_id) % 5 = 0")
    pos = clu.materialize(held.select("user_id", "item_id"))
    neg = clu.materialize(pos.selectExpr("user_id", "(item_id * 7 + 3) % 90 AS item_id"))
    names = ["user_id", "item_id", "plays"]
    scores, auc = [], []
    for reg in (2.0, 3.5):
        m = rec.als(6, 5.0, reg, *names).fit(train)
        own = rec.score_pairs(m, pos, "user_id", "item_id")
        per = rec.user_auc(own, rec.score_pairs(m, neg, "user_id", "item_id"), "user_id", "score", neg_bound=90)
        scores.append({(r.user_id, r.item_id): r.score for r in own.collect()})
        auc.append(rec.mean_auc(per).first()["mean_auc"])
    blocks, plain = [], rec.als

    def spy(*given):
        blocks.append(plain(*given).getNumItemBlocks())
        return plain(*given)

    monkeypatch.setattr(rec, "als", spy)
    grid = {r.reg: r.mean_auc for r in rec.als_grid(train, pos, neg, *names, [6], [5.0], [2.0, 3.5], neg_bound=90).collect()}
    assert blocks == [3, 3]
    assert [grid[2.0], grid[3.5]] == pytest.approx(auc, abs=1e-4)
    few = plain(6, 5.0, 2.0, *names, item_blocks=3).fit(train)
    for r in rec.score_pairs(few, pos, "user_id", "item_id").collect():
        assert r.score == pytest.approx(scores[0][r.user_id, r.item_id], abs=1e-5)
    assert [rec.shared_item_blocks(n) for n in (0, 15_000_000, 15_000_001, 10**9)] == [3, 3, 4, 10]


def test_epochs_carry_weights_and_keep_the_best(spark, separable):
    """The history is what single epochs from the same weights give, and the model is that of its best epoch."""
    df = mdl.assemble(["x1", "x2"]).transform(separable)
    train, valid = df.filter("id % 5 > 0"), df.filter("id % 5 = 0")
    model, history = mdl.fit_epochs(train, valid, "y", [2, 3, 2], most=8, patience=2, seed=3)
    loss = lambda m: mdl.binary_metrics(mdl.positive_score(m.transform(valid), "mlp"), "y", "score").first()["log_loss"]
    best, least = mdl.best_epoch(history)
    assert loss(model) == pytest.approx(least, abs=1e-12)
    weights, again = None, []
    for _ in history:
        more = {} if weights is None else {"initialWeights": weights}
        m = mdl.make_estimator("mlp", "y", seed=3, layers=[2, 3, 2], maxIter=1, blockSize=128, **more).fit(train)
        weights = m.weights
        again.append(loss(m))
    assert again == pytest.approx([x for _, x in history], abs=1e-9)
    # it stops at the first epoch that is ``patience`` behind the best, and not before
    assert len(history) == 8 or len(history) - best == 2
    assert mdl.best_epoch([(1, 0.5), (2, 0.3), (3, 0.3), (4, 0.4)]) == (2, 0.3)


def test_kmodes_on_patterns_equals_rows(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(i, rnd.choice("abcd"), rnd.choice(["x", "y", None]), rnd.randint(0, 2)) for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, c1 STRING, c2 STRING, c3 INT")
    cols = ["c1", "c2", "c3"]
    assigned, modes = clu.kmodes(df, "id", cols, 4, 7)
    modes = [tuple(r) for r in modes.orderBy("cluster").collect()]
    far = lambda r, m: sum(a is None or a != b for a, b in zip(r[1:], m[1:]))
    want = {r[0]: min((far(r, m), m[0]) for m in modes) for r in rows}
    assert {r.id: (r.mismatch, r.cluster) for r in assigned.collect()} == want
    for m in modes:             # a fixed point: every mode holds its rows' most frequent values
        own = [r for r in rows if want[r[0]][1] == m[0]]
        for i in (1, 2, 3):
            count = {v: sum(r[i] == v for r in own) for v in {r[i] for r in own}}
            assert not own or count[m[i]] == max(count.values())
    monkeypatch.setattr(clu, "SMALL", 0)
    assert [tuple(r) for r in clu.kmodes(df, "id", cols, 4, 7)[1].orderBy("cluster").collect()] == modes
    assert clu.kmodes(df.limit(0), "id", cols, 4, 7)[0].count() == 0


def test_concurrent_jobs_keep_order_properties_and_errors(spark):
    from tessera.session import concurrently
    sc = spark.sparkContext
    sc.setLocalProperty("spark.scheduler.pool", "mine")
    try:
        assert concurrently([lambda k=k: (k, sc.getLocalProperty("spark.scheduler.pool")) for k in range(6)], 3) == [(k, "mine") for k in range(6)]
        with pytest.raises(ZeroDivisionError):
            concurrently([lambda: 1, lambda: 1 // 0, lambda: 2])
    finally:
        sc.setLocalProperty("spark.scheduler.pool", None)


def test_tower_means_weigh_repeated_tokens(spark):
    from tessera.functions.hashing import hash32
    from tessera.operators import twotower as tt
    from pyspark.sql import functions as F
    emb = spark.createDataFrame([(i, [float(i), i * i / 7.0]) for i in range(11)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    pairs = spark.createDataFrame([(1, ["u", "v", "u", "u"], ["w"]), (2, [], ["z", "z"]), (3, None, [])], "id INT, a ARRAY<STRING>, b ARRAY<STRING>")
    at = {r.t: r.k for r in spark.createDataFrame([(c,) for c in "uvwz"], "t STRING").select("t", F.pmod(hash32("tok", "t"), F.lit(11)).alias("k")).collect()}
    vec = lambda c: [float(at[c]), at[c] ** 2 / 7.0]
    mean = lambda cs: [sum(x) / len(cs) for x in zip(*map(vec, cs))] if cs else [0.0, 0.0]
    got = {r.id: r for r in tt.two_tower_features(pairs, "id", "a", "b", emb, 11, 2).collect()}
    for i, a, b in [(1, "uvuu", "w"), (2, "", "zz"), (3, "", "")]:
        assert got[i]["sum"] == pytest.approx([x + y for x, y in zip(mean(a), mean(b))], abs=1e-9)
        assert got[i]["sq_diff"] == pytest.approx([(x - y) ** 2 for x, y in zip(mean(a), mean(b))], abs=1e-9)


@pytest.mark.parametrize("block", [1 << 18, 4])
def test_towers_join_no_vector_to_a_token(spark, monkeypatch, block):
    """Blocks of the table, vec_ids that repeat or are missing, repeated and missing ids, missing texts, tokens, vectors and components; no join."""
    from collections import Counter
    from hashlib import md5
    from tessera.operators import twotower as tt
    monkeypatch.setattr(tt, "BLOCK", block, raising=False)
    vecs = [(i, [i + 0.5, i * i / 7.0]) for i in range(11) if i != 7] + [(3, [100.0, -1.0]), (None, [9.0, 9.0]), (40, [1.0, 1.0]), (5, [None, 2.0]), (6, None)]
    words = [f"w{i}" for i in range(40)]
    rows = [(i, words[i:i + 9] * 2 + words[:i], words[3 * i % 40:]) for i in range(12)]
    rows += [(1, ["x", None, "x"], ["w1"]), (1, [], None), (None, ["w1"], ["w2"]), (None, ["w3"], None), (20, None, None), (21, [], ["w5"])]
    pairs = spark.createDataFrame(rows, "id INT, a ARRAY<STRING>, b ARRAY<STRING>").repartition(3)
    out = tt.two_tower_features(pairs, "id", "a", "b", spark.createDataFrame(vecs, "vec_id LONG, embedding ARRAY<DOUBLE>"), len(vecs), 2)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    held = {}
    for i, a, b in rows:
        for side, t in enumerate((a, b)):
            held.setdefault(i, (Counter(), Counter()))[side].update(
                int(md5(("tok" if w is None else f"tok|{w}").encode()).hexdigest()[:8], 16) % len(vecs) for w in t or [])

    def mean(n):
        own = [(n[i], [x or 0.0 for x in v]) for i, v in vecs if i is not None and v is not None and n[i]]
        return [sum(k * v[d] for k, v in own) / sum(k for k, _ in own) if own else 0.0 for d in (0, 1)]
    got = out.collect()
    assert Counter(r.id for r in got) == Counter(i for i, _, _ in rows)
    for r in got:
        a, b = ([0.0, 0.0], [0.0, 0.0]) if r.id is None else map(mean, held[r.id])
        assert r["sum"] == pytest.approx([x + y for x, y in zip(a, b)], abs=1e-9), r
        assert r["sq_diff"] == pytest.approx([(x - y) ** 2 for x, y in zip(a, b)], abs=1e-9), r


def test_als_frees_what_earlier_iterations_shipped(spark):
    """The scores are those of a fit without early checkpoints, and fewer shuffle files lie on the disk at once."""
    import threading
    from pyspark.ml.recommendation import ALS
    from tessera.operators import recommend as rec
    rows = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(60) for i in range(40) if (u + i) % 3 == 0], "user INT, item INT, n DOUBLE").cache()
    rows.count()
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {m for m in disk.getAllFiles().mkString("\n").split("\n") if m.endswith(".data") and "shuffle_" in m}

    def most(als):
        before, seen, over = files(), [0], threading.Event()

        def look():
            while not over.wait(0.02):
                seen[0] = max(seen[0], len(files() - before))
        t = threading.Thread(target=look)
        t.start()
        try:
            model = als.fit(rows)
        finally:
            over.set()
            t.join()
        return seen[0], {(r.user, r.item): r.score for r in rec.score_pairs(model, rows, "user", "item").collect()}
    whole, want = most(ALS(implicitPrefs=True, rank=4, alpha=2.0, regParam=1.0, userCol="user", itemCol="item", ratingCol="n", seed=0, maxIter=10))
    own, got = most(rec.als(4, 2.0, 1.0, "user", "item", "n"))
    assert got == want and own < 0.7 * whole, (own, whole)
