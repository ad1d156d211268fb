"""Hot keys: one user / stratum holding about a third of all rows gives the
same answers as brute force, across different input partitionings."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ranking
from tessera.operators import survival as sv


def test_user_auc_with_hot_user(spark):
    rnd = random.Random(9)
    prow, nrow = [], []
    for u in range(60):
        n_pos = 900 if u == 0 else rnd.randint(1, 20)        # user 0: ~1/3 of positives
        prow += [(u, float(rnd.randint(0, 50))) for _ in range(n_pos)]
        nrow += [(u, float(rnd.randint(0, 50))) for _ in range(rnd.randint(1, 25))]
    for parts in (1, 13):
        p = spark.createDataFrame(prow, "user_id INT, score DOUBLE").repartition(parts)
        n = spark.createDataFrame(nrow, "user_id INT, score DOUBLE").repartition(parts)
        got = {r.user_id: r.auc for r in ranking.user_auc(p, n, "user_id", "score").collect()}
        for u in (0, 1, 2):
            ps = [s for uu, s in prow if uu == u]
            ns = [s for uu, s in nrow if uu == u]
            exp = sum(1 for a in ps for b in ns if a > b) / (len(ps) * len(ns))
            assert got[u] == pytest.approx(exp)


def test_km_hot_stratum_matches_product_limit(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        s = "hot" if i % 3 else f"s{i % 7}"                  # 'hot' holds 2/3 of subjects
        rows.append((i, s, rnd.randint(1, 60), int(rnd.random() < 0.6)))
    df = spark.createDataFrame(rows, "id INT, stratum STRING, time INT, event INT").repartition(9)
    km = {(r.stratum, r.time): r.surv for r in
          sv.kaplan_meier(df, "time", "event", stratum="stratum").filter("stratum = 'hot'").collect()}
    hot = sorted((t, e) for _, s, t, e in rows if s == "hot")
    surv, n, out = 1.0, len(hot), {}
    for t in sorted({t for t, _ in hot}):
        d = sum(1 for tt, e in hot if tt == t and e == 1)
        m = sum(1 for tt, _ in hot if tt == t)
        surv *= 1 - d / n
        out[t] = surv
        n -= m
    for t, s in out.items():
        assert km[("hot", t)] == pytest.approx(s, abs=1e-12)


def test_global_auc_with_one_outlier_and_ties(spark):
    from tessera.operators.models import auc
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 1), rnd.choice([0.25, rnd.random()])) for _ in range(3000)] + [(1, 1e12), (0, float("nan"))]
    rank = lambda s: float("inf") if s != s else s
    pos, neg = [rank(s) for y, s in rows if y], [rank(s) for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y INT, s DOUBLE").repartition(5)
    assert auc(df, "y", "s").first()["auc"] == pytest.approx(want, abs=1e-9)


def test_surrogate_ids_with_payload(spark):
    """Ids are 1..n in order, whatever columns travel along and however small the partitions are."""
    from tessera.operators.cohort import surrogate_id
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    try:
        for size in ("1m", "64m"):
            spark.conf.set(key, size)
            out = surrogate_id(li, order, "id")
            r = out.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"),
                        F.max("id").alias("hi")).first()
            assert r.n == r.d == r.hi == li.count() and r.lo == 1
            swaps = out.select("id", F.struct(*order).alias("k")).alias("a").join(
                out.select((F.col("id") - 1).alias("id"), F.struct(*order).alias("n")), "id").filter("k > n")
            assert swaps.count() == 0
    finally:
        spark.conf.set(key, old)


def test_many_ties_at_one_time(spark, monkeypatch):
    """Over half of the events at one time: blocks of tied events give the same fit as one block."""
    from tessera.operators import survival as s
    rnd = random.Random(2)
    rows = [(10 if rnd.random() < 0.6 else rnd.randint(1, 30), rnd.randint(0, 1), rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "t INT, e INT, x INT")
    fit = lambda: s.cox_ph(df, "t", "e", ["x"])
    whole, tests = fit()
    assert tests.first().converged
    monkeypatch.setattr(s, "TIE_BLOCK", 7)
    assert fit()[0].first().coef == pytest.approx(whole.first().coef, abs=1e-9)


def test_concordance_against_all_pairs(spark):
    from tessera.operators import survival as s
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 12), rnd.randint(0, 1), float(rnd.randint(0, 9))) for _ in range(150)]
    coefs = spark.createDataFrame([("x", 0.5)], "term STRING, coef DOUBLE")
    got = s.concordance(spark.createDataFrame(rows, "t INT, e INT, x DOUBLE"), "t", "e", ["x"], coefs).first()
    con = dis = tie = 0
    for t, e, x in rows:
        for u, f, y in rows:
            if e and (u > t or (u == t and not f)):
                con, dis, tie = con + (x > y), dis + (x < y), tie + (x == y)
    assert (got.concordant, got.discordant, got.tied_risk) == (con, dis, tie)


def test_logistic_estimates_match_an_independent_fit(spark):
    import numpy as np
    from tessera.operators import models as m
    rnd = np.random.default_rng(5)
    rows = [(rnd.choice(["de", "en", "fr"]), float(rnd.normal())) for _ in range(600)]
    y = [int(rnd.random() < 1 / (1 + np.exp(-(0.3 + 0.8 * (a == "en") - 0.6 * (a == "de") + 0.5 * x)))) for a, x in rows]
    df = spark.createDataFrame([(str(a), x, float(z)) for (a, x), z in zip(rows, y)], "lang STRING, x DOUBLE, y DOUBLE")
    fit, names = m.dummies(df, m.levels_of(df, ["lang"]))
    names += ["x"]
    model, _ = m.fit_score(m.make_estimator("glm", "y"), [m.assemble(names)], fit, fit.limit(0), "glm")
    got = {r.term: r for r in m.glm_estimates(model, names).collect()}
    X = np.array([[a == "de", a == "en", x, 1.0] for a, x in rows], float)
    b, Y = np.zeros(4), np.array(y, float)
    for _ in range(30):
        p = 1 / (1 + np.exp(-X @ b))
        info = X.T @ (X * (p * (1 - p))[:, None])
        b += np.linalg.solve(info, X.T @ (Y - p))
    se = np.sqrt(np.diag(np.linalg.inv(info)))
    for k, term in enumerate(["lang_de", "lang_en", "x", "(intercept)"]):
        assert got[term].estimate == pytest.approx(b[k], abs=1e-4)
        assert got[term].std_error == pytest.approx(se[k], abs=1e-3)


def test_quantiles_by_rank_with_hot_group_and_value(spark):
    import numpy as np
    from tessera.operators.quantiles import quantiles
    rnd = random.Random(6)
    rows = [("hot", rnd.choice([5.0, 5.0, rnd.random() * 10])) for _ in range(900)]
    rows += [(f"g{i % 7}", rnd.random()) for i in range(200)] + [("one", 3.0), ("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE").repartition(6)
    got = {r.g: r for r in quantiles(df, ["g"], "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).collect()}
    assert set(got) == {g for g, x in rows if x is not None}
    for g, r in got.items():
        own = [x for k, x in rows if k == g and x is not None]
        for name, p in zip("abcde", (0, 0.25, 0.5, 0.9, 1.0)):
            assert r[name] == pytest.approx(np.quantile(own, p))
    assert quantiles(df.limit(0), ["g"], "x", {"a": 0.5}).count() == 0
