"""Centroid clustering, exact top-k search and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import centroids, resample, topk

SCHEMA = "vec_id long, embedding array<double>"


def finite(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def lloyd(rows, k, dim, scale, rounds, seed):
    """Plain clustering in Python integers."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if finite(v) and len(v) == dim]
    name = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    for step in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]
        if step == rounds:
            break
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    per = Counter()
    for d, c in own:
        per[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, per[c], sum(per.values()), sha[c]) for (i, _), (d, c) in zip(kept, own)), key=str)


def clustered(df, **given):
    return sorted((tuple(r) for r in centroids.cluster(df, **given).collect()), key=str)


@pytest.mark.parametrize("k,dim,n", [(5, 6, 400), (3, 2, 60), (16, 64, 40)])
def test_clusters_equal_plain_ones(spark, k, dim, n):
    rng = np.random.default_rng(k)
    x = rng.normal(size=(n, dim)) * rng.uniform(0.1, 3, size=(n, 1))
    x[::3] = x[0]                   # a third of all vectors are equal
    rows = [(i % (n - 7), v.tolist()) for i, v in enumerate(x)]         # some ids repeat
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("cluster", F.lit("x")).withColumn("apex", F.lit(1))
    given = {"k": k, "dim": dim, "scale": 64.0, "rounds": 3, "seed": 1}
    assert clustered(df, **given) == lloyd(rows, **given)


def test_few_odd_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("-inf"), 1.0]), (5, []),
            (6, [1.0, 2.0, 3.0]), (None, [0.0, 0.0]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (8, [-0.001, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    given = {"k": 4, "dim": 2, "scale": 64.0, "rounds": 2, "seed": 1}
    assert clustered(df, **given) == lloyd(rows, **given)
    assert len(clustered(df, **given)) == 5
    empty = centroids.cluster(df.limit(0), **given)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    huge = spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 0.0])], SCHEMA)
    assert len(clustered(huge, **given)) == 2


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    x = np.floor(64 * rng.normal(size=(600, 12)) + 200 * rng.integers(0, 6, size=(600, 1))).astype(np.int64)
    simplex = centroids.Simplex(x[:200])
    a = simplex.apex(x)
    true = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    flat = ((a[:, None, :-1] - a[None, :, :-1]) ** 2).sum(axis=2)
    slack = 1e-6 * (1 + true.max())
    assert (flat + (a[:, None, -1] - a[None, :, -1]) ** 2 <= true + slack).all()
    assert (flat + (a[:, None, -1] + a[None, :, -1]) ** 2 >= true - slack).all()
    best, distance, compared = centroids.nearest(x, a, x[:16], a[:16])
    assert (best == true[:, :16].argmin(axis=1)).all() and (distance == true[:, :16].min(axis=1)).all()
    assert compared < 0.6 * 600 * 16


def highest(rows, step, k, scale):
    """Brute force in Python integers."""
    own = {}
    for i, v in rows:
        if i is not None and finite(v):
            own[i] = min(own.get(i, v), v)
    whole = {i: [math.floor(scale * c) for c in v] for i, v in own.items()}
    out = []
    for q in sorted(whole):
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_top_k_equals_brute_force(spark, monkeypatch, hot):
    """Ranges, blocks and query sets far smaller than the table; ties everywhere in the hot case."""
    for name, value in (("BLOCK", 8), ("GROUP", 64), ("SET", 3), ("CHUNK", 2), ("SLICE", 2), ("PIVOTS", 20)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 5)) + 3 * rng.integers(-1, 2, size=(700, 5))
    if hot:
        x = np.round(x)
        x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(50, x[3].tolist()), (1000, [])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("range", F.lit(1)).withColumn("ids", F.lit("x"))
    got = topk.search(df, F.col("vec_id") % 50 == 0, 5, 256.0 if not hot else 1.0)
    assert sorted(map(tuple, got.collect())) == highest(rows, 50, 5, 256 if not hot else 1)


def test_blocks_below_the_kth_score_are_left_out():
    import pandas as pd
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(0, 10_000, size=(64 * 40, 1)), axis=0)[::-1].copy()
    blocks = x.reshape(40, 64, 1)
    pdf = pd.DataFrame({"low": [b.min(axis=0).tobytes() for b in blocks], "high": [b.max(axis=0).tobytes() for b in blocks],
                        "forward": [b.tobytes() for b in blocks], "ids": [[[64 * n + i] for i in range(64)] for n in range(40)]})
    q = pd.DataFrame({"query_id": [-1], "q": [np.array([3]).tobytes()], "floor": [topk.LEAST]})
    found, scored = topk.score_range(q, pdf, 5, 1)
    want = sorted((-3 * int(v), i) for i, v in enumerate(x[:, 0]))[:5]
    assert [(-s, v) for _, v, s in found] == want and scored == 1


def test_top_k_of_few_odd_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [float("inf"), 1.0]), (50, [-0.001, 2.0]), (None, [1.0, 1.0]), (100, [])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.search(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == highest(rows, 50, 5, 256)
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(df.filter("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
    huge = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300])], SCHEMA)
    assert [r.vec_id for r in topk.search(huge, F.col("vec_id") == 0).sort("rank").collect()] == [1, 2]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resampled(docs, target, n, buckets, percent, least, seed):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    def feats(text):
        w = WORD.findall(lower(text))
        runs = [" ".join(w[i:i + m]) for m in range(1, n + 1) for i in range(len(w) - m + 1)]
        return len(w), Counter(zlib.crc32(r.encode()) % buckets for r in runs)

    own = [(i, t, *feats(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for *_, f in own:
        s.update(f)
    for text in target:
        t.update(feats(text)[1])
    size, aim = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (aim * 0 + size + buckets) / ((s[b] + 1.0) * (aim + buckets)))) for b in s}
    rows = []
    for i, text, words, f in own:
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * c for b, c in f.items())
        rows.append([i, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n_, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = n_ + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_resampling_equals_brute_force(spark, odd_texts, n):
    rnd = random.Random(2)
    words = ["Alpha", "beta", "gamma", "the", "of", "x1", "Ünï", "日本", "w" * 90]
    line = lambda: " ".join(rnd.choice(words) + rnd.choice(["", ".", "-"]) for _ in range(rnd.randint(0, 9)))
    shared = "The shared line of all documents"
    texts = ["\n".join([line(), shared, line(), "", line()]) for _ in range(120)] + odd_texts
    docs = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (5, texts[5]), (7, "another text\nunder the id of seven " * 9), (None, shared * 9)]
    target = [line() for _ in range(20)] + [None, "", shared + "\nthe of"]
    given = {"n": n, "buckets": 97, "percent": 30, "least": 4, "seed": 2024}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns(
        {c: F.lit("x") for c in ("key", "line", "weight", "rank", "copies")})
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in resample.select(df, aim, **given).collect()), key=str)
    want = resampled(docs, target, **given)
    # rows of one doc_id and score may share their ranks out either way; here only equal texts do
    assert got == want
    assert resample.select(df.limit(0), aim, **given).count() == 0
    none = resample.select(df, aim.limit(0), **given)
    assert none.count() == len(docs)


def test_crc_of_spans():
    rnd = random.Random(4)
    words = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 3, 64, 65, 500]))) for _ in range(200)]
    buf = np.frombuffer(b"".join(words), np.uint8)
    edge = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    state = np.array([rnd.randrange(1 << 32) for _ in words], np.uint32)
    got = resample.crc32(state, buf, edge[:-1], edge[1:])
    assert got.tolist() == [zlib.crc32(w, int(s)) for w, s in zip(words, state)]
