"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import ann


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [int(i) for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def run(df, k=20):
    got = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 20 == 0, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    return got


def test_recall_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {}
    for r in sorted(ann.op2_ann(spark, sf).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = sum(len(set(got[q]) & {v for v, _ in w}) for q, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


def test_hot_group_norms_and_ties(spark, monkeypatch):
    """A third of equal vectors, unequal norms, blocks smaller than a leaf: still mostly exact, ties by id."""
    monkeypatch.setattr(ann, "BLOCK", 40)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(900, 8)) * rng.uniform(0.1, 5, size=(900, 1))).round(3)
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert set(got) == set(want)
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
    assert hit >= 0.9 * 20 * len(want)
    for q in got:
        assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda e: (-e[1], e[0])) and q not in dict(got[q])
        for v, s in got[q]:
            assert abs(s - float(x[q] @ x[v])) < 1e-9


def test_what_takes_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [float("inf"), 1.0]), (20, [0.0, 2.0]), (40, []), (60, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit(1)).withColumn("ids", F.lit("x"))
    assert run(df) == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_leaves_fill_boxes_of_bounded_size():
    """Small leaves share boxes in their order, a crowded one has boxes of its own, none is lost."""
    size = np.array([3, 0, 5, 25, 4, 4, 4, 10, 11, 1])
    dealt = ann.deal(size, 10)
    own = {}
    for (leaf, first, cuts), n in zip(dealt, size.tolist()):
        assert cuts == max(1, -(-n // 10))
        for box in range(first, first + cuts):
            own.setdefault(box, []).append(leaf)
    assert [leaf for leaf, _, _ in dealt] == list(range(10))
    for leaves in own.values():
        crowded = [x for x in leaves if size[x] > 10]
        assert leaves == crowded[:1] if crowded else sum(size[x] for x in leaves) < 20
    assert ann.deal(np.zeros(3, np.int64), 10) == [(0, 0, 1), (1, 0, 1), (2, 0, 1)]


def test_hot_vector_keeps_few_ids(spark):
    """A vector of 2,000 rows is one entry of the smallest ids; its queries find each other, ties by id."""
    df = spark.range(2000).selectExpr("id as vec_id", "array(1.0D, 2.0D) as embedding").repartition(8)
    got = run(df, 5)
    assert len(got) == 100 and got[40] == [(i, 5.0) for i in range(5)] and got[0] == [(i, 5.0) for i in range(1, 6)]
