"""Entropy trees against a tree grown by recursion over raw rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import tree as T
from tessera.session import scratch_path


def entropy(rows):
    n, k = len(rows), sum(r["y"] for r in rows)
    return -sum(c / n * math.log2(c / n) for c in (k, n - k) if c)


def binned(v, lo, hi, bins):
    if v is None or v != v or abs(v) == math.inf:
        return None
    return 0 if hi == lo else max(0, min(bins - 1, math.floor((v - lo) / ((hi - lo) / bins))))


def brute(rows, interval, nominal, depth, leaf, bins):
    """{node: (n, events, input, left bins or levels, missing goes left)}; splits are tried one by one."""
    ends = {}
    for c in interval:
        own = [r[c] for r in rows if r[c] is not None and math.isfinite(r[c])]
        ends[c] = (min(own, default=0.0), max(own, default=0.0))
    value = lambda r, c: binned(r[c], *ends[c], bins) if c in ends else r[c]
    out = {}

    def part(node, own):
        k = sum(r["y"] for r in own)
        out[node] = (len(own), k, None, None, None)
        if node.bit_length() > depth or k in (0, len(own)):
            return
        best = None
        for c in interval + nominal:
            seen = sorted({value(r, c) for r in own} - {None})
            if c in nominal:
                rate = {v: sum(r["y"] for r in own if value(r, c) == v) / sum(value(r, c) == v for r in own) for v in seen}
                seen.sort(key=lambda v: (rate[v], v))
            for at in range(1, len(seen)):
                left = set(seen[:at])
                in_left = sum(value(r, c) in left for r in own)
                known = sum(value(r, c) is not None for r in own)
                missing_left = in_left >= known - in_left
                goes = [missing_left if value(r, c) is None else value(r, c) in left for r in own]
                a = [r for r, g in zip(own, goes) if g]
                b = [r for r, g in zip(own, goes) if not g]
                if min(len(a), len(b)) < leaf:
                    continue
                gain = round(entropy(own) - (len(a) * entropy(a) + len(b) * entropy(b)) / len(own), 9)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, c, left, missing_left, a, b)
        if best:
            _, c, left, missing_left, a, b = best
            out[node] = (len(own), k, c, left, missing_left)
            part(2 * node, a)
            part(2 * node + 1, b)

    part(1, rows)
    return out


SCHEMA = "id INT, a DOUBLE, b DOUBLE, c STRING, d STRING, y INT"


def sample(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.choice([None, rnd.random() * 10, 3.0]), rnd.choice([float("nan"), rnd.gauss(0, 5)]), rnd.choice([None, "x", "y", "z", "w"])
        p = 0.1 + 0.5 * (a is None) + 0.3 * (c in ("x", "w")) * (b == b and b > 0)
        rows.append({"id": i, "a": a, "b": b, "c": c, "d": rnd.choice(["one", "two"]), "y": int(rnd.random() < p)})
    return rows


@pytest.mark.parametrize("seed,depth,leaf,bins", [(1, 4, 4, 10), (2, 6, 3, 25), (3, 2, 30, 5)])
def test_nodes_equal_brute_force(spark, seed, depth, leaf, bins):
    rows = sample(400, seed)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5).withColumn("node", F.lit("x"))
    tree = T.grow(df, "y", ["a", "b"], ["c", "d"], depth, leaf, bins)
    want = brute(rows, ["a", "b"], ["c", "d"], depth, leaf, bins)
    assert {t.node for t in tree.nodes} == set(want)
    for t in tree.nodes:
        n, k, split, left, missing_left = want[t.node]
        assert (t.n, t.n_event, t.input, t.missing_left) == (n, k, split, missing_left)
        if split in ("a", "b"):
            assert set(left) <= set(t.left_bins) and max(left) == max(t.left_bins)
        elif split:
            assert t.left_levels == ",".join(sorted(left))
    assert any(t.input and t.missing_left is not None for t in tree.nodes)


def test_scores_of_missing_unknown_and_saved(spark):
    rows = sample(300, 8)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    tree = T.grow(df, "y", ["a", "b"], ["c", "d"], 5, 4, 20)
    per = {r.node: (r.n, r.k) for r in tree.score(df.drop("node")).groupBy("node").agg(
        F.count("*").alias("n"), F.sum("y").alias("k")).collect()}
    leaves = {t.node: (t.n, t.n_event) for t in tree.nodes if not t.input}
    assert per == leaves                    # every training row falls into the leaf that counted it
    odd = spark.createDataFrame([(1, None, None, None, None, None), (2, float("inf"), -1e9, "never seen", "", 0)], SCHEMA)
    scored = {r.id: (r.node, r.score) for r in tree.score(odd).collect()}
    assert set(scored) == {1, 2} and all(0 <= s <= 1 for _, s in scored.values())
    path = scratch_path(spark, "models")
    tree.save(spark, path)
    again = T.EntropyTree.load(spark, path)
    assert again.nodes == tree.nodes and again.inputs == tree.inputs
    table = tree.table(spark)
    assert table.filter("parent is null").count() == 1 and table.count() == len(tree.nodes)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        T.grow(empty, "y", ["a"], ["c"], 3, 1)
    one = spark.createDataFrame([(1, None, 1.0, None, "q", 1), (2, None, 1.0, None, "q", 0), (3, None, 1.0, None, "q", None)], SCHEMA)
    tree = T.grow(one, "y", ["a", "b"], ["c", "d"], 3, 1)        # nothing to split on
    assert [(t.n, t.n_event, t.input) for t in tree.nodes] == [(2, 1, None)]
    assert {r.score for r in tree.score(one).collect()} == {0.5}
    only_missing_tells = spark.createDataFrame([(i, None if i % 2 else 1.0 + i % 3, 0.0, "k", "q", i % 2) for i in range(20)], SCHEMA)
    tree = T.grow(only_missing_tells, "y", ["a"], [], 2, 1)      # a missing value follows the larger side, it is no split of its own
    assert all(t.input in (None, "a") for t in tree.nodes)
