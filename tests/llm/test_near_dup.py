"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import near_dup as nd
from tessera.llm.components import Forest, connected_components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = [(d, shingles(t)) for d, t in rows]
    f = Forest()
    for i, (_, a) in enumerate(sets):
        f.find(i)
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                f.join(i, j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[f.find(i)] = min(d, least.get(f.find(i), d))
    return {d: (len(s), least[f.find(i)], d == least[f.find(i)]) for i, (d, s) in enumerate(sets)}


def edited(rnd, base, share):
    return " ".join(w if rnd.random() > share else f"w{rnd.randint(0, 10**6)}" for w in base)


@pytest.fixture(scope="module")
def corpus(odd_texts):
    """Exact copies, a hot group of near copies of all degrees, and chains of small edits."""
    rnd = random.Random(7)
    bases = [[f"t{rnd.randint(0, 3000)}" for _ in range(rnd.randint(20, 200))] for _ in range(12)]
    texts = list(odd_texts)
    for k, b in enumerate(bases):
        texts += [" ".join(b)] * rnd.randint(1, 5)
        texts += [edited(rnd, b, rnd.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(120 if k == 0 else 8)]
    chain = bases[1]
    for _ in range(25):
        chain = list(chain)
        chain[rnd.randrange(len(chain))] = f"c{rnd.randint(0, 10**6)}"
        texts.append(" ".join(chain))
    rnd.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("percent", [85, 80])
def test_components_match_all_pairs(spark, corpus, percent, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 32)       # the hot group is compared over many block pairs
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df, percent).collect()}
    assert got == brute(corpus, percent)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.op5_near_dup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute(rows, 85)


def test_repeated_and_null_ids_clashing_columns_and_empty(spark):
    t = "one two three four five six"
    df = spark.createDataFrame([(1, t, "a"), (1, t, "b"), (None, t, "c"), (4, t, None), (None, None, None)],
                               "doc_id long, text string, root string").withColumn("sk", F.lit(1)).withColumn("bands", F.lit(2))
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in nd.near_duplicates(df).collect())
    assert got == [("1", "1", True), ("1", "1", True), ("4", "1", False), ("None", "1", False), ("None", "None", True)]
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_superminhash_estimates_similarity():
    rnd = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.9):
        errors = []
        for _ in range(30):
            both = rnd.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, rnd.integers(0, 2**63, 400 - len(both), dtype=np.uint64)])) for _ in range(2))
            s = nd.superminhash([a, b])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((s[0] == s[1]).mean() - true)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
    one = nd.superminhash([np.array([5], np.uint64), np.zeros(0, np.uint64)])
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(nd.HASHES))     # a permutation of all ranks


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
