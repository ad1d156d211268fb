"""Approximate nearest neighbours by inner product: hierarchical k-means tree, best-bin-first.

The tree is fitted on a bounded sample; every vector is put into a leaf.  A query takes
nodes from a priority queue, nearest centroid first, and visits leaves until it has seen
the number of leaves at which calibration queries reach the recall asked for.  The
largest inner product becomes the smallest distance by one more coordinate that fills
every vector up to the largest norm.

Leaves are dealt into blocks of bounded size (a crowded leaf over several).  Queries are
dealt into sets by their first leaf, so that a set's queries visit much the same blocks,
and only blocks that a set visits meet it; a task compares one block of vectors with one
set of queries and hands on the best of each query.  Equal vectors are one entry with
their smallest ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import read, map_arrow
from tessera.session import materialize

SAMPLE = 20_000         # vectors the tree is fitted on at most, chosen by hash
BRANCH, LEAF, ROUNDS = 8, 64, 8
CALIBRATE = 200         # sample vectors that serve as calibration queries at most
RECALL = 0.96           # on the sample; the whole holds closer neighbours, which are found more easily
BLOCK, QUERIES = 2048, 4096     # vectors and queries of a task


@dataclass
class Tree:
    """Centroids of all nodes; children of inner nodes; the leaf number of the others."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray
    largest: float

    def filled(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.largest ** 2 - (x * x).sum(axis=1)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: at every node the nearest child."""
        x = self.filled(x)
        node, out = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            k, own = todo.pop()
            if not self.children[k]:
                out[own] = self.leaf[k]
                continue
            c = self.centres[self.children[k]]
            node = ((c * c).sum(axis=1) - 2 * x[own] @ c.T).argmin(axis=1)
            todo += [(child, own[node == i]) for i, child in enumerate(self.children[k]) if (node == i).any()]
        return out

    def order(self, queries: np.ndarray) -> Iterator[Iterator[int]]:
        """For each query its leaves, best bin first."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        far = (self.centres ** 2).sum(axis=1) - 2 * q @ self.centres.T
        for d in far:
            yield self._walk(d.tolist())

    def _walk(self, far: list[float]) -> Iterator[int]:
        heap = [(far[0], 0)]
        while heap:
            _, k = heapq.heappop(heap)
            if not self.children[k]:
                yield int(self.leaf[k])
            for c in self.children[k]:
                heapq.heappush(heap, (far[c], c))


def fit(x: np.ndarray, largest: float) -> Tree:
    """Hierarchical k-means on the sample ``x`` (fixed seed)."""
    tree = Tree(np.zeros((0, 0)), [], np.zeros(0, np.int64), largest)
    filled = tree.filled(x)
    rng = np.random.default_rng(11)
    centres, leaf, n_leaves = [filled.mean(axis=0) if len(x) else np.zeros(x.shape[1] + 1)], [-1], 0
    tree.children.append([])
    todo = [(0, filled)]
    while todo:
        k, own = todo.pop()
        parts = []
        if len(own) > LEAF:
            c = own[rng.choice(len(own), BRANCH, replace=False)]
            for _ in range(ROUNDS):
                near = ((c * c).sum(axis=1) - 2 * own @ c.T).argmin(axis=1)
                c = np.stack([own[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(BRANCH)])
            near = ((c * c).sum(axis=1) - 2 * own @ c.T).argmin(axis=1)
            parts = [own[near == i] for i in range(BRANCH) if (near == i).any()]
        if len(parts) < 2:      # a leaf, or vectors that cannot be told apart
            leaf[k], n_leaves = n_leaves, n_leaves + 1
            continue
        for part in parts:
            tree.children[k].append(len(centres))
            todo.append((len(centres), part))
            centres.append(part.mean(axis=0))
            leaf.append(-1)
            tree.children.append([])
    tree.centres, tree.leaf = np.stack(centres), np.array(leaf)
    return tree


def leaves_needed(tree: Tree, x: np.ndarray, k: int, recall: float) -> int:
    """Leaves to visit so that calibration queries find that share of their k best in the sample."""
    n = len(x)
    at = np.linspace(0, n - 1, min(n, CALIBRATE)).astype(int) if n else np.zeros(0, int)
    leaf = tree.assign(x)
    n_leaves = int(tree.leaf.max()) + 1
    found = np.zeros(n_leaves + 1)
    total = 0
    for q, visits in zip(at.tolist(), tree.order(x[at]), strict=True):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.argpartition(-score, min(k, n - 1) - 1)[:k] if n > 1 else np.zeros(0, int)
        rank = np.zeros(n_leaves, int)
        rank[list(visits)] = np.arange(n_leaves)
        found += np.bincount(rank[leaf[best]] + 1, minlength=n_leaves + 1)
        total += len(best)
    if not total:
        return n_leaves
    return int(np.argmax(np.cumsum(found) >= recall * total))


def clean(vectors: DataFrame, dim: int | None = None) -> tuple[DataFrame, int]:
    """(vec_id, embedding array<double>) of the vectors that take part, and their dimension.

    Vectors that are null, zero or empty, hold null or non-finite components, or have another
    dimension than most, and rows without a vec_id take no part.  Rows that repeat a vec_id
    count once, with the smallest vector.
    """
    x = F.col("embedding").cast("array<double>")
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).filter(
        "vec_id is not null and embedding is not null").filter(
        F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))).filter(
        F.exists("embedding", lambda v: v != 0))
    if dim is None:
        top = ok.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
        dim = top.d if top else 0
    return ok.filter(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), dim


def deal(size: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(leaf, first box, boxes): consecutive leaves fill boxes of about ``most``; a larger leaf is dealt over boxes of its own."""
    cuts = np.maximum(1, -(-size // most))
    small = np.where(cuts > 1, 0, size)
    first = (np.cumsum(small) - small) // most
    own = np.where(cuts > 1, cuts, 0)
    first = np.where(cuts > 1, int(first.max()) + 1 + np.cumsum(own) - own, first)
    return [(i, int(f), int(c)) for i, (f, c) in enumerate(zip(first, cuts, strict=True))]


def search(vectors: DataFrame, is_query, k: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector where ``is_query`` holds, its k nearest of all others.

    ``vectors`` has vec_id and embedding; see ``clean`` for what takes part.  Nearest is the
    largest inner product (double precision), ties to the smaller vec_id; with fewer than k
    candidates all are returned.  Approximate: on average at least ``recall`` of the true
    neighbours of sample queries are found in the sample.  Empty input gives no rows.
    """
    spark = vectors.sparkSession
    rows, dim = clean(vectors)
    rows = materialize(rows)
    keep = k + 1            # of equal vectors, no query needs more ids
    # the limit on row numbers holds before the shuffle too, so a hot vector sends few rows a task
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    entries = rows.withColumn("nth", nth).filter(F.col("nth") <= keep).groupBy("embedding").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v))
    about = entries.agg(F.count("*").alias("n"), F.max(norm).alias("largest")).first()
    share = min(1.0, SAMPLE / max(1, about.n))
    chosen = entries.filter(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(share * (1 << 30)))
    x = np.array([r[0] for r in chosen.select("embedding").sort(F.xxhash64("embedding")).collect()], float).reshape(about.n and -1, dim)
    tree = fit(x, float(about.largest or 0.0))
    visits = leaves_needed(tree, x, k, recall)
    n_leaves = int(tree.leaf.max()) + 1
    shared = spark.sparkContext.broadcast(tree)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.array(b.column("embedding").to_pylist(), float).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.assign(v))], names=["embedding", "ids", "leaf"])

    placed = materialize(entries.select("embedding", "ids").transform(map_arrow, put, "embedding array<double>, ids array<bigint>, leaf long"))
    size = np.zeros(n_leaves, np.int64)         # one number a leaf, bounded by the sample
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        size[r.leaf] = r.n
    block_of = deal(size, BLOCK)
    leaf_blocks = spark.createDataFrame(block_of, "leaf long, first long, cuts long")       # one row a leaf

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches:
            v = np.array(b.column("embedding").to_pylist(), float).reshape(-1, dim)
            out: list[list] = [[], [], [], [], []]
            for q, e, order in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist(), t.order(v), strict=True):
                seen, n, blocks, nearest = 0, 0, {}, None
                for leaf in order:
                    nearest = leaf if nearest is None else nearest
                    if seen >= visits and n > k:
                        break
                    seen, n = seen + 1, n + int(size[leaf])
                    _, at, c = block_of[leaf]
                    for block in range(at, at + c):
                        blocks.setdefault(block, []).append(leaf)
                for block, leaves in blocks.items():
                    for column, value in zip(out, (nearest, block, q, e, leaves), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                             names=["leaf", "block", "query_id", "embedding", "leaves"])

    asked = materialize(rows.filter(is_query).transform(
        map_arrow, visit, "leaf long, block long, query_id long, embedding array<double>, leaves array<bigint>"))
    near = np.zeros(n_leaves, np.int64)         # queries by their first leaf, one number a leaf
    for r in asked.groupBy("leaf").agg(F.countDistinct("query_id").alias("n")).collect():
        near[r.leaf] = r.n
    sets = spark.createDataFrame(deal(near, QUERIES), "leaf long, first long, cuts long")
    asked = asked.join(F.broadcast(sets), "leaf").select(
        "block", (F.col("first") + F.pmod(F.xxhash64("query_id"), F.col("cuts"))).alias("part"), "query_id", "embedding", "leaves")
    visited = asked.groupBy("block").agg(F.collect_set("part").alias("parts"))
    dealt = placed.join(F.broadcast(leaf_blocks), "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("embedding"), F.col("cuts"))).alias("block"), "leaf", "embedding", "ids")
    dealt = dealt.join(visited, "block").select("block", "leaf", "embedding", "ids", F.explode("parts").alias("part"))

    def compare(own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(queries):
            x = np.stack(own["embedding"].to_list())
            least = np.array([i[0] for i in own["ids"]])
            named, column = np.unique(own["leaf"].to_numpy(), return_inverse=True)
            scores = np.stack(queries["embedding"].to_list()) @ x.T
            for q, leaves, s in zip(queries["query_id"].tolist(), queries["leaves"], scores, strict=True):
                near = np.flatnonzero(np.isin(named, leaves)[column])
                if len(near) > keep:
                    limit = np.partition(s[near], len(near) - keep)[len(near) - keep]
                    near = near[s[near] >= limit]
                near = near[np.lexsort((least[near], -s[near]))]
                best = sorted((-s[i], int(v)) for i in near[:2 * keep] for v in own["ids"].iloc[i] if v != q)[:k]
                out.append((q, [{"far": a, "vec_id": v} for a, v in best]))
        return pd.DataFrame(out, columns=["query_id", "best"])

    best_of = lambda c: F.slice(F.array_sort(F.flatten(F.collect_list(c))), 1, k)
    found = (asked.groupBy("block", "part").cogroup(dealt.groupBy("block", "part"))
             .applyInPandas(lambda q, v: compare(v, q), "query_id long, best array<struct<far:double,vec_id:bigint>>"))
    found = found.groupBy("query_id", F.pmod(F.xxhash64("best"), F.lit(32)).alias("some")).agg(best_of("best").alias("best"))
    found = found.groupBy("query_id").agg(best_of("best").alias("best"))
    return found.select("query_id", F.posexplode("best").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), (-F.col("n.far")).alias("score"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), F.col("vec_id") % 20 == 0, k=20)
