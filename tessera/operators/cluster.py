"""Clustering (CLU-01..03).

k-means: Spark ML on standardised inputs; the number of clusters is chosen by
the gap statistic against uniform reference data drawn over the bounding box
(generated by Spark with a seeded ``rand``, so it scales with the data).  The fits
of that choice start from Spark ML's own first centres and then take their
iterations together: one pass over the rows serves every k and every reference set.

k-modes (nominal inputs): rows are collapsed once to distinct patterns with
counts; seeds, steps and the stop rule run on that table.  Each iteration compares
every pattern with the k current modes (k is bounded by the caller — at most 20 —
and inlined as a literal array, so assignment is a narrow projection), assigns the
closest mode by mismatch count (ties → lowest cluster id), and recomputes all
columns' modes in one job.  The driver only holds the k modes between iterations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import concurrently, materialize
from tessera.functions.hashing import hash32


def standardized_features(df: DataFrame, cols: list[str] | None = None, vector: str | None = None,
                          out: str = "features") -> DataFrame:
    if vector is not None:
        v = df.withColumn("__raw", array_to_vector(F.col(vector)))
    else:
        v = VectorAssembler(inputCols=cols, outputCol="__raw").transform(df)
    sc = StandardScaler(inputCol="__raw", outputCol=out, withMean=True, withStd=True).fit(v)
    return sc.transform(v).drop("__raw")


BLOCK = 1024            # vectors that are one row of a blocks table
TOL = 1e-4              # Spark ML's default: a fit ends when none of its centres moves further


def _blocks(sets: list[DataFrame], dim: int) -> DataFrame:
    """(set, block): the ``features`` of every set, ``BLOCK`` vectors of doubles a row, written once."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            own = int(b.column(0)[0].as_py()) if len(b) else 0
            rows = [flat[k:k + BLOCK * dim].tobytes() for k in range(0, len(flat), BLOCK * dim)]
            yield pa.RecordBatch.from_arrays([pa.array([own] * len(rows), pa.int32()), pa.array(rows, pa.binary())], names=["set", "block"])
    packed = [s.select(F.lit(i).alias("set"), vector_to_array("features").alias("v")).mapInArrow(pack, "set int, block binary")
              for i, s in enumerate(sets)]
    out = packed[0]
    for p in packed[1:]:
        out = out.unionByName(p)
    return materialize(out.repartition(out.sparkSession.sparkContext.defaultParallelism))


def _step(blocks: DataFrame, centres: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], tuple]:
    """One pass over the rows for all fits (set, k): the rows and the sum of the vectors nearest to each centre (ties: the
    first), and the squared distances summed over all.  At most one row a fit and centre reaches the driver."""
    fits = sorted(centres)
    shared = blocks.sparkSession.sparkContext.broadcast([(f, centres[f]) for f in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for (at, k), c in shared.value:
            own.setdefault(at, []).append((k, c, np.zeros(len(c)), np.zeros_like(c), np.zeros(len(c))))
        stacked = {at: np.concatenate([c for _, c, *_ in fs]) for at, fs in own.items()}
        for b in batches:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if at not in stacked:
                    continue            # all fits of this set have ended
                c = stacked[at]
                x = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, c.shape[1])
                norm = (x * x).sum(1)
                score = (c * c).sum(1) - 2.0 * (x @ c.T)
                first = 0
                for _, own_c, n, total, cost in own[at]:
                    mine = score[:, first:first + len(own_c)]
                    first += len(own_c)
                    best = mine.argmin(1)
                    near = np.maximum(mine[np.arange(len(x)), best] + norm, 0.0)
                    n += np.bincount(best, minlength=len(n))
                    cost += np.bincount(best, near, len(n))
                    chosen = np.zeros((len(x), len(n)))
                    chosen[np.arange(len(x)), best] = 1.0
                    total += chosen.T @ x
        rows = [(at, k, i, n[i], cost[i], total[i]) for at, fs in own.items() for k, _, n, total, cost in fs
                for i in np.flatnonzero(n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in rows], t) for j, t in enumerate(
                [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64())])],
            names=["set", "k", "centre", "n", "cost", "total"])
    sums = blocks.mapInArrow(run, "set int, k int, centre int, n double, cost double, total array<double>")
    found = sums.groupBy("set", "k", "centre").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("total")).alias("total")).collect()
    shared.unpersist()
    out = {f: (np.zeros(len(centres[f])), np.zeros_like(centres[f]), [0.0]) for f in fits}
    for r in sorted(found, key=lambda r: (r["set"], r["k"], r["centre"])):
        n, total, cost = out[r["set"], r["k"]]
        n[r["centre"]], total[r["centre"]] = r["n"], r["total"].toArray()
        cost[0] += r["cost"]
    return out


def kmeans_costs(sets: list[DataFrame], ks: list[int], seed: int, max_iter: int = 100) -> dict[tuple[int, int], float]:
    """{(set, k): training cost} of Spark ML's k-means for every set and k.

    Each fit starts from the centres that ``KMeans`` itself draws (a fit of no iterations) and ends as it
    does: no centre moves beyond ``TOL``, or ``max_iter``.  The iterations of all fits run side by side, so
    the rows are read ``max_iter`` times at most, not that often for each fit.
    """
    fits = [(i, k) for i in range(len(sets)) for k in ks]

    def first(i, k):
        return np.array(KMeans(k=k, seed=seed, maxIter=0, featuresCol="features").fit(sets[i]).clusterCenters())
    centres = dict(zip(fits, concurrently([partial(first, *f) for f in fits]), strict=True))
    blocks = _blocks(sets, next(iter(centres.values())).shape[1])
    cost = dict.fromkeys(fits, 0.0)
    for _ in range(max_iter):
        if not centres:
            break
        for f, (n, total, (spent,)) in _step(blocks, centres).items():
            old, used = centres[f], n > 0
            new = np.where(used[:, None], total / np.maximum(n, 1.0)[:, None], old)
            cost[f], centres[f] = spent, new
            if (((new - old) ** 2).sum(1) <= TOL * TOL).all():
                del centres[f]
    return cost


def kmeans_choose_k(df: DataFrame, k_min: int, k_max: int, seed: int, max_iter: int = 100,
                    refs: int = 1, key: str = "vec_id") -> tuple[DataFrame, int]:
    """CLU-01: for k in [k_min, k_max]: log W_k on the data and on ``refs``
    uniform reference sets; gap = mean(log W*_k) − log W_k; choose the
    smallest k with gap_k ≥ gap_{k+1} − s_{k+1} (Tibshirani et al. 2001).

    ``df`` needs a ``features`` vector column (see standardized_features).
    Returns (table k, log_w, gap, s, chosen) and the chosen k.
    """
    spark = df.sparkSession
    a = df.select(vector_to_array("features").alias("__a"))
    dim = len(a.first()["__a"])
    bounds = a.select(*[F.min(F.col("__a")[i]).alias(f"lo{i}") for i in range(dim)],
                      *[F.max(F.col("__a")[i]).alias(f"hi{i}") for i in range(dim)]).first()
    ref_sets = []
    for r in range(refs):
        cols = [(hash32(seed + 1000 * (r + 1) + i, key) / F.lit(float(1 << 32)) * (bounds[f"hi{i}"] - bounds[f"lo{i}"]) + bounds[f"lo{i}"])
                for i in range(dim)]
        ref_sets.append(materialize(df.select(array_to_vector(F.array(*cols)).alias("features"))))
    ks = list(range(k_min, k_max + 1))
    cost = kmeans_costs([df, *ref_sets], ks, seed, max_iter)

    def one(k):
        lw = math.log(max(cost[0, k], 1e-300))
        lw_ref = [math.log(max(cost[r, k], 1e-300)) for r in range(1, refs + 1)]
        mean_ref = sum(lw_ref) / len(lw_ref)
        sd = math.sqrt(sum((x - mean_ref) ** 2 for x in lw_ref) / len(lw_ref))
        return [k, lw, mean_ref - lw, sd * math.sqrt(1 + 1 / len(lw_ref))]

    rows = [one(k) for k in ks]
    chosen = rows[-1][0]
    for cur, nxt in zip(rows, rows[1:]):
        if cur[2] >= nxt[2] - nxt[3]:
            chosen = cur[0]
            break
    out = [(k, lw, g, s, k == chosen) for k, lw, g, s in rows]
    return spark.createDataFrame(out, "k INT, log_w DOUBLE, gap DOUBLE, s DOUBLE, chosen BOOLEAN"), chosen


def kmeans_assign(df: DataFrame, k: int, seed: int, max_iter: int = 100) -> DataFrame:
    """CLU-01/03: fit k-means with the chosen k and label rows with a cluster."""
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol="cluster").fit(df)
    return model.transform(df)


def initial_modes(df: DataFrame, key: str, cols: list[str], k: int, seed) -> DataFrame:
    """k seed rows: the k smallest keyed hashes (deterministic, order-free)."""
    return (df.select(key, *cols).withColumn("__h", hash32(seed, key))
            .orderBy("__h", key).limit(k)
            .withColumn("cluster", F.row_number().over(Window.orderBy("__h", key)) - 1)
            .select("cluster", *cols))


SMALL = 10_000          # patterns that one task may hold


def patterns(df: DataFrame, key: str, cols: list[str], seed) -> DataFrame:
    """The distinct combinations of ``cols`` with their rows ``__n`` and the smallest keyed hash ``__h`` among
    them, from one scan, written once: k-modes needs no more of the rows.  A small table is one task."""
    t = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"), F.min(hash32(seed, key)).alias("__h")))
    return t.coalesce(1) if t.limit(SMALL + 1).count() <= SMALL else t


def farthest_first_modes(pats: DataFrame, cols: list[str], k: int) -> list[tuple]:
    """Diverse seeds: the first is the pattern of the smallest keyed hash, each next one the
    pattern with the largest mismatch count to its nearest chosen seed (ties → smallest hash,
    then smallest pattern).  One aggregation per seed; at most k rows on the driver."""
    own = F.struct(*cols)
    first = pats.agg(F.min_by(own, F.struct("__h", own)).alias("m")).first()["m"]
    modes = [(0, *[first[x] for x in cols])] if first else []
    for c in range(1, k if modes else 0):
        a = assign_modes(pats, modes, cols)
        r = a.agg(F.min_by(own, F.struct(-F.col("mismatch"), F.col("__h"), own)).alias("m"), F.max("mismatch").alias("d")).first()
        if not r["d"]:
            break                       # fewer than k distinct patterns
        modes.append((c, *[r["m"][x] for x in cols]))
    return modes


def assign_modes(df: DataFrame, modes: list[tuple], cols: list[str]) -> DataFrame:
    """CLU-02/03: nearest mode by number of mismatching columns (NULL never
    matches); ties go to the lowest cluster id.

    ``modes`` = [(cluster, v1, v2, ...)] with at most k entries (bounded); they
    are inlined as a literal array, so assignment is a narrow projection.
    """
    lit_modes = F.array(*[F.struct(F.lit(m[0]).alias("cluster"),
                                   *[F.lit(v).alias(c) for v, c in zip(m[1:], cols)]) for m in modes])

    def score(m):
        mis = sum((F.when(F.col(c) == m[c], 0).otherwise(1) for c in cols), F.lit(0))
        return F.struct(mis.alias("mismatch"), m["cluster"].alias("cluster"))
    best = F.array_min(F.transform(lit_modes, score))
    return df.withColumn("__b", best).withColumns(
        {"cluster": F.col("__b.cluster"), "mismatch": F.col("__b.mismatch")}).drop("__b")


def update_modes(assigned: DataFrame, cols: list[str]) -> dict[int, tuple]:
    """{cluster: mode}: the most frequent value (``__n`` rows a pattern) per cluster and column; ties → smallest
    value, NULL first.  One job for all columns, one row a cluster."""
    best = []
    for i, c in enumerate(cols):
        n = F.sum("__n").over(Window.partitionBy("cluster", c))
        best.append(F.struct((-n).alias("n"), F.col(c).alias("v")).alias(f"__b{i}"))
    r = assigned.select("cluster", *best).groupBy("cluster").agg(*[F.min(f"__b{i}").alias(f"b{i}") for i in range(len(cols))])
    return {x["cluster"]: tuple(x[f"b{i}"]["v"] for i in range(len(cols))) for x in r.collect()}


def kmodes(df: DataFrame, key: str, cols: list[str], k: int, seed, max_iter: int = 20,
           init: str = "farthest"):
    """CLU-02: Lloyd-style k-modes over the table of distinct patterns; stops when the modes no longer
    change.  ``init='farthest'`` (default) or ``'hash'`` (k smallest keyed hashes).  Returns the rows
    with their cluster and the modes; an empty table has neither."""
    spark = df.sparkSession
    schema = ", ".join(["cluster INT", *[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols]])
    pats = patterns(df, key, cols, seed)
    if init == "hash":
        cur = [tuple(r) for r in initial_modes(df, key, cols, k, seed).orderBy("cluster").collect()]
    else:
        cur = farthest_first_modes(pats, cols, k)
    for _ in range(max_iter if cur else 0):
        upd = update_modes(assign_modes(pats, cur, cols), cols)
        new = [(m[0], *upd.get(m[0], m[1:])) for m in cur]     # an emptied cluster keeps its mode
        if new == cur:
            break
        cur = new
    rows = assign_modes(df, cur, cols) if cur else df.withColumns({"cluster": F.lit(0), "mismatch": F.lit(0)})
    return rows, spark.createDataFrame(cur, schema)
