"""Centroid clustering on integer vectors, with centroids filtered by n-simplex projection.

A few pivots span a base simplex.  A vector's distances to the pivots are computed once
and turned into apex coordinates: its place in the pivots' span and its height above it
(never negative).  Two apexes on the same side of the span are never farther apart, and
on opposite sides never nearer, than the vectors themselves.  A centroid whose lower bound
exceeds the smallest upper bound of all centroids cannot be the nearest; the rest are
compared by exact integer distances, ties to the smaller number.

Vectors stay where they are: a round is one narrow pass that hands on at most one sum a
cluster, component and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import binary_rows, map_arrow, read
from tessera.session import materialize

PIVOTS = 12             # at most; as many as are needed to span the sample
SAMPLE = 1024           # vectors the pivots are chosen from at most
ROWS = 8192             # vectors handled by one numpy step
SLACK = 1e-6            # relative room for rounding in the bounds


def starts(vectors: DataFrame, k: int, seed: int) -> list[tuple[int, ...]]:
    """The k vectors of smallest sha256 of ``seed:vec_id`` (a null id reads ``null``), in that order."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return [tuple(r.v) for r in vectors.orderBy(F.sha2(named, 256), "v").select("v").limit(k).collect()]


def whole_vectors(table: DataFrame, dim: int, scale: float) -> DataFrame:
    """(vec_id, v): components as longs floor(scale * x); vectors of another size, or with null or non-finite components, go."""
    most = float(int((2 ** 58 / dim) ** 0.5))     # squared distances stay longs; larger components are held there
    x = F.col("embedding").cast("array<double>")
    ok = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter(F.size("x") == dim).filter(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return ok.select("vec_id", F.transform(
        "x", lambda c: F.greatest(F.least(F.floor(c * scale).cast("double"), F.lit(most)), F.lit(-most)).cast("long")).alias("v"))


class Simplex:
    """Base simplex of pivots: apex coordinates from distances to them."""

    def __init__(self, sample: np.ndarray, most: int = PIVOTS):
        """Pivots farthest first; each has to rise above the span of those before it."""
        x = sample.astype(float)
        at = [0] if len(x) else []
        base = np.zeros((1, 0))
        far = ((x - x[0]) ** 2).sum(axis=1) if len(x) else np.zeros(0)
        while at and len(at) < most:
            new = int(far.argmax())
            d = np.sqrt(((x[at] - x[new]) ** 2).sum(axis=1))
            apex = self._solve(base, d[None, :])[0] if len(at) > 1 else d
            if apex[-1] <= 1e-3 * max(1.0, d.max()):
                break
            base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apex])
            at.append(new)
            far = np.minimum(far, ((x - x[new]) ** 2).sum(axis=1))
        self.pivots, self.base = x[at], base

    @staticmethod
    def _solve(base: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Apexes over ``base`` (pivot i in row i, lower triangular): coordinates in the span, then the height."""
        square = d * d
        out = np.zeros((len(d), base.shape[1] + 1))
        for j in range(1, len(base)):
            known = out[:, :j - 1] @ base[j, :j - 1]
            out[:, j - 1] = ((square[:, 0] - square[:, j] + base[j] @ base[j]) / 2 - known) / base[j, j - 1]
        out[:, -1] = np.sqrt(np.maximum(0.0, square[:, 0] - (out[:, :-1] ** 2).sum(axis=1)))
        return out

    def apex(self, x: np.ndarray) -> np.ndarray:
        if not len(self.pivots):
            return np.zeros((len(x), 1))
        x = x.astype(float)
        d = np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in self.pivots], axis=1))
        return self._solve(self.base, d)


def nearest(x: np.ndarray, apexes: np.ndarray, centres: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and the number of exact comparisons."""
    flat = ((apexes[:, None, :-1] - own[None, :, :-1]) ** 2).sum(axis=2)
    lower = flat + (apexes[:, None, -1] - own[None, :, -1]) ** 2
    upper = flat + (apexes[:, None, -1] + own[None, :, -1]) ** 2
    room = SLACK * (1.0 + (apexes ** 2).sum(axis=1) + (own ** 2).sum(axis=1).max())
    row, c = np.nonzero(lower <= (upper.min(axis=1) + room)[:, None])
    distance = np.full(lower.shape, np.iinfo(np.int64).max)
    for at in range(0, len(row), ROWS):
        r, k = row[at:at + ROWS], c[at:at + ROWS]
        gap = x[r] - centres[k]
        distance[r, k] = (gap * gap).sum(axis=1)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(x)), best], len(row)


def cluster(table: DataFrame, k: int = 16, dim: int = 64, scale: float = 64.0, rounds: int = 3, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector kept.

    ``table`` has vec_id and embedding (other columns are not read); ``whole_vectors`` says which
    rows stay.  Start: ``starts``.  Each round assigns all vectors and moves every non-empty
    centroid to the floor of its vectors' mean; then vectors are assigned once more.  All sums
    and distances are exact integers.  Repeated rows count as often as they occur and come back
    as often; a null vec_id stays null.  With fewer than k vectors there are fewer centroids, and
    an empty table gives no rows.
    """
    spark = table.sparkSession
    vectors = whole_vectors(table, dim, scale)
    centres = np.array(starts(vectors, k, seed), np.int64).reshape(-1, dim)
    some = vectors.orderBy(F.xxhash64("v"), "v").select("v").limit(SAMPLE).collect()
    simplex = spark.sparkContext.broadcast(Simplex(np.array([r.v for r in some], np.int64).reshape(-1, dim)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("v").to_pylist(), np.int64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), binary_rows(x), binary_rows(simplex.value.apex(x))],
                                             names=["vec_id", "v", "apex"])

    cached = materialize(map_arrow(vectors, project, "vec_id long, v binary, apex binary"))

    def assigned(batches: Iterator[pa.RecordBatch], at: np.ndarray, own: np.ndarray):
        for b in batches:
            for first in range(0, b.num_rows, ROWS):
                part = b.slice(first, ROWS)
                x = np.frombuffer(b"".join(part.column("v").to_pylist()), np.int64).reshape(-1, dim)
                apexes = np.frombuffer(b"".join(part.column("apex").to_pylist())).reshape(len(x), -1)
                best, distance, _ = nearest(x, apexes, at, own)
                yield part, x, best, distance

    for _ in range(rounds if len(centres) else 0):
        own = simplex.value.apex(centres)

        def add(batches, at=centres, own=own):
            sums, sizes = [[0] * dim for _ in at], [0] * len(at)        # Python integers: no overflow
            for _, x, best, _ in assigned(batches, at, own):
                for c in np.unique(best).tolist():
                    mine = x[best == c]
                    sizes[c] += len(mine)
                    part = mine.sum(axis=0) if len(mine) * int(np.abs(mine).max()) < 1 << 62 else mine.astype(object).sum(axis=0)
                    sums[c] = [a + int(v) for a, v in zip(sums[c], part, strict=True)]
            full = [(c, i) for c, n in enumerate(sizes) if n for i in range(dim)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in full], pa.int32()), pa.array([i for _, i in full], pa.int32()),
                 pa.array([sizes[c] for c, _ in full], pa.int64()), pa.array([str(sums[c][i]) for c, i in full])],
                names=["cluster", "component", "n", "total"])

        parts = map_arrow(cached, add, "cluster int, component int, n long, total string")
        moved = parts.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        centres = centres.copy()
        for r in moved.collect():               # at most k * dim rows
            centres[r.cluster, r.component] = int(r.total) // r.n

    own = simplex.value.apex(centres)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, best, distance in assigned(batches, centres, own):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    found = materialize(map_arrow(cached, last, "vec_id long, cluster int, distance long"))
    inertia = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    held = lambda n: min(n, (1 << 63) - 1)
    per_cluster = [(c, held(inertia[c]), held(sum(inertia.values())), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest())
                   for c in sorted(inertia)]
    table = spark.createDataFrame(per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(    # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def oracle(k: int = 16, dim: int = 64, scale: int = 64, rounds: int = 3, seed: int = 1) -> str:
    """DuckDB SQL of ``cluster``: long rows (vector, component, integer), one pair of CTEs a round."""
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * c::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cells AS MATERIALIZED (SELECT r, unnest(range({dim})) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT c, unnest(range({dim})) AS d, unnest(v) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v FROM kept) WHERE c < {k})"""]
    for n in range(rounds + 1):
        ctes.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, min_by(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT cells.r, c{n}.c, sum((cells.x - c{n}.x) * (cells.x - c{n}.x)) AS dist FROM cells JOIN c{n} USING (d) GROUP BY 1, 2) GROUP BY r)""")
        if n < rounds:
            ctes.append(f"""
m{n} AS (
  SELECT c, d, CAST(sum(x) AS BIGINT) AS total, count(*) AS size FROM cells JOIN a{n} USING (r) GROUP BY 1, 2),
c{n + 1} AS MATERIALIZED (
  SELECT c, d, CASE WHEN m{n}.total IS NULL THEN x ELSE (total - (((total % size) + size) % size)) // size END AS x
  FROM c{n} LEFT JOIN m{n} USING (c, d))""")
    return f"""
WITH {",".join(ctes)},
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c),
per AS (SELECT c, sum(dist) AS total FROM a{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, CAST(total AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(dist) FROM a{rounds}) AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN named USING (c) JOIN per USING (c)
"""


ORACLE_OP11 = oracle()
