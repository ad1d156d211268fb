"""Exact top-k search by inner product: block-at-a-time pruning over a block forward index.

Components are terms, integer components their weights.  Vectors are put in an order in
which neighbours are alike, and dealt into document ranges: ``GROUP`` vectors travel
together as blocks of ``BLOCK`` vectors.  A block keeps its forward index (all integers
of its vectors) and the largest and smallest value of each term.  A query's bound on a
block is the sum, over its terms, of its weight times the larger of both products; no
vector of the block scores higher.

A query first goes to the range of highest bound, which gives it a threshold (its kth
score there), then to every other range whose bound reaches the threshold.  Inside a
range the blocks are taken by falling bound, and scored until the bounds fall below the
kth score.  A block whose bound equals the kth score is scored too, so ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import binary_rows, map_arrow, read, shuffle_partitions
from tessera.session import materialize

BLOCK = 64              # vectors with term maxima of their own
GROUP = 16_384          # vectors of a document range, which one task holds
SET = 2048              # queries that meet a range in one task
CHUNK = 1024            # ranges whose bounds one task compares with a set of queries
SLICE = 256             # queries scored at a time
PIVOTS = 512            # vectors that the order is made from at most, chosen by hash
LEAST = np.iinfo(np.int64).min
RESULT = "query_id long, rank int, vec_id long, score long"


def integers(vectors: DataFrame, scale: float) -> tuple[DataFrame, int]:
    """(vec_id, v) with v the components floor(scale * x) as longs, and the largest number of components.

    Rows without vec_id and vectors that are null or hold null or non-finite components take
    no part.  Rows that repeat a vec_id count once, with the smallest vector.  Integers are
    held to the range in which every inner product is a long.
    """
    x = F.col("embedding").cast("array<double>")
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter(
        "vec_id is not null and x is not null").filter(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    dim = max(1, ok.agg(F.max(F.size("x")).alias("d")).first().d or 0)
    most = float(int((2 ** 62 / dim) ** 0.5))
    whole = F.transform("x", lambda c: F.greatest(F.least(F.floor(c * scale).cast("double"), F.lit(most)), F.lit(-most)).cast("long"))
    return ok.groupBy("vec_id").agg(F.min("x").alias("x")).select("vec_id", whole.alias("v")), dim


def padded(column, dim: int) -> np.ndarray:
    """Vectors as rows of integers; components that a shorter vector lacks are 0."""
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where every partial sum is below 2**53."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Summed term maxima: for each query the most that a vector between ``low`` and ``high`` can score."""
    q = q.astype(float)
    most = np.maximum(q, 0) @ high.T.astype(float) + np.minimum(q, 0) @ low.T.astype(float)
    return most + 1e-9 * np.abs(most)       # never below the exact bound


def in_order(pivots: np.ndarray) -> np.ndarray:
    """Pivots one after the other, each time the nearest that is left."""
    if not len(pivots):
        return pivots
    x = pivots.astype(float)
    left, at, order = np.ones(len(x), bool), 0, []
    for _ in range(len(x)):
        order.append(at)
        left[at] = False
        if left.any():
            far = ((x - x[at]) ** 2).sum(axis=1)
            at = int(np.where(left, far, np.inf).argmin())
    return pivots[order]


def index(rows: DataFrame, dim: int, k: int) -> DataFrame:
    """The blocks: range, low, high, forward (packed integers) and the ids of each vector.

    Equal vectors are one entry with their k + 1 smallest ids, which is all that a query can need.
    """
    spark = rows.sparkSession
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = (rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    entries = materialize(entries)
    share = min(1.0, PIVOTS / max(1, entries.count()))
    some = entries.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30)))
    pivots = in_order(padded([r.v for r in some.select("v").sort(F.xxhash64("v"), "v").limit(2 * PIVOTS).collect()], dim))
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value.astype(float)
        for b in batches:
            x = padded(b.column("v").to_pylist(), dim)
            cell, far = np.zeros(len(x), np.int64), np.zeros(len(x))
            if len(p) and len(x):
                d = (x.astype(float) ** 2).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * x.astype(float) @ p.T
                cell, far = d.argmin(axis=1), d.min(axis=1)
            yield pa.RecordBatch.from_arrays([binary_rows(x), b.column("ids"), pa.array(cell), pa.array(far)],
                                             names=["v", "ids", "cell", "far"])

    placed = map_arrow(entries, place, "v binary, ids array<bigint>, cell long, far double")
    ranged = placed.repartitionByRange(shuffle_partitions(spark), "cell", "far", "v").sortWithinPartitions("cell", "far", "v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, held = TaskContext.get().partitionId() << 32, 0, []

        def block(part: list) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(v for v, _ in part), np.int64).reshape(-1, dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([own + n * BLOCK // GROUP]), *(binary_rows(m.reshape(1, -1)) for m in (x.min(axis=0), x.max(axis=0), x)),
                 pa.array([[i for _, i in part]], pa.list_(pa.list_(pa.int64())))], names=["range", "low", "high", "forward", "ids"])

        for b in batches:
            held += zip(b.column("v").to_pylist(), b.column("ids").to_pylist(), strict=True)
            while len(held) >= BLOCK:
                yield block(held[:BLOCK])
                held, n = held[BLOCK:], n + 1
        if held:
            yield block(held)

    return materialize(map_arrow(ranged, cut, "range long, low binary, high binary, forward binary, ids array<array<bigint>>"))


def matrix(column, dim: int) -> np.ndarray:
    """Packed rows as one matrix."""
    return np.frombuffer(b"".join(column), np.int64).reshape(-1, dim)


def score_range(queries: pd.DataFrame, blocks: pd.DataFrame, k: int, dim: int) -> tuple[list, int]:
    """(query_id, vec_id, score) of each query's k best in the blocks, and the number of blocks scored.

    A query takes the blocks by falling bound, first one, then twice as many each time, until
    the next bound is below its kth score (or below the threshold it came with).
    """
    low, high = matrix(blocks["low"], dim), matrix(blocks["high"], dim)
    forward = [np.frombuffer(f, np.int64).reshape(-1, dim) for f in blocks["forward"]]
    names = [list(i) for own in blocks["ids"] for i in own]
    edge = np.concatenate(([0], np.cumsum([len(f) for f in forward])))
    out, scored = [], 0
    for at in range(0, len(queries), SLICE):
        part = queries.iloc[at:at + SLICE]
        q, floor = matrix(part["q"], dim), part["floor"].to_numpy(np.int64)
        own = part["query_id"].to_numpy(np.int64)
        bound = bounds(q, low, high)
        order = np.argsort(-bound, axis=1, kind="stable")
        falling = np.take_along_axis(bound, order, axis=1)
        scores = np.full((len(q), edge[-1]), LEAST)
        kth, done, step = floor.copy(), 0, 1
        while done < len(forward):
            # falling bounds: a query whose next bound is too low is through
            wanted = falling[:, done:done + step] >= kth[:, None]
            if not wanted.any():
                break
            row, column = np.nonzero(wanted)
            block = order[row, done + column]
            by = np.argsort(block, kind="stable")
            for run in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
                b = int(block[run[0]])
                scores[row[run], edge[b]:edge[b + 1]] = product(q[row[run]], forward[b])
            scored += len(row)
            done, step = done + step, 2 * step
            kth = np.maximum(kth, _kth(scores, names, own, k))
        for r in range(len(q)):
            near = np.flatnonzero(scores[r] >= max(kth[r], LEAST + 1))
            best = sorted((-int(scores[r, i]), v) for i in near for v in names[i] if v != own[r])[:k]
            out += [(int(own[r]), v, -s) for s, v in best]
    return out, scored


def _kth(scores: np.ndarray, names: list[list[int]], own: np.ndarray, k: int) -> np.ndarray:
    """A score that k candidates reach, per query: the (k + 1)th entry, as its own vector may be one of them."""
    if scores.shape[1] <= k:
        return np.full(len(scores), LEAST)
    return np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, scores.shape[1] - k - 1]


def search(vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` holds, the k highest of all others.

    ``vectors`` has vec_id and embedding (others are not read); see ``integers`` for what takes
    part.  Score is the inner product of the integers, ties go to the smaller vec_id; with fewer
    than k candidates all are returned.  Vectors of unlike length are filled up with zeros.  The
    result is exact.  An empty table gives no rows.
    """
    rows, dim = integers(vectors, scale)
    rows = materialize(rows)
    blocks = index(rows, dim, k)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), binary_rows(padded(b.column("v").to_pylist(), dim))], names=["query_id", "q"])

    queries = materialize(map_arrow(rows.filter(is_query), pack, "query_id long, q binary"))
    sets = -(-queries.count() // SET) or 1

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = matrix(pdf["low"], dim).min(axis=0), matrix(pdf["high"], dim).max(axis=0)
        return pd.DataFrame({"range": pdf["range"].iloc[:1], "low": [low.tobytes()], "high": [high.tobytes()]})

    ranges = materialize(blocks.select("range", "low", "high").groupBy("range").applyInPandas(whole, "range long, low binary, high binary"))
    chunks = -(-ranges.count() // CHUNK) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = ranges.select("*", F.pmod(F.xxhash64("range"), F.lit(chunks)).alias("chunk"), every(sets).alias("part"))

    def ask(asking: DataFrame, visit) -> DataFrame:
        """(query_id, q, floor, range) of the ranges that ``visit`` chooses from a query's bounds on all ranges of a chunk."""
        def choose(qs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            got = []
            if len(qs) and len(own):
                named = own["range"].to_numpy(np.int64)
                low, high = matrix(own["low"], dim), matrix(own["high"], dim)
                for at in range(0, len(qs), SLICE):
                    part = qs.iloc[at:at + SLICE]
                    bound = bounds(matrix(part["q"], dim), low, high)
                    row, column = np.nonzero(visit(bound, part, named))
                    got.append(part.iloc[row][["query_id", "q", "floor"]].assign(range=named[column], bound=bound[row, column]))
            return pd.concat(got) if got else pd.DataFrame(columns=["query_id", "q", "floor", "range", "bound"])

        asking = asking.select("*", F.pmod(F.xxhash64("query_id"), F.lit(sets)).alias("part"), every(chunks).alias("chunk"))
        return (asking.groupBy("part", "chunk").cogroup(dealt.groupBy("part", "chunk"))
                .applyInPandas(choose, "query_id long, q binary, floor long, range long, bound double"))

    def score(asked: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): k best of each query in each range it visits."""
        asked = materialize(asked.select("query_id", "q", "floor", "range"))
        split = materialize(asked.groupBy("range").agg(F.ceil(F.count("*") / SET).cast("long").alias("parts")))
        asked = asked.join(split, "range").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
        sent = blocks.join(split.select("range", F.col("parts").alias("n")), "range").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))

        def compare(qs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            found = score_range(qs, own, k, dim)[0] if len(qs) and len(own) else []
            return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

        return (asked.groupBy("range", "part").cogroup(sent.groupBy("range", "part"))
                .applyInPandas(compare, "query_id long, vec_id long, score long"))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    open_ = queries.withColumn("floor", F.lit(int(LEAST)).cast("long"))
    highest = ask(open_, lambda bound, part, named: bound.argmax(axis=1)[:, None] == np.arange(bound.shape[1]))
    first = highest.groupBy("query_id").agg(F.max_by(F.struct("q", "floor", "range"), F.struct("bound", "range")).alias("a")).select("query_id", "a.*")
    first = materialize(first)
    begun = materialize(top(score(first)))
    floors = begun.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    seen = first.join(floors, "query_id", "left").select(
        "query_id", "q", F.coalesce("kth", "floor").alias("floor"), F.col("range").alias("seen"))

    def rest(bound: np.ndarray, part: pd.DataFrame, named: np.ndarray) -> np.ndarray:
        return (bound >= part["floor"].to_numpy(np.int64)[:, None]) & (named != part["seen"].to_numpy(np.int64)[:, None])

    found = begun.drop("rank").unionByName(score(ask(seen, rest)))
    return top(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), F.col("vec_id") % 50 == 0)


ORACLE_OP13 = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda c: c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  GROUP BY vec_id),
w AS (SELECT vec_id, list_transform(x, lambda c: floor(c * 256)) AS x FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""
