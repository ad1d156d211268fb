"""Two-tower text features and neural scoring (FEA-08, MOD-16..18).

Re-aimed from a single-machine LSTM: every token of the whole text is mapped
to an embedding row (hashed token → vec_id), embeddings are averaged per text
weighted by the tokens' counts, and the pair representation is (a − b)² ⧺ (a + b) ⧺ the
NLP features.  A multilayer perceptron stands in for the dense head
(``models.fit_epochs``).

A vector never travels with a token.  The embedding table is cut into blocks of
``BLOCK`` vec_ids and the pairs into parts; a task has one block and the counts of one
part's texts, and gives each text's sum over that block.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 18                 # vectors a task holds: 64 MB of 64 floats each
SLICE_TOKENS = 1 << 20          # tokens counted by one numpy step; a longer text is a step of its own
SLICE_VECTORS = 1 << 15         # vectors added up by one numpy step


def _places(tokens: pa.Array, n_vectors: int) -> np.ndarray:
    """The vec_id of every token: ``hash32("tok", token)`` modulo the size of the table, found once per distinct token."""
    d = tokens.dictionary_encode()
    of = [hashlib.md5(b"tok|" + t, usedforsecurity=False) for t in d.dictionary.cast(pa.binary()).to_pylist()]
    of.append(hashlib.md5(b"tok", usedforsecurity=False))       # of a missing token
    at = np.array([int.from_bytes(x.digest()[:4], "big") % n_vectors for x in of], np.int64)
    return at[d.indices.fill_null(len(d.dictionary)).to_numpy(zero_copy_only=False)]


def _counts_batch(a: pa.Array, b: pa.Array, n_vectors: int, block: int) -> pa.Array:
    """Per row the pieces (side, block, places in the block, counts)."""
    size = pc.add(pc.fill_null(pc.list_value_length(a), 0), pc.fill_null(pc.list_value_length(b), 0))
    ends = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))])
    keys, counts, i = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE_TOKENS, "right")) - 1)
        text = [2 * pc.list_parent_indices(x.slice(i, j - i)).to_numpy(zero_copy_only=False).astype(np.int64) + k for k, x in enumerate((a, b))]
        flat = pa.concat_arrays([pc.list_flatten(x.slice(i, j - i)) for x in (a, b)])
        if len(flat):
            key, n = np.unique((np.concatenate(text) + 2 * i) * n_vectors + _places(flat, n_vectors), return_counts=True)
            keys.append(key)
            counts.append(n)
        i = j
    key, n = np.concatenate(keys), np.concatenate(counts)
    text, place = key // n_vectors, key % n_vectors
    blocks = -(-n_vectors // block)
    piece = text * blocks + place // block
    start = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(piece) else np.zeros(0, np.int64)
    within = pa.array(np.append(start, len(piece)), pa.int32())
    entries = pa.StructArray.from_arrays([
        pa.array(text[start] % 2 + 1, pa.int32()), pa.array(place[start] // block, pa.int32()),
        pa.ListArray.from_arrays(within, pa.array(place % block, pa.int32())), pa.ListArray.from_arrays(within, pa.array(n, pa.int32()))],
        names=["side", "block", "at", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[start] // 2, np.arange(len(a) + 1)), pa.int32()), entries)


def _lists(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of lists without missing ones."""
    return pc.list_value_length(x).to_numpy(zero_copy_only=False), pc.list_flatten(x).to_numpy(zero_copy_only=False)


def _summed(batches, block: int, dim: int):
    """Rows of (block, part), vectors first, to each piece's sum of count × vector and its count of tokens that have a vector."""
    held, table, known = None, None, None
    for batch in batches:
        cell = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("block", "part", "kind")], 1)
        cut = np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1 if len(cell) else []
        for i, j in zip([0, *cut], [*cut, len(cell)]):
            if i == j:
                continue
            rows = batch.slice(i, j - i)
            if tuple(cell[i, :2]) != held:
                held, table, known = tuple(cell[i, :2]), None, np.zeros(block)
            if cell[i, 2] == 0:
                length, values = pc.list_value_length(rows.column("v")).to_numpy(zero_copy_only=False), pc.list_flatten(rows.column("v"))
                values = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
                if (length != dim).any():
                    raise ValueError(f"embeddings of other lengths than {dim}: {sorted(set(length[length != dim].tolist()))[:5]}")
                if table is None:
                    table = np.zeros((block, dim), values.dtype)
                to = rows.column("place").to_numpy(zero_copy_only=False)
                again = len(set(to.tolist())) < len(to) or known[to].any()
                if again:           # a vec_id that repeats counts as often as it is there
                    table = table.astype(np.float64, copy=False)
                    np.add.at(table, to, values.reshape(-1, dim))
                else:
                    table[to] = values.reshape(-1, dim)
                np.add.at(known, to, 1)
                continue
            (length, at), (_, n) = _lists(rows.column("at")), _lists(rows.column("n"))
            total, weight = np.zeros((len(rows), dim)), np.zeros(len(rows))
            end = np.cumsum(length)
            k = 0
            while k < len(rows) and table is not None:
                m = max(k + 1, int(np.searchsorted(end, end[k] - length[k] + SLICE_VECTORS, "right")))
                some = np.flatnonzero(length[k:m]) + k
                if len(some):
                    first, last = end[some[0]] - length[some[0]], end[some[-1]]
                    own, times, start = at[first:last], n[first:last].astype(np.float64), end[some] - length[some] - first
                    total[some] = np.add.reduceat(table[own] * times[:, None], start)
                    weight[some] = np.add.reduceat(known[own] * times, start)
                k = m
            side = rows.column("side").to_numpy(zero_copy_only=False)
            kept = np.flatnonzero((weight > 0) | (side == 0))
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * dim, pa.int32()), pa.array(total[kept].ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("id").take(pa.array(kept)), pa.array(side[kept], pa.int32()), sums, pa.array(weight[kept])],
                                             names=["id", "side", "total", "weight"])


def text_embeddings(pairs: DataFrame, id_col: str, tok_a: str, tok_b: str, emb: DataFrame,
                    n_vectors: int, dim: int) -> DataFrame:
    """One row an id: ``rows``, the number of its rows, and ``a`` and ``b``, the mean embeddings over all tokens
    of its first and second texts (NULL without any).  Tokens whose vector is missing take no part, a missing component is 0.

    Tokens are counted within their row.  Each block of the embedding table goes to the parts that the
    pairs are dealt into, a few per core, and meets the counts that fall into it there."""
    parallel = 4 * pairs.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n_vectors // BLOCK))
    parts = max(1, -(-parallel // blocks))
    block = max(1, min(BLOCK, n_vectors))
    piece = "array<struct<side:int,block:int,at:array<int>,n:array<int>>>"
    counted = F.arrow_udf(lambda a, b: _counts_batch(a, b, max(1, n_vectors), block), piece)
    row = F.expr(f"cast(array(struct(0, 0, array(), array())) as {piece})")         # stands for the row itself
    ids = pairs.schema[id_col].dataType.simpleString()
    texts = pairs.select(F.col(id_col).alias("id"), F.explode(F.concat(row, counted(tok_a, tok_b))).alias("p")).select(
        "p.block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "p.side", "p.at", "p.n")
    vectors = emb.filter((F.col("vec_id") >= 0) & (F.col("vec_id") < n_vectors) & F.col("embedding").isNotNull()).select(
        F.expr(f"cast(vec_id div {block} as int)").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"),
        F.expr(f"cast(vec_id % {block} as int)").alias("place"), F.col("embedding").alias("v"))
    cells = texts.unionByName(vectors, allowMissingColumns=True).repartition(2 * blocks * parts, "block", "part").sortWithinPartitions("block", "part", "kind")
    sums = cells.mapInArrow(partial(_summed, block=block, dim=dim), f"id {ids}, side int, total array<double>, weight double")
    mean = lambda k: F.expr(
        f"aggregate(filter(s, x -> x.side = {k}), cast(null as struct<total:array<double>,weight:double>), "
        "(m, x) -> struct(if(m is null, x.total, zip_with(m.total, x.total, (u, v) -> u + v)) as total, coalesce(m.weight, 0D) + x.weight as weight), "
        "m -> transform(m.total, u -> u / m.weight))")
    return (sums.groupBy("id").agg(F.count_if(F.col("side") == 0).alias("rows"), F.collect_list(F.when(F.col("side") > 0, F.struct("side", "total", "weight"))).alias("s"))
            .select(F.col("id").alias(id_col), "rows", mean(1).alias("a"), mean(2).alias("b")))


def two_tower_features(pairs: DataFrame, id_col: str, tok_a: str, tok_b: str, emb: DataFrame,
                       n_vectors: int, dim: int) -> DataFrame:
    """(a − b)² and (a + b) element-wise, one array per pair (texts without
    any token get zero vectors, and so do pairs without an id)."""
    m = text_embeddings(pairs, id_col, tok_a, tok_b, emb, n_vectors, dim)
    own = lambda c: F.coalesce(F.when(F.col(id_col).isNotNull(), F.col(c)), F.array_repeat(F.lit(0.0), dim)).alias(c)
    j = m.select(id_col, F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))), own("a"), own("b"))
    return j.select(id_col,
                    F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)).alias("sq_diff"),
                    F.zip_with("a", "b", lambda x, y: x + y).alias("sum"))
