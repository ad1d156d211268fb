"""MinHash near-duplicates: SuperMinHash signatures, banding, verification, union-find.

Plan: one pass over the texts gives each document its shingle-set key, size and
signature.  Documents with equal sets form one class by a map-side minimum, so a
group of exact copies is one row from there on.  Classes that share a band of
their signatures are compared inside that bucket; a bucket larger than ``BLOCK``
is dealt over pairs of blocks.  A comparison walks the bucket breadth first and
emits only the edges of a spanning forest, never all pairs.  The components of
those estimated links bound where a true link can be; inside each, links are
confirmed on the full sets, again block by block and breadth first, and the
components of the confirmed links are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    GOLD, Emit, batch, binary_rows, groups, lower_ascii, mix, ngram_hash, prefix_sums, read, shuffle_partitions,
    span_hash, text_key, text_slices, word_spans, map_arrow)
from tessera.llm.components import Forest, connected_components
from tessera.session import materialize

WORDS = 5           # words in a shingle
HASHES = 128        # positions of a signature
BAND = 4            # positions in a band
MARGIN = 0.16       # a pair goes on to the sets if its estimate is at least the threshold less this (5 deviations)
BLOCK = 512         # classes compared in one task at most, as two half blocks
BLOCK_BYTES = 16 << 20


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document.  With fewer words than a
    shingle has, the whole sequence is one; without words the set is empty."""
    low = lower_ascii(buf)
    starts, ends, at = word_spans(low, off)
    hashes = span_hash(prefix_sums(low), starts, ends)
    runs = ngram_hash(hashes, words)
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if j - i >= words:
            s = np.sort(runs[i:j - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif j > i:
            out.append(mix(ngram_hash(hashes[i:j], j - i) + np.uint64(j - i)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray], m: int = HASHES) -> np.ndarray:
    """SuperMinHash signatures, one row of m values a set.

    Element e offers value j + r (r in [0, 1)) to position p_j, where p is a random
    permutation drawn step by step from e's own hash: ranks of one element are
    correlated, so no position is left to chance twice.  A document stops at the
    step whose rank exceeds all its minima.  Values hold j above 32 bits of r.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full((len(sets), m), np.uint64(2**64 - 1))
    if not sizes.sum():
        return out
    flat = out.reshape(-1)
    elements = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    places = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
    live, open_docs = np.arange(len(elements)), np.flatnonzero(sizes)
    for j in range(m):
        draw = mix(elements[live] + np.uint64((j + 1) * int(GOLD) % 2**64))
        k = j + ((draw >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        at = places[live, k]
        places[live, k] = places[live, j]
        np.minimum.at(flat, doc[live] * m + at, (draw & np.uint64(0xFFFFFFFF)) | np.uint64(j << 32))
        going = out[open_docs].max(axis=1) >= np.uint64((j + 1) << 32)
        if not going.all():
            keep = np.zeros(len(sets), bool)
            open_docs = open_docs[going]
            keep[open_docs] = True
            live = live[keep[doc[live]]]
            if not len(live):
                break
    return out


def bands(signatures: np.ndarray, size: int = BAND) -> np.ndarray:
    """Keys of each signature's bands."""
    n, m = signatures.shape
    keys = np.zeros((n, m // size), np.uint64)
    for k in range(size):
        keys = mix(keys + signatures[:, k::size][:, :m // size] * GOLD)
    return mix(keys + np.arange(m // size, dtype=np.uint64) * GOLD)


def _sign(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("tk", pa.binary()), ("n_shingles", pa.int64()),
                        ("sk", pa.binary()), ("bands", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in text_slices(b.column("text")):
                sets = shingle_sets(buf, off, words)
                values = superminhash(sets)
                yield batch(schema, [
                    b.column("doc_id")[i:j], b.column("tk")[i:j], [len(s) for s in sets],
                    [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                    binary_rows(bands(values)), binary_rows(mix(values).astype(np.uint16))])
    return run


def _walk(n: int, close) -> list[tuple[int, int]]:
    """Edges of a spanning forest: ``close(i, rest)`` marks which of rest are linked to i."""
    rest, found = np.arange(1, n), []
    queue = [0] if n else []
    while queue:
        i = queue.pop()
        if len(rest):
            near = close(i, rest)
            found += [(i, int(x)) for x in rest[near]]
            queue += rest[near].tolist()
            rest = rest[~near]
        if not queue and len(rest):
            queue, rest = [int(rest[0])], rest[1:]
    return found


def _bucket_links(least: float):
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, known = Emit(schema), Forest()
        for _, run_ in groups(batches, 3):
            ids = [r[3] for r in run_]
            if len(ids) == 2 and known.find(ids[0]) == known.find(ids[1]):
                continue
            sig = np.frombuffer(b"".join(r[4] for r in run_), np.uint16).reshape(len(ids), -1)
            for x, y in _walk(len(ids), lambda i, rest: (sig[rest] == sig[i]).mean(axis=1) >= least):  # noqa: B023
                if known.join(ids[x], ids[y]) and out.add(ids[x], ids[y]):
                    yield from out.take()
            if len(known.parent) > 200_000:
                known = Forest()
        yield from out.take()
    return run


def _set_links(words: int, percent: int):
    """Confirmed links of one block pair: 100 * intersection >= percent * union."""
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emit(schema)
        for _, run_ in groups(batches, 3):
            ids = [r[3] for r in run_]
            data = [r[4].encode() for r in run_]
            off = np.cumsum([0] + [len(x) for x in data])
            sets = shingle_sets(np.frombuffer(b"".join(data), np.uint8), off, words)
            sizes = np.array([len(s) for s in sets])
            values, code = np.unique(np.concatenate(sets), return_inverse=True)
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(ids)), sizes)
            order = np.argsort(code, kind="stable")            # postings of each shingle
            post, first = owner[order], np.concatenate(([0], np.cumsum(np.bincount(code, minlength=len(values)))))

            def close(i, rest):
                mine = code[ends[i] - sizes[i]:ends[i]]        # noqa: B023
                a, n = first[mine], first[mine + 1] - first[mine]  # noqa: B023
                at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                both = np.bincount(post[at], minlength=len(ids))[rest]  # noqa: B023
                return 100 * both >= percent * (sizes[i] + sizes[rest] - both)  # noqa: B023

            for x, y in _walk(len(ids), close):
                if out.add(ids[x], ids[y]):
                    yield from out.take()
        yield from out.take()
    return run


def _block_pairs(df: DataFrame, blocks: str, by: str) -> DataFrame:
    """Every row once for each pair of blocks (a, b) that its own block takes part in."""
    own = F.pmod(F.xxhash64(by), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(F.col(blocks).cast("int") - 1, F.lit(0))))
    return (df.withColumn("own", own).withColumn("other", other)
            .filter((F.col(blocks) == 1) | (F.col("own") != F.col("other")))
            .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("own", "other"))


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = WORDS) -> DataFrame:
    """doc_id, tk, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; more columns are ignored).
    ``tk`` is ``text_key``, so a row can be told from others of its doc_id.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| over their sets of
    ``words``-word shingles (A-Z lower-cased, split at ASCII white space).  component_id is
    the smallest doc_id reachable over links.  Null, empty and blank texts have an empty set,
    are linked with nothing and stay (their component is their own doc_id).  Rows that repeat
    a doc_id count as one document each and share their component's smallest id.  A null
    doc_id has part in links but never names a component; it stays only if no other row does.
    Empty input: no rows.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    signed = materialize(docs.select(F.col("doc_id").cast("long"), "text", text_key().alias("tk")).transform(map_arrow, 
        _sign(words), "doc_id long, tk binary, n_shingles long, sk binary, bands binary, sig binary"))
    full = signed.filter("n_shingles > 0")
    # one row per distinct set; its signature and one document to read the text from
    classes = materialize(full.groupBy("sk").agg(
        F.min(F.struct("doc_id", "tk", "bands", "sig")).alias("r"), F.min("doc_id").alias("least")).select("sk", "least", "r.*"))
    n_bands = HASHES // BAND
    keyed = classes.select("sk", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda i: F.substring("bands", i * 8 + 1, F.lit(8)))).alias("band", "key")).select("sk", "key")
    sized = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1") \
        .withColumn("blocks", F.when(F.col("n") <= BLOCK, 1).otherwise(F.ceil(F.col("n") * 2 / BLOCK)).cast("int"))
    member = keyed.join(sized.select("key", "blocks"), "key").join(classes.select("sk", "sig"), "sk")
    estimated = (_block_pairs(member, "blocks", "sk").select("key", "a", "b", "sk", "sig")
                 .repartition(parts, "key", "a", "b").sortWithinPartitions("key", "a", "b", "sk")
                 .transform(map_arrow, _bucket_links(percent / 100 - MARGIN), "u binary, v binary"))
    coarse = connected_components(estimated)
    coarse = coarse.unionByName(coarse.select(F.col("root").alias("node"), "root").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("d"), "text", text_key().alias("t"))
    read_from = classes.join(coarse, F.col("sk") == F.col("node")).select("root", "sk", "doc_id", "tk")
    near = (texts.join(read_from, (F.col("t") == F.col("tk")) & F.col("d").eqNullSafe(F.col("doc_id")))
            .select("root", "sk", "text").dropDuplicates(["sk"]))
    near = materialize(near.withColumn("size", F.octet_length("text")))
    groups_ = near.groupBy("root").agg(F.greatest(
        F.when(F.count("*") <= BLOCK, 1).otherwise(F.ceil(F.count("*") * 2 / BLOCK)),
        F.ceil(F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks"))
    confirmed = (_block_pairs(near.join(groups_, "root"), "blocks", "sk").select("root", "a", "b", "sk", "text")
                 .repartition(parts, "root", "a", "b").sortWithinPartitions("root", "a", "b", "sk")
                 .transform(map_arrow, _set_links(words, percent), "u binary, v binary"))
    found = connected_components(confirmed)
    # the smallest doc_id of each class, then of each component
    of = classes.select("sk", "least").join(
        found.select(F.col("node").alias("sk"), "root"), "sk", "left").select(
        "sk", F.coalesce("root", "sk").alias("root"), "least")
    names = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(names, "root").select("sk", "component_id")
    out = signed.select("doc_id", "tk", "n_shingles", "sk").join(named, "sk", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "tk", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", ["doc_id", "text"]), percent=85).drop("tk")
