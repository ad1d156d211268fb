"""Importance resampling of documents towards a target distribution of n-grams, by segment deduplication.

Newlines separate words, so a text is cut at them into lines.  Equal lines have equal
features: the corpus is reduced to its distinct lines and their numbers of occurrences,
the features of a line are counted once, and every count is multiplied by the line's
occurrences.  n-grams that run across lines are no line's own and are added separately,
from the words at the edges of the lines.  A document's weight is put together the same
way: the weights of its lines, looked up, and those of its cross-line n-grams.

A feature's bucket is the crc32 of its bytes modulo the number of buckets.  The sums of
the buckets, of the corpus and of the target, are all that reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import binary_rows, doc_key, lower_ascii, map_arrow, read, text_slices, word_spans
from tessera.operators.cohort import surrogate_id
from tessera.session import materialize

RUN = 512               # buckets whose sums travel together
LONG = 64               # bytes; longer words are hashed by zlib one by one
OUTSIDE = np.ones(256, bool)        # bytes between words: all ASCII but digits and letters a-z
OUTSIDE[48:58] = OUTSIDE[97:123] = OUTSIDE[128:] = False
WORDED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"       # matches where a text has a word (before lower-casing)
FEATURES = "buckets array<int>, counts array<long>, n_words long, n_features long"


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def crc32(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of what ``state`` is the crc32 of followed by each span of ``buf``."""
    out = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    n_long = int((size > LONG).sum())
    short = order[n_long:]
    at, left = starts[short], size[short]
    c = out[short]
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, "left"))       # spans longer than ``step`` come first
        c[:live] = CRC[(c[:live] ^ buf[at[:live] + step]) & 0xFF] ^ (c[:live] >> np.uint32(8))
    out[short] = c
    out ^= np.uint32(0xFFFFFFFF)
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(state[i]))
    return out


def ngrams(buf: np.ndarray, off: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length 1 to n: the text, first word, last word's number and crc32 of every run of words in a text of ``buf``."""
    low = lower_ascii(buf)
    starts, ends, first = word_spans(low, off, OUTSIDE)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    state = np.zeros(len(starts), np.uint32)
    space = np.array([32], np.uint8)
    for size in range(1, n + 1):
        kept = len(starts) - size + 1
        if kept <= 0:
            return
        if size > 1:
            state = crc32(state[:kept], space, np.zeros(kept, np.int64), np.ones(kept, np.int64))
        state = crc32(state[:kept], low, starts[size - 1:], ends[size - 1:])
        whole = text[:kept] == text[size - 1:]
        at = np.flatnonzero(whole)
        yield size, text[at], starts[at], starts[at + size - 1], state[at]


def counted(text: np.ndarray, bucket: np.ndarray, n_texts: int, buckets: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Per text its distinct buckets, how often each occurs, and how many features that is."""
    pair, times = np.unique(text.astype(np.int64) * buckets + bucket, return_counts=True)
    edge = np.searchsorted(pair, np.arange(n_texts + 1) * np.int64(buckets)).astype(np.int32)
    lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(edge), pa.array(values, kind))
    return lists((pair % buckets).astype(np.int32), pa.int32()), lists(times, pa.int64()), np.bincount(text, minlength=n_texts)


def features(texts: DataFrame, n: int, buckets: int, across: bool) -> DataFrame:
    """``texts`` (text and others) with the features of each text in the text's place.

    Within lines a text is taken whole; ``across`` takes only the runs that a newline lies in,
    so lines' own features and those across lines make up all of a text's.
    """
    kept = [f for f in texts.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            other = [b.column(f.name) for f in kept]
            for i, j, buf, off in text_slices(b.column("text")):
                text, bucket, words = [], [], np.zeros(j - i, np.int64)
                breaks = np.concatenate(([0], np.cumsum(buf == 10))) if across else None
                for size, t, first, last, crc in ngrams(buf, off, n):
                    if size == 1:
                        words = np.bincount(t, minlength=j - i)
                    if across:
                        over = breaks[first] != breaks[last]
                        t, crc = t[over], crc[over]
                    text.append(t)
                    bucket.append((crc % np.uint32(buckets)).astype(np.int64))
                none = [np.zeros(0, np.int64)]
                lists = counted(np.concatenate(text or none), np.concatenate(bucket or none), j - i, buckets)
                cols = [*(c.slice(i, j - i) for c in other), *lists[:2], pa.array(words, pa.int64()), pa.array(lists[2], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=[*(f.name for f in kept), "buckets", "counts", "n_words", "n_features"])

    of_kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return map_arrow(texts.select(*[f.name for f in kept], "text"), run, of_kept + FEATURES)


def _lists(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All buckets and counts of a batch end to end, and the row of each."""
    buckets, counts = b.column("buckets"), b.column("counts")
    return buckets.flatten().to_numpy(), counts.flatten().to_numpy(), np.repeat(np.arange(b.num_rows), np.diff(buckets.offsets.to_numpy()))


def bucket_sums(counted_rows: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of each bucket over all rows, every row ``times`` times.

    A task hands on its sums in a few runs of ``RUN`` buckets, and runs are added up as they stream in.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-buckets // RUN) * RUN, np.int64)
        for b in batches:
            bucket, n, row = _lists(b)
            np.add.at(total, bucket, n * b.column("times").to_numpy()[row])
        runs = total.reshape(-1, RUN)
        full = np.flatnonzero(runs.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full), binary_rows(runs[full])], names=["run", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            for run, sums in zip(b.column("run").to_pylist(), b.column("sums").to_pylist(), strict=True):
                total[run] = total.get(run, 0) + np.frombuffer(sums, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                         names=["run", "sums"])

    out = np.zeros((-(-buckets // RUN), RUN), np.int64)
    parts = map_arrow(counted_rows.select("buckets", "counts", "times"), count, "run long, sums binary")
    for r in map_arrow(parts.repartition("run"), add, "run long, sums binary").collect():       # one number a bucket
        out[r.run] = np.frombuffer(r.sums, np.int64)
    return out.ravel()[:buckets]


def with_weight(counted_rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows with the sum of their features' gains in place of the features."""
    shared = counted_rows.sparkSession.sparkContext.broadcast(gain)     # one number a bucket
    kept = [f for f in counted_rows.schema.fields if f.name not in ("buckets", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, count, row = _lists(b)
            weight = np.zeros(b.num_rows, np.int64)
            np.add.at(weight, row, count * shared.value[bucket])
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), pa.array(weight)],
                                             names=[*(f.name for f in kept), "weight"])

    return map_arrow(counted_rows, run, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "weight long")


def distinct_lines(texts: DataFrame) -> DataFrame:
    """(text, times): the distinct lines of all texts that hold a word, and how often each occurs."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("text")).filter(F.col("text").rlike(WORDED))
    return lines.groupBy("text").agg(F.count("*").alias("times"))


def line_key(line):
    return F.unhex(F.md5(line))


def select(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10,
           least: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document of ``docs``.

    ``docs`` has doc_id and text, ``target`` has text; other columns are not read.  The documents
    of at least ``least`` words with the highest scores, floor(percent * N / 100) of them, have a
    rank; ties go to the smaller doc_id (a null one last, named ``null`` in the hash), then by
    text.  Null and empty texts have no features and weight 0; whole texts are read, however long.
    Rows equal in doc_id and text are ranked one behind the other.  An empty target gives every
    bucket the same prior; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted_lines = materialize(features(distinct_lines(docs).select(line_key("text").alias("line"), "times", "text"), n, buckets, False))
    source = bucket_sums(counted_lines, buckets)
    wanted = bucket_sums(features(distinct_lines(target), n, buckets, False), buckets)
    crossing = None
    if n > 1:       # runs of one word lie in one line
        crossing = materialize(features(docs.select(doc_key().alias("key"), F.lit(1).cast("long").alias("times"), "text"), n, buckets, True)
                               .filter(F.size("buckets") > 0))
        source = source + bucket_sums(crossing, buckets)
        wanted = wanted + bucket_sums(features(target.select(F.lit(1).cast("long").alias("times"), "text"), n, buckets, True), buckets)
    s, t = source.astype(float), wanted.astype(float)
    gain = np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)

    # small: written first, so that a frequent line's occurrences, on the other side, can be split
    weights = materialize(with_weight(counted_lines.drop("times"), gain))
    keyed = docs.select(doc_key().alias("key"), F.explode(F.split("text", "\n")).alias("text")).filter(F.col("text").rlike(WORDED))
    sums = [F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    per_doc = keyed.select("key", line_key("text").alias("line")).join(weights, "line").groupBy("key").agg(*sums)
    if crossing is not None:
        over = with_weight(crossing.drop("times"), gain).select("key", F.lit(0).cast("long").alias("n_words"), "n_features", "weight")
        per_doc = per_doc.unionByName(over).groupBy("key").agg(*sums)
    rows = docs.groupBy(doc_key().alias("key"), "doc_id").agg(F.count("*").alias("copies"))
    per_copy = lambda c: F.coalesce(F.expr(f"{c} div copies"), F.lit(0)).alias(c)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("long")
    scored = materialize(rows.join(per_doc, "key", "left").select(
        "key", "doc_id", "copies", *[per_copy(c) for c in ("n_words", "n_features", "weight")]).withColumn("score", F.col("weight") + noise))

    able = scored.filter(F.col("n_words") >= least)
    total = able.agg(F.sum("copies").alias("n")).first().n or 0
    drawn = percent * total // 100
    line_up = able.select("key", "doc_id", "copies", (-F.col("score")).alias("last"), F.col("doc_id").isNull().alias("unnamed"))
    line_up = line_up.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    ranked = surrogate_id(line_up, ["last", "unnamed", "doc_id", "key", "copy"], "rank").filter(F.col("rank") <= drawn).select("key", "copy", "rank")
    every = scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return every.join(ranked, ["key", "copy"], "left").select("doc_id", "n_features", "weight", "score", "rank")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "documents", ["doc_id", "text"]), read(spark, sf_dir, "benchmark", ["text"]))


ORACLE_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
low AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM d),
own AS MATERIALIZED (SELECT r, w, count(*) AS n FROM low GROUP BY ALL),
aim AS MATERIALIZED (
  SELECT w, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY w),
words AS (SELECT DISTINCT w FROM (SELECT w FROM own UNION ALL SELECT w FROM aim)),
crc AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS v
  FROM (SELECT unnest(range(256)) AS i)),
steps AS (SELECT list(v ORDER BY i) AS crcs FROM crc),
bytes AS (SELECT w, list_transform(range(octet_length(encode(w))), lambda k: ('0x' || substr(hex(encode(w)), 2 * k + 1, 2))::BIGINT) AS b FROM words),
hashed AS MATERIALIZED (
  SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, crcs[xor(c, x) % 256 + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
s AS (SELECT bucket, sum(n)::DOUBLE AS n FROM own JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::DOUBLE AS n FROM aim JOIN hashed USING (w) GROUP BY bucket),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
                                 / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket)),
per AS (SELECT r, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS weight FROM own JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS MATERIALIZED (
  SELECT r, doc_id, text, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN per USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, 10 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
