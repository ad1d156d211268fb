"""Packing token sequences: shortest pack first over the length histogram.

Documents are tokenised and cut into pieces of at most ``room`` tokens.  Only the
histogram of piece lengths (at most ``room`` numbers) reaches the driver, which
fills packing patterns from the longest length to the shortest and keeps a count
for each pattern.  Patterns become rank intervals of every length; a piece finds
its sequence and offset from its length and its rank among pieces of that length.
Ranks need no sort: each task numbers its own pieces, and a running sum over the
tasks' counts gives where its numbers begin.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import load, text_slices_decoded
from tessera.llm.common import batch, read, map_arrow
from tessera.session import materialize

ROOM = 4096


def pieces(docs: DataFrame, path: str, end_id: int, room: int = ROOM) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, part, rank.

    A document's ids are those of its whole text and then ``end_id``; it is cut after every
    ``room`` ids, however long it is.  Null and empty texts are ``end_id`` alone, rows that repeat
    are documents of their own, and columns other than doc_id and text are not read.  ``rank``
    counts the pieces of one length within the task ``part``.  Empty input: no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("part", pa.int64()), ("rank", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = load(path), TaskContext.get().partitionId()
        seen = np.zeros(room + 1, np.int64)
        for b in batches:
            for i, j, texts in text_slices_decoded(b.column("text")):
                flat, count = bpe.encode_flat(texts)
                total = count + 1
                line = np.empty(len(flat) + len(total), "<u4")      # every document's ids and the end behind
                last = np.cumsum(total) - 1
                line[last] = end_id
                inside = np.ones(len(line), bool)
                inside[last] = False
                line[inside] = flat
                n = -(-total // room)
                doc = np.repeat(np.arange(len(total)), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * room
                length = np.minimum(room, total[doc] - start)
                at = np.repeat(last + 1 - total, n) + start
                raw = memoryview(line).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                head = np.searchsorted(ranked, ranked)
                rank = np.empty(len(doc), np.int64)
                rank[order] = np.arange(len(doc)) - head + seen[ranked]
                seen += np.bincount(length, minlength=room + 1)
                yield batch(schema, [b.column("doc_id")[i:j].take(pa.array(doc)), start, length, crc, total[doc],
                                     np.full(len(doc), part), rank])
    run.keeps = True
    return docs.select(F.col("doc_id").cast("long"), "text").transform(map_arrow, 
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, rank long")


def shortest_pack_first(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, dict[int, int]]]:
    """(how often, {length: times in the pattern}) for a histogram of lengths.

    Lengths are placed longest first, each into the least filled patterns, until one has no
    room left for it; what remains opens new patterns.  A step splits one pattern at most, so
    there are at most two patterns a length, whatever the counts.
    """
    by_fill: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        placed = []
        for fill in sorted(by_fill):
            if not left or fill + length > room:
                break
            rest = []
            for often, pattern in by_fill.pop(fill):
                # a pattern takes one piece at a time: others of its fill come first
                take = min(often, left)
                if take:
                    placed.append((fill + length, take, pattern | {length: pattern.get(length, 0) + 1}))
                    left -= take
                if often > take:
                    rest.append((often - take, pattern))
            if rest:
                by_fill[fill] = rest
        while left:
            each = room // length
            full, more = divmod(left, each)
            if full:
                placed.append((each * length, full, {length: each}))
            if more:
                placed.append((more * length, 1, {length: more}))
            left = 0
        for fill, often, pattern in placed:
            by_fill[fill].append((often, pattern))
    return [x for fill in sorted(by_fill, reverse=True) for x in by_fill[fill]]


def intervals(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, times, offset), sorted: the ranks of a length
    that a pattern takes, where its sequences begin, and where the length lies in each."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for often, pattern in patterns:
        offset = 0
        for length, times in sorted(pattern.items(), reverse=True):
            out.append((length, used[length], sequence, times, offset))
            used[length] += often * times
            offset += length * times
        sequence += often
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, room: int = ROOM) -> DataFrame:
    """``cut`` with sequence_id and offset in place of part and rank (and of columns of these names).

    Needs length (1 to ``room``), part and rank as ``pieces`` makes them; other columns come along,
    whatever their names.  Every row lands in exactly one sequence; sequences have no gaps and at
    most ``room`` tokens.  Repeated rows are pieces of their own.  Empty input: no rows.
    """
    spark = cut.sparkSession
    per_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    base = per_part.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("base"))
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most room rows
    table = spark.sparkContext.broadcast(intervals(shortest_pack_first(counts, room)))
    names = [c for c in cut.columns if c not in ("part", "rank", "sequence_id", "offset")]
    rows = cut.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "length", "part", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = t[:, 0] << 44 | t[:, 1]
        for b in batches:
            length, rank = (np.asarray(b.column(c)) for c in ("length", "rank"))
            row = t[np.searchsorted(key, length << 44 | rank, "right") - 1]
            within = rank - row[:, 1]
            sequence, offset = row[:, 2] + within // row[:, 3], row[:, 4] + within % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"])

    ranked = rows.join(base, ["length", "part"]).select("row", "length", (F.col("rank") + F.col("base")).alias("rank"))
    placed = ranked.transform(map_arrow, place, f"row {rows.schema['row'].dataType.simpleString()}, sequence_id long, offset long")
    return placed.select("row.*", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    return pack(materialize(pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"), end_id=2)))
