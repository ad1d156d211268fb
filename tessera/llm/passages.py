"""Repeated-passage removal by column-wise multi-document suffix sorting.

Every byte covered by a ``length``-byte string that also starts elsewhere goes.

The texts are cut into pieces that can be sorted independently: each window of
``length`` bytes is assigned to its anchor, the smallest hashed k-gram in it, so
equal windows have equal anchors at equal offsets.  A piece is the run of windows
of one anchor.  Anchors seen once cannot hold a repeat and are dropped by a
count; the other pieces are grouped by anchor and aligned at it.

Inside a group the suffixes are sorted column by column, from the last to the
first: each round puts one symbol of every piece in front, updates the order
(the collection's Burrows-Wheeler column is the symbols in that order) and the
common-prefix lengths of neighbours, in time linear in the pieces.  As pieces are
aligned, equal windows meet in one column, so no suffix has to be placed among
those of other columns.  Sorted shuffle partitions are the sequential external
files: a task streams its groups and holds one batch of columns, of at most ``HOT``
pieces a group.  The windows of larger groups are counted by hashes instead.

Repeats of several lengths come from one sort.  Anchors and pieces are those of the
shortest; a piece's bytes run on to the longest length behind its last window.  Equal
strings of a longer length begin with equal windows, so they meet in the same column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    Emit, batch, mix, prefix_sums, read, rows, shuffle_partitions, span_hash, text_buffer, text_key, text_slices, map_arrow)
from tessera.session import discard, materialize

LENGTH = 400
PASSAGE = 240           # bytes of about forty words: 99 in 100 runs of 51 words are longer
SEGMENT = 1 << 20       # windows of one document handled at a time
BATCH = 4 << 20         # piece bytes sorted together, at least one whole group
HOT = 50_000            # distinct pieces that are sorted together at most: beyond, a second anchor splits a group


def anchor_bytes(length: int) -> int:
    return max(1, length * 2 // 5)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, from running minima of blocks of w."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.uint64(2**64 - 1))
    full[:len(v)] = v
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchored_runs(buf: np.ndarray, off: np.ndarray, length: int, salt: int = 0):
    """Runs of windows with one anchor, in documents laid end to end in ``buf``.

    Returns (document, first window, windows, anchor position, anchor key) and the prefix
    sums of ``buf``.  A long document is taken in segments; a run may end at their borders.
    """
    k = anchor_bytes(length)
    w = length - k + 1
    parts, sums = [], prefix_sums(buf)
    todo = [(0, len(buf))] if len(buf) <= SEGMENT + length else [
        (a, min(len(buf), a + SEGMENT + length - 1)) for a in range(0, len(buf) - length + 1, SEGMENT)]
    bits = np.uint64(int(SEGMENT * 2 + length).bit_length())
    for a, b in todo:
        if b - a < length:
            continue
        at = np.arange(a, b - k + 1)
        grams = span_hash(sums, at, at + k)
        ranked = mix(grams + np.uint64(salt)) >> bits << bits | np.arange(len(at), dtype=np.uint64)
        pick = (_sliding_min(ranked, w) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        s = np.arange(a, b - length + 1)
        doc = np.searchsorted(off, s, "right") - 1
        inside = s + length <= off[doc + 1]
        s, doc, pick = s[inside], doc[inside], pick[inside]
        if not len(s):
            continue
        new = np.concatenate(([True], (pick[1:] != pick[:-1]) | (doc[1:] != doc[:-1])))
        first = np.flatnonzero(new)
        parts.append((doc[first], s[first], np.diff(np.append(first, len(s))), a + pick[first],
                      grams[pick[first]].astype(np.int64)))
    if not parts:
        none = np.zeros(0, np.int64)
        return (none, none, none, none, none), sums
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)), sums


def _anchors(length: int):
    schema = pa.schema([("tk", pa.binary()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in text_slices(b.column("text")):
                (doc, _, _, _, key), _ = anchored_runs(buf, off, length)
                if len(doc):
                    yield batch(schema, [b.column("tk")[i:j].take(pa.array(doc)), pa.array(key)])
    return run


def _pieces(length: int, reach: int):
    """Pieces whose anchor is among the text's ``keys``, with the bytes up to ``reach`` from each of their windows;
    a content is sent once a slice."""
    schema = pa.schema([("tk", pa.binary()), ("start", pa.int64()), ("key", pa.int64()), ("piece", pa.int64()),
                        ("lead", pa.int32()), ("windows", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at = b.column("keys"), np.asarray(b.column("keys").offsets)
            flat = np.asarray(keys.values)
            for i, j, buf, off in text_slices(b.column("text")):
                (doc, first, n, anchor, key), sums = anchored_runs(buf, off, length)
                wanted = np.zeros(len(doc), bool)
                edge = np.searchsorted(doc, np.arange(j - i + 1))
                for d in range(j - i):
                    lo, hi = edge[d], edge[d + 1]
                    wanted[lo:hi] = np.isin(key[lo:hi], flat[at[i + d]:at[i + d + 1]])
                doc, first, n, anchor, key = (x[wanted] for x in (doc, first, n, anchor, key))
                if not len(doc):
                    continue
                end = np.minimum(first + n + reach - 1, off[doc + 1])
                piece = mix(span_hash(sums, first, end) + n.astype(np.uint64)).astype(np.int64)
                new = np.zeros(len(piece), bool)
                new[np.unique(np.stack([key, piece]), axis=1, return_index=True)[1]] = True
                raw = buf.tobytes()
                yield batch(schema, [
                    b.column("tk")[i:j].take(pa.array(doc)), pa.array(first - off[doc]), pa.array(key),
                    pa.array(piece), pa.array((anchor - first).astype(np.int32)), pa.array(n.astype(np.int32)),
                    pa.array([raw[s:e] if f else None for s, e, f in
                              zip(first.tolist(), end.tolist(), new.tolist(), strict=True)], pa.binary())])
    return run


def _resplit(length: int, reach: int):
    """Pieces of one hot anchor by a second anchor each; ``base`` is the first window's place in the piece."""
    schema = pa.schema([("grp", pa.int64()), ("key", pa.int64()), ("piece", pa.int64()), ("base", pa.int32()),
                        ("lead", pa.int32()), ("windows", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emit(schema)
        for b in batches:
            buf, off = text_buffer(b.column("data"))
            (doc, first, n, anchor, second), _ = anchored_runs(buf, off, length, salt=0x5EED)
            n = np.minimum(n, np.asarray(b.column("windows"))[doc] - (first - off[doc]))     # not those of the bytes behind
            doc, first, n, anchor, second = (x[n > 0] for x in (doc, first, n, anchor, second))
            end = np.minimum(first + n + reach - 1, off[doc + 1])
            key, piece = np.asarray(b.column("key")), np.asarray(b.column("piece"))
            grp = mix(key[doc].astype(np.uint64) ^ mix(second.astype(np.uint64))).astype(np.int64)
            raw = buf.tobytes()
            for d, s, m, e, a, g in zip(*(x.tolist() for x in (doc, first, n, end, anchor, grp)), strict=True):
                if out.add(g, int(key[d]), int(piece[d]), s - int(off[d]), a - s, m, raw[s:e]):
                    yield from out.take()
        yield from out.take()
    return run


def repeated_windows(group: np.ndarray, lead: np.ndarray, data: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, which of its windows also occur in another piece of its group."""
    (found,), shift = repeated_columns(group, lead, data, [length])
    return [found[s:s + len(d) - length + 1, i] for i, (s, d) in enumerate(zip(shift.tolist(), data, strict=True))]


def repeated_columns(group: np.ndarray, lead: np.ndarray, data: list[bytes], lengths: list[int]):
    """For each length, which strings (column, piece) also occur in another piece of the group; each piece's first column.

    ``group`` is sorted; pieces are aligned at ``lead``.  One round a column: order and
    neighbour prefixes of the suffixes that start there come from those of the next column.
    """
    n = len(data)
    shift = int(lead.max()) - lead
    size = np.fromiter(map(len, data), np.int64, n)
    width = int((shift + size).max())
    cells = np.full((n, width), 0xFF, np.uint8)             # 0xFF is in no UTF-8 text: outside a piece
    for row, s, d in zip(cells, shift.tolist(), data, strict=True):
        row[s:s + len(d)] = np.frombuffer(d, np.uint8)
    columns = np.ascontiguousarray(cells.T)
    order, prefix = np.arange(n), np.zeros(n + 1, np.int32)  # prefix[i]: common with the one before
    bucket = group.astype(np.int64) << 8
    found = [np.zeros((width, n), bool) for _ in lengths]
    for c in range(width - 1, -1, -1):
        rank = bucket + columns[c][order]                    # this column of the Burrows-Wheeler transform
        place = np.argsort(rank, kind="stable")
        ranked = rank[place]
        nxt = np.zeros(n + 1, np.int32)
        same = np.flatnonzero((ranked[1:] == ranked[:-1]) & ((ranked[1:] & 0xFF) != 0xFF)) + 1
        if len(same):
            before, here = place[same - 1] + 1, place[same]
            low = prefix[here]
            far = np.flatnonzero(before < here)
            if len(far):
                span = np.empty(2 * len(far), np.int64)
                span[0::2], span[1::2] = before[far], here[far] + 1
                low[far] = np.minimum.reduceat(prefix, span)[0::2]
            nxt[same] = low + 1
        order, prefix = order[place], nxt
        for length, flags in zip(lengths, found, strict=True):
            hit = np.flatnonzero(nxt >= length)
            flags[c, order[hit]] = True
            flags[c, order[hit - 1]] = True
    return found, shift


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True))


def _sort_columns(lengths: list[int]):
    schema = pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("length", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, size, last = Emit(schema), [], 0, None

        def flush():
            ids = np.array([r[0] for r in held])
            group = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1])))
            found, shift = repeated_columns(group, np.array([r[4] for r in held]), [r[6] for r in held], lengths)
            for i, (r, s) in enumerate(zip(held, shift.tolist(), strict=True)):
                for length, flags in zip(lengths, found, strict=True):
                    for a, b in _runs(flags[s:s + r[5], i]):
                        out.add(r[1], r[2], length, r[3] + a, r[3] + b)

        for r in rows(batches):
            if r[0] != last and size >= BATCH:
                flush()
                yield from out.take()
                held, size = [], 0
            held.append(r)
            size, last = size + len(r[6]), r[0]
        if held:
            flush()
            yield from out.take()
    return run


def _hashed_windows(length: int):
    """(group, two hashes, key, piece, place) of each window of crowded groups' pieces."""
    schema = pa.schema([("grp", pa.int64()), ("whole", pa.int64()), ("half", pa.int64()), ("key", pa.int64()),
                        ("piece", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in text_slices(b.column("data")):
                sums = prefix_sums(buf)
                n = np.clip(np.diff(off) - length + 1, 0, np.asarray(b.column("windows"))[i:j])
                row = np.repeat(np.arange(j - i), n)
                at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                s = off[row] + at
                grp, key, piece, base = (np.asarray(b.column(c))[i:j][row] for c in ("grp", "key", "piece", "base"))
                yield batch(schema, [grp, span_hash(sums, s, s + length).astype(np.int64),
                                     span_hash(sums, s, s + (length + 1) // 2).astype(np.int64), key, piece, (base + at).astype(np.int32)])
    return run


def _window_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the places of a piece's windows."""
    out = Emit(pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
    for key, piece, places in rows(batches):
        flags = np.zeros(max(places) + 1, bool)
        flags[places] = True
        for a, b in _runs(flags):
            if out.add(key, piece, a, b):
                yield from out.take()
    yield from out.take()


def sorted_groups(distinct: DataFrame, length: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """Groups of pieces to sort by columns, none of over ``HOT`` pieces, and the pieces of crowded groups.

    A group of more is split by a second anchor.  Pieces of a passage that very many texts share
    may agree in that one too: what is then still over ``HOT`` is crowded.
    """
    parts = shuffle_partitions(distinct.sparkSession)
    over = lambda df, by: materialize(df.groupBy(by).agg(F.count("*").alias("pieces")).filter(F.col("pieces") > HOT).select(by))
    hot = over(distinct, "key")
    plain = distinct.join(hot, "key", "left_anti").select(
        F.col("key").alias("grp"), "key", "piece", F.lit(0).alias("base"), "lead", "windows", "data")
    split = materialize(distinct.join(hot, "key").select("key", "piece", "windows", "data").repartition(parts).transform(
        map_arrow, _resplit(length, reach), "grp long, key long, piece long, base int, lead int, windows int, data binary"))
    crowded = over(split, "grp")
    return plain.unionByName(split.join(crowded, "grp", "left_anti")), split.join(crowded, "grp", "left_semi")


def crowded_windows(pieces: DataFrame, length: int) -> DataFrame:
    """(key, piece, length, first, last): the repeated windows of crowded groups, found by counting windows by two 64-bit
    hashes with map-side sums, so no task holds a group."""
    windows = pieces.transform(map_arrow, _hashed_windows(length), "grp long, whole long, half long, key long, piece long, at int")
    many = windows.groupBy("grp", "whole", "half").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    many = materialize(many)        # so the join is free to split a frequent window
    return windows.join(many, ["grp", "whole", "half"], "left_semi").groupBy("key", "piece").agg(
        F.collect_set("at").alias("places")).transform(map_arrow, _window_runs, "key long, piece long, first long, last long").select(
        "key", "piece", F.lit(length).alias("length"), "first", "last")


def _cover(lengths: list[int]):
    """What is left of each text for the longest length, how many bytes in how many runs went, and the text left for the shortest."""
    schema = pa.schema([("tk", pa.binary()), ("kept", pa.binary()), ("text", pa.string()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("shortest", pa.string())])

    def uncovered(data: np.ndarray, spans: list[dict], length: int) -> np.ndarray:
        gone = np.zeros(len(data) + 1, np.int32)
        edge = np.array([(s["first"], s["last"]) for s in spans if s["length"] == length], np.int64).reshape(-1, 2)
        np.add.at(gone, edge[:, 0], 1)
        np.add.at(gone, edge[:, 1] + length - 1, -1)
        return np.cumsum(gone[:-1]) == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emit(schema, 256)
        for tk, text, spans in rows(batches):
            data = np.frombuffer(text.encode(), np.uint8)
            keep = uncovered(data, spans, lengths[-1])
            rest = None if keep.all() else data[keep].tobytes()
            short = data[uncovered(data, spans, lengths[0])].tobytes().decode("utf-8", "ignore") if len(lengths) > 1 else None
            if out.add(tk, rest, None if rest is None else rest.decode("utf-8", "ignore"), int((~keep).sum()), len(_runs(~keep)), short):
                yield from out.take()
        yield from out.take()
    return run


def repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tk, kept, text, n_removed, n_spans) of each distinct text that loses bytes; every other text stays whole.

    ``docs`` has doc_id and text.  ``tk`` is ``text_key``; ``kept`` the remaining bytes end to
    end (a cut may fall inside a character), ``text`` the same without split characters, ``n_spans`` the maximal removed runs.  Rows with
    equal texts are repeats of each other.  Null and empty texts and those shorter than
    ``length`` bytes never lose anything.  Empty input: no rows.
    """
    return passages_of_lengths(docs, [length]).drop("shortest")


def passages_of_lengths(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``repeated_passages`` for the longest of the ascending ``lengths`` and, as ``shortest``, the text left for the
    first of them.  A text that loses bytes for the first only has null in kept and text, and zeros."""
    spark = docs.sparkSession
    parts, length, reach = shuffle_partitions(spark), lengths[0], lengths[-1]
    whole = docs.select(text_key().alias("tk"), "text").filter(F.octet_length("text") >= length)
    anchors = materialize(whole.transform(map_arrow, _anchors(length), "tk binary, key long"))
    per_text = anchors.groupBy("key", "tk").agg(F.count("*").alias("n"))
    copies = whole.groupBy("tk").agg(F.count("*").alias("copies"))
    # a text's own copies hold its anchors once each: count them once
    per_text = materialize(per_text.join(copies, "tk").select("key", "tk", (F.col("n") / F.col("copies")).alias("n")))
    repeated = per_text.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    repeated = materialize(repeated)    # so the join is free to split a frequent anchor
    wanted = per_text.join(repeated, "key").groupBy("tk").agg(F.collect_list("key").alias("keys"))
    texts = materialize(whole.join(wanted, "tk").dropDuplicates(["tk"]).select("tk", "text", "keys"))
    discard(anchors, per_text, repeated)
    found = materialize(texts.repartition(parts, "tk").transform(
        map_arrow, _pieces(length, reach), "tk binary, start long, key long, piece long, lead int, windows int, data binary"))
    distinct = materialize(found.groupBy("key", "piece").agg(
        F.count("*").alias("n"), F.first("lead").alias("lead"), F.first("windows").alias("windows"),
        F.first("data", ignorenulls=True).alias("data")))
    pieces = materialize(found.select("tk", "start", "key", "piece"))
    discard(found)      # the bytes are in ``distinct`` once
    calm, crowded = sorted_groups(distinct, length, reach)
    inside = (calm.repartition(parts, "grp").sortWithinPartitions("grp", "key", "piece", "base")
              .transform(map_arrow, _sort_columns(lengths), "key long, piece long, length int, first long, last long"))
    for size in lengths:
        # a piece that occurs twice is repeated whole
        twice = distinct.filter("n > 1").select(
            "key", "piece", F.lit(size).alias("length"), F.lit(0).cast("long").alias("first"),
            F.least("windows", F.octet_length("data") - size + 1).cast("long").alias("last")).filter("last > 0")
        inside = inside.unionByName(crowded_windows(crowded, size)).unionByName(twice)
    inside = materialize(inside)
    discard(distinct)
    spans = pieces.select("tk", "start", "key", "piece").join(inside, ["key", "piece"]).select(
        "tk", "length", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last"))
    spans = spans.groupBy("tk").agg(F.collect_list(F.struct("length", "first", "last")).alias("spans"))
    lost = texts.select("tk", "text").join(spans, "tk").join(
        copies.filter("copies > 1").select("tk"), "tk", "left_anti")
    partly = lost.select("tk", "text", "spans").transform(
        map_arrow, _cover(lengths), "tk binary, kept binary, text string, n_removed long, n_spans long, shortest string")
    long = F.col("size") >= reach
    all_gone = whole.select("tk", F.octet_length("text").cast("long").alias("size")).groupBy("tk").agg(
        F.max("size").alias("size"), F.count("*").alias("copies")).filter("copies > 1").select(
        "tk", F.when(long, F.lit(b"")).alias("kept"), F.when(long, F.lit("")).alias("text"),
        F.when(long, F.col("size")).otherwise(F.lit(0).cast("long")).alias("n_removed"), long.cast("long").alias("n_spans"),
        F.lit("" if len(lengths) > 1 else None).cast("string").alias("shortest"))
    return partly.unionByName(all_gone)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns; behind them the text they leave and, as text, what is left once passages that repeat
    for ``PASSAGE`` bytes go too (both without characters that a cut splits)."""
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    lost = passages_of_lengths(docs, [PASSAGE, LENGTH]).select(
        "tk", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"), F.col("text").alias("rest"), "shortest")
    text = F.coalesce("text", F.lit("")).cast("binary")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tk"), F.col("text").alias("all"),
                      F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    return own.join(lost, "tk", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
        F.coalesce("rest", "all", F.lit("")).alias("kept_text"), F.coalesce("shortest", "all", F.lit("")).alias("text"))


def brute_force(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """The definition, for tests: (bytes, removed, runs, digest of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for s in range(len(d) - length + 1):
            seen[d[s:s + length]] = seen.get(d[s:s + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), len(_runs(gone)), hashlib.sha256(kept).hexdigest()))
    return out
