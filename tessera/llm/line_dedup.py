"""Line dedup with a fixed-depth log-template tree.

A line's tokens (digits make a token variable) lead to a leaf by their count and the
first ``DEPTH`` of them.  In a leaf, a token that fewer than ``MIN_DOCS`` lines of documents
hold at its place is a variable field; what stays constant is the line's template, as long
as most tokens and one behind the first ``DEPTH`` do.  A template that recurs in at least
``MIN_DOCS`` documents is dropped from all of them but the first.  A line with too few
constant tokens of its own (a row of numbers, or any line of up to ``DEPTH`` tokens, as
all lines of scripts without spaces) has no template: it is dropped only where the very
same tokens recur, digits and all.

Leaves are found by hashes alone; tokens are only sent for distinct lines of leaves
that enough documents share.  Fields are told by counts per (leaf, place, token), so a
template depends neither on the order of lines nor on how many a leaf has, and no task
holds a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    GOLD, SPACE, _powers, batch, doc_key, mix, prefix_sums, read, shuffle_partitions, span_hash, text_buffer, text_slices,
    word_spans, map_arrow)
from tessera.session import discard, materialize

DEPTH = 3               # leading tokens that lead to a leaf
MIN_DOCS = 10           # documents a template recurs in, and lines that hold a constant token
ANY = np.uint64(0x2A2A2A2A2A2A2A2A)     # a variable token
NO_LEAF = 0             # the leaf of lines that are compared whole
NEWLINE = np.isin(np.arange(256), [10])
DIGIT = np.isin(np.arange(256), list(b"0123456789"))


def parse_lines(buf: np.ndarray, off: np.ndarray):
    """Non-empty lines of texts laid end to end: document, byte span, token hashes, leaf, line and whole keys.

    The line key leaves variable tokens out, the whole key does not; they are the same where
    the leaf is ``NO_LEAF``, as such lines have too few constant tokens for a template.
    """
    sums = prefix_sums(buf)
    a, b, _ = word_spans(buf, off, NEWLINE)
    starts, ends, _ = word_spans(buf, off, SPACE)
    tokens = span_hash(sums, starts, ends)
    digits = np.concatenate(([0], np.cumsum(DIGIT[buf])))
    variable = digits[ends] > digits[starts]
    first, last = np.searchsorted(starts, a), np.searchsorted(starts, b)
    n = last - first
    power, inverse = _powers(len(tokens) + 1)

    def totals():
        total = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * power[:len(tokens)], out=total[1:])
        return total

    def key(total):
        return mix((total[last] - total[first]) * inverse[first] + n.astype(np.uint64) * GOLD).astype(np.int64)

    whole = key(totals())
    tokens[variable] = ANY
    total = totals()
    head = np.minimum(last, first + DEPTH)
    leaf = mix((total[head] - total[first]) * inverse[first] ^ mix(n.astype(np.uint64) * GOLD)).astype(np.int64)
    constant = np.concatenate(([0], np.cumsum(~variable)))
    told = (constant[last] > constant[head]) & (2 * (constant[last] - constant[first]) > n)
    doc = np.searchsorted(off, a, "right") - 1
    return (doc, a, b, first, last, tokens, np.where(told, np.where(leaf == NO_LEAF, 1, leaf), NO_LEAF),
            np.where(told, key(total), whole), whole)


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each document once; ``whole`` is null where it is the line key."""
    schema = pa.schema([("dk", pa.binary()), ("doc_id", pa.int64()), ("leaf", pa.int64()), ("line", pa.int64()), ("whole", pa.int64())])
    for b in batches:
        for i, j, buf, off in text_slices(b.column("text")):
            doc, _, _, first, last, _, leaf, line, whole = parse_lines(buf, off)
            use = np.flatnonzero(last > first)
            each = np.unique(np.stack([doc[use], whole[use]]), axis=1, return_index=True)[1]
            use = use[each]
            if len(use):
                at = pa.array(doc[use])
                yield batch(schema, [b.column("dk")[i:j].take(at), b.column("doc_id")[i:j].take(at), leaf[use], line[use],
                                     pa.array(whole[use], mask=whole[use] == line[use])])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token hashes of the wanted lines, once a slice."""
    schema = pa.schema([("leaf", pa.int64()), ("line", pa.int64()), ("tokens", pa.binary())])
    for b in batches:
        want, at = np.asarray(b.column("lines").values), np.asarray(b.column("lines").offsets)
        for i, j, buf, off in text_slices(b.column("text")):
            _, _, _, first, last, tokens, leaf, line, _ = parse_lines(buf, off)
            line_, use = np.unique(line, return_index=True)
            use = use[np.isin(line_, want[at[i]:at[j]]) & (leaf[use] != NO_LEAF)]
            if len(use):
                yield batch(schema, [leaf[use], line[use], [tokens[first[k]:last[k]].tobytes() for k in use.tolist()]])


def _cells(min_docs: int):
    """(cell, line, place, n) of the constant tokens behind the leading ones: a cell is a token at its place in a leaf.

    Cells that a batch alone finds ``min_docs`` times are counted in one row without a line.
    """
    schema = pa.schema([("cell", pa.int64()), ("line", pa.int64()), ("place", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, off = text_buffer(b.column("tokens"))
            size = np.diff(off) // 8
            row = np.repeat(np.arange(b.num_rows), size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            token = np.frombuffer(tokens.tobytes(), np.uint64)
            use = np.flatnonzero((place >= DEPTH) & (token != ANY))
            row, place = row[use], place[use]
            leaf, line, n = (np.asarray(b.column(c)) for c in ("leaf", "line", "n"))
            cell = mix(leaf[row].astype(np.uint64) ^ mix(token[use] + place.astype(np.uint64) * GOLD)).astype(np.int64)
            known, of = np.unique(cell, return_inverse=True)
            total = np.zeros(len(known), np.int64)
            np.add.at(total, of, n[row])
            often = np.flatnonzero(total >= min_docs)
            if len(often):
                none = pa.nulls(len(often))
                yield batch(schema, [known[often], none.cast(pa.int64()), none.cast(pa.int32()), total[often]])
            rare = np.flatnonzero(total[of] < min_docs)
            if len(rare):
                yield batch(schema, [cell[rare], line[row[rare]], place[rare].astype(np.int32), n[row[rare]]])
    return run


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, line, template): the hash of the tokens without variable fields, or the line where too few would stay."""
    schema = pa.schema([("leaf", pa.int64()), ("line", pa.int64()), ("template", pa.int64())])
    for b in batches:
        names = []
        for line, data, fields in zip(*(b.column(c).to_pylist() for c in ("line", "tokens", "fields")), strict=True):
            t = np.frombuffer(data, np.uint64).copy()
            t[fields or []] = ANY
            constant = t != ANY
            told = constant[DEPTH:].any() and 2 * int(constant.sum()) > len(t)
            names.append(int(tokens_key(t)) if fields and told else line)
        yield batch(schema, [b.column("leaf"), b.column("line"), names])


def tokens_key(tokens: np.ndarray) -> np.int64:
    """The line key of ``parse_lines`` for one line's token hashes."""
    power, _ = _powers(len(tokens) + 1)
    total = np.array([(tokens * power[:len(tokens)]).sum(dtype=np.uint64)], np.uint64)
    return mix(total + np.array([len(tokens)], np.uint64) * GOLD).astype(np.int64)[0]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kept, lines, dropped = [], [], []
        gone = b.column("gone")
        want, at = np.asarray(gone.values), np.asarray(gone.offsets)
        for i, j, buf, off in text_slices(b.column("text")):
            doc, a, e, first, last, _, _, _, whole = parse_lines(buf, off)
            raw = buf.tobytes()
            edge = np.searchsorted(doc, np.arange(j - i + 1))
            for d in range(j - i):
                text = raw[off[d]:off[d + 1]]
                lines.append(text.count(b"\n") + 1 if text else 0)
                lo, hi = edge[d], edge[d + 1]
                drop = np.isin(whole[lo:hi], want[at[i + d]:at[i + d + 1]]) & (last[lo:hi] > first[lo:hi])
                dropped.append(int(drop.sum()))
                if dropped[-1]:
                    cut = {int(x) for x in a[lo:hi][drop] - off[d]}
                    rest, pos = [], 0
                    for part in text.split(b"\n"):
                        if pos not in cut or not part:
                            rest.append(part)
                        pos += len(part) + 1
                    text = b"\n".join(rest)
                kept.append(text.decode() if b.column("text")[i + d].is_valid else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            names=["row", "kept", "n_lines", "n_dropped"])


def templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(dk, doc_id, leaf, line, whole) of every document's lines, and (leaf, line, template) of recurring templates' lines.

    A line of ``NO_LEAF`` is its own template.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    lines = materialize(docs.select("dk", "doc_id", "text").transform(map_arrow, _leaves,
                        "dk binary, doc_id long, leaf long, line long, whole long").dropDuplicates(["dk", "line", "whole"]))
    told = lines.filter(F.col("leaf") != NO_LEAF)
    shared = told.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("leaf")
    shared = materialize(shared)    # so the join is free to split a crowded leaf
    wanted = told.join(shared, "leaf")
    one = materialize(wanted.groupBy("leaf", "line").agg(F.min("dk").alias("dk"), F.count("*").alias("n")))  # a document to read each from
    sources = one.groupBy("dk").agg(F.collect_list("line").alias("lines"))
    # ``sources`` and ``gone`` below grow with the lines: merged at every size, never broadcast
    tokens = (docs.select("dk", "text").join(sources.hint("merge"), "dk").dropDuplicates(["dk"]).select("text", "lines")
              .transform(map_arrow, _tokens, "leaf long, line long, tokens binary").dropDuplicates(["leaf", "line"]))
    # lines of a leaf side by side, so most constant tokens are seen within a batch
    tokens = materialize(tokens.join(one.drop("dk"), ["leaf", "line"]).repartitionByRange(parts, "leaf", "line"))
    cells = materialize(tokens.transform(map_arrow, _cells(min_docs), "cell long, line long, place int, n long"))
    variable = materialize(cells.groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") < min_docs).select("cell"))
    fields = cells.filter("line is not null").join(variable, "cell", "left_semi").groupBy("line").agg(F.collect_set("place").alias("fields"))
    of = materialize(tokens.join(fields, "line", "left").select("leaf", "line", "tokens", "fields").transform(
        map_arrow, _named, "leaf long, line long, template long"))
    discard(one, tokens, cells, variable)
    held = told.join(of, ["leaf", "line"]).select("template", "dk", "doc_id", "leaf").distinct()
    docs_of = [F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "dk")).alias("first")]
    recurring = held.groupBy("leaf", "template").agg(*docs_of).filter(F.col("n_docs") >= min_docs)
    same = lines.filter(F.col("leaf") == NO_LEAF).groupBy("leaf", "line").agg(*docs_of).filter(F.col("n_docs") >= min_docs)
    names = ["leaf", "line", "template", "n_docs", F.col("first.dk").alias("first_dk")]
    return lines, materialize(of.join(recurring, ["leaf", "template"]).select(*names).unionByName(
        same.withColumn("template", F.col("line")).select(*names)))     # small; so the join with it is free to split


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``kept`` (its text without dropped lines), n_lines, n_dropped.

    Needs doc_id and text.  Lines are split at \\n; blank lines always stay.  Short lines, rows of
    numbers and other lines with too few constant tokens go only if the same tokens recur in as
    many documents.  A template's first document, the one of smallest doc_id
    (null before all), keeps its lines.  Rows equal in doc_id and text are one document.  Null
    texts stay null with 0 lines; empty input gives no rows.
    """
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = keyed.withColumn("dk", doc_key())
    lines, recurring = templates(keyed, min_docs)
    gone = lines.join(recurring, ["leaf", "line"]).filter(F.col("dk") != F.col("first_dk")).groupBy("dk").agg(
        F.collect_set(F.coalesce("whole", "line")).alias("gone"))
    kind = docs.select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    out = keyed.join(gone.hint("merge"), "dk", "left").select("row", "text", F.coalesce("gone", F.array().cast("array<bigint>")).alias("gone"))
    return out.transform(map_arrow, _without, f"row {kind}, kept string, n_lines long, n_dropped long")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_recurring_lines(read(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped",
                      F.octet_length("kept").cast("long").alias("kept_bytes"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows_: list[tuple[int, str]], min_docs: int) -> dict[int, tuple[int, int, str]]:
    """The same by plain Python, for tests with distinct doc ids: doc_id -> (lines, dropped, kept text)."""
    mask = lambda t: tuple("<*>" if any(c in b"0123456789" for c in w) else w for w in t)
    told = lambda t: any(x != "<*>" for x in t[DEPTH:]) and 2 * sum(x != "<*>" for x in t) > len(t)
    leaves: dict[tuple, dict[tuple, dict[tuple, set]]] = {}
    whole: dict[tuple, set] = {}
    for doc, text in rows_:
        for part in (text or "").split("\n"):
            t = tuple(part.encode().split())
            m = mask(t)
            if not t:
                continue
            if told(m):
                leaves.setdefault((len(t), m[:DEPTH]), {}).setdefault(m, {}).setdefault(t, set()).add(doc)
            else:
                whole.setdefault(t, set()).add(doc)
    gone: dict[int, set] = {}

    def drop(members: dict[tuple, set]) -> None:
        docs = set().union(*members.values())
        if len(docs) >= min_docs:
            for t, own in members.items():
                for d in own - {min(docs)}:
                    gone.setdefault(d, set()).add(t)

    for own in leaves.values():
        lines: dict[tuple, int] = {}       # (place, token) -> lines of documents that hold it
        for m, members in own.items():
            for cell in enumerate(m):
                lines[cell] = lines.get(cell, 0) + sum(map(len, members.values()))
        same: dict[tuple, dict[tuple, set]] = {}
        for m, members in own.items():
            cut = tuple(w if i < DEPTH or lines[i, w] >= min_docs else "<*>" for i, w in enumerate(m))
            for t, docs in members.items():
                same.setdefault(cut if told(cut) else m, {}).setdefault(t, set()).update(docs)
        for members in same.values():
            drop(members)
    for t, docs in whole.items():
        drop({t: docs})
    out = {}
    for doc, text in rows_:
        parts = (text or "").split("\n")
        rest = [p for p in parts if tuple(p.encode().split()) not in gone.get(doc, ())]
        out[doc] = (len(parts) if text else 0, len(parts) - len(rest), "\n".join(rest))
    return out
