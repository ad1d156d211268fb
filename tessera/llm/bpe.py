"""Byte-level BPE encoding and decoding by speculation and verification.

A word is first cut by greedy longest match.  The cut is what the merges would
give exactly if every token is reproduced by its own merges and no merge can
reach across any two neighbours; both are tested for all tokens of a batch at
once with array operations.  Only the words that fail are merged rank by rank.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import KEPT, batch, map_arrow, read, slices, text_buffer

#: White space as the tokenizers' patterns see it (fixed values).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The patterns that split a text into words before any merge (fixed values).
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((WHITE,) * 4)
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^%s\p{L}\p{N}]+" % WHITE
#: Unions of whole words: no word crosses them, so a chunk's ids depend on the chunk alone.
BYTE_CHUNKS = r" ?[^%s]+|[%s]+(?![^%s])|[%s]+" % ((WHITE,) * 4)
LOWER_CHUNKS = r"[^%s]+" % WHITE
SEPARATORS = re.compile("[\x1c-\x1f]")
CACHE = 500_000         # chunks whose ids a task keeps
NEVER = np.int64(2**40)
END, GAP = "\u0100", "\u0101"     # the end of a word, where the vocabulary marks it; between words


def _byte_alphabet() -> dict[str, str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + i): chr(b) for i, b in enumerate(other)}


def _lower(text: str) -> str:
    """Canonical composition, then every character's own lower case."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
    return text.lower()


class Bpe:
    """Encoder and decoder of one vocabulary file (tokenizers' JSON, byte-level BPE).

    Tokens and words are held as strings with one character a byte, and END behind the last
    one where the vocabulary marks ends of words.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, model = _byte_alphabet(), spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.end = END if suffix else ""
        self.prepare = _lower if spec["normalizer"] else None
        self.chunk = re.compile(LOWER_CHUNKS if spec["normalizer"] else BYTE_CHUNKS)
        self.word = regex.compile(LOWER_WORDS if spec["normalizer"] else BYTE_WORDS)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

        def plain(t: str) -> str:
            if suffix and t.endswith(suffix):
                return "".join(byte[c] for c in t[:-len(suffix)]) + END
            return "".join(byte[c] for c in t)

        name = {t: plain(t) for t in model["vocab"] if t not in self.special}
        self.ids = {name[t]: i for t, i in model["vocab"].items() if t not in self.special}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for t, i in self.ids.items():
            self.token[i] = t.replace(END, " ").encode("latin-1")
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.size = np.array([len(t) for t in self.token])
        self.text = [str(i) for i in range(size)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.ids[name[a]] for a, _ in merges])
        right = np.array([self.ids[name[b]] for _, b in merges])
        made = np.array([self.ids[name[a] + name[b]] for a, b in merges])
        rank = np.arange(len(merges))
        self.pair_made = made
        self._table(left << 32 | right, rank)
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.rank = np.full(size, -1)                          # when a token is made; single bytes at -1
        self.left[made[::-1]], self.right[made[::-1]], self.rank[made[::-1]] = left[::-1], right[::-1], rank[::-1]
        self.sound = np.zeros(size, bool)                      # reproduced by its own merges
        self.sound[[i for t, i in self.ids.items() if len(t.rstrip(END)) == 1]] = True
        apart = self._apart(left, right, rank)
        for r in np.flatnonzero(apart):                        # parts are made before the whole
            self.sound[made[r]] |= self.sound[left[r]] and self.sound[right[r]] and self.rank[made[r]] == r
        self.longest_match = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.longest_match.add_word(t, i)
        self.longest_match.make_automaton()
        self.single = np.array([self.ids[chr(b)] for b in range(256)])
        self.last = np.array([self.ids[chr(b) + self.end] for b in range(256)])
        special = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.split_special = re.compile(f"({special})") if special else None
        self._reset()

    def _reset(self) -> None:
        self.known = {t: k for k, t in enumerate(self.special)}
        self.flat = np.fromiter(self.special.values(), np.int32, len(self.special))
        self.at = np.arange(len(self.special) + 1, dtype=np.int64)
        self.again = np.zeros(0, bool)

    def _forget(self) -> None:
        """Keeps the chunks that came again since they were learnt or last kept."""
        old, self.again = self.again, np.append(self.again, np.zeros(len(self.at) - 1 - len(self.again), bool))
        self.again[:len(self.special)] = True
        keep = np.flatnonzero(self.again) if len(old) else np.arange(len(self.special))
        if len(keep) > CACHE // 2:
            return self._reset()
        n, start = np.diff(self.at)[keep], self.at[keep]
        self.flat = self.flat[np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())]
        self.at = np.concatenate(([0], np.cumsum(n)))
        names = list(self.known)
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.again = np.zeros(len(keep), bool)

    def _table(self, keys: np.ndarray, rank: np.ndarray) -> None:
        """Open-addressing table from pairs to ranks; the last slot is never filled."""
        self.mask = (1 << int(4 * len(keys)).bit_length()) - 1
        self.slot_key, self.slot_rank = np.full(self.mask + 1, -1), np.full(self.mask + 1, NEVER)
        todo, step = np.unique(keys, return_index=True)[1], 0
        while len(todo):
            at = self._slot(keys[todo], step)
            free = self.slot_key[at] == -1
            self.slot_key[at[free]] = keys[todo[free]]
            won = self.slot_key[at] == keys[todo]
            self.slot_rank[at[won]] = rank[todo[won]]
            todo, step = todo[~won], step + 1
        self.probes = step

    def _slot(self, key: np.ndarray, step: int) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        return (mixed.astype(np.int64) + step) & self.mask

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or NEVER."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key, 0)
        hit = self.slot_key[at]
        out = np.where(hit == key, self.slot_rank[at], NEVER)
        open_ = np.flatnonzero((hit != key) & (hit != -1))
        for step in range(1, self.probes):
            if not len(open_):
                break
            at = self._slot(key[open_], step)
            hit = self.slot_key[at]
            same = hit == key[open_]
            out[open_[same]] = self.slot_rank[at[same]]
            open_ = open_[~same & (hit != -1)]
        return out

    def _apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (before rank ``until``) joins the end of a to the start of b.

        Undoes the two tokens' own merges from the last to the first.  Each state is the pair
        of parts that touch at the border; a merge of the two happens if its rank comes before
        the left part is used up, and not after the right one is (equal ranks merge leftmost first).
        """
        ok = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        x_end = np.full(len(a), NEVER) if until is None else until.astype(np.int64)
        y_end = x_end.copy()
        live = np.arange(len(a))
        while len(live):
            u, v = x[live], y[live]
            r = self._lookup(u, v)
            clash = (r < x_end[live]) & (r <= y_end[live])
            ok[live[clash]] = False
            ru, rv = self.rank[u], self.rank[v]
            go = ~clash & (np.maximum(ru, rv) >= 0)
            undo_x = go & (ru > rv)
            undo_y = go & ~undo_x
            i, j = live[undo_x], live[undo_y]
            x_end[i], x[i] = ru[undo_x], self.right[u[undo_x]]
            y_end[j], y[j] = rv[undo_y], self.left[v[undo_y]]
            live = live[go]
        return ok

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: each round joins every word's lowest-ranked pair."""
        raw = [w.rstrip(END) if self.end else w for w in words]
        data = np.frombuffer("".join(raw).encode("latin-1"), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ids = self.single[data]
        ids[np.cumsum(size) - 1] = self.last[data[np.cumsum(size) - 1]]
        owner = np.repeat(np.arange(len(words)), size)
        while True:
            rank = np.where(owner[:-1] == owner[1:], self._lookup(ids[:-1], ids[1:]), NEVER)
            best = np.full(len(words), NEVER)
            np.minimum.at(best, owner[:-1], rank)
            join = (rank < NEVER) & (rank == best[owner[:-1]])
            if not join.any():
                return ids, np.bincount(owner, minlength=len(words))
            start = join & ~np.concatenate(([False], join[:-1]))   # in a run of overlapping pairs, every second
            place = np.arange(len(join))
            join &= (place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0
            first = np.flatnonzero(join)
            ids[first] = self.pair_made[rank[first]]
            keep = np.ones(len(ids), bool)
            keep[first + 1] = False
            ids, owner = ids[keep], owner[keep]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words end to end, and how many each has: proposed by greedy longest
        match, verified all together, and merged exactly where they fail."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size + 1) - size - 1
        found = itertools.chain.from_iterable(self.longest_match.iter_long(GAP.join(words)))
        ends, flat = np.fromiter(found, np.int64).reshape(-1, 2).T
        owner = np.searchsorted(start, ends, "right") - 1
        n = np.bincount(owner, minlength=len(words))
        bad = np.bincount(owner, weights=self.size[flat], minlength=len(words)) != size   # an end of word left over
        bad[owner[~self.sound[flat]]] = True
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        bad[owner[inner[~self._apart(flat[inner], flat[inner + 1])]]] = True
        failed = np.flatnonzero(bad)
        if not len(failed):
            return flat, n
        merged, m = self._merge([words[i] for i in failed.tolist()])
        stay = ~bad[owner]
        each = np.concatenate([owner[stay], np.repeat(failed, m)])
        return np.concatenate([flat[stay], merged])[np.argsort(each, kind="stable")], np.bincount(each, minlength=len(words))

    def _learn(self, chunks: list[str]) -> None:
        words = self.word.findall
        if self.prepare:        # all at once: a newline is in no chunk and joins with no character
            cut = [[c] if c.isalpha() else words(c) for c in self.prepare("\n".join(chunks)).split("\n")]
        else:                   # letters alone, with a blank before them or not, are one word
            cut = [[c] if c.removeprefix(" ").isalpha() else words(c) for c in chunks]
        each = list(itertools.chain.from_iterable(cut))
        number = dict(zip(dict.fromkeys(each), itertools.count()))
        which = np.fromiter(map(number.__getitem__, each), np.int64, len(each))
        per_chunk = np.zeros(len(chunks), np.int64)
        if number:
            flat, n = self.words([(w if w.isascii() else w.encode().decode("latin-1")) + self.end for w in number])
            at = np.cumsum(n) - n
            per_word, of = n[which], np.repeat(np.arange(len(cut)), [len(c) for c in cut])
            per_chunk = np.bincount(of, weights=per_word, minlength=len(cut)).astype(np.int64)
            flat = flat[np.repeat(at[which] - np.cumsum(per_word) + per_word, per_word) + np.arange(per_word.sum())]
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        base = len(self.at) - 1
        self.known.update(zip(chunks, range(base, base + len(chunks)), strict=True))
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(per_chunk)])

    def _chunks(self, text: str) -> list[str]:
        # str.split() splits at WHITE and the four separators of SEPARATORS
        cut = str.split if self.prepare and not SEPARATORS.search(text) else self.chunk.findall
        if self.split_special is None or "<" not in text:
            return cut(text)
        out = []
        for k, part in enumerate(self.split_special.split(text)):
            out += [part] if k % 2 else cut(part)
        return out

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if len(self.known) > CACHE:
            self._forget()
        cut = [self._chunks(t) for t in texts]
        first_new = len(self.known)
        every = list(itertools.chain.from_iterable(cut))
        new = list(set(every).difference(self.known))
        if new:
            self._learn(new)
        size = np.diff(self.at)
        self.again = np.append(self.again, np.zeros(len(size) - len(self.again), bool))
        k = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        self.again[k[k < first_new]] = True
        n = size[k]
        flat = self.flat[np.repeat(self.at[k] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        done = np.concatenate(([0], np.cumsum(n)))
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        return flat, np.diff(done[np.concatenate(([0], ends))])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        flat, n = self.encode_flat(texts)
        return np.split(flat, np.cumsum(n)[:-1]) if len(n) else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 read as U+FFFD."""
        return b"".join(map(self.token.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


KEPT.append(load.cache_clear)


def text_slices_decoded(col) -> Iterator[tuple[int, int, list[str]]]:
    buf, off = text_buffer(col)
    raw = buf.tobytes()
    for i, j in slices(off):
        yield i, j, [raw[off[k]:off[k + 1]].decode() for k in range(i, j)]


def encode(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of each row's whole ``text``; null and empty texts have no ids.  Rows that
    repeat come out as often as they come in; other columns are ignored."""
    kind = docs.schema[key].dataType
    schema = pa.schema([("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for i, j, texts in text_slices_decoded(b.column(1)):
                ids = pa.array([x for x in bpe.encode(texts)], schema.field("ids").type)
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], ids], names=[key, "ids"])
    run.keeps = True
    return docs.select(key, "text").transform(map_arrow, run, f"`{key}` {kind.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) of each row's ``ids``; null reads as no ids."""
    kind = encoded.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])
    run.keeps = True
    return encoded.select(key, "ids").transform(map_arrow, run, f"`{key}` {kind.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encode and decode in one pass,
    so ids need not leave the task.  Null and empty texts: 0 tokens and digests of nothing."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for i, j, texts in text_slices_decoded(b.column("text")):
                ids = bpe.encode(texts)
                yield batch(schema, [
                    b.column("doc_id")[i:j], [len(x) for x in ids],
                    [digest(",".join(map(bpe.text.__getitem__, x.tolist())).encode()) for x in ids],
                    [digest(bpe.decode(x).encode()) for x in ids]])
    run.keeps = True
    return docs.select(F.col("doc_id").cast("long"), "text").transform(map_arrow, 
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers
    return round_trip(read(spark, sf_dir, "documents", ["doc_id", "text"]),
                      path or public_tokenizers.path("byte_bpe_50k.json"))
