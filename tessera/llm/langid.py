"""Language ID by interpolated Kneser-Ney character models.

One model a language, over the characters of letter words with ``ORDER - 1``
boundary marks before and one after each.  Spark counts the ORDER-grams of a
bounded labelled sample; one task a language turns its counts into sorted hash arrays,
which are broadcast.  A language's arrays hold its own grams only, and the languages
share ``TOTAL_CHARS``, so the broadcast is bounded however many there are.  As a word's score depends on the word alone and a position's on one
ORDER-gram, a task scores each distinct word once, from a table of the ORDER-grams it
has met.  The language of lowest cross-entropy per character wins; a text whose
entropy lies far above that of most calibration texts of that language and length is
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices_decoded
from tessera.llm.common import GOLD, batch, mix, read, text_buffer, word_spans, _powers, map_arrow
from tessera.session import materialize

ORDER = 5
MARK = 32                   # word boundary
MAX_CHARS = 6_000_000       # bound on the characters counted per language (whole texts, chosen by hash)
TOTAL_CHARS = 48_000_000    # and of all languages together: more languages get an equal part of it each
ALPHABET = 4096             # size of the uniform model below order 1
CALIBRATE = 10              # one in so many sample texts is kept from the counts to set the rejection limits
HIGH = 0.9                  # quantile of the calibration texts' excess over their language's median entropy
REACH = 8                   # so many times that quantile, of texts as long, is not rejected
LEAST = 0.04                # nats per character the quantile counts as at least
FEW = 20                    # calibration texts below which a length class takes the quantile of others
CLASSES = 32                # length classes: powers of 2 in characters
CACHE = 1_600_000           # scores (words or grams times languages) a task keeps
_letters: list[np.ndarray] = []


def separators() -> np.ndarray:
    """For each code point, whether it is no letter."""
    if not _letters:
        _letters.append(np.fromiter((not chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _gram_hash(grams: np.ndarray) -> np.ndarray:
    """Hash of each row of code points; rows of other lengths never share a seed."""
    h = np.full(len(grams), np.uint64(grams.shape[1] * int(GOLD) % 2**64))
    for k in range(grams.shape[1]):
        h = mix(h ^ (grams[:, k].astype(np.uint64) + np.uint64(1)) * GOLD)
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class Words:
    """Letter words of lower-cased texts, as code points end to end."""

    def __init__(self, texts: list[str]):
        low = [t.lower() for t in texts]
        self.codes = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)
        off = np.cumsum([0] + [len(t) for t in low])
        self.starts, self.ends, self.at = word_spans(self.codes, off, separators())
        power, inverse = _powers(len(self.codes) + 1)
        sums = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(mix((self.codes.astype(np.uint64) + np.uint64(1)) * GOLD) * power[:len(self.codes)], out=sums[1:])
        self.hash = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def grams(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ORDER-grams of the given words, and each word's count of them."""
        size = self.ends[which] - self.starts[which]
        width = size + ORDER
        head = np.cumsum(width) - width
        line = np.full(int(width.sum()), MARK, np.uint32)
        to = np.repeat(head + ORDER - 1 - np.cumsum(size) + size, size) + np.arange(size.sum())
        line[to] = self.codes[np.repeat(self.starts[which] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        n = size + 1
        first = np.repeat(head - np.cumsum(n) + n, n) + np.arange(n.sum())
        return line[first[:, None] + np.arange(ORDER)], n


@dataclass
class Model:
    """By language and order: sorted gram keys with log probabilities, sorted context keys with log weights."""

    langs: list[str]
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = field(default_factory=list)
    middle: np.ndarray | None = None    # calibration: median entropy per character,
    reach: np.ndarray | None = None     # and the excess that is not rejected, by length class

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of each ORDER-gram's last character given the ones before, by language."""
        keys = [(_gram_hash(grams[:, ORDER - n:]), _gram_hash(grams[:, ORDER - n:-1])) for n in range(1, ORDER + 1)]
        out = np.empty((len(grams), len(self.langs)))
        for k, orders in enumerate(self.tables):
            open_, passed = np.arange(len(grams)), np.zeros(len(grams))
            for (gram, context), (known, logs, contexts, weights) in zip(reversed(keys), reversed(orders), strict=True):
                at, hit = _find(known, gram[open_])
                out[open_[hit], k] = passed[open_[hit]] + logs[at[hit]]
                open_ = open_[~hit]
                at, hit = _find(contexts, context[open_])
                passed[open_[hit]] += weights[at[hit]]
            out[open_, k] = passed[open_] - np.log(ALPHABET)
        return out


def _estimate(grams: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Interpolated Kneser-Ney of one language: by order (gram keys, log p, context keys, log weight)."""
    levels = []
    for n in range(ORDER, 0, -1):
        levels.append((grams, counts))
        if n > 1:       # a lower order counts in how many contexts a gram continues
            grams, counts = np.unique(grams[:, 1:], axis=0, return_counts=True)
    below: tuple[np.ndarray, np.ndarray] | None = None
    out = []
    for grams, counts in reversed(levels):
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones else 0.5
        keys, context = _gram_hash(grams), _gram_hash(grams[:, :-1])
        ctx, where = np.unique(context, return_inverse=True)
        total = np.bincount(where, weights=counts)
        weight = discount * np.bincount(where) / total
        lower = np.full(len(grams), 1 / ALPHABET) if below is None else below[1][np.searchsorted(below[0], _gram_hash(grams[:, 1:]))]
        p = np.maximum(counts - discount, 0) / total[where] + weight[where] * lower
        order = np.argsort(keys)
        below = keys[order], p[order]
        out.append((keys[order], np.log(p[order]), ctx, np.log(weight)))
    return out


#: A language's arrays as handed on by its task: one row an order.
TABLES = "lang string, n int, grams binary, logs binary, contexts binary, weights binary"
KINDS = (np.uint64, np.float64, np.uint64, np.float64)


def _fit(counts: pa.Table) -> pa.Table:
    """``TABLES`` of one language's (lang, gram, n); its rows are bounded by the sample's characters."""
    codes = np.frombuffer(text_buffer(counts.column("gram"))[0].tobytes().decode().encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
    order = np.lexsort(codes.T[::-1])
    levels = _estimate(codes[order], counts.column("n").to_numpy()[order])
    lang = counts.column("lang")[0].as_py()
    return pa.table([pa.array([lang] * ORDER, pa.string()), pa.array(range(1, ORDER + 1), pa.int32())]
                    + [pa.array([x.tobytes() for x in column], pa.binary()) for column in zip(*levels, strict=True)],
                    names=["lang", "n", "grams", "logs", "contexts", "weights"])


class Scorer:
    """Scores texts with a model, keeping the words and ORDER-grams it has met."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        width = len(self.model.langs)
        self.words, self.word_logs = np.zeros(0, np.uint64), np.zeros((0, width))
        self.grams, self.gram_logs = np.zeros(0, np.uint64), np.zeros((0, width))

    def _gram_scores(self, grams: np.ndarray) -> np.ndarray:
        keys = _gram_hash(grams)
        _, hit = _find(self.grams, keys)
        if not hit.all():
            miss = np.flatnonzero(~hit)
            new, first = np.unique(keys[miss], return_index=True)
            every = np.concatenate([self.grams, new])
            order = np.argsort(every, kind="stable")
            self.grams = every[order]
            self.gram_logs = np.concatenate([self.gram_logs, self.model.score(grams[miss[first]])])[order]
        return self.gram_logs[np.searchsorted(self.grams, keys)]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by language, and the scored characters of each text."""
        w = Words(texts)
        if self.word_logs.size + self.gram_logs.size > CACHE:
            self._reset()
        each, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        _, hit = _find(self.words, each)
        if not hit.all():
            new = first[~hit]
            grams, n = w.grams(new)
            logs = np.add.reduceat(self._gram_scores(grams), np.cumsum(n) - n, axis=0)
            every = np.concatenate([self.words, each[~hit]])
            order = np.argsort(every, kind="stable")
            self.words, self.word_logs = every[order], np.concatenate([self.word_logs, logs])[order]
        logs = self.word_logs[np.searchsorted(self.words, each)] if len(each) else self.word_logs
        sums = np.concatenate([np.zeros((1, len(self.model.langs))), np.cumsum(logs[inverse], axis=0)])
        chars = np.concatenate(([0], np.cumsum(w.ends - w.starts + 1)))
        n = chars[w.at[1:]] - chars[w.at[:-1]]
        return (sums[w.at[:-1]] - sums[w.at[1:]]) / np.maximum(n, 1)[:, None], n


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])
    for b in batches:
        langs = b.column("lang").to_pylist()
        for i, _, texts in text_slices_decoded(b.column("text")):
            own = langs[i:i + len(texts)]
            for lang in sorted(set(own)):
                w = Words([t for t, x in zip(texts, own, strict=True) if x == lang])
                if not len(w.starts):
                    continue
                grams, _ = w.grams(np.arange(len(w.starts)))
                _, first, n = np.unique(_gram_hash(grams), return_index=True, return_counts=True)
                text = np.ascontiguousarray(grams[first]).tobytes().decode("utf-32-le")
                yield batch(schema, [[lang] * len(n), [text[k:k + ORDER] for k in range(0, len(text), ORDER)], n])


def train(labelled: DataFrame, least_rows: int = 1) -> Model:
    """A model of (text, lang) rows; rows with a null in either, or no letter, teach nothing.

    Every label of at least ``least_rows`` rows is learnt (without that rule all are), from whole
    texts of about ``MAX_CHARS`` characters, less if the labels together would pass ``TOTAL_CHARS``,
    chosen by a hash of the text, so equal inputs give equal models on any partitioning.  The text
    of a label's least hash always teaches.  Without any usable row the model has no languages.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    draw = (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30))
    share = materialize(rows.groupBy("lang").agg(F.sum(F.length("text")).alias("chars"), F.min(draw).alias("first"), F.count("*").alias("rows"))
                        .filter(F.col("rows") >= least_rows))
    most = min(MAX_CHARS, TOTAL_CHARS // max(1, share.count()))
    share = share.select("lang", "first", F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(F.col("chars"), F.lit(1))).alias("share"))
    sample = rows.join(F.broadcast(share), "lang").filter((draw < F.col("share")) | (draw == F.col("first")))    # a row a label
    kept = (F.pmod(F.xxhash64("text", F.lit("calibrate")), F.lit(CALIBRATE)) == 0) & (draw > F.col("first"))
    counts = (sample.filter(~kept).select("lang", "text").transform(map_arrow, _count_grams, "lang string, gram string, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    found: dict[str, list] = {}
    for r in counts.groupBy("lang").applyInArrow(_fit, TABLES).toArrow().to_batches():
        for lang, n, *arrays in zip(*r.columns, strict=True):
            levels = found.setdefault(lang.as_py(), [None] * ORDER)
            levels[n.as_py() - 1] = tuple(np.frombuffer(x.as_buffer(), t) for x, t in zip(arrays, KINDS, strict=True))
    langs = sorted(found)
    if not langs:
        return Model([])
    model = Model(langs, [found[x] for x in langs])
    shared = sample.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("lang", pa.string()), ("entropy", pa.float64()), ("chars", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        place = {x: k for k, x in enumerate(shared.value.langs)}
        for b in batches:
            own = b.column("lang").to_pylist()
            for i, j, texts in text_slices_decoded(b.column("text")):
                e, chars = scorer.entropies(texts)
                rows_ = [(x, e[k, place[x]], chars[k]) for k, x in enumerate(own[i:j]) if x in place and chars[k]]
                if rows_:
                    yield batch(schema, list(map(list, zip(*rows_, strict=True))))

    found = materialize(sample.filter(kept).select("lang", "text").transform(
        map_arrow, measure, "lang string, entropy double, chars long"))
    model.middle, model.reach = _limits(found, langs)
    return model


def _limits(found: DataFrame, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Median entropy of each language's calibration texts, and the excess over it allowed in each length class.

    A class of fewer than ``FEW`` texts takes the quantile of the next shorter class that has
    them, or of the next longer one, grown by the root of the lengths' ratio; a language without
    such a class that of all its texts, or with fewer than ``FEW`` that of all languages' texts.
    A language without calibration texts rejects nothing.
    """
    own = found.groupBy("lang").agg(F.percentile("entropy", F.lit(0.5)).alias("middle"))
    found = found.join(F.broadcast(own), "lang").select(      # a row a label
        "lang", "middle", (F.col("entropy") - F.col("middle")).alias("excess"), F.floor(F.log2("chars")).cast("int").alias("size"))
    high, n = F.percentile("excess", F.lit(HIGH)).alias("high"), F.count("*").alias("n")
    sizes: dict[str, dict[int, float]] = {}
    for r in found.groupBy("lang", "size").agg(high, n).filter(F.col("n") >= FEW).collect():
        sizes.setdefault(r.lang, {})[min(r["size"], CLASSES - 1)] = r.high
    every = found.agg(high).first().high
    middle, reach = np.full(len(langs), np.inf), np.zeros((len(langs), CLASSES))
    for r in found.groupBy("lang").agg(F.first("middle").alias("middle"), high, n, F.percentile("size", F.lit(0.5)).alias("size")).collect():
        known = sizes.get(r.lang) or {min(int(r["size"]), CLASSES - 1): r.high if r.n >= FEW else every}
        k = langs.index(r.lang)
        middle[k] = r.middle
        for c in range(CLASSES):
            shorter = [x for x in known if x <= c]
            high_ = known[max(shorter)] if shorter else known[min(known)] * 2 ** ((min(known) - c) / 2)
            reach[k, c] = REACH * max(LEAST, high_)
    return middle, reach


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, entropy and rejected (columns of these names are replaced).

    lang_pred is ``und`` with score 0 if the text is null or has no letter; else the language of
    least cross-entropy per character (ties: the first by name).  score is that language's share
    of the evidence of up to 100 characters.  rejected: ``und``, or an entropy beyond what
    ``REACH`` times the ``HIGH`` quantile of calibration texts of that length.  Every input row comes out once.
    """
    new = ["lang_pred", "score", "entropy", "rejected"]
    names = [c for c in docs.columns if c not in new]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = Scorer(m) if m.langs else None
        for b in batches:
            for i, j, texts in text_slices_decoded(b.column("text")):
                if scorer is None:
                    found = [["und"] * (j - i), [0.0] * (j - i), [None] * (j - i), [True] * (j - i)]
                else:
                    e, chars = scorer.entropies(texts)
                    best = np.argmin(e, axis=1)
                    least = e[np.arange(len(e)), best]
                    seen = np.minimum(chars, 100)[:, None]
                    score = 1 / np.exp(np.minimum(0, (least[:, None] - e) * seen)).sum(axis=1)
                    size = np.log2(np.maximum(chars, 1)).astype(np.int64)
                    limit = m.middle[best] + m.reach[best, np.minimum(size, CLASSES - 1)]
                    none = chars == 0
                    found = [["und" if x else m.langs[k] for x, k in zip(none, best, strict=True)],
                             np.where(none, 0.0, score), pa.array(least, pa.float64(), mask=none),
                             none | (least > limit)]
                own = [b.column(c)[i:j] for c in names]
                yield pa.RecordBatch.from_arrays(
                    own + [pa.array(x, t) if not isinstance(x, pa.Array) else x for x, t in
                           zip(found, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)], names=names + new)
    return docs.select(*names).transform(map_arrow, run, f"{kinds}, lang_pred string, score double, entropy double, rejected boolean")


def held_out():
    """Documents nothing is learnt from: crc32 of the doc_id's text leaves 2 modulo 4 (or no doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    model = train(docs.filter(~held_out()))
    out = classify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected", "entropy")
