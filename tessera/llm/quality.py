"""Quality rules: how much of a text lies inside repeated n-grams and lines.

For each of several n-gram lengths, the hashes of all word runs of a document are
compared with array operations, and the characters of words inside any run that
occurs twice are measured as a share of all word characters; so are the
characters of repeated lines.  Every document is judged alone, so one pass over the
texts with no shuffle is all it takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    batch, ngram_hash, prefix_sums, read, span_hash, text_slices, word_spans, map_arrow)

MIN_WORDS = 50
REPEAT_WINDOW, REPEAT_PERCENT = 3, 50
#: n-gram length -> largest share of word characters inside n-grams that occur twice: the shares
#: published for web-text filters.  In texts of under 300 words the two places of a single run of
#: ``RUN`` words (a sentence) may hold more than that, 2 RUN / words; there that is the limit.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
RUN = 15
LINE_COVERAGE = 0.20        # of word characters in lines that occur earlier in the text
SYMBOLS_PER_WORD = 0.10
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
NEWLINE = np.isin(np.arange(256), [10])
LEADS = (np.arange(256) & 0xC0) != 0x80                 # first bytes of code points


def _twice(h: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = np.concatenate(([False], s[1:] == s[:-1]))
    out = np.zeros(len(h), bool)
    out[order] = same | np.concatenate((same[1:], [False]))
    return out


def _earlier(h: np.ndarray) -> np.ndarray:
    """Which values occur before in the array."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    out = np.zeros(len(h), bool)
    out[order] = np.concatenate(([False], s[1:] == s[:-1]))
    return out


def _covered(repeated: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside any marked run of n words."""
    edge = np.zeros(words + 1, np.int32)
    edge[:len(repeated)] += repeated
    edge[n:n + len(repeated)] -= repeated
    return np.cumsum(edge[:-1]) > 0


def measure(buf: np.ndarray, off: np.ndarray) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup line share, shares by n) of each text."""
    sums = prefix_sums(buf)
    starts, ends, at = word_spans(buf, off)
    points = np.concatenate(([0], np.cumsum(LEADS[buf])))
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[buf])))
    chars = points[ends] - points[starts]
    words = span_hash(sums, starts, ends)
    line_start, line_end, line_at = word_spans(buf, off, NEWLINE)
    line_hash = span_hash(sums, line_start, line_end)
    first_word = np.searchsorted(starts, line_start)
    last_word = np.searchsorted(starts, line_end)
    line_chars = np.concatenate(([0], np.cumsum(chars)))
    out = []
    for d in range(len(off) - 1):
        i, j = int(at[d]), int(at[d + 1])
        n, own, size = j - i, words[i:j], chars[i:j]
        total = int(size.sum())
        a, b = int(line_at[d]), int(line_at[d + 1])
        full = np.flatnonzero(last_word[a:b] > first_word[a:b]) + a
        dup = full[_earlier(line_hash[full])]
        dup_chars = int((line_chars[last_word[dup]] - line_chars[first_word[dup]]).sum())
        again = _twice(ngram_hash(own, REPEAT_WINDOW))
        n_repeat = int(_covered(again, REPEAT_WINDOW, n).sum()) if again.any() else 0
        shares = []
        for k in COVERAGE:
            # no longer run repeats where no shorter one does
            again = _twice(ngram_hash(own, k)) if n_repeat and n > k else np.zeros(0, bool)
            shares.append(float(size[_covered(again, k, n)].sum()) / total if again.any() else 0.0)
        out.append((n, total, int(symbols[off[d + 1]] - symbols[off[d]]), len(dup), n_repeat,
                    dup_chars / total if total else 0.0, *shares))
    return out


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of each row's whole ``text`` (doc_id, text; more columns are ignored).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, reason,
    dup_line_share, dup_5_share ... dup_10_share.  base_failed: fewer than 50 words, or over half of
    them in 3-word windows that occur twice.  The method's verdict fails a text whose repeated
    n-grams or lines cover more than ``COVERAGE`` (in short texts more than a run's two places)
    / ``LINE_COVERAGE``, or with over one symbol for ten words.  ``reason`` names the first rule that failed.  Null, empty and blank texts have
    zeros throughout and fail; repeated rows are judged alike; empty input gives no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shares = ["dup_line_share"] + [f"dup_{n}_share" for n in COVERAGE]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), *((n, pa.float64()) for n in shares)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in text_slices(b.column("text")):
                found = measure(buf, off)
                yield batch(schema, [b.column("doc_id")[i:j], *map(list, zip(*found, strict=True))])

    spec = "doc_id long, " + ", ".join([f"{n} long" for n in names] + [f"{n} double" for n in shares])
    m = docs.select(F.col("doc_id").cast("long"), "text").transform(map_arrow, run, spec)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    reason = F.when(F.col("n_words") < MIN_WORDS, "words").when(base, "repeated windows")
    for n, most in COVERAGE.items():
        room = F.greatest(F.lit(most), F.lit(2.0 * RUN) / F.col("n_words"))
        reason = reason.when(F.col(f"dup_{n}_share") > room, f"repeated {n}-grams")
    reason = (reason.when(F.col("dup_line_share") > LINE_COVERAGE, "repeated lines")
              .when(F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words"), "symbols"))
    return m.withColumn("base_failed", base).withColumn("reason", reason).select(
        "doc_id", *names, "base_failed", F.col("reason").isNull().alias("kept"), "reason", *shares)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents", ["doc_id", "text"]))
