"""A training corpus from raw documents, in five stages.

language ID -> line dedup -> MinHash near-dedup -> suffix-array dedup -> packing

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before kept.
All but the last return the columns of ``docs``; the last returns packed pieces.  No
stage is expressible in SQL; ``tests/llm/test_pipeline.py`` compares ``run`` with plain
Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import doc_key, text_key
from tessera.llm.langid import classify, train
from tessera.llm.line_dedup import drop_recurring_lines
from tessera.llm.near_dup import near_duplicates
from tessera.llm.packing import pack, pieces
from tessera.llm.passages import repeated_passages
from tessera.session import materialize

SIMILAR_PERCENT = 80    # near-duplicates: Jaccard similarity of five-word shingles
PASSAGE_BYTES = 200     # repeated passages: shorter than any fifty words
VOCABULARY, END_ID = "word_bpe_49k.json", 2


def _with_text(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names`` of the struct ``row`` with ``kept`` as the text and its length as n_chars,
    without rows left blank."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return rows.filter(F.coalesce(F.col("kept"), F.lit("")).rlike(r"\S")).select(
        *[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in names])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is known: those without a letter (null and empty ones too), or far from all
    languages learnt from the labelled rows, go.  Rows that repeat stay; an empty table stays empty."""
    return classify(docs, train(docs)).filter(~F.col("rejected")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first; documents of such lines alone go, as do
    those without text.  Rows equal in doc_id and text are one document; an empty table stays empty."""
    out = drop_recurring_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return _with_text(out.select("row", changed.alias("kept")), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest doc_id, stays.  Of rows equal in doc_id
    and text the first in the order of their other columns (maps aside) stays.  Null and empty texts are in
    no group; an empty table stays empty."""
    kept = near_duplicates(docs, percent=SIMILAR_PERCENT).filter("kept")
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")
    keys = kept.select(F.unhex(F.md5(F.concat(number, F.lit(b"\n"), "tk"))).alias("key")).distinct()
    rows = docs.select(doc_key().alias("key"), F.struct("*").alias("row")).join(keys, "key", "left_semi")
    told = [f"row.`{f.name}`" for f in docs.schema.fields if f.name != "text" and "map" not in f.dataType.simpleString()]
    return rows.groupBy("key").agg(F.min_by("row", F.struct(*told)).alias("row")).select("row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go; documents of nothing else go, as do those without text.  Rows with
    equal texts are repeats of each other; an empty table stays empty."""
    lost = repeated_passages(docs, PASSAGE_BYTES).select("tk", F.col("text").alias("rest"))
    rows = docs.select(F.struct("*").alias("row"), text_key().alias("tk")).join(lost, "tk", "left")
    return _with_text(rows.select("row", F.coalesce("rest", "row.text").alias("kept")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in a sequence; ids are checked by their CRC.  Null and empty
    texts are the end token alone; every row is a document of its own; an empty table has no pieces."""
    return pack(materialize(pieces(docs, public_tokenizers.path(VOCABULARY), END_ID)))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
