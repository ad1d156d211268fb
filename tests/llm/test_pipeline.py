"""The pipeline, stage by stage, against plain Python on the smallest table, and on odd rows."""

import public_tokenizers
from pyspark.sql import functions as F
from test_bpe_packing import check_pieces
from test_near_dup import brute
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tessera.llm import line_dedup, passages
from tessera.session import materialize

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    a = materialize(pipeline.language_id(spark, docs, SF))
    assert a.columns == columns and texts(a) == {k: t for k, t in texts(docs).items() if any(c.isalpha() for c in t)}
    b = materialize(pipeline.line_dedup(spark, a, SF))
    want = {k: t for k, (_, _, t) in line_dedup.brute_force(list(texts(a).items()), line_dedup.MIN_DOCS).items() if t.strip()}
    assert b.columns == columns and texts(b) == want
    c = materialize(pipeline.near_dedup(spark, b, SF))
    kept = {d for d, (_, _, k) in brute(list(texts(b).items()), pipeline.SIMILAR_PERCENT).items() if k}
    assert c.columns == columns and texts(c) == {k: t for k, t in texts(b).items() if k in kept}
    d = materialize(pipeline.suffix_array_dedup(spark, c, SF))
    own = texts(c)
    gone = {k: n for k, (_, n, _, _) in zip(own, passages.brute_force(list(own.values()), pipeline.PASSAGE_BYTES), strict=True)}
    got = texts(d)
    for k, t in own.items():
        if gone[k] == 0:
            assert got[k] == t
        elif k in got:
            assert len(t.encode()) - gone[k] - 6 * 100 <= len(got[k].encode()) <= len(t.encode()) - gone[k]
    assert d.columns == columns and all(r.n_chars == len(r.text) for r in d.collect())
    tokens = Tokenizer.from_file(public_tokenizers.path(pipeline.VOCABULARY))
    check_pieces(pipeline.packing(spark, d, SF).collect(), list(got.items()), tokens)
    assert {r.doc_id for r in pipeline.run(spark, SF).collect()} == set(got)


def test_odd_rows_pass_every_stage(spark, odd_texts):
    rows = [(None if i == 4 else i // 2, t, None if i % 3 else "en", None, None) for i, t in enumerate(odd_texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {c: F.lit("clash") for c in ("tk", "row", "key", "kept", "rest", "__kept", "__key", "__tk", "__rest", "dk", "n_dropped")})
    for data in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES:
            data = materialize(stage(spark, data, SF))
        data.collect()


def test_ties_in_near_dedup(spark):
    """Of rows equal in doc_id and text the first by their other columns stays, however they are dealt."""
    text = "one two three four five six seven"
    rows = [(1, text, "en", s, None) for s in ("b", "a", "c")] + [(2, text, "en", "0", None)]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        docs = docs.withColumn("extra", F.create_map(F.lit("k"), "source"))
        assert [(r.doc_id, r.source) for r in pipeline.near_dedup(spark, docs, SF).collect()] == [(1, "a")]
