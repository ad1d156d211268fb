"""Text-pair features: hand fixtures (Q8, Q9, STR-07) and brute-force checks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import textpair as tp
from tessera.plans import catalog

SF001 = "/root/testdata/sf0.001"


def levenshtein_np(a: str, b: str) -> int:
    """Character edit distance, one NumPy row per character of ``a``."""
    if not a:
        return len(b)
    if not b:
        return len(a)
    bb = np.array([ord(c) for c in b])
    prev = np.arange(len(b) + 1)
    j = np.arange(len(b) + 1)
    for i, ch in enumerate(a, 1):
        cost = (bb != ord(ch)).astype(np.int64)
        tmp = np.empty_like(prev)
        tmp[0] = i
        tmp[1:] = np.minimum(prev[1:] + 1, prev[:-1] + cost)
        prev = np.minimum.accumulate(tmp - j) + j
    return int(prev[-1])


def test_levenshtein_np_small():
    assert levenshtein_np("kitten", "sitting") == 3
    assert levenshtein_np("été", "ete") == 2
    assert levenshtein_np("", "abc") == 3


def test_question_levenshtein_whole_texts(spark):
    """pair_levenshtein over whole sf0.001 texts equals a brute-force DP."""
    rows = catalog.pairs(spark, SF001).select("id", "q1", "q2").collect()
    got = {r.id: r for r in catalog.pair_levenshtein(spark, SF001).collect()}
    assert len(got) == len(rows) > 0
    for r in rows:
        assert got[r.id].question_leven == levenshtein_np(r.q1, r.q2)


def test_tokens_hand_fixture(spark):
    df = spark.createDataFrame(
        [(1, "", "A  b"), (2, "Spark? is great", "don_t été"), (3, "The boxes were running", "x")],
        "id INT, a STRING, b STRING")
    out = {r.id: r for r in df.select(
        "id", T.lemma_by_rules(T.content_tokens(F.col("a"))).alias("la"), T.clean_tokens(F.col("b")).alias("cb"),
        T.word_count(F.col("b")).alias("wb")).collect()}
    assert out[1].la == []                 # empty text → no tokens (Q9 default)
    assert out[1].cb == ["a", "b"] and out[1].wb == 2
    assert out[2].la == ["great"]          # 'spark?' dropped whole (Q8), 'is' stop word
    assert out[2].cb == ["dont", "été"]    # underscore stripped, accents kept (STR-07)
    assert out[3].la == ["box", "run"]     # rule lemmas: noun then verb suffix rules


def test_ngrams_guard(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "b", "c"])], "x ARRAY<STRING>, y ARRAY<STRING>")
    r = df.select(T.ngrams(F.col("x"), 3).alias("n3"), T.shared_ngrams(F.col("x"), F.col("y"), 2)
                  .alias("s2")).first()
    assert r.n3 == [] and r.s2 == 1


def test_tfidf_matches_spark_ml(spark):
    """FEA-05 (exploded SQL) equals CountVectorizer(minDF=2) + IDF + squared distance."""
    from pyspark.ml.feature import IDF, CountVectorizer
    data = [(1, ["a", "b", "b"], ["a", "c"]), (2, ["c", "d"], ["d", "d", "e"]),
            (3, ["a"], ["b", "e"]), (4, [], ["a", "a"])]
    df = spark.createDataFrame(data, "id INT, t1 ARRAY<STRING>, t2 ARRAY<STRING>")
    ours = {r.id: r.tfidfDistance for r in tp.tfidf_distance(df, "id", "t1", "t2").collect()}
    corpus = df.selectExpr("t1 AS words").unionByName(df.selectExpr("t2 AS words"))
    cv = CountVectorizer(inputCol="words", outputCol="tf", minDF=2.0).fit(corpus)
    idf = IDF(inputCol="tf", outputCol="v").fit(cv.transform(corpus))

    def vecs(col):
        return {r.id: r.v for r in idf.transform(cv.transform(df.selectExpr("id", f"{col} AS words"))).collect()}
    v1, v2 = vecs("t1"), vecs("t2")
    for i in ours:
        assert ours[i] == pytest.approx(float(v1[i].squared_distance(v2[i])), abs=1e-9)


def test_corpus_multiplicity_matches_join(spark):
    """Q10: [a,b]×2 ⟗ [a,b]×2 plus two singles → 6 rows."""
    df = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a", "b"], ["a", "b"]), (["x"], ["y"])],
                               "t1 ARRAY<STRING>, t2 ARRAY<STRING>")
    k = tp.corpus_multiplicity(df, "t1", "t2")
    assert k.agg(F.sum("n_rows")).first()[0] == 6


def test_bitparallel_edit_distance_matches_dp():
    import random
    rnd = random.Random(11)
    for _ in range(500):
        a = "".join(rnd.choice("abé c") for _ in range(rnd.randint(0, 70)))
        b = "".join(rnd.choice("abé c") for _ in range(rnd.randint(0, 70)))
        assert T._edit_distance(a, b) == levenshtein_np(a, b)


def test_edit_distance_udf_matches_builtin(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("été", "ete"), (None, "x"), ("", "abc")],
                               "a STRING, b STRING")
    r = df.select(T.edit_distance(F.col("a"), F.col("b")).alias("u"),
                  F.levenshtein("a", "b").alias("v")).collect()
    assert [x.u for x in r] == [x.v for x in r] == [3, 2, None, 3]


def test_lemma_dictionary(spark, tmp_path):
    """Dictionary before rules, noun before verb, once per token; 'running' is 'run'."""
    words = "running stopped children went making geese boxes thing falling added was wolves"
    df = spark.createDataFrame([(1, words, "nothing listed here"), (2, "", "Children children"), (3, None, "x")],
                               "id INT, q1 STRING, q2 STRING")
    got = {r.id: r for r in tp.with_tokens(df, "q1", "q2").collect()}
    assert got[1].lemma_tok1 == ["run", "stop", "child", "go", "make", "goose", "box", "thing", "fall", "add", "wolf"]
    assert got[2].lemma_tok1 == [] and got[2].lemma_tok2 == ["child", "child"] and got[3].lemma_tok1 is None
    own = tmp_path / "own.tsv"
    own.write_text("surface\ttag\tlemma\nrunning\tv\tdash\nboxes\tn\tcrate\ncrate\tv\tpack\n\tn\tx\nboxes\tn\tzoo\n")
    mine = tp.with_tokens(df, "q1", "q2", exceptions=tp.lemma_exceptions(spark, str(own))).filter("id = 1").first()
    assert mine.lemma_tok1[0] == "dash" and mine.lemma_tok1[6] == "pack" and mine.lemma_tok1[2] == "children"


def test_lemma_table_joins_distinct_tokens(spark):
    """A token that fills a third of all texts is looked up once."""
    df = spark.createDataFrame([(i, ["went"] * 50 + [f"w{i}"], ["x"]) for i in range(300)], "id INT, a ARRAY<STRING>, b ARRAY<STRING>")
    out = tp.with_lemmas(df, "id", {"a": "la", "b": "lb"}, tp.lemma_exceptions(spark))
    assert out.filter("size(filter(la, x -> x = 'go')) = 50 AND lb = array('x')").count() == 300
    table = tp.lemma_table(spark.createDataFrame([("went",), ("geese",), ("zzz",)], "token STRING"), tp.lemma_exceptions(spark))
    assert {r.token: r.lemma for r in table.collect()} == {"went": "go", "geese": "goose", "zzz": "zzz"}


def test_shared_ngram_counts_equal_shared_ngrams(spark):
    rows = [(1, "A b, c a b c", "a b\tc - d"), (2, "", "x"), (3, "x", ""), (4, None, "x"), (5, "a_b ÉTÉ été", "ab été"),
            (6, "one", "One!"), (7, "a b c d e f " * 50, "f e d c b a " * 50), (8, "... --", "-")]
    df = spark.createDataFrame(rows, "id INT, a STRING, b STRING").withColumns({"x": T.clean_tokens(F.col("a")), "y": T.clean_tokens(F.col("b"))})
    out = df.withColumn("got", T.shared_ngram_counts(T.clean_text(F.col("a")), T.clean_text(F.col("b")))).select(
        "id", "got", *[T.shared_ngrams(F.col("x"), F.col("y"), n).alias(f"w{n}") for n in (1, 2, 3)]).collect()
    assert len(out) == len(rows)
    for r in out:
        want = (r.w1, r.w2, r.w3)
        assert (r.got.n1, r.got.n2, r.got.n3) == (want if r.id != 4 else (None, None, None)), r


def test_small_dictionary_moves_no_text(spark):
    """Lemmas of a dictionary that fits the plan equal those of the joined one, without an exchange."""
    df = spark.createDataFrame([(1, "theses children boxes running", "went mice"), (2, "", "cats studied\u2028 dies"), (3, None, "ates")],
                               "id INT, q1 STRING, q2 STRING")
    t = tp.with_tokens(df, "q1", "q2").select("id", "lemma_tok1", "lemma_tok2")
    assert "Exchange" not in t._jdf.queryExecution().executedPlan().toString()
    kept = df.select("id", T.content_tokens(F.col("q1")).alias("a"), T.content_tokens(F.col("q2")).alias("b"))
    joined = tp.with_lemmas(kept, "id", {"a": "lemma_tok1", "b": "lemma_tok2"}, tp.lemma_exceptions(spark))
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, joined.select("id", "lemma_tok1", "lemma_tok2").collect()))


def test_pairs_are_dealt_once(spark, tmp_path):
    """Copies of one text, and neighbours that differ; texts are dealt by the join's keys, not again by id."""
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "a"), (6, None), (7, None), (8, "b"), (9, "c"), (None, "c")]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.id >> 32, r.id & 0xFFFFFFFF, r.q1 == r.q2) for r in catalog.pairs(spark, str(tmp_path)).collect()}
    assert got == {(1, 3, True), (1, 4, True), (2, 8, True), (1, 2, False), (2, 3, False), (8, 9, False)}
    plan = catalog.pairs(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [id" not in plan


def test_edit_distance_steps_over_the_shorter_text():
    """The longer text is the bit vector: a long text against a short one takes few steps, whichever comes first."""
    import random
    import time
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc é😀") for _ in range(rnd.choice([0, 1, 7, 8, 9, 63, 64, 65, 600]))) for _ in range(2))
        assert T._edit_distance(a, b) == T._edit_distance(b, a) == levenshtein_np(a, b)
    long, short = ("".join(rnd.choice(x) for _ in range(n)) for x, n in (("abcdefgh", 200_000), ("hgfedcba", 20)))

    def seconds(f):
        spent = []
        for _ in range(3):
            begun = time.process_time()
            f()
            spent.append(time.process_time() - begun)
        return min(spent)

    def one_step_a_character():
        x = y = (1 << 20) - 1
        for _ in long:
            x = (((x & y) + y) ^ y) & y | 1
    assert T._edit_distance(long, short) == T._edit_distance(short, long) == 199_980
    assert seconds(lambda: T._edit_distance(long, short)) < 2 * seconds(one_step_a_character)


def test_edit_distances_of_many_pairs_step_together(monkeypatch):
    """Pairs of all lengths, stepped together in lanes of 64 characters, equal the DP; and many cost less than one by one."""
    import random
    import time
    rnd = random.Random(3)
    sizes = [0, 1, 2, 40, 63, 64, 65, 100, 127, 128, 129, 300]

    def text(letters, n):
        return "".join(rnd.choice(letters) for _ in range(n))
    pairs = [(text("abc é😀\u0085", rnd.choice(sizes)), text("abd é漢", rnd.choice(sizes))) for _ in range(400)]
    pairs += [(p, p) for p, _ in pairs[:5]] + [(x := text("ab", 200), x[:90] + "c" + x[91:]), ("ab\ud800" * 40, "b\ud800c" * 30)]
    want = [levenshtein_np(a, b) for a, b in pairs]
    for lanes, alone in ((8192, 0.6), (8192, 1e9), (7, 1e9), (8192, 0.0)):
        monkeypatch.setattr(T, "LANES", lanes)
        monkeypatch.setattr(T, "STEP_ALONE", alone)
        assert T._edit_distances(pairs) == want
    monkeypatch.undo()
    many = [(text("etaoin shrdlu", 2000), text("etaoin shrdlu", rnd.randint(600, 2000))) for _ in range(300)]

    def seconds(f):
        begun = time.process_time()
        f()
        return time.process_time() - begun
    one_by_one = min(seconds(lambda: [T._edit_distance(*p) for p in many]) for _ in range(2))
    assert min(seconds(lambda: T._edit_distance_batch(*map(pd.Series, zip(*many)))) for _ in range(3)) < 0.8 * one_by_one


@pytest.mark.parametrize("corpus", ["union", "full_join"])
@pytest.mark.parametrize("frequent", [200_000, 3])
def test_tfidf_counts_within_rows(spark, tmp_path, monkeypatch, corpus, frequent):
    """Repeated and missing ids, missing and equal arrays, rare tokens joined apart; no (pair, token) row is dealt out by id and token."""
    import re
    from collections import Counter
    from math import log
    monkeypatch.setattr(tp, "FREQUENT", frequent, raising=False)
    rows = [(1, ["a", "b", "b"], ["a", "c"]), (2, ["c", "d"], ["d", "d", "e"]), (2, ["a"], ["b", "e"]), (3, [], ["a", "a"]),
            (4, None, ["q", "a"]), (5, ["a", None], ["b"]), (None, ["a", "z"], ["c"]), (None, ["z"], ["z"]), (6, ["c", "d"], ["a"]),
            (7, ["x y"], ["x", "y"]), (8, ["b", "e"], ["c", "d"]), (9, ["b", "e"], ["c", "d"]), (10, ["only"], ["only", "b"])]
    spark.createDataFrame(rows, "id INT, t1 ARRAY<STRING>, t2 ARRAY<STRING>").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    d, seen, total = {}, Counter(), 0
    for i, a, b in rows:
        if corpus == "full_join" or (a is not None and b is not None):
            d.setdefault(i, (Counter(), Counter()))
            d[i][0].update(a or [])
            d[i][1].update(b or [])
    if corpus == "union":
        seen.update(t for sides in d.values() for s in sides for t in s)
        total = 2 * len(rows)
    else:
        for r in tp.corpus_multiplicity(df, "t1", "t2").collect():
            seen.update({t: r.n_rows for t in set(r.words or [])})
            total += r.n_rows
    weight = {t: log((total + 1) / (n + 1)) for t, n in seen.items() if n >= 2 and t is not None}
    want = {i: sum(((x[t] - y[t]) * weight.get(t, 0.0)) ** 2 for t in x | y) for i, (x, y) in d.items() if i is not None}
    out = tp.tfidf_distance(df, "id", "t1", "t2", corpus=corpus)
    got = out.collect()
    assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _, _ in rows)
    for r in got:
        assert r.tfidfDistance == pytest.approx(want.get(r.id, 0.0), abs=1e-9), r
    assert not re.search(r"hashpartitioning\(id#\d+\w*, token", out._jdf.queryExecution().executedPlan().toString())
