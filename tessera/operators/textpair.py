"""Text-pair features (STR-*, MTH-01/02, SET-01/03, PRJ-03/05, FLT-04,
FEA-01..06, JN-03).

The reference runs seven Python UDFs per row; here every feature but the edit
distance and the shared n-grams is a native expression in one projection (tokens computed
once per text and reused), lemmas come from a dictionary in the plan, or if that is large
joined per distinct token, and TF-IDF is computed in exploded relational form (FEA-05): no vocabulary is
collected to the driver, no vector self-join, no vocabulary cap.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import cpu_partitions, materialize, per_group
from tessera.sources.delimited import read_delimited

FEATURES = ["lWCount1", "lWCount2", "qWCount1", "qWCount2", "lLen1", "lLen2", "qLen1", "qLen2",
            "lWCount_ratio", "qWCount_ratio", "lLen_ratio", "qLen_ratio",
            "qNgrams_1", "qNgrams_2", "qNgrams_3", "lNgrams_1", "lNgrams_2", "lNgrams_3",
            "qUnigram_ratio", "lUnigram_ratio", "tfidfDistance", "lemma_leven", "question_leven"]


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    """FLT-04: drop rows with a NULL in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def union_unlabelled(train: DataFrame, test: DataFrame, id_col: str, label: str,
                     sentinel: int | None = -1) -> DataFrame:
    """SET-01 / PRJ-03 / PRJ-05: shift test ids past the largest train id,
    give them the sentinel label (Q12; ``None`` keeps NULL) and union by name.

    The max id is a one-row aggregate joined to the test rows (broadcast of a
    single row), not a driver round trip.  ``orig_id`` keeps the unshifted id
    so the split can be undone at write time (SNK-03).
    """
    mx = F.broadcast(train.agg(F.max(id_col).alias("__max")))
    t = test.crossJoin(mx).select(
        (F.col(id_col) + F.col("__max") + 1).alias(id_col), F.col(id_col).alias("orig_id"),
        *[c for c in test.columns if c not in (id_col, label)],
        F.lit(sentinel).cast("int").alias(label), F.col("__max").alias("max_train_id"))
    tr = train.crossJoin(mx).select(id_col, F.col(id_col).alias("orig_id"),
                                    *[c for c in train.columns if c not in (id_col, label)],
                                    F.col(label).cast("int").alias(label),
                                    F.col("__max").alias("max_train_id"))
    return tr.unionByName(t)


def split_unlabelled(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """SNK-03 inverse: labelled rows, and unlabelled rows with ids un-shifted."""
    lab = df.filter(F.col(id_col) <= F.col("max_train_id"))
    unl = df.filter(F.col(id_col) > F.col("max_train_id")).withColumn(
        id_col, F.col(id_col) - F.col("max_train_id") - 1)
    return lab, unl


def lemma_exceptions(spark: SparkSession, path: str | None = None) -> DataFrame:
    """STR-04: the lemma dictionary (surface, tag n or v, lemma), one row a (surface, tag).

    ``path`` is tab-separated text with a header, on storage that all executors see; without
    one, a small list of irregular English forms that comes with the package.
    """
    schema = "surface STRING, tag STRING, lemma STRING"
    if path:
        table = read_delimited(spark, path, schema, sep="\t", header=True)
    else:
        lines = Path(__file__).parents[1].joinpath("functions", "lemma_exceptions.tsv").read_text().splitlines()
        table = spark.createDataFrame([tuple(x.split("\t")) for x in lines[1:]], schema)
    return table.filter("surface is not null and lemma is not null").groupBy("surface", "tag").agg(F.min("lemma").alias("lemma"))


def lemma_table(tokens: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(token, lemma) of distinct tokens: looked up as a noun, the result as a verb; what the
    dictionary does not list goes by the suffix rules."""
    def listed(tag: str, key: str, value: str) -> DataFrame:
        return exceptions.filter(F.col("tag") == tag).select(F.col("surface").alias(key), F.col("lemma").alias(value))
    noun = tokens.join(listed("n", "token", "__n"), "token", "left").select(
        "token", F.coalesce("__n", T.noun_rules(F.col("token"))).alias("__noun"))
    return noun.join(listed("v", "__noun", "__v"), "__noun", "left").select(
        "token", F.coalesce("__v", T.verb_rules(F.col("__noun"))).alias("lemma"))


def with_lemmas(df: DataFrame, id_col: str, names: dict[str, str], exceptions: DataFrame) -> DataFrame:
    """``df`` with the lemma arrays ``names[c]`` of its token arrays ``c``; ``id_col`` is unique.

    The dictionary is joined once per distinct token.  Tokens whose lemma is not what the rules
    give are then few; each text gets those of its own as a small map, so the texts themselves
    are neither exploded in order nor gathered again.
    """
    tokens = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in names])
    distinct = df.select(F.explode(tokens).alias("token")).distinct()
    rules = T.verb_rules(F.col("__r"))
    found = lemma_table(distinct, exceptions).withColumn("__r", T.noun_rules(F.col("token")))
    hits = per_group(found.filter(F.col("lemma") != rules).select("token", "lemma"))
    own = df.select(id_col, F.explode(F.array_distinct(tokens)).alias("token")).join(hits, "token").groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("__listed"))     # at most one per dictionary entry
    out = df.join(own, id_col, "left")
    return out.withColumns({new: T.lemma_by_rules(F.col(c), F.col("__listed")) for c, new in names.items()}).drop("__listed")


IN_PLAN = 1000          # dictionary rows that an expression may hold


def with_tokens(df: DataFrame, a: str, b: str, id_col: str = "id", exceptions: DataFrame | None = None) -> DataFrame:
    """Token arrays computed once per text (reused by every feature).  A dictionary of at most
    ``IN_PLAN`` rows is part of the projection, so texts are neither written nor moved; a larger
    one is joined, and the content tokens are written once, as that join reads them several times."""
    content = {"__c1": T.content_tokens(F.col(a)), "__c2": T.content_tokens(F.col(b))}
    exceptions = exceptions or lemma_exceptions(df.sparkSession)
    listed = exceptions.limit(IN_PLAN + 1).collect()
    if len(listed) <= IN_PLAN:
        nouns, verbs = ({r.surface: r.lemma for r in listed if r.tag == tag} for tag in "nv")
        lemmas = df.withColumns({f"lemma_tok{k}": T.lemma_by_dictionary(content[f"__c{k}"], nouns, verbs) for k in (1, 2)})
    else:
        lemmas = with_lemmas(materialize(df.withColumns(content)), id_col, {"__c1": "lemma_tok1", "__c2": "lemma_tok2"},
                             exceptions).drop("__c1", "__c2").repartition(cpu_partitions(df.sparkSession), id_col)
    return lemmas.withColumns({
        "q_tok1": T.clean_tokens(F.col(a)), "q_tok2": T.clean_tokens(F.col(b)),
        "lemma1": F.array_join("lemma_tok1", " "), "lemma2": F.array_join("lemma_tok2", " "),
    }).withColumns({
        "l_tok1": T.clean_tokens(F.col("lemma1")), "l_tok2": T.clean_tokens(F.col("lemma2")),
    })


def pair_features(df: DataFrame, a: str = "q1", b: str = "q2", id_col: str = "id") -> DataFrame:
    """FEA-06 without the TF-IDF column: the 22 row-local features."""
    t = with_tokens(df, a, b, id_col)
    qa, qb, la, lb = F.col(a), F.col(b), F.col("lemma1"), F.col("lemma2")
    t = t.withColumns({
        "lWCount1": T.word_count(la), "lWCount2": T.word_count(lb),
        "qWCount1": T.word_count(qa), "qWCount2": T.word_count(qb),
        "lLen1": F.length(la), "lLen2": F.length(lb), "qLen1": F.length(qa), "qLen2": F.length(qb),
        "__q": T.shared_ngram_counts(T.clean_text(qa), T.clean_text(qb)),
        "__l": T.shared_ngram_counts(T.clean_text(la), T.clean_text(lb)),
        "lemma_leven": T.edit_distance(la, lb), "question_leven": T.edit_distance(qa, qb),
    })
    t = t.withColumns({f"{k}Ngrams_{n}": F.col(f"__{k}.n{n}") for k in "ql" for n in (1, 2, 3)}).drop("__q", "__l")
    return t.withColumns({
        "lWCount_ratio": T.rel_diff(F.col("lWCount1"), F.col("lWCount2")),
        "qWCount_ratio": T.rel_diff(F.col("qWCount1"), F.col("qWCount2")),
        "lLen_ratio": T.rel_diff(F.col("lLen1"), F.col("lLen2")),
        "qLen_ratio": T.rel_diff(F.col("qLen1"), F.col("qLen2")),
        "qUnigram_ratio": T.unigram_ratio(F.col("qNgrams_1"), F.col("qWCount1"), F.col("qWCount2")),
        "lUnigram_ratio": T.unigram_ratio(F.col("lNgrams_1"), F.col("lWCount1"), F.col("lWCount2")),
    })


def corpus_multiplicity(df: DataFrame, a_tokens: str, b_tokens: str) -> DataFrame:
    """JN-03 / Q10 parity: rows the reference's full outer join on the token
    array would produce, per distinct array (m·n when on both sides, else m or
    n) — computed from per-side counts, without materialising the m·n pairs."""
    ka = df.groupBy(F.col(a_tokens).alias("words")).agg(F.count(F.lit(1)).alias("n_left"))
    kb = df.groupBy(F.col(b_tokens).alias("words")).agg(F.count(F.lit(1)).alias("n_right"))
    k = ka.join(kb, "words", "full")
    return k.withColumn("n_rows", F.when(F.col("n_left").isNotNull() & F.col("n_right").isNotNull(),
                                         F.col("n_left") * F.col("n_right"))
                        .otherwise(F.coalesce("n_left", "n_right")))


FREQUENT = 200_000      # tokens whose weights are sent to every task


def _one_row_an_id(df: DataFrame, id_col: str, a: str, b: str) -> DataFrame:
    """(id, tokens of both sides): rows of one id are one pair that holds the tokens of them all.  Only ids are
    grouped; the tokens of an id that does not repeat stay where they are."""
    again = per_group(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(F.col(id_col).alias("__again")))
    if again.isEmpty():
        return df.select(id_col, a, b)
    held = F.col(id_col).eqNullSafe(F.col("__again"))
    several = df.join(again, held, "left_semi").groupBy(id_col).agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in (a, b)])
    return df.join(again, held, "left_anti").select(id_col, a, b).unionByName(several)


def _full_join_df(df: DataFrame, a_tokens: str, b_tokens: str) -> tuple[DataFrame, DataFrame]:
    """Number of documents and document frequencies of the corpus of :func:`corpus_multiplicity`.

    A token array counts m·n times if it is on both sides, so each of its m rows on the left counts n times and those
    on the right not at all; else each of its rows counts once.  Arrays are told apart by their digests, and only
    those that do not count once a row on the left are looked up again."""
    digest = lambda c: F.unhex(F.md5(F.to_json(c)))
    side = lambda c, left: df.select(digest(c).alias("key"), F.lit(left).alias("l"))
    counts = materialize(side(a_tokens, 1).unionByName(side(b_tokens, 0)).groupBy("key").agg(
        F.sum("l").alias("n_left"), F.sum(1 - F.col("l")).alias("n_right")))
    both = F.col("key").isNotNull() & (F.col("n_left") > 0) & (F.col("n_right") > 0)
    n_docs = counts.agg(F.sum(F.when(both, F.col("n_left") * F.col("n_right")).otherwise(F.col("n_left") + F.col("n_right"))).alias("__N"))
    more = per_group(counts.filter(both & (F.col("n_right") > 1)).select("key", (F.col("n_right") - 1).alias("w")), FREQUENT)
    right = per_group(counts.filter((F.col("n_left") == 0) & F.col("key").isNotNull()).select("key", F.lit(1).cast("long").alias("w")), FREQUENT)
    parts = [df.select(F.col(a_tokens).alias("words"), F.lit(1).cast("long").alias("w")),
             df.select(F.col(a_tokens).alias("words"), digest(a_tokens).alias("key")).join(more, "key").select("words", "w"),
             df.select(F.col(b_tokens).alias("words"), digest(b_tokens).alias("key")).join(right, "key").select("words", "w")]
    tokens = parts[0].unionByName(parts[1]).unionByName(parts[2]).select(F.explode(F.array_distinct("words")).alias("token"), "w")
    return n_docs, tokens.groupBy("token").agg(F.sum("w").alias("df"))


def tfidf_distance(df: DataFrame, id_col: str, a_tokens: str, b_tokens: str, min_df: int = 2,
                   corpus: str = "union") -> DataFrame:
    """FEA-01..05: squared Euclidean distance between the TF-IDF vectors of
    the two texts of each pair.

    Vocabulary: terms in at least ``min_df`` corpus documents; idf =
    ln((N+1)/(df+1)).  ``corpus='union'`` has one document per text (2 per
    pair); ``'full_join'`` weights each distinct token array by the
    reference's full-join multiplicity.  Plan: document frequencies are a
    partial aggregation on the token; a pair's tf differences are counted
    within its row.  The weights of the ``FREQUENT`` commonest tokens go to every
    task, so (pair, token) rows are summed where they arise; only those of rarer
    tokens are dealt out, to an equi-join on the token.
    """
    a, b = F.col(a_tokens), F.col(b_tokens)
    if corpus == "union":       # a pair with one text missing has no tokens
        docs = df.select(id_col, F.when(b.isNotNull(), a).alias(a_tokens), F.when(a.isNotNull(), b).alias(b_tokens))
        rows = _one_row_an_id(docs, id_col, a_tokens, b_tokens)
        n_docs = df.agg((F.count(F.lit(1)) * 2).alias("__N"))
        dfreq = (rows.select(F.explode(F.concat(F.array_distinct(a_tokens), F.array_distinct(b_tokens))).alias("token"))
                 .groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    else:
        rows = _one_row_an_id(df, id_col, a_tokens, b_tokens)
        n_docs, dfreq = _full_join_df(df, a_tokens, b_tokens)
    vocab = materialize(dfreq.filter((F.col("df") >= min_df) & F.col("token").isNotNull()).crossJoin(F.broadcast(n_docs))   # 1-row broadcast
                        .select("token", "df", F.log((F.col("__N") + 1) / (F.col("df") + 1)).alias("idf")))
    diff = rows.select(id_col, F.explode(T.token_changes(a, b)).alias("__t")).select(id_col, "__t.token", "__t.d")
    size = vocab.count()
    if size <= FREQUENT:
        found = diff.join(F.broadcast(vocab.select("token", "idf")), "token")
    else:
        cut = vocab.agg(F.percentile_approx("df", F.lit(1 - FREQUENT / size), F.lit(10_000))).first()[0]
        common = F.broadcast(vocab.filter(F.col("df") > cut).select("token", "idf"))
        rare = vocab.filter(F.col("df") <= cut).select("token", "idf")
        found = diff.join(common, "token").unionByName(diff.join(common, "token", "left_anti").join(rare, "token"))
    dist = found.groupBy(id_col).agg(F.sum(F.pow(F.col("d") * F.col("idf"), 2)).alias("tfidfDistance"))
    return df.select(id_col).join(dist, id_col, "left").select(
        id_col, F.coalesce("tfidfDistance", F.lit(0.0)).alias("tfidfDistance"))
