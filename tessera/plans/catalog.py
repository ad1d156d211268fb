"""Named queries: operators bound to the fixture views (Spark side).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB SQL of the same name in :mod:`tessera.plans.oracle`.
Doubles that come out of floating sums are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import profile as prof
from tessera.operators import ranking, sampling
from tessera.plans import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- V1 family
def _item_profile(spark, sf):
    p = prof.entity_profile(V.interactions(spark, sf), "item_id", "plays", "user_id",
                            "total_plays", "n_users", "plays_per_user")
    return prof.with_dimension(p, V.items(spark, sf), "item_id")


def _user_profile(spark, sf):
    return prof.entity_profile(V.interactions(spark, sf), "user_id", "plays", "item_id",
                               "total_plays", "n_items", "plays_per_item")


@query("item_profile")
def item_profile(spark, sf):
    return _item_profile(spark, sf).select("item_id", "name", "total_plays", "n_users",
                                           r6("plays_per_user").alias("plays_per_user"))


@query("user_profile")
def user_profile(spark, sf):
    return _user_profile(spark, sf).select("user_id", "total_plays", "n_items",
                                           r6("plays_per_item").alias("plays_per_item"))


@query("outlier_thresholds")
def outlier_thresholds(spark, sf):
    it = prof.threshold(_item_profile(spark, sf), "plays_per_user", V.V1_ITEM_K) \
        .withColumn("entity", F.lit("item"))
    us = prof.threshold(_user_profile(spark, sf), "plays_per_item", V.V1_USER_K) \
        .withColumn("entity", F.lit("user"))
    return it.unionByName(us).select("entity", r6("mean").alias("mean"), r6("sd").alias("sd"),
                                     "k", r6("cutoff").alias("cutoff"))


def eligible(spark, sf) -> DataFrame:
    """Eligibility chain.  The interaction table feeds four consumers (fact,
    item profile, user profile, user threshold); it is written once to the
    shared checkpoint dir rather than re-joined and re-aggregated four times."""
    from tessera.session import materialize
    v1 = materialize(V.interactions(spark, sf))
    ip = prof.with_dimension(prof.entity_profile(v1, "item_id", "plays", "user_id", "total_plays",
                                                 "n_users", "plays_per_user"), V.items(spark, sf), "item_id")
    up = prof.entity_profile(v1, "user_id", "plays", "item_id", "total_plays", "n_items", "plays_per_item")
    items = prof.eligible_items(ip, "n_users", V.V1_ITEM_MIN_USERS,
                                name_col="name", exclude_names=V.V1_ITEM_EXCLUDE_NAMES,
                                exclude_like=V.V1_ITEM_EXCLUDE_LIKE)
    users = prof.eligible_users(up, "plays_per_item", V.V1_USER_K, "n_items", V.V1_USER_MIN_ITEMS)
    return prof.restrict(v1, {"item_id": items, "user_id": users})


@query("eligible_interactions")
def eligible_interactions(spark, sf):
    return eligible(spark, sf).select("user_id", "item_id", "plays")


@query("eligible_items_optional")
def eligible_items_optional(spark, sf):
    """FLT-02: the item filters with the optional cuts, names that match a pattern and plays per user at
    or above mean + k·sd."""
    items = prof.eligible_items(_item_profile(spark, sf), "n_users", V.V1_ITEM_MIN_USERS, name_col="name",
                                exclude_names=V.V1_ITEM_EXCLUDE_NAMES, exclude_like=V.V1_ITEM_EXCLUDE_LIKE,
                                exclude_rlike=V.V1_ITEM_EXCLUDE_RLIKE, ratio_col="plays_per_user", ratio_k=V.V1_ITEM_K)
    return items.select("item_id", "name", "n_users", r6("plays_per_user").alias("plays_per_user"))


def split(spark, sf) -> DataFrame:
    return sampling.hash_split(eligible(spark, sf), ["user_id", "item_id"], V.SPLIT_WEIGHTS,
                               V.SPLIT_SEED, names=["train", "test"])


@query("hash_split_counts")
def hash_split_counts(spark, sf):
    return split(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"), F.sum("plays").alias("total_plays"))


def popularity(train: DataFrame) -> DataFrame:
    """AGG-06: users per item over the training rows."""
    return train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_users"))


@query("top_items")
def top_items(spark, sf):
    train = split(spark, sf).filter(F.col("split") == "train")
    return prof.top_k(popularity(train), "n_users", V.TOP_K, "item_id")


def negatives(spark, sf):
    """Split, popular pool and sampled negatives.  The eligible split feeds
    the pool, the positives, the exclusions and the short-user pass, so it is
    written once to the checkpoint dir instead of being re-derived (scan, join,
    profiles, semi-joins) by each consumer."""
    from tessera.session import materialize
    s = materialize(split(spark, sf))
    train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
    pool = sampling.indexed_pool(popularity(train), "item_id", "n_users", V.TOP_K)
    neg = sampling.sample_negatives(test, pool, "user_id", "item_id", V.SPLIT_SEED)
    return train, test, neg


@query("sampled_negatives")
def sampled_negatives(spark, sf):
    return negatives(spark, sf)[2]


@query("user_auc")
def user_auc(spark, sf):
    train, test, neg = negatives(spark, sf)
    pop = popularity(train)

    def scored(df):
        return df.join(pop, "item_id", "left").withColumn(
            "score", F.coalesce(F.col("n_users"), F.lit(0)).cast("double"))
    # negatives per user are at most the pool size (the sampler's draw bound)
    per = ranking.user_auc(scored(test), scored(neg), "user_id", "score", neg_bound=V.TOP_K)
    return per.select("user_id", "n_pos", "n_neg", F.col("n_correct").cast("bigint").alias("n_correct"),
                      r6("auc").alias("auc"))


@query("mean_user_auc")
def mean_user_auc(spark, sf):
    per = user_auc(spark, sf)
    return per.agg(r6(F.avg("auc")).alias("mean_auc"), F.count(F.lit(1)).alias("n_users"))


@query("tail_split_orders")
def tail_split_orders(spark, sf):
    """SMP-04: the last tenth of all orders by key, counted."""
    o = sampling.tail_split(V.load(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), ["o_orderkey"], 0.1)
    return o.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
                                  F.max("o_orderkey").alias("last_key"))


@query("stratified_partition")
def stratified_partition(spark, sf):
    return sampling.stratified_partition(V.risk_rows(spark, sf), "toxic", "doc_id", 0.7,
                                         20161117).select("doc_id", "toxic", "partition")


# ------------------------------------------------------- cohort (V4) family
from tessera.operators import cohort as coh  # noqa: E402
from tessera.operators import descriptive as desc  # noqa: E402

FLAGS = [f"{t}_flag" for t in V.EVENT_TYPES]
DATES = [f"{t}_dt" for t in V.EVENT_TYPES]


def cohort_frame(spark, sf):
    w = coh.clean_sentinels(V.wide_patients(spark, sf))
    w = coh.parse_dates(w, ["birth_date", "death_date"] + DATES)
    d = coh.derive(w, FLAGS, DATES, list(V.EVENT_TYPES), "birth_date", "death_date",
                   V.V4_STUDY_END)
    steps = coh.cohort_steps(FLAGS, DATES, V.V4_DX_CUTOFF, V.V4_EARLY_DATE, "race")
    return d, steps


@query("cohort_attrition")
def cohort_attrition(spark, sf):
    d, steps = cohort_frame(spark, sf)
    return desc.attrition(d, steps)


@query("surrogate_ids")
def surrogate_ids(spark, sf):
    """PRJ-07 on the labelled documents: consecutive ids in doc_id order."""
    return coh.surrogate_id(V.risk_rows(spark, sf).select("doc_id", "toxic"), ["doc_id"], "patient_id")


@query("surrogate_ids_lines")
def surrogate_ids_lines(spark, sf):
    """PRJ-07 on all order lines with their payload."""
    li = V.load(spark, sf, "lineitem", None)
    return coh.surrogate_id(li, LINE_ORDER, "line_id").select("line_id", *LINE_ORDER)


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("cohort_filled")
def cohort_filled(spark, sf):
    """FLT-07: the cohort with missing values as dummies."""
    d, steps = cohort_frame(spark, sf)
    d = coh.fill_missing(coh.apply_steps(d, steps).select("user_id", "race", "dx2death"), ["dx2death"], -1)
    return d.select("user_id", "race", r6("dx2death").alias("dx2death"))


@query("cohort_subset")
def cohort_subset(spark, sf):
    """FLT-12: two levels of race, counted."""
    d, steps = cohort_frame(spark, sf)
    sub, _ = coh.subset_levels(coh.apply_steps(d, steps), "race", ["Asian", "Black"])
    return sub.groupBy("race").agg(F.count(F.lit(1)).alias("n"))


@query("column_summary")
def column_summary_orders(spark, sf):
    """SRC-08 on all orders."""
    from tessera.sources.schema import column_summary
    s = column_summary(V.load(spark, sf, "orders", ["o_totalprice", "o_custkey"]))
    return s.select("column_name", "n", "n_null", *[r6(c).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")])


@query("schema_listing")
def schema_listing_customer(spark, sf):
    """SRC-05/06: columns and labels of the customer table."""
    from tessera.sources.schema import schema_listing, with_labels
    return schema_listing(with_labels(V.load(spark, sf, "customer", None), {"c_acctbal": "account balance"}))


@query("delimited_round_trip")
def delimited_round_trip(spark, sf):
    """SRC-01..04 / SNK-01..04: customers written as tab-separated text and read back by a declared schema."""
    from tessera.session import scratch_path
    from tessera.sources.delimited import coerce, read_delimited
    from tessera.sources.sinks import write_ordered
    df = V.load(spark, sf, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    path = scratch_path(spark, "delimited")
    write_ordered(df, path, "c_custkey", sep="\t")
    back = read_delimited(spark, path, "c_custkey STRING, c_name STRING, c_acctbal STRING, c_mktsegment STRING",
                          sep="\t", header=True)
    return coerce(back, {"c_custkey": "BIGINT", "c_acctbal": "DOUBLE"})


@query("quoted_round_trip")
def quoted_round_trip(spark, sf):
    """SRC-02 / SRC-03 / SNK-02: whole texts (line breaks, quotes, separators) written as quoted text
    with a header and read back without a schema."""
    from tessera.session import scratch_path
    from tessera.sources.delimited import coerce, read_delimited
    from tessera.sources.sinks import write_quoted
    path = scratch_path(spark, "quoted")
    write_quoted(V.load(spark, sf, "documents", ["doc_id", "text", "lang", "n_chars"]), path)
    back = read_delimited(spark, path, header=True, escape='"', multiline=True, null_value=r"\N")
    return coerce(back, {"doc_id": "BIGINT", "n_chars": "BIGINT"})


@query("inferred_schema")
def inferred_schema(spark, sf):
    """SRC-04: all orders written as text with a header, read back with inferred types, listed."""
    from tessera.session import scratch_path
    from tessera.sources.delimited import read_delimited
    from tessera.sources.schema import schema_listing
    from tessera.sources.sinks import write_delimited
    path = scratch_path(spark, "delimited")
    orders = V.load(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    write_delimited(orders.withColumn("o_orderdate", F.to_date("o_orderdate")), path)
    return schema_listing(read_delimited(spark, path, header=True, infer=True)).select(
        "position", "column_name", "data_type", "n_rows", "n_null")


@query("headerless_tsv")
def headerless_tsv(spark, sf):
    """SRC-01 / SNK-01 / STR-13: the interactions as tab-separated text without a header, in a folder
    named by the time, read back by a declared schema."""
    from tessera.session import scratch_path
    from tessera.sources.delimited import read_delimited
    from tessera.sources.sinks import timestamp_suffix, write_delimited
    v1 = V.interactions(spark, sf)
    path = f"{scratch_path(spark, 'delimited')}/{timestamp_suffix(v1)}"
    write_delimited(v1, path, sep="\t", header=False)
    return read_delimited(spark, path, "user_id BIGINT, item_id BIGINT, plays BIGINT", sep="\t")


@query("split_sink")
def split_sink(spark, sf):
    """SNK-03: labelled and unlabelled pairs united, then written to folders of their own, ids un-shifted;
    a reader of one part prunes the other."""
    from tessera.session import scratch_path
    from tessera.sources.sinks import write_split
    p = V.pairs_raw(spark, sf).select("id", "is_duplicate", "split")
    parts = [p.filter(F.col("split") == x).drop("split") for x in ("train", "test")]
    labelled, unlabelled = tp.split_unlabelled(tp.union_unlabelled(*parts, "id", "is_duplicate"))
    path = scratch_path(spark, "split")
    write_split(labelled.withColumn("part", F.lit("labelled")).unionByName(
        unlabelled.withColumn("part", F.lit("unlabelled"))), path, "part")
    return spark.read.parquet(path).select("part", "id", "is_duplicate")


@query("cohort_derived")
def cohort_derived(spark, sf):
    d, steps = cohort_frame(spark, sf)
    return coh.apply_steps(d, steps).select(
        "user_id", "sex", "race", "cancer_type", r6("dx_age").alias("dx_age"),
        r6("death_age").alias("death_age"), "age_cat", r6("dx2death").alias("dx2death"),
        "dx_date", F.year("dx_date").alias("dx_year"), "tt_event", "death")


# -------------------------------------------------- descriptive (V3/V5) family
STRATA = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["0", "1", "2", "3", "4"]
AGE_EDGES = [10, 20, 30, 40, 50, 60, 70, 80, 90, 100]


@query("age_bins")
def age_bins(spark, sf):
    from tessera.functions.binning import bin_right_closed
    s = V.subjects(spark, sf)
    return s.groupBy(bin_right_closed(F.col("age"), AGE_EDGES).alias("age_cat")).agg(
        F.count(F.lit(1)).alias("n"))


@query("freq_one_way")
def freq_one_way(spark, sf):
    f = desc.freq(V.subjects(spark, sf), "stratum")
    return f.select("stratum", "n", r6("pct").alias("pct"), "cum_n", r6("cum_pct").alias("cum_pct"),
                    "n_levels")


@query("freq_two_way")
def freq_two_way(spark, sf):
    return desc.crosstab_complete(V.subjects(spark, sf), "stratum", "region")


@query("column_percent")
def column_percent(spark, sf):
    c = desc.column_percent(V.subjects(spark, sf), "stratum", "region")
    return c.select("stratum", "region", "n", r6("pct").alias("pct"))


@query("group_summary")
def group_summary(spark, sf):
    """AGG-17/12/13/21: totals, events, percents, median and min time per stratum, all from the
    counts of (stratum, time, event)."""
    s = materialize(V.subjects(spark, sf).groupBy("stratum", "time", "event").agg(F.count(F.lit(1)).alias("m")))
    hit = F.when(F.col("event") == 1, F.col("m")).otherwise(0)
    g = s.groupBy("stratum").agg(
        F.sum("m").alias("n"), F.sum(hit).alias("n_event"), F.sum(F.when(F.col("time") <= 1000, hit).otherwise(0)).alias("n_event_1000"),
        F.min("time").alias("min_time")).join(quantiles(s, ["stratum"], "time", {"median_time": 0.5}, "m"), "stratum")
    return g.select("stratum", "n", F.col("n_event").cast("bigint").alias("n_event"),
                    F.round(F.col("n_event") * 100.0 / F.col("n"), 2).alias("pct_event"),
                    "n_event_1000",
                    F.round(F.col("n_event_1000") * 100.0 / F.col("n"), 2).alias("pct_event_1000"),
                    r6("median_time").alias("median_time"), "min_time")


@query("group_means")
def group_means(spark, sf):
    g = desc.group_means(V.subjects(spark, sf), ["stratum", "region"], "age")
    return g.select("stratum", "region", r6("mean_age").alias("mean_age"), "n")


def _pivot(spark, sf):
    p = desc.pivot_mean(V.subjects(spark, sf), "stratum", "region", "age", REGIONS)
    return p.select("stratum", *[r6(F.col(f"`{r}`")).alias(f"r_{r}") for r in REGIONS])


@query("pivot_means")
def pivot_means(spark, sf):
    return _pivot(spark, sf)


@query("transpose_means")
def transpose_means(spark, sf):
    return desc.transpose(_pivot(spark, sf), "stratum", "region")


@query("histogram")
def histogram(spark, sf):
    h = desc.histogram(V.subjects(spark, sf), "time", 20, ["stratum"])
    return h.select("stratum", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"),
                    "n", r6("density").alias("density"))


@query("box_stats")
def box_stats(spark, sf):
    b = desc.box_stats(V.subjects(spark, sf), "time", ["stratum"])
    return b.select("stratum", "n", "min", r6("q1").alias("q1"), r6("median").alias("median"),
                    r6("q3").alias("q3"), "max", r6("iqr").alias("iqr"), "whisker_lo", "whisker_hi",
                    "n_outliers")


@query("density")
def density(spark, sf):
    d = desc.density(V.subjects(spark, sf), "age", ["stratum"], grid_points=32, bins=64)
    return d.select("stratum", "point", r6("x").alias("x"), r6("density").alias("density"))


@query("rare_event_rate")
def rare_event_rate(spark, sf):
    f = desc.freq(V.risk_rows(spark, sf), "toxic")
    return f.select("toxic", "n", r6("pct").alias("pct"), "cum_n", r6("cum_pct").alias("cum_pct"),
                    "n_levels")


# ----------------------------------------------------- survival (V3) family
from tessera.operators import survival as sv  # noqa: E402

KM_COLS = ["stratum", "group2", "time", "n_risk", "n_event", "n_censor"]


def _km(spark, sf):
    return sv.kaplan_meier(V.subjects(spark, sf), "time", "event", "group2", "stratum")


@query("km_curve")
def km_curve(spark, sf):
    return _km(spark, sf).select(*KM_COLS, r6("surv").alias("surv"))


@query("km_curve_window")
def km_curve_window(spark, sf):
    """SUR-07: the curve from day 100 to day 1,000."""
    return sv.clip_time(_km(spark, sf), "time", 100, 1000).select(*KM_COLS, r6("surv").alias("surv"))


@query("km_ci")
def km_ci(spark, sf):
    return _km(spark, sf).select("stratum", "group2", "time", r6("surv").alias("surv"),
                                 r6("std_err").alias("std_err"), r6("lower").alias("lower"),
                                 r6("upper").alias("upper"))


@query("km_median")
def km_median(spark, sf):
    return sv.km_median(_km(spark, sf), "time", ["stratum", "group2"])


@query("risk_table")
def risk_table(spark, sf):
    return sv.risk_table(V.subjects(spark, sf), "time", "event", 500, "group2", "stratum")


@query("censor_counts")
def censor_counts(spark, sf):
    return sv.censor_counts(V.subjects(spark, sf), "time", "event", "group2", "stratum")


@query("logrank")
def logrank(spark, sf):
    per, _ = sv.logrank_terms(V.subjects(spark, sf), "time", "event", "group2", "stratum")
    return per.select("stratum", "group2", "observed", r6("expected").alias("expected"),
                      r6("var").alias("var"))


@query("logrank_test")
def logrank_test(spark, sf):
    """Several groups (5 regions) per stratum; p from the χ² tail."""
    return sv.logrank_test(V.subjects(spark, sf), "time", "event", "region", "stratum")


@query("logrank_two_groups")
def logrank_two_groups(spark, sf):
    """Two groups per stratum: one degree of freedom."""
    t = sv.logrank_test(V.subjects(spark, sf), "time", "event", "group2", "stratum")
    return t.select("stratum", "n_groups", r6("chisq").alias("chisq"), "df", r6("p_value").alias("p_value"))


@query("curve_crossings")
def curve_crossings(spark, sf):
    return sv.curve_crossings(_km(spark, sf), "time", "group2", "low", "high", "stratum")


def _cox(spark, sf, interaction: bool):
    s = V.subjects(spark, sf)
    factors = ["region", "group2"] if interaction else ["group2"]
    inter = [("region", "group2")] if interaction else []
    d, xs = sv.design(s, factors, inter, levels={"region": REGIONS, "group2": ["high", "low"]})
    return d, xs, sv.cox_ph(d, "time", "event", xs, "stratum")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if t == "double" else c for c, t in df.dtypes])


@query("cox_fit")
def cox_fit(spark, sf):
    return _rounded(_cox(spark, sf, False)[2][0])


@query("cox_tests")
def cox_tests(spark, sf):
    return _rounded(_cox(spark, sf, False)[2][1])


@query("cox_interaction")
def cox_interaction(spark, sf):
    return _cox(spark, sf, True)[2][0]


@query("cox_concordance")
def cox_concordance(spark, sf):
    d, xs, (coefs, _) = _cox(spark, sf, False)
    return _rounded(sv.concordance(d, "time", "event", xs, coefs, "stratum"))


@query("cox_curve")
def cox_curve(spark, sf):
    d, xs, (coefs, _) = _cox(spark, sf, False)
    return _rounded(sv.cox_curve(d, "time", "event", xs, coefs, "stratum"))


# ---------------------------------------------------- text pairs (V2) family
from tessera.operators import textpair as tp  # noqa: E402
from tessera.operators.quantiles import quantiles  # noqa: E402


def pairs(spark, sf):
    """Cleaned V2 pairs; the view spreads them over cpu_partitions tasks."""
    return tp.drop_incomplete(V.pairs_raw(spark, sf), ["q1", "q2"])


@query("pair_dropna")
def pair_dropna(spark, sf):
    raw = V.pairs_with_gaps(spark, sf)
    before = raw.groupBy("split").agg(F.count(F.lit(1)).alias("n_before"))
    after = tp.drop_incomplete(raw, ["q1", "q2"]).groupBy("split").agg(F.count(F.lit(1)).alias("n_after"))
    return before.join(after, "split", "left").select("split", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))


@query("pair_union_shift")
def pair_union_shift(spark, sf):
    p = pairs(spark, sf)
    cols = ["id", "q1", "q2", "is_duplicate"]
    u = tp.union_unlabelled(p.filter(F.col("split") == "train").select(*cols),
                            p.filter(F.col("split") == "test").select(*cols), "id", "is_duplicate")
    return u.select("id", "orig_id", "is_duplicate", "max_train_id")


@query("pair_lemmas")
def pair_lemmas(spark, sf):
    return tp.with_tokens(pairs(spark, sf), "q1", "q2").select("id", "lemma1", "lemma2")


def _features(spark, sf):
    return tp.pair_features(pairs(spark, sf))


@query("pair_counts")
def pair_counts(spark, sf):
    return _features(spark, sf).select("id", *tp.FEATURES[:8])


@query("pair_ratios")
def pair_ratios(spark, sf):
    cols = ["lWCount_ratio", "qWCount_ratio", "lLen_ratio", "qLen_ratio", "qUnigram_ratio",
            "lUnigram_ratio"]
    return _features(spark, sf).select("id", *cols)


@query("pair_ngrams")
def pair_ngrams(spark, sf):
    return _features(spark, sf).select("id", *[f"{k}Ngrams_{n}" for k in "ql" for n in (1, 2, 3)])


@query("pair_levenshtein")
def pair_levenshtein(spark, sf):
    return _features(spark, sf).select("id", "lemma_leven", "question_leven")


def _lemma_tokens(spark, sf):
    """(id, lemma tokens ×2) written once: the TF-IDF plan reads it three times
    and re-deriving it would re-join and re-tokenise whole texts each time."""
    from tessera.session import materialize
    return materialize(tp.with_tokens(pairs(spark, sf), "q1", "q2")
                       .select("id", "lemma_tok1", "lemma_tok2"))


@query("pair_corpus_full_join")
def pair_corpus_full_join(spark, sf):
    k = tp.corpus_multiplicity(_lemma_tokens(spark, sf), "lemma_tok1", "lemma_tok2")
    return k.select(F.array_join("words", " ").alias("corpus_key"), "n_left", "n_right", "n_rows")


@query("pair_tfidf_distance")
def pair_tfidf_distance(spark, sf):
    d = tp.tfidf_distance(_lemma_tokens(spark, sf), "id", "lemma_tok1", "lemma_tok2")
    return d.select("id", r6("tfidfDistance").alias("tfidfDistance"))


@query("pair_tfidf_full_join")
def pair_tfidf_full_join(spark, sf):
    d = tp.tfidf_distance(_lemma_tokens(spark, sf), "id", "lemma_tok1", "lemma_tok2",
                          corpus="full_join")
    return d.select("id", r6("tfidfDistance").alias("tfidfDistance"))


def feature_table(spark, sf):
    """FEA-06: id, the 23 features in order, label and split."""
    from tessera.session import materialize
    feats = [c for c in tp.FEATURES if c != "tfidfDistance"]
    # one pass over the texts (all row-local features + token arrays), written
    # once to the checkpoint dir; TF-IDF and the final join read that table
    f = materialize(tp.pair_features(pairs(spark, sf)).select(
        "id", *feats, "is_duplicate", "split", "lemma_tok1", "lemma_tok2"))
    d = tp.tfidf_distance(f, "id", "lemma_tok1", "lemma_tok2")
    return f.join(d, "id").select("id", *tp.FEATURES, "is_duplicate", "split")


@query("pair_features")
def pair_features(spark, sf):
    return feature_table(spark, sf).withColumn("tfidfDistance", r6("tfidfDistance"))


# --------------------------------------------- models / clustering / recommender
from tessera.operators import cluster as clu  # noqa: E402
from tessera.operators import models as mdl  # noqa: E402
from tessera.operators import recommend as rec  # noqa: E402
from tessera.operators import tree as entropy_tree  # noqa: E402
from tessera.operators import twotower as tt  # noqa: E402
from tessera.session import concurrently, materialize, scratch_path  # noqa: E402

# fixed values: model parameters, ALS_GRID below and the feature names of textpair.FEATURES
PAIR_CONFIGS = {
    "glm": ("glm", {}),
    "dt": ("dt", {"maxDepth": 15}),
    "rf": ("rf", {}),
    "gbt": ("gbt", {"maxIter": 40, "stepSize": 0.05, "maxDepth": 4}),
}
NLP = [f for f in tp.FEATURES]


def _pair_sets(spark, sf):
    """Feature table written once: the sweep fits four models on it."""
    f = materialize(feature_table(spark, sf))
    lab = f.filter(F.col("split") == "train")
    s = sampling.hash_split(lab, ["id"], [0.7, 0.3], 0, names=["fit", "holdout"])
    return f, lab, s.filter(F.col("split") == "fit"), s.filter(F.col("split") == "holdout")


@query("pair_models")
def pair_models(spark, sf):
    _, _, fit, hold = _pair_sets(spark, sf)
    res, _ = mdl.sweep(fit, hold, PAIR_CONFIGS, [mdl.assemble(NLP)], "is_duplicate")
    return res.select("config", "kind", r6("auc").alias("auc"))


@query("pair_best_scores")
def pair_best_scores(spark, sf):
    f, lab, fit, hold = _pair_sets(spark, sf)
    res, _ = mdl.sweep(fit, hold, PAIR_CONFIGS, [mdl.assemble(NLP)], "is_duplicate")
    best = mdl.best_config(res, list(PAIR_CONFIGS))
    kind, params = PAIR_CONFIGS[best]
    est = mdl.make_estimator(kind, "is_duplicate", **params)
    _, scored = mdl.fit_score(est, [mdl.assemble(NLP)], lab, f.filter(F.col("split") == "test"), kind)
    return scored.select("id", r6("score").alias("predict"), F.lit(best).alias("model"))


@query("feature_importance")
def feature_importance(spark, sf):
    _, _, fit, _ = _pair_sets(spark, sf)
    out = None
    for name in ("rf", "gbt"):
        kind, params = PAIR_CONFIGS[name]
        m, _ = mdl.fit_score(mdl.make_estimator(kind, "is_duplicate", **params), [mdl.assemble(NLP)],
                             fit, fit.limit(0), kind)
        t = mdl.importance(m, NLP).withColumn("model", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


def _v6_tokens(spark, sf):
    from tessera.functions.text import clean_tokens
    p = pairs(spark, sf)
    return p, p.select("id", clean_tokens(F.col("q1")).alias("q_tok1"), clean_tokens(F.col("q2")).alias("q_tok2"))


def _towers(spark, sf):
    _, toks = _v6_tokens(spark, sf)
    emb = V.vectors(spark, sf)
    n = emb.count()                     # size of the embedding table: one scalar
    return tt.two_tower_features(toks, "id", "q_tok1", "q_tok2", emb, n, 64)


@query("two_tower_features")
def two_tower_features(spark, sf):
    """FEA-08, a row a pair and dimension."""
    both = F.arrays_zip("sq_diff", "sum")
    return _towers(spark, sf).select("id", F.posexplode(both).alias("dim", "v")).select(
        "id", "dim", r6("v.sq_diff").alias("sq_diff"), r6("v.sum").alias("sum"))


MOST_EPOCHS, PATIENCE, BLOCK_ROWS = 30, 3, 1025       # fixed values


@query("mlp_scores")
def mlp_scores(spark, sf):
    """MOD-16/17/18: MLP on two-tower ⧺ NLP features; training stops when the holdout log-loss has not
    improved for three epochs, 30 at most; the unlabelled pairs are scored with the best epoch's weights."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorSizeHint
    from pyspark.ml.functions import array_to_vector
    f, _, fit, hold = _pair_sets(spark, sf)
    tower = materialize(_towers(spark, sf))
    stages = [VectorSizeHint(inputCol="tower", size=128, handleInvalid="error"),
              mdl.assemble(["tower"] + NLP, "raw"), mdl.standardize("raw", "features")]

    def joined(df):
        return df.join(tower, "id").withColumn("tower", array_to_vector(F.concat("sq_diff", "sum")))
    prepare = Pipeline(stages=stages).fit(joined(fit))

    def rows(df):       # every epoch reads these
        return materialize(prepare.transform(joined(df)).select("id", "is_duplicate", "features"))
    model, history = mdl.fit_epochs(rows(fit), rows(hold), "is_duplicate", [128 + len(NLP), 100, 2], MOST_EPOCHS, PATIENCE, block=BLOCK_ROWS)
    epoch, loss = mdl.best_epoch(history)
    sc = mdl.positive_score(model.transform(rows(f.filter(F.col("split") == "test"))), "mlp")
    return sc.select("id", r6("score").alias("predict"), F.lit(epoch).alias("epochs"), F.lit(round(loss, 6)).alias("holdout_loss"))


# SAS-style rare-event models on V5 (target: toxic); depths, leaf sizes and the
# seven variable subsets are fixed values
V5_INTERVAL = ["n_chars", "next_chars", "quality"]
V5_NOMINAL = ["lang", "next_lang", "source"]
TREE_CONFIGS = {
    "tree1": (3, 4, V5_INTERVAL + V5_NOMINAL),
    "tree2": (5, 4, V5_INTERVAL + V5_NOMINAL),
    "tree3": (4, 4, V5_INTERVAL + V5_NOMINAL),
    "tree4": (4, 3, V5_INTERVAL + V5_NOMINAL),
    "tree5": (6, 4, ["quality", "lang", "next_lang", "source"]),
    "tree6": (5, 4, ["n_chars", "next_chars", "quality", "lang"]),
    "tree7": (4, 4, ["quality", "lang", "source"]),
}
TREE_BINS = 100


def _v5_parts(spark, sf):
    """Training / validation partitions, written once: every fit in a sweep reads them."""
    p = materialize(sampling.stratified_partition(V.risk_inputs(spark, sf), "toxic", "doc_id", 0.7, 20161117))
    return p.filter("partition = 1"), p.filter("partition = 0")


def _tree(train, name):
    depth, leaf, cols = TREE_CONFIGS[name]
    return entropy_tree.grow(train, "toxic", [c for c in cols if c in V5_INTERVAL], [c for c in cols if c in V5_NOMINAL],
                             depth, leaf, TREE_BINS)


@query("tree_sweep")
def tree_sweep(spark, sf):
    train, valid = _v5_parts(spark, sf)

    def one(name, depth, leaf, cols):
        tree = _tree(train, name)
        a = mdl.auc(tree.score(valid), "toxic", "score").first()["auc"]
        return name, depth, leaf, len(cols), round(float(a), 6) if a is not None else None, len(tree.nodes)
    rows = concurrently([partial(one, name, *c) for name, c in TREE_CONFIGS.items()])
    return spark.createDataFrame(rows, "config STRING, max_depth INT, min_leaf INT, n_inputs INT, "
                                       "auc DOUBLE, n_nodes INT")


@query("tree_nodes")
def tree_nodes(spark, sf):
    train, _ = _v5_parts(spark, sf)
    t = _tree(train, "tree2").table(spark)
    return t.select("node", "parent", "depth", "n", "n_event", r6("p_event").alias("p_event"), r6("entropy").alias("entropy"),
                    "input", r6("cut").alias("cut"), "left_levels", "missing_to", r6("gain").alias("gain"))


@query("logistic_estimates")
def logistic_estimates(spark, sf):
    train, _ = _v5_parts(spark, sf)
    m, names, _ = _logistic(train)
    return mdl.glm_estimates(m, names)


def _logistic(train):
    """The logistic model of V5: lang with its last level as the reference, n_chars, quality."""
    levels = mdl.levels_of(train, ["lang"])
    fit, names = mdl.dummies(train, levels)
    names = names + ["n_chars", "quality"]
    m, _ = mdl.fit_score(mdl.make_estimator("glm", "toxic"), [mdl.assemble(names)], fit, fit.limit(0), "glm")
    return m, names, levels


@query("logistic_scores")
def logistic_scores(spark, sf):
    """MOD-02/13: the logistic model applied to the validation partition."""
    train, valid = _v5_parts(spark, sf)
    m, _, levels = _logistic(train)
    rows, _ = mdl.dummies(valid, levels)
    return mdl.positive_score(m.transform(rows), "glm").select("doc_id", "toxic", r6("score").alias("score"))


@query("model_metrics")
def model_metrics(spark, sf):
    """MOD-14 on the tree scores of the validation partition; threshold = the
    training event rate as a probability (Q23)."""
    train, valid = _v5_parts(spark, sf)
    rate = train.agg(F.avg("toxic")).first()[0]
    m = mdl.binary_metrics(_tree(train, "tree5").score(valid), "toxic", "score", threshold=float(rate))
    return m.select("n", "tp", "fp", "tn", "fn", *[r6(c).alias(c) for c in (
        "brier", "log_loss", "misclassification", "sensitivity", "specificity", "precision", "auc")])


def _fixed_score(df):
    return df.withColumn("score", F.least(F.lit(1.0), F.col("n_chars") / F.lit(20000.0)))


@query("model_metrics_fixed")
def model_metrics_fixed(spark, sf):
    m = mdl.binary_metrics(_fixed_score(V.risk_rows(spark, sf)), "toxic", "score", threshold=0.1)
    return m.select("n", "tp", "fp", "tn", "fn", r6("brier").alias("brier"),
                    r6("log_loss").alias("log_loss"), r6("misclassification").alias("misclassification"),
                    r6("sensitivity").alias("sensitivity"), r6("specificity").alias("specificity"),
                    r6("precision").alias("precision"), r6("auc").alias("auc"))


@query("persisted_scores")
def persisted_scores(spark, sf):
    """MOD-13: save the fitted tree, load it back, score the other partition."""
    train, valid = _v5_parts(spark, sf)
    path = scratch_path(spark, "models")
    _tree(train, "tree5").save(spark, path)
    return entropy_tree.EntropyTree.load(spark, path).score(valid).select("doc_id", "node", r6("score").alias("score"))


def _v6_parts(spark, sf):
    v = clu.standardized_features(V.vectors(spark, sf), vector="embedding")
    s = sampling.hash_split(v, ["vec_id"], [0.7, 0.3], 20161117, names=["fit", "valid"])
    return s.filter("split = 'fit'"), s.filter("split = 'valid'")


GAP_REFS = 3     # uniform reference sets per k (gives the gap's standard error)

@query("kmeans_choice")
def kmeans_choice(spark, sf):
    fit, _ = _v6_parts(spark, sf)
    table, _ = clu.kmeans_choose_k(materialize(fit), 2, 20, 20161117, max_iter=100, refs=GAP_REFS, key="vec_id")
    return table.select("k", r6("log_w").alias("log_w"), r6("gap").alias("gap"), r6("s").alias("s"), "chosen")


@query("kmeans_clusters")
def kmeans_clusters(spark, sf):
    fit, valid = _v6_parts(spark, sf)
    fit = materialize(fit)
    _, k = clu.kmeans_choose_k(fit, 2, 20, 20161117, max_iter=100, refs=GAP_REFS, key="vec_id")
    from pyspark.ml.clustering import KMeans
    model = KMeans(k=k, seed=20161117, maxIter=100, predictionCol="cluster").fit(fit)
    return model.transform(valid).select("vec_id", "label", "cluster")


KMODES_COLS = ["lang", "source", "quality", "toxic"]
KMODES_K = 4
KMODES_MOST = 20


@query("kmodes_assign")
def kmodes_assign(spark, sf):
    """CLU-02/03 one assignment step against the seeded initial modes."""
    df = V.risk_rows(spark, sf)
    init = [tuple(r) for r in clu.initial_modes(df, "doc_id", KMODES_COLS, KMODES_K, 20161117)
            .orderBy("cluster").collect()]
    return clu.assign_modes(df, init, KMODES_COLS).select("doc_id", "cluster", "mismatch")


@query("kmodes_fit")
def kmodes_fit(spark, sf):
    """CLU-02/03: modes fitted on the training partition (at most 20 clusters), both
    partitions labelled with their nearest mode."""
    train, valid = _v5_parts(spark, sf)
    assigned, modes = clu.kmodes(train, "doc_id", KMODES_COLS, KMODES_MOST, 20161117)
    cur = [tuple(r) for r in modes.orderBy("cluster").collect()]          # at most 20 rows
    both = clu.assign_modes(valid, cur, KMODES_COLS).withColumn("part", F.lit("valid")).unionByName(
        assigned.withColumn("part", F.lit("train")))
    return both.select("doc_id", "part", "cluster", "mismatch")


# recommender (V1)
ALS_GRID = {"ranks": [30, 35, 40], "alphas": [2.0, 5.0, 12.0], "regs": [2.0, 3.0, 3.5]}


@query("als_scores")
def als_scores(spark, sf):
    """REC-01/03: fit on the training split, score the held-out pairs."""
    train, test, _ = negatives(spark, sf)
    m = rec.als(30, 2.0, 2.0, "user_id", "item_id", "plays", seed=0).fit(train.select("user_id", "item_id", "plays"))
    return rec.score_pairs(m, test, "user_id", "item_id").select("user_id", "item_id", r6("score").alias("score"))


@query("als_final_scores")
def als_final_scores(spark, sf):
    """REC-03: the grid's best parameters refitted on all eligible rows, applied to the held-out pairs."""
    train, test, neg = negatives(spark, sf)
    train = materialize(train.select("user_id", "item_id", "plays"))
    test, neg = materialize(test), materialize(neg)
    g = rec.als_grid(train, test, neg, "user_id", "item_id", "plays", neg_bound=V.TOP_K, **ALS_GRID)
    best = rec.best_params(g).first()
    every = train.unionByName(test.select("user_id", "item_id", "plays"))
    m = rec.als(best["rank"], best["alpha"], best["reg"], "user_id", "item_id", "plays", seed=0).fit(every)
    return rec.score_pairs(m, test, "user_id", "item_id").select("user_id", "item_id", r6("score").alias("score"))


@query("als_grid")
def als_grid(spark, sf):
    train, test, neg = negatives(spark, sf)
    neg = materialize(neg)                # drawn once for the whole grid
    train = materialize(train.select("user_id", "item_id", "plays"))
    g = rec.als_grid(train, test, neg, "user_id", "item_id", "plays", neg_bound=V.TOP_K, **ALS_GRID)
    best = rec.best_params(g).select(F.struct("rank", "alpha", "reg").alias("b")).first()["b"]
    return g.select("rank", "alpha", "reg", r6("mean_auc").alias("mean_auc"),
                    ((F.col("rank") == best["rank"]) & (F.col("alpha") == best["alpha"])
                     & (F.col("reg") == best["reg"])).alias("best"))
