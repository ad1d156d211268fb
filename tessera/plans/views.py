"""Fixture views over the test tables (Spark side).

Each view maps a reference input onto the TPC-H-ish tables.  Views read whole
tables: no id subsets, no prefixes, no row caps.  Their DuckDB twins live in
``tessera.plans.oracle`` and must stay in step with this file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import TWO_32, hash32
from tessera.session import cpu_partitions, per_group
from tessera.sources.tables import load

# Fixed parameters of the views (shared with the oracle SQL).
V1_ITEM_MIN_USERS = 25          # users per item must exceed this
V1_ITEM_EXCLUDE_LIKE = ("%.com%", "%.org%", "%ring%")
V1_ITEM_EXCLUDE_NAMES = ("[unknown]",)
V1_ITEM_EXCLUDE_RLIKE = "^[^a-z]+$|^[a-g]"   # names without a letter, or of the first letters
V1_USER_K = 3.0                 # user plays-per-item must be < mean + 3 sd
V1_USER_MIN_ITEMS = 5
V1_ITEM_K = 2.0                 # item threshold (reported, not applied: Q7)
SPLIT_SEED = 0
SPLIT_WEIGHTS = (0.9, 0.1)
TOP_K = 10000                   # popular-item pool size

V2_TEST_FRACTION = 0.2          # pairs with no label (the unlabelled part)
V3_STUDY_END = "2001-08-01"
V3_EVENT_PRICE = 470000.0
V3_GROUP2_BALANCE = 4500.0
V4_FLAG_VALUE = 200.0           # an event of a type at/above this value sets the flag
V4_DEATH_VALUE = 260.0           # death = last event at/above this value


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    """V1: (user_id, item_id, plays) = customer × part, summed quantity."""
    li = load(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.sum("l_quantity").cast("bigint").alias("plays")))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))


def pairs_raw(spark: SparkSession, sf: str) -> DataFrame:
    """V2: (id, q1, q2, is_duplicate, split) over the whole texts of every language.

    Duplicates: every copy of a text paired with the smallest doc_id holding
    that text (star pairs: linear in the copies, never all pairs of a group).
    Non-duplicates: consecutive doc ids with different texts.
    """
    d = load(spark, sf, "documents", ["doc_id", "text"])
    parts = cpu_partitions(spark)           # every consumer runs CPU-heavy per-row text work
    # texts are grouped by a 64-bit hash, and those of groups of several then confirmed to be equal;
    # other texts are only read
    key = F.xxhash64("text").alias("key")
    full = d.filter("text is not null")
    several = per_group(full.groupBy(key).agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("__n"))
                        .filter("__n > 1").select("key", "rep_id"))
    held = full.select("*", key).join(several, "key")
    rep = held.filter("doc_id = rep_id").groupBy("key").agg(F.min("text").alias("rep_text"))
    dup = (held.filter("doc_id <> rep_id").join(rep, "key")
           .filter(F.col("text") == F.col("rep_text"))
           .select(F.col("rep_id").alias("a_id"), F.col("doc_id").alias("b_id"),
                   F.col("text").alias("q1"), F.col("text").alias("q2"),
                   F.lit(1).alias("is_duplicate")).repartition(parts, "a_id", "b_id"))
    # dealt once, by the join's own keys into as many parts as the work needs
    a = d.select(F.col("doc_id").alias("a_id"), F.col("text").alias("q1"), (F.col("doc_id") + 1).alias("next_id")).repartition(parts, "next_id")
    b = d.select(F.col("doc_id").alias("b_id"), F.col("text").alias("q2")).repartition(parts, "b_id")
    non = (a.join(b, F.col("b_id") == F.col("next_id"))
           .filter(F.col("q1") != F.col("q2"))
           .select("a_id", "b_id", "q1", "q2", F.lit(0).alias("is_duplicate")))
    p = dup.unionByName(non).withColumn("id", F.col("a_id") * F.lit(TWO_32) + F.col("b_id"))
    test_cut = int(round(V2_TEST_FRACTION * TWO_32))
    unl = hash32("v2split", "id") < F.lit(test_cut)
    return p.select(
        "id", "q1", "q2",
        F.when(unl, F.lit(None).cast("int")).otherwise(F.col("is_duplicate")).alias("is_duplicate"),
        F.when(unl, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def pairs_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """V2 as a raw file would hold it, for FLT-04 alone: a document's next one may
    not exist, which leaves the pair's second text NULL."""
    d = load(spark, sf, "documents", ["doc_id", "text"])
    a, b = d.alias("a"), d.alias("b")
    return a.join(b, F.col("b.doc_id") == F.col("a.doc_id") * 2, "left").select(
        F.col("a.doc_id").alias("id"), F.col("a.text").alias("q1"), F.col("b.text").alias("q2"),
        F.when(F.col("a.doc_id") % 2 == 0, "train").otherwise("test").alias("split"))


def subjects(spark: SparkSession, sf: str) -> DataFrame:
    """V3: one subject per customer with orders; time-to-event in days."""
    o = load(spark, sf, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    c = load(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = load(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    per = (o.groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("start"),
        F.min(F.when(F.col("o_totalprice") > V3_EVENT_PRICE, F.col("o_orderdate").cast("date")))
         .alias("event_date")))
    end = F.lit(V3_STUDY_END).cast("date")
    return (per.join(c, per.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)   # 25 rows (fixed dimension)
            .select(
                F.col("c_custkey").alias("subject_id"),
                F.col("c_mktsegment").alias("stratum"),
                F.col("n_regionkey").cast("string").alias("region"),
                F.when(F.col("c_acctbal") < V3_GROUP2_BALANCE, F.lit("low")).otherwise(F.lit("high"))
                 .alias("group2"),
                (F.lit(10) + F.col("c_custkey") % 95).cast("double").alias("age"),
                "start", "event_date",
                F.datediff(F.coalesce("event_date", end), F.col("start")).alias("time"),
                F.col("event_date").isNotNull().cast("int").alias("event")))


EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
RACES = ("Asian", "Black", "White", "Native", "Multiple", "Declined", "NULL")


def wide_patients(spark: SparkSession, sf: str) -> DataFrame:
    """V4: a wide 'patient' table as the cohort script receives it.

    One row per user of ``events``.  Flag/date per event type: first event of
    that type with value >= V4_FLAG_VALUE.  Dates are strings in M/d/yyyy with
    '#N/A' for missing, death '#N/A' → 'NULL' string, as in the raw file.
    Birth date, sex and race are derived from the user id.
    """
    e = load(spark, sf, "events", ["user_id", "ts", "event_type", "value"])
    flag_dt = {t: F.min(F.when((F.col("event_type") == t) & (F.col("value") >= V4_FLAG_VALUE),
                               F.col("ts").cast("date"))).alias(f"{t}_dt") for t in EVENT_TYPES}
    death = F.max(F.when(F.col("value") >= V4_DEATH_VALUE, F.col("ts").cast("date"))
                  ).alias("death_dt")
    g = e.groupBy("user_id").agg(*flag_dt.values(), death)

    def as_text(c, missing):
        return F.coalesce(F.date_format(c, "M/d/yyyy"), F.lit(missing))

    race_idx = F.pmod(F.col("user_id") * 3 + 1, F.lit(len(RACES))).cast("int")
    return g.select(
        "user_id",
        as_text(F.date_add(F.lit("1940-01-01").cast("date"),
                           F.pmod(F.col("user_id") * 7919, F.lit(20000)).cast("int")), "#N/A")
         .alias("birth_date"),
        as_text(F.col("death_dt"), "NULL").alias("death_date"),
        F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        F.element_at(F.array(*[F.lit(r) for r in RACES]), race_idx + 1).alias("race"),
        *[F.col(f"{t}_dt").isNotNull().cast("int").alias(f"{t}_flag") for t in EVENT_TYPES],
        *[as_text(F.col(f"{t}_dt"), "#N/A").alias(f"{t}_dt") for t in EVENT_TYPES])


def risk_rows(spark: SparkSession, sf: str) -> DataFrame:
    """V5: labelled documents; ``toxic`` is the rare target."""
    d = load(spark, sf, "documents", ["doc_id", "n_chars", "lang", "source"])
    lab = load(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    return d.join(lab, "doc_id")


def risk_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """V5 with two inputs that have gaps: length and language of the next document,
    missing where that one has no label."""
    v = risk_rows(spark, sf)
    after = v.select((F.col("doc_id") - 1).alias("doc_id"), F.col("n_chars").alias("next_chars"), F.col("lang").alias("next_lang"))
    return v.join(after, "doc_id", "left")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """V6: embedding vectors (vec_id, embedding array<float>, label)."""
    return load(spark, sf, "embeddings", ["vec_id", "embedding", "label"])

# Cohort parameters for V4 (events span January 2024).
V4_DX_CUTOFF = "2024-01-29"     # dx dates must be before this (or missing)
V4_STUDY_END = "2024-01-28"
V4_EARLY_DATE = "2024-01-02"    # keep dx_date after this
