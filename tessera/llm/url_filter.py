"""URL filters: list rules, then gradient-boosted trees on lexical features.

Host and path rules decide the urls they fit.  Those urls, with the rules' verdicts as
labels, train the trees that judge the rest.  Everything is DataFrame expressions and
Spark ML; only the model and the suffix rates of the training sample are shared.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read
from tessera.session import materialize

#: verdict, host, path (fixed by the contract).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
MAX_TRAIN = 20_000      # labelled urls the trees are fitted on, chosen by hash
TREES, LEVELS = 10, 4
FEATURES = ["n_chars", "host_chars", "labels", "depth", "digit_share", "entropy", "n_params", "query_chars",
            "hyphens", "longest_label", "escapes", "has_fragment", "secure", "suffix_rate"]


def parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path.  Null urls and those without ``://`` have both empty."""
    rest = F.expr("case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end")
    lower = F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("rest", F.coalesce(rest, F.lit(""))).withColumn("host", lower).withColumn(
        "path", F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)).drop("rest")


def listed(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (with host and path) with the longest fitting rule and its verdict, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("listed", verdict)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with the features of ``FEATURES`` but suffix_rate, and the host's last label as suffix."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))

    def count(chars: str):
        return (F.length(url) - F.length(F.translate(url, chars, ""))).cast("double")

    p = pages.withColumn("u", url).withColumn("query", F.regexp_extract(url, r"\?([^#]*)", 1))
    entropy = F.aggregate(F.array_distinct(F.split("u", "")), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(
        (lambda f: f * F.log2(f))((F.length("u") - F.length(F.replace("u", c, F.lit("")))) / F.greatest(F.length("u"), F.lit(1)))))
    labels = F.split("host", r"\.")
    return p.select(
        "*", F.length("u").cast("double").alias("n_chars"), F.length("host").cast("double").alias("host_chars"),
        F.size(labels).cast("double").alias("labels"),
        (F.length("path") - F.length(F.translate("path", "/", ""))).cast("double").alias("depth"),
        (count("0123456789") / n).alias("digit_share"), entropy.alias("entropy"),
        F.when(F.col("query") == "", 0.0).otherwise(F.size(F.split("query", "&")).cast("double")).alias("n_params"),
        F.length("query").cast("double").alias("query_chars"), count("-").alias("hyphens"),
        F.aggregate(labels, F.lit(0), lambda a, x: F.greatest(a, F.length(x))).cast("double").alias("longest_label"),
        count("%").alias("escapes"), F.col("u").contains("#").cast("double").alias("has_fragment"),
        F.col("u").startswith("https:").cast("double").alias("secure"),
        F.element_at(labels, -1).alias("suffix")).drop("u", "query")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score for each row of ``pages`` (page_id, url).

    The longest rule that fits decides (hosts and their subdomains, paths by their start); else
    the trees do, at a block score of one half.  If the rules label urls of one kind only, or
    none, there is nothing to learn and the rest takes that kind (allow without any).
    Repeated and null urls are judged like others; empty input gives no rows.
    """
    spark = pages.sparkSession
    known = listed(parts(pages.select("page_id", "url")), rules)
    known = materialize(lexical(known))
    counts = {r.listed: r.n for r in known.filter("listed is not null").groupBy("listed").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        other = next(iter(counts), "allow")
        return known.select("page_id", "host", "path", "rule", F.coalesce("listed", F.lit(other)).alias("verdict"),
                            F.lit(1.0 if other == "block" else 0.0).alias("block_score"))
    share = min(1.0, MAX_TRAIN / sum(counts.values()))
    sample = known.filter("listed is not null").filter(
        F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(share * (1 << 30))).withColumn(
        "label", (F.col("listed") == "block").cast("double"))
    sample = materialize(sample)
    prior = counts.get("block", 0) / sum(counts.values())
    # at most one row a training row, so MAX_TRAIN bounds what is broadcast
    rates = materialize(sample.groupBy("suffix").agg(((F.sum("label") + 10 * prior) / (F.count("*") + 10)).alias("rate")))

    def vectors(df: DataFrame) -> DataFrame:
        df = df.join(F.broadcast(rates), "suffix", "left").withColumn("suffix_rate", F.coalesce("rate", F.lit(prior))).drop("rate")
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    both = sample.agg(F.min("label"), F.max("label")).first()
    if both[0] == both[1]:
        score = F.lit(float(both[0] if both[0] is not None else 0.0))
        judged = known.withColumn("block_score", score)
    else:
        trees = GBTClassifier(maxIter=TREES, maxDepth=LEVELS, maxBins=32, seed=7, checkpointInterval=-1).fit(vectors(sample))
        judged = trees.transform(vectors(known)).withColumn("block_score", vector_to_array("probability")[1])
    own = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("listed", own).alias("verdict"), "block_score")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages", ["page_id", "url"]))
