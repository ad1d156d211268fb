"""Running values range by range: equal to plain windows, no task with a whole group, stratum or not."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import scan
from tessera.operators import survival as sv


@pytest.fixture
def by_ranges(monkeypatch):
    monkeypatch.setattr(scan, "ONE_TASK", 0)


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("descending,own", [(False, True), (True, True), (False, False), (True, False)])
def test_equal_to_plain_windows(spark, by_ranges, keys, descending, own):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "a", "a", "b"]), t, rnd.choice([None, rnd.randint(0, 9)]), rnd.choice([None, None, rnd.random()])) for t in range(3000)]
    df = spark.createDataFrame(rows, "g STRING, t INT, x INT, y DOUBLE").repartition(7)
    got = scan.running(scan.ordered(df, keys, "t"), keys, "t", {"s": ("sum", "x"), "l": ("last", "y")}, descending, own)
    by = F.col("t").desc() if descending else F.col("t").asc()
    w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    want = df.withColumns({"s": F.coalesce(F.sum("x").over(w), F.lit(0)), "l": F.last("y", True).over(w)})
    assert sorted(got.select("t", "s", "l").collect()) == sorted(want.select("t", "s", "l").collect())
    empty = scan.running(scan.ordered(df.limit(0), keys, "t"), keys, "t", {"s": ("sum", "x")}, descending, own)
    assert empty.count() == 0


def test_no_task_holds_a_whole_group(spark):
    """1,000,000 distinct times without stratum: rows are dealt evenly, and the sums are right."""
    n, parts = 1_000_000, int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("t"), F.lit(1).cast("long").alias("x"))
    out = scan.running(scan.ordered(df, [], "t"), [], "t", {"n_risk": ("sum", "x")}, descending=True)
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in per) == n and max(r.n for r in per) <= 2 * n / parts
    assert out.filter(F.col("n_risk") != n - F.col("t")).count() == 0
    km = sv.kaplan_meier(df.withColumn("e", F.lit(1)), "t", "e")
    assert km.filter(F.col("n_risk") != n - F.col("t")).count() == 0
    assert km.filter("t = 499999").first().surv == pytest.approx(0.5, abs=1e-9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Window")[1]


@pytest.mark.parametrize("stratum", [None, "s"])
def test_survival_by_ranges_equals_plain(spark, monkeypatch, stratum):
    rnd = random.Random(5)
    rows = [(rnd.choice("pq"), rnd.choice(["u", "v", "w"]), rnd.randint(1, 300), int(rnd.random() < 0.6), float(rnd.randint(0, 1)), rnd.gauss(0, 1))
            for _ in range(800)]
    df = spark.createDataFrame(rows, "s STRING, g STRING, t INT, e INT, x DOUBLE, z DOUBLE").repartition(5)

    def results():
        km = sv.kaplan_meier(df, "t", "e", "g", stratum)
        coefs, tests = sv.cox_ph(df, "t", "e", ["x", "z"], stratum)
        made = [km, sv.logrank_test(df, "t", "e", "g", stratum), sv.curve_crossings(km, "t", "g", "u", "v", stratum), coefs, tests,
                sv.concordance(df, "t", "e", ["x", "z"], coefs, stratum), sv.cox_curve(df, "t", "e", ["x", "z"], coefs, stratum)]
        return [sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in d.collect()), key=str) for d in made]

    plain = results()
    monkeypatch.setattr(scan, "ONE_TASK", 0)
    assert results() == plain


def test_concordance_of_a_continuous_score(spark, by_ranges):
    rnd = random.Random(9)
    rows = [(rnd.randint(1, 60), int(rnd.random() < 0.7), rnd.choice([rnd.gauss(0, 1), 0.5])) for _ in range(300)]
    df = spark.createDataFrame(rows, "t INT, e INT, z DOUBLE").repartition(3)
    coefs = spark.createDataFrame([("z", 0.8)], "term STRING, coef DOUBLE")
    r = sv.concordance(df, "t", "e", ["z"], coefs).first()
    better = worse = tied = 0
    for ta, ea, za in rows:
        for tb, eb, zb in rows:
            if ea and (tb > ta or (tb == ta and not eb)):
                better, worse, tied = better + (za > zb), worse + (za < zb), tied + (za == zb)
    assert (r.concordant, r.discordant, r.tied_risk) == (better, worse, tied)
