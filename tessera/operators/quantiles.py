"""Exact quantiles per group by rank, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.scan import ordered, running
from tessera.session import per_group


def quantiles(df: DataFrame, by: list[str], x: str, probs: dict[str, float], times: str | None = None) -> DataFrame:
    """One row per group with a column per name of ``probs``: type-7 quantiles of x.

    Rows (each counted ``times`` times, if that column is named) are collapsed to
    (group, value) counts; a value covers the ranks from the running count below it.
    The two ranks that a quantile lies between are looked up and interpolated.
    NULLs are left out; a group without values has no row.
    """
    c = df.filter(F.col(x).isNotNull()).groupBy(*by, F.col(x).cast("double").alias("__x")).agg(
        F.sum(times if times else F.lit(1)).alias("__n"))
    c = running(ordered(c, by, "__x"), by, "__x", {"__below": ("sum", "__n")}, own=False)
    names = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(p)).alias("p")) for k, p in probs.items()])
    want = c.groupBy(*by).agg(F.sum("__n").alias("__N")).withColumn("__q", F.explode(names))
    at = F.col("__q.p") * (F.col("__N") - 1)
    want = per_group(want.select(*by, F.col("__q.name").alias("__name"), at.alias("__at"), F.floor(at).alias("__low")))
    keys = [c[k].eqNullSafe(want[k]) for k in by]
    last = F.col("__below") + F.col("__n") - 1
    hit = (F.col("__below") <= F.col("__low") + 1) & (last >= F.col("__low"))
    on = hit
    for k in keys:
        on = on & k
    j = c.join(want, on).select(*[want[k].alias(k) for k in by], "__name", "__at", "__low", "__x", "__below", last.alias("__last"))
    low = F.max(F.when((F.col("__below") <= F.col("__low")) & (F.col("__last") >= F.col("__low")), F.col("__x")))
    high = F.max(F.when((F.col("__below") <= F.col("__low") + 1) & (F.col("__last") >= F.col("__low") + 1), F.col("__x")))
    v = j.groupBy(*by, "__name", "__at", "__low").agg(low.alias("__a"), high.alias("__b"))
    share = F.col("__at") - F.col("__low")
    value = F.when(share == 0, F.col("__a")).otherwise(F.col("__a") + share * (F.col("__b") - F.col("__a")))
    return v.groupBy(*by).agg(*[F.max(F.when(F.col("__name") == k, value)).alias(k) for k in probs])
