"""Descriptive tables (AGG-09..22, WIN-07, MOD-15).

All of these are grouped aggregates with partial (map-side) aggregation, so a
hot group costs one partial row per task.  Windows only run over the
*aggregated* tables, whose size is the number of levels, never the row count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.models import levels_of
from tessera.operators.quantiles import quantiles
from tessera.session import materialize, per_group


def freq(df: DataFrame, col: str) -> DataFrame:
    """AGG-09 / WIN-07 / MOD-15: level, n, pct, cumulative n and pct, n_levels.

    The cumulative window runs over the level table (one row per level).
    """
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w_all = Window.partitionBy()
    w_cum = Window.orderBy(F.col(col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(w_all)
    return c.select(col, "n",
                    (F.col("n") * 100.0 / total).alias("pct"),
                    F.sum("n").over(w_cum).alias("cum_n"),
                    (F.sum("n").over(w_cum) * 100.0 / total).alias("cum_pct"),
                    F.count(F.lit(1)).over(w_all).alias("n_levels"))


def crosstab_complete(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG-10 / AGG-22: counts for every (a, b) level pair, zeros included.

    The grid of all level pairs is the result itself; it is read off the
    counts, so the rows are aggregated once.
    """
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    la, lb = counts.select(a).distinct(), counts.select(b).distinct()
    grid = la.crossJoin(lb)
    return grid.join(counts, [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))


def column_percent(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG-11: share of each b level within each a level (complete grid)."""
    ct = crosstab_complete(df, a, b)
    w = Window.partitionBy(a)
    return ct.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(w))


def group_means(df: DataFrame, by: list[str], x: str) -> DataFrame:
    """AGG-14: mean of x per (by...) in long form."""
    return df.groupBy(*by).agg(F.avg(x).alias(f"mean_{x}"), F.count(F.lit(1)).alias("n"))


def pivot_mean(df: DataFrame, row: str, col: str, x: str, levels: list) -> DataFrame:
    """AGG-15: wide mean matrix; explicit ``levels`` avoid the extra distinct job."""
    return df.groupBy(row).pivot(col, levels).agg(F.avg(x))


def transpose(wide: DataFrame, key: str, new_key: str) -> DataFrame:
    """AGG-16: swap rows and columns of a small summary matrix (unpivot → pivot).

    The input is a summary (one row per level), so its size is bounded by the
    level counts.
    """
    value_cols = [c for c in wide.columns if c != key]
    long = wide.unpivot(key, value_cols, new_key, "value")
    row_levels = levels_of(wide, [key])[key]
    return long.groupBy(new_key).pivot(key, row_levels).agg(F.first("value"))


def value_counts(df: DataFrame, x: str, by: list[str]) -> DataFrame:
    """(by, x) with ``__n`` rows each, NULLs left out, written once: the tables below read this
    instead of the rows."""
    return materialize(df.filter(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count(F.lit(1)).alias("__n")))


def histogram(df: DataFrame, x: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """AGG-18: equal-width bins over [min, max] of x (per group if ``by``);
    n and density n / (N · width).  The last bin is closed on the right."""
    return _histogram(value_counts(df, x, by or []), x, bins, by or [])


def _histogram(counts: DataFrame, x: str, bins: int, by: list[str]) -> DataFrame:
    bounds = counts.groupBy(*by).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"), F.sum("__n").alias("__total"))
    j = counts.join(per_group(bounds), by) if by else counts.crossJoin(F.broadcast(bounds))     # one row
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(x) - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    j = j.withColumns({"bin": idx, "__w": width})
    g = j.groupBy(*by, "bin", "__lo", "__w", "__total").agg(F.sum("__n").alias("n"))
    return g.select(*by, "bin",
                    (F.col("__lo") + F.col("bin") * F.col("__w")).alias("bin_lo"),
                    (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("bin_hi"),
                    "n",
                    F.when(F.col("__w") > 0, F.col("n") / (F.col("__total") * F.col("__w")))
                     .alias("density"))


def box_stats(df: DataFrame, x: str, by: list[str]) -> DataFrame:
    """AGG-19: five-number summary (type-7 quantiles), whiskers at 1.5·IQR and
    the outlier count, per group.  Quantiles are exact, by rank."""
    counts = value_counts(df, x, by)
    q = counts.groupBy(*by).agg(F.sum("__n").alias("n"), F.min(x).alias("min"), F.max(x).alias("max")).join(
        quantiles(counts, by, x, {"q1": 0.25, "median": 0.5, "q3": 0.75}, "__n"), by).select(
        *by, "n", "min", "q1", "median", "q3", "max")
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"fence_lo": F.col("q1") - 1.5 * F.col("iqr"),
                       "fence_hi": F.col("q3") + 1.5 * F.col("iqr")})
    q = per_group(q)
    j = counts.join(q.select(*by, "fence_lo", "fence_hi"), by)
    inside = (F.col(x) >= F.col("fence_lo")) & (F.col(x) <= F.col("fence_hi"))
    w = j.groupBy(*by).agg(F.min(F.when(inside, F.col(x))).alias("whisker_lo"),
                           F.max(F.when(inside, F.col(x))).alias("whisker_hi"),
                           F.sum(F.when(inside, 0).otherwise(F.col("__n"))).alias("n_outliers"))
    return q.join(w, by)


def density(df: DataFrame, x: str, by: list[str], grid_points: int = 64, bins: int = 256,
            bandwidth: float | None = None) -> DataFrame:
    """AGG-20: Gaussian kernel density per group on an evenly spaced grid.

    The data is first reduced to ``bins`` equal-width bin counts per group
    (AGG-18), then every grid point sums kernel weights over the bins:
    cost is groups × grid × bins, independent of the row count.  Bandwidth
    defaults to Silverman's rule, 0.9·min(sd, IQR/1.34)·n^(-1/5), per group.
    """
    counts = value_counts(df, x, by)
    h = _histogram(counts, x, bins, by)
    v, n = F.col(x).cast("double"), F.col("__n")
    stats = counts.groupBy(*by).agg(F.sum("__n").alias("__n"), F.min(x).alias("__lo"), F.max(x).alias("__hi"),
                                    (F.sum(v * n) / F.sum(n)).alias("__mean"))
    if bandwidth is None:
        spread = quantiles(counts, by, x, {"__q1": 0.25, "__q3": 0.75}, "__n")
        around = counts.join(per_group(stats.drop("__n")), by) if by else counts.crossJoin(F.broadcast(stats.drop("__n")))  # one row
        sd = around.groupBy(*by).agg(F.sqrt(F.sum(n * F.pow(v - F.col("__mean"), 2)) / (F.sum(n) - 1)).alias("__sd"))
        for own in (spread, sd):
            stats = stats.join(own, by) if by else stats.crossJoin(own)     # one row each
        bw = 0.9 * F.least(F.col("__sd"), (F.col("__q3") - F.col("__q1")) / 1.34) * F.pow(F.col("__n"), -0.2)
    else:
        bw = F.lit(float(bandwidth))
    stats = stats.withColumn("__bw", bw)
    grid = stats.select(*by, "__n", "__bw", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1)))
                        .alias("point"), "__lo", "__hi").withColumn(
        "x", F.col("__lo") + F.col("point") * (F.col("__hi") - F.col("__lo")) / F.lit(grid_points - 1))
    middle, one = (F.col("bin_lo") + F.col("bin_hi")) / 2, F.lit(1).alias("__one")
    bars = h.groupBy(*by, *([] if by else [one])).agg(      # at most ``bins`` bars a group
        F.collect_list(F.struct(middle.alias("c"), F.col("n").alias("m"))).alias("__bars"))
    j = grid.join(bars, by) if by else grid.withColumn("__one", F.lit(1)).join(bars, "__one")
    j = j.withColumn("__bar", F.explode("__bars"))
    u = (F.col("x") - F.col("__bar.c")) / F.col("__bw")
    k = F.exp(-0.5 * u * u) / F.lit(math.sqrt(2 * math.pi))
    return (j.groupBy(*by, "point", "x", "__n", "__bw")
            .agg((F.sum(F.col("__bar.m") * k) / (F.col("__n") * F.col("__bw"))).alias("density"))
            .drop("__n", "__bw"))


def attrition(df: DataFrame, steps: list[tuple[str, object]]) -> DataFrame:
    """FLT-15: rows left after each cumulative filter step, in one scan.

    ``steps``: (name, Column condition); conditions are ANDed cumulatively.
    Three-valued logic: a NULL condition removes the row, like ``filter``.
    """
    aggs, cond = [F.count(F.lit(1)).alias("s0")], None
    for i, (_, c) in enumerate(steps, 1):
        cond = c if cond is None else (cond & c)
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"s{i}"))
    wide = df.agg(*aggs)
    names = ["input"] + [n for n, _ in steps]
    stack = ", ".join(f"{i}, '{n}', s{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (step_no, step, n_rows)")
