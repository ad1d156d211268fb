"""Running values along an ordered column without a window over a whole group (WIN-01..03).

A window over (group, order) is one task per group, so a group that holds all
rows is one task.  Here the rows are range-partitioned by (group, order) and
written once; the ranges' totals (a row a group and range) are run over by a
small window, and each range starts from what lies before it.  A task then holds
one range.  Tables of at most ``ONE_TASK`` rows are left to a plain window: the
result is the same, and the size of that task is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranking import ranged
from tessera.session import materialize

ONE_TASK = 200_000


def ordered(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df``, one row per (keys, order), written once; with its range as ``__range`` if it is large."""
    t = materialize(df)
    return t if t.limit(ONE_TASK + 1).count() <= ONE_TASK else ranged(t, [*keys, order])


def running(df: DataFrame, keys: list[str], order: str, values: dict[str, tuple[str, str]],
            descending: bool = False, own: bool = True) -> DataFrame:
    """``df`` (see :func:`ordered`) with running values: ``values`` maps a new column to (kind, column).

    Kinds: ``sum`` (NULLs count 0; 0 before the first row) and ``last`` (the last value that is
    not NULL).  ``own`` tells whether a row's own value is in, ``descending`` runs from the end.
    """
    by = F.col(order).desc() if descending else F.col(order).asc()
    frame = (Window.unboundedPreceding, 0 if own else -1)

    def over(kind: str, x, w):
        return F.coalesce(F.sum(x).over(w), F.lit(0)) if kind == "sum" else F.last(x, True).over(w)

    if "__range" not in df.columns:
        w = Window.partitionBy(*keys).orderBy(by).rowsBetween(*frame)
        return df.withColumns({new: over(kind, F.col(c), w) for new, (kind, c) in values.items()})
    # a row a group and range: what the range adds, then what lies before it
    ends = {"sum": lambda c: F.sum(c),
            "last": lambda c: (F.min_by if descending else F.max_by)(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))}
    totals = df.groupBy(*keys, "__range").agg(*[ends[kind](c).alias(new) for new, (kind, c) in values.items()])
    before = Window.partitionBy(*keys).orderBy(F.col("__range").desc() if descending else F.col("__range").asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select(*keys, "__range", F.lit(0).alias("__row"),
                          *[over(kind, F.col(new), before).alias(f"__before_{new}") for new, (kind, _) in values.items()])
    rows = df.withColumn("__row", F.lit(1)).unionByName(first, allowMissingColumns=True)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy(*keys, "__range").orderBy("__row", by).rowsBetween(*frame)
    out = rows.repartitionById(parts, "__range").withColumns({       # one range a task
        new: over(kind, F.when(F.col("__row") == 0, F.col(f"__before_{new}")).otherwise(F.col(c)), w) for new, (kind, c) in values.items()})
    return out.filter("__row = 1").drop("__row", *[f"__before_{new}" for new in values])


def dense_rank(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """``df`` (distinct (keys, order) rows) with 0-based consecutive ranks along ``order``."""
    t = ordered(df.withColumn("__one", F.lit(1).cast("long")), keys, order)
    return running(t, keys, order, {name: ("sum", "__one")}, own=False).drop("__one", "__range")
