"""Splits, exact stratified partitions and negative sampling (SMP-01..06, WIN-05/06, JN-09).

All draws come from :func:`tessera.functions.hashing.hash32`, a function of
the key values and the seed only, so results do not depend on partitioning,
task retries or executor loss (a recomputed partition draws the same values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import per_group
from tessera.functions.hashing import cumulative_cutoffs, hash32

RADIX_BITS = 16
RADIX_MASK = (1 << RADIX_BITS) - 1


def hash_split(df: DataFrame, keys: list[str], weights, seed, names=None,
               split_col: str = "split") -> DataFrame:
    """SMP-01/02/04: weighted split by a keyed hash (no shuffle, narrow op)."""
    names = list(names or [str(i) for i in range(len(weights))])
    cuts = cumulative_cutoffs(list(weights))
    h = hash32(seed, *keys)
    expr = None
    for name, cut in zip(names, cuts):
        expr = F.when(h < F.lit(cut), F.lit(name)) if expr is None else expr.when(h < F.lit(cut), F.lit(name))
    return df.withColumn(split_col, expr)


def _cumulate(counts: DataFrame, group: list[str], order: str) -> DataFrame:
    w = (Window.partitionBy(*group).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("__cum", F.sum("__n").over(w)).withColumn(
        "__before", F.col("__cum") - F.col("__n"))


def flag_first_n(df: DataFrame, group: list[str], order: str, tie: str, need: DataFrame,
                 flag: str = "keep") -> DataFrame:
    """Flag the first ``need`` rows per group in (order, tie) order — exactly,
    without putting a whole group into one window partition.

    ``order`` is a BIGINT in [0, 2^32).  Radix selection: count rows per
    (group, high 16 bits) with map-side partial aggregation and locate the
    bucket holding the cut (a window over at most 65,536 counts per group);
    repeat on the low 16 bits for the rows of that bucket only.  The final
    pass compares every row with its group's two cut values; only rows whose
    whole 32-bit value equals the cut need a row number, taken within
    (group, value) partitions that hold about one row each.  A group with a
    third of the data costs two small aggregations, never one giant sort.

    ``need``: group columns + ``need`` (rows to keep per group).
    """
    x = df.withColumns({"__hi": F.shiftright(F.col(order), RADIX_BITS),
                        "__lo": F.col(order).bitwiseAND(F.lit(RADIX_MASK))})
    c1 = _cumulate(x.groupBy(*group, "__hi").agg(F.count(F.lit(1)).alias("__n")), group, "__hi")
    need = per_group(need)
    cut1 = per_group(c1.join(need, group)
                     .filter((F.col("__before") < F.col("need")) & (F.col("__cum") >= F.col("need")))
                     .select(*group, F.col("__hi").alias("__hi1"),
                             (F.col("need") - F.col("__before")).alias("__need2")))
    in_bucket = x.join(cut1, group).filter(F.col("__hi") == F.col("__hi1"))
    c2 = _cumulate(in_bucket.groupBy(*group, "__lo").agg(F.count(F.lit(1)).alias("__n")), group, "__lo")
    cut2 = (c2.join(cut1.select(*group, "__need2"), group)
            .filter((F.col("__before") < F.col("__need2")) & (F.col("__cum") >= F.col("__need2")))
            .select(*group, F.col("__lo").alias("__lo2"),
                    (F.col("__need2") - F.col("__before")).alias("__need3")))
    cuts = per_group(need.join(cut1, group, "left").join(cut2, group, "left"))    # one row per group
    j = x.join(cuts, group)
    hi, lo, hi1, lo2 = F.col("__hi"), F.col("__lo"), F.col("__hi1"), F.col("__lo2")
    edge = F.coalesce((hi == hi1) & (lo == lo2), F.lit(False))      # rows equal to the cut: about one per group
    keep = (F.when(hi1.isNull(), F.col("need") > 0)          # need >= size (all) or <= 0 (none)
            .when(hi != hi1, hi < hi1).otherwise(lo < lo2))
    rn = F.row_number().over(Window.partitionBy(*group, order).orderBy(tie))
    cut = j.filter(edge).withColumn(flag, rn <= F.col("__need3")).select(*df.columns, flag)
    return j.filter(~edge).withColumn(flag, keep).select(*df.columns, flag).unionByName(cut)


def tail_split(df: DataFrame, order_by: list[str], frac: float, flag: str = "split") -> DataFrame:
    """SMP-04: the last ``frac`` of the rows in ``order_by`` order is the validation part
    (as a framework's ``validation_split`` takes it); ranks as in ``cohort.surrogate_id``."""
    from tessera.operators.cohort import surrogate_id
    s = surrogate_id(df, order_by, "__row")
    cut = F.broadcast(s.agg(F.floor(F.count(F.lit(1)) * (1 - frac)).alias("__cut")))      # 1 row
    side = F.when(F.col("__row") <= F.col("__cut"), "train").otherwise("valid")
    return s.crossJoin(cut).withColumn(flag, side).drop("__row", "__cut")


def stratified_partition(df: DataFrame, target: str, key: str, frac: float, seed,
                         flag: str = "partition") -> DataFrame:
    """SMP-03 / WIN-06: exactly ceil(frac * n_level) rows of each target level
    get ``partition = 1`` (training), chosen by keyed hash order; others 0."""
    h = df.withColumn("__h", hash32(seed, key))
    need = h.groupBy(target).agg(F.ceil(F.count(F.lit(1)) * F.lit(float(frac))).alias("need"))
    out = flag_first_n(h, [target], "__h", key, need, flag="__keep")
    return out.withColumn(flag, F.col("__keep").cast("int")).drop("__keep", "__h")


def indexed_pool(items: DataFrame, item: str, by: str, k: int) -> DataFrame:
    """SMP-06: top-k items by ``by`` with a dense index 0..k-1.

    Bounded by k rows by construction, so the global window here sorts at most
    k rows and the pool may be broadcast.
    """
    top = items.orderBy(F.col(by).desc(), F.col(item).asc()).limit(k)
    w = Window.orderBy(F.col(by).desc(), F.col(item).asc())
    return top.select(item, (F.row_number().over(w) - 1).alias("idx"))


def sample_negatives(positives: DataFrame, pool: DataFrame, user: str, item: str, seed,
                     oversample: int = 3, exclude: DataFrame | None = None) -> DataFrame:
    """SMP-05 / JN-09: per user, as many sampled items as distinct positive
    items, drawn with replacement from ``pool`` (columns item, idx), skipping
    the user's items in ``exclude`` (default: the positives, Q5), trying at
    most |pool| draws — the reference's loop bound.

    Draw d of user u is ``pool[hash32(seed,u,d) mod |pool|]``; the result is
    the first n_pos surviving draws.  First pass: draws 1..min(oversample·n, |pool|);
    users left short get all |pool| draws in a second pass, so the answer is
    exact without drawing |pool| items for everyone.  Per-user work is
    bounded by |pool| (≤ k), so the per-user windows are bounded too.  The
    pool size travels as a column of a one-row broadcast: no driver action.
    """
    psize = F.broadcast(pool.agg(F.count(F.lit(1)).alias("__P")))    # 1 row
    excl = (exclude if exclude is not None else positives).select(user, item).distinct()
    pos_n = positives.select(user, item).distinct().groupBy(user).agg(
        F.count(F.lit(1)).alias("n_pos")).crossJoin(psize)
    bpool = F.broadcast(pool.select(item, "idx"))        # ≤ k rows

    def draw(users: DataFrame, upper) -> DataFrame:
        d = users.select(user, "n_pos", "__P", F.explode(F.sequence(F.lit(1), upper)).alias("draw"))
        d = d.withColumn("idx", F.pmod(hash32(seed, user, "draw"), F.col("__P")))
        d = d.join(bpool, "idx").drop("idx", "__P").join(excl, [user, item], "left_anti")
        rn = F.row_number().over(Window.partitionBy(user).orderBy("draw"))
        return d.withColumn("__rn", rn).filter(F.col("__rn") <= F.col("n_pos"))

    first = draw(pos_n, F.least(F.col("n_pos") * oversample, F.col("__P")))
    got = first.groupBy(user).agg(F.count(F.lit(1)).alias("__got"))
    short = (pos_n.join(got, user, "left")
             .filter((F.coalesce("__got", F.lit(0)) < F.col("n_pos"))
                     & (F.col("n_pos") * oversample < F.col("__P")))
             .select(user, "n_pos", "__P"))
    second = draw(short, F.col("__P"))
    done = first.join(short.select(user), user, "left_anti")
    return done.unionByName(second).select(user, "draw", item)
