"""Cohort cleaning and derivation from a wide patient-style table
(FLT-05..11, DAT-01..05, MTH-05..08, SUR-01, PRJ-07).

The whole derivation is one projection + filters over the scan: no shuffle.
The attrition table (FLT-15) evaluates every step in a single aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.binning import bin_right_closed
from tessera.functions.dates import parse_date, row_max, years_between
from tessera.session import materialize


def clean_sentinels(df: DataFrame, sentinels=("NULL", "#N/A"), columns=None) -> DataFrame:
    """FLT-05: sentinel strings → SQL NULL on every (or the given) string column."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]

    def clean(c):
        x = F.col(c)
        for s in sentinels:
            x = F.nullif(x, F.lit(s))
        return x
    return df.withColumns({c: clean(c) for c in cols})


def parse_dates(df: DataFrame, cols, fmt: str = "M/d/yyyy") -> DataFrame:
    """DAT-01: parse several text date columns."""
    return df.withColumns({c: parse_date(F.col(c), fmt) for c in cols})


def any_not_null(cols) -> Column:
    """FLT-06: False only when every listed column is NULL."""
    return F.coalesce(*[F.col(c) for c in cols]).isNotNull()


def all_before_or_null(cols, cutoff: str) -> Column:
    """FLT-08: every date is before ``cutoff`` or missing (no dummy dates, Q14)."""
    d = F.lit(cutoff).cast("date")
    return reduce(lambda a, b: a & b, [F.col(c).isNull() | (F.col(c) < d) for c in cols])


def flag_sum(flags) -> Column:
    """MTH-08: row-wise sum of 0/1 flags."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(0)) for f in flags])


def first_flagged(flags, values, labels=None) -> Column:
    """MTH-05: value (or label) of the first set flag, nested-if order."""
    out = None
    for i, (f, v) in enumerate(zip(flags, values)):
        val = F.lit(labels[i]) if labels else F.col(v)
        cond = F.col(f) == 1
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def derive(df: DataFrame, flags, dates, labels, birth: str, death: str, study_end: str,
           age_edges=(10, 20, 30, 40, 50, 60, 70, 80, 90, 100), parity: bool = False) -> DataFrame:
    """Derived columns of the cohort script.

    dx_age, death_age (years), age_cat (right-closed bins, Q17), cancer_type,
    dx2death (years), dx_date = latest of the dx dates (NULLs skipped, Q18),
    tt_event (days) and death flag (SUR-01).

    Default censoring (Q15/Q16): follow-up ends at min(death, study_end);
    death = 1 iff death <= study_end.  ``parity=True`` keeps the reference's
    rule (time runs to a post-study death, flag < study_end + 1 day).
    """
    end = F.lit(study_end).cast("date")
    dx_of_type = first_flagged(flags, dates)
    out = df.withColumns({
        "dx_age": years_between(dx_of_type, F.col(birth)),
        "death_age": years_between(F.col(death), F.col(birth)),
        "cancer_type": first_flagged(flags, dates, labels),
        "dx_date": row_max(*[F.col(c) for c in dates]),
        "study_end": end,
    })
    out = out.withColumns({
        "age_cat": bin_right_closed(F.col("dx_age"), list(age_edges)),
        "dx2death": F.col("death_age") - F.col("dx_age"),
    })
    if parity:
        tt = F.when(F.col("dx2death").isNotNull(), F.col("dx2death") * 365.25) \
            .otherwise(F.datediff(end, F.col("dx_date")).cast("double"))
        died = (F.col(death).isNotNull() & (F.col(death) <= end)).cast("int")
    else:
        stop = F.least(F.coalesce(F.col(death), end), end)
        tt = F.datediff(stop, F.col("dx_date")).cast("double")
        died = (F.col(death).isNotNull() & (F.col(death) <= end)).cast("int")
    return out.withColumns({"tt_event": tt, "death": died})


def cohort_steps(flags, dates, dx_cutoff: str, early_date: str, race: str):
    """The reference's attrition sequence as (name, condition) pairs; the
    conditions reference columns produced by :func:`derive`."""
    return [
        ("has_dx_date", any_not_null(dates)),
        ("dx_before_cutoff", all_before_or_null(dates, dx_cutoff)),
        ("single_type", flag_sum(flags) == 1),
        ("non_negative_dx2death", F.col("dx2death").isNull() | (F.col("dx2death") >= 0)),
        ("dx_after_early_date", F.col("dx_date") > F.lit(early_date).cast("date")),
        ("race_known", F.col(race).isNotNull()),
    ]


def apply_steps(df: DataFrame, steps) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [c for _, c in steps]))


def fill_missing(df: DataFrame, cols, value) -> DataFrame:
    """FLT-07: NULL → a dummy constant (offered for parity; the default
    pipeline keeps NULLs and writes NULL-aware predicates, Q14)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in cols})


def subset_levels(df: DataFrame, col: str, levels) -> tuple[DataFrame, DataFrame]:
    """FLT-12: keep two (or more) category levels; the re-derived level set is
    the distinct values of the result (empty levels disappear, as with R's
    ``factor()`` re-levelling)."""
    sub = df.filter(F.col(col).isin(list(levels)))
    return sub, sub.select(col).distinct()


def surrogate_id(df: DataFrame, order_by: list[str], name: str = "row_id") -> DataFrame:
    """PRJ-07: consecutive 1-based ids in ``order_by`` order without a global
    window.  The range-sorted rows are written once with
    ``monotonically_increasing_id`` (partition number above 33 bits of row
    number); row counts per partition and the ids are both read from that
    table, so they always speak of the same partitions.  An id is the rows of
    the partitions before plus the row number; the offsets are one row per
    partition."""
    s = materialize(df.orderBy(*order_by).withColumn("__mid", F.monotonically_increasing_id()))
    pid = F.shiftright("__mid", 33)
    counts = s.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    row = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (s.withColumn("__pid", pid).join(F.broadcast(offs), "__pid")     # one row per partition
            .withColumn(name, F.col("__off") + row + 1).drop("__pid", "__mid", "__off"))
