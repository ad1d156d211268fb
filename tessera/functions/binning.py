"""Interval binning (MTH-06, Q17): right-closed bins ``(lo, hi]``; outside → NULL.

``width_bucket`` and ``Bucketizer`` are left-closed, so they give the wrong
bin at the edges; an explicit CASE is exact and stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fmt(v) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


def right_closed_labels(edges) -> list[str]:
    return [f"({_fmt(lo)},{_fmt(hi)}]" for lo, hi in zip(edges[:-1], edges[1:])]


def bin_right_closed(x: Column, edges, labels=None) -> Column:
    labels = labels or right_closed_labels(edges)
    expr = None
    for (lo, hi), lab in zip(zip(edges[:-1], edges[1:]), labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def sql_bin_right_closed(x: str, edges, labels=None) -> str:
    labels = labels or right_closed_labels(edges)
    whens = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'"
                     for (lo, hi), lab in zip(zip(edges[:-1], edges[1:]), labels))
    return f"(CASE {whens} END)"
