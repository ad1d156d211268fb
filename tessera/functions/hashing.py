"""Deterministic, order-independent pseudo-random draws.

``hash32(seed, k1, k2, ...)`` = first 32 bits of md5('seed|k1|k2|...') as a
non-negative BIGINT.  It depends only on the key values, never on partitioning
or row order, so a split/sample is reproducible on any cluster shape.  The same
value is computed in DuckDB by ``('0x' || substr(md5(concat_ws('|', ...)), 1, 8))::BIGINT``
which makes sampled results checkable against an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def hash32(seed, *cols) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def sql_hash32(seed, *exprs: str) -> str:
    """DuckDB twin of :func:`hash32` (for oracle SQL)."""
    inner = ", ".join([f"'{seed}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT"


def cumulative_cutoffs(weights: list[float]) -> list[int]:
    """Integer upper bounds on the 32-bit hash for each split weight, so split
    membership is an exact integer comparison on both engines."""
    total = float(sum(weights))
    out, acc = [], 0.0
    for w in weights:
        acc += w / total
        out.append(min(TWO_32, int(round(acc * TWO_32))))
    out[-1] = TWO_32
    return out
