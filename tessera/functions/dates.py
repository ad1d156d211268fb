"""Date expressions (DAT-01..06, MTH-07)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def parse_date(c: Column, fmt: str = "M/d/yyyy") -> Column:
    """DAT-01/02: lenient parse; unparsable text becomes NULL (not an error)."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def years_between(later: Column, earlier: Column) -> Column:
    """DAT-03/05: day difference / 365.25 (double)."""
    return F.datediff(later, earlier) / F.lit(DAYS_PER_YEAR)


def row_max(*cols: Column) -> Column:
    """MTH-07: row-wise max; NULLs are skipped (no dummy dates needed, Q18)."""
    return F.greatest(*cols)
