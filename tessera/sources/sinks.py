"""Sinks (SNK-01..06).

The reference funnels outputs through ``coalesce(1)``; at scale that puts the
whole result through one task, so ``single_file`` is opt-in and the default
writes one file per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timestamp_suffix(df: DataFrame) -> str:
    """STR-13: ``yyyy-MM-dd-'T'HHmmss`` of the current time (one driver value)."""
    return df.sparkSession.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd-'T'HHmmss")).first()[0]


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite", single_file: bool = False) -> None:
    """SNK-01/02/04: delimited text. Spark's default quoting is kept (the
    reference's ``quote=""`` makes Spark emit NUL quote characters)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_quoted(df: DataFrame, path: str, sep: str = ",", null_value: str = r"\N", mode: str = "overwrite") -> None:
    """SNK-02 for texts of any kind: header, every value quoted, quotes doubled, white space at the ends
    kept and NULL written as ``null_value``, so ``read_delimited(header=True, escape='"',
    multiline=True, null_value=...)`` gives the same rows.  One file a partition: readers cannot split one."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", null_value).option("emptyValue", "").csv(path))


def write_ordered(df: DataFrame, path: str, key: str, **kw) -> None:
    """SNK-04: output ordered by ``key``; a range-partitioned sort keeps the
    order across part files without a single-task funnel."""
    write_delimited(df.orderBy(key), path, **kw)


def write_split(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """SNK-03: labelled and unlabelled rows to separate directories in one job."""
    df.write.mode(mode).partitionBy(split_col).format(fmt).save(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-05/06: typed parquet hand-off between jobs (types survive)."""
    df.write.mode(mode).parquet(path)
