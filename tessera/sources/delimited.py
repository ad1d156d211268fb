"""Delimited-text scans (SRC-01..04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = ",", header: bool = False, quote: str = '"',
                   escape: str | None = None, multiline: bool = False,
                   encoding: str = "UTF-8", infer: bool = False, null_value: str | None = None) -> DataFrame:
    """SRC-01 (TSV, declared schema), SRC-02 (quoted multi-line CSV), SRC-03
    (no schema: all strings), SRC-04 (inferred types).

    A declared schema is the production path: inference costs an extra pass
    over the input and multi-line files cannot be split across tasks, so they
    should come in many files.  ``null_value`` tells NULL from an empty text.
    """
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("quote", quote).option("multiLine", multiline)
              .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if escape is not None:
        reader = reader.option("escape", escape)
    if multiline:       # "\r" inside quotes is text
        reader = reader.option("lineSep", "\n")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast string columns read without a schema; bad values become NULL
    (``try_cast``) instead of failing the job under ANSI mode (Q24)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items()})
