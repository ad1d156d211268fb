"""Schema listing, column labels, previews and table summaries (SRC-05..08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.quantiles import quantiles


EXACT = 16      # distinct values are exact up to 2 ** EXACT, beyond within about 0.4 %


def schema_listing(df: DataFrame) -> DataFrame:
    """SRC-05: one row per column (position, name, type, nullable, label) with its rows, NULLs and
    distinct values, from one pass of mergeable counts and theta sketches.

    Values of other than numeric, text or binary type are compared by their text; types without
    one (maps, variants) have no distinct count.
    """
    def plain(f):
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("integer", "long", "float", "double", "string", "binary"):
            return c
        return F.to_json(c) if f.dataType.typeName() in ("array", "struct") else c.cast("string")

    fields, told = df.schema.fields, {}
    for i, f in enumerate(fields):
        told[f"null{i}"] = F.count_if(F.col(f"`{f.name}`").isNull())
        if f.dataType.typeName() not in ("map", "variant"):
            told[f"seen{i}"] = F.theta_sketch_estimate(F.theta_sketch_agg(plain(f), F.lit(EXACT)))
    r = df.agg(F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in told.items()]).first()
    at = r.asDict()
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("label"), r.n, at[f"null{i}"], at.get(f"seen{i}"))
            for i, f in enumerate(fields)]
    return df.sparkSession.createDataFrame(
        rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN, label STRING, "
              "n_rows LONG, n_null LONG, n_distinct LONG")


def with_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """SRC-06: attach descriptive labels as column metadata (names unchanged)."""
    for c, label in labels.items():
        df = df.withMetadata(c, {"label": label})
    return df


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """SRC-07: the first ``n`` rows (a preview is the feature)."""
    return df.limit(n)


def column_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """SRC-08: per numeric/date column: n, n_null, min, q1, median, mean, q3, max.

    Values are unpivoted to (column, value) rows; the counts and extremes are one
    aggregation, the quantiles are exact, by rank.
    """
    cols = columns or [f.name for f in df.schema.fields
                       if f.dataType.typeName() in ("integer", "long", "double", "float",
                                                    "short", "decimal")]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("v")).select("v.*")
    x = F.col("value")
    plain = long.groupBy("column_name").agg(F.count(x).alias("n"), F.count_if(x.isNull()).alias("n_null"),
                                            F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max"))
    q = quantiles(long, ["column_name"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return plain.join(q, "column_name", "left").select(
        "column_name", "n", "n_null", "min", "q1", "median", "mean", "q3", "max")
