"""Data-quality checks, all as one aggregation over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ORDERED = ("string", "int", "bigint", "double", "float", "boolean", "timestamp", "timestamp_ntz", "date")


def profile(df: DataFrame) -> DataFrame:
    """Rows, nulls, minimum and maximum (as text) of every column: one row per column."""
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls{i}"))
        ordered = kinds[c] in _ORDERED
        aggs.append((F.min(f"`{c}`").cast("string") if ordered else F.lit(None).cast("string")).alias(f"min{i}"))
        aggs.append((F.max(f"`{c}`").cast("string") if ordered else F.lit(None).cast("string")).alias(f"max{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("n_rows"),
                F.col(f"nulls{i}").alias("n_nulls"),
                F.col(f"min{i}").alias("min_value"),
                F.col(f"max{i}").alias("max_value"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def schema_check(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column with ``present`` and the table's row count."""
    have = set(df.columns)
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("present")) for c in required]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("n_rows", F.inline(rows))


def cardinality_check(df: DataFrame, column: str, expected: int) -> DataFrame:
    """Whether a column has the expected number of distinct values."""
    found = df.select(column).distinct().agg(F.count(column).alias("n_distinct"))
    return found.withColumn("expected", F.lit(expected).cast("bigint")).withColumn(
        "ok", F.col("n_distinct") == F.col("expected")
    )


def dashboard_totals(prices: DataFrame, news: DataFrame) -> DataFrame:
    """Row counts, number of commodities and a flag for each non-empty input."""
    p = prices.groupBy("commodity").agg(F.count(F.lit(1)).alias("n"))
    p = p.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_prices"), F.count("commodity").alias("n_commodities"))
    n = news.agg(F.count(F.lit(1)).alias("n_news"))
    totals = p.unionByName(n, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("n_prices", "n_commodities", "n_news")]
    )
    return totals.withColumns({"live_ok": F.col("n_prices") > 0, "news_ok": F.col("n_news") > 0})
