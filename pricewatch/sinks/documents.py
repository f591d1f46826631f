"""Result documents: a few bounded tables folded into one JSON row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.functions import numbers, times

#: Rows of each table in the dashboard export.
EXPORT_LIMITS = {"volatility": 50, "trend": 100, "alert": 50, "news_correlation": 50}


def clean_numbers(df: DataFrame) -> DataFrame:
    """Doubles without NaN or infinity and with two decimals, whole numbers without null."""
    plain = {"double": numbers.safe_float, "float": numbers.safe_float, "int": numbers.safe_int, "bigint": numbers.safe_int}
    return df.select(*[plain[t](F.col(c)).alias(c) if t in plain else F.col(c) for c, t in df.dtypes])


def iso_times(df: DataFrame) -> DataFrame:
    """Timestamps and dates as ISO text, as in a JSON export."""
    out = []
    for c, t in df.dtypes:
        if t in ("timestamp", "timestamp_ntz"):
            out.append(times.iso_text(F.col(c)).alias(c))
        elif t == "date":
            out.append(F.date_format(c, "yyyy-MM-dd").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def top(df: DataFrame, order_by: list[Column], n: int | None) -> DataFrame:
    """First ``n`` rows (all without ``n``) with their ``position``; only those reach one task."""
    first = df.orderBy(*order_by).limit(n) if n is not None else df
    return first.withColumn("position", F.row_number().over(Window.orderBy(*order_by)))


def rows_as_array(df: DataFrame, order_by: list[Column], n: int | None = None) -> DataFrame:
    """One row holding the first ``n`` rows as an ordered array; without ``n``, all rows.

    A section without a limit must be an aggregate with a row per commodity: a document is one row
    and as long as the list of commodities.
    """
    packed = F.array_sort(F.collect_list(F.struct("position", F.struct(*df.columns).alias("row"))))
    return top(df, order_by, n).agg(F.transform(packed, lambda x: x["row"]).alias("rows"))


def document(sections: dict[str, DataFrame]) -> DataFrame:
    """One row, one column per section, from one-row DataFrames with a ``rows`` or named value."""
    parts = [df.select(F.col(df.columns[0]).alias(name)) for name, df in sections.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.first(name, ignorenulls=True).alias(name) for name in sections])


def as_json(df: DataFrame, name: str = "document") -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def write_document(df: DataFrame, path: str) -> None:
    """Write a one-row document as a single JSON text."""
    df.coalesce(1).write.mode("overwrite").text(path)
