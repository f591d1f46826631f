"""Keep one row per key, the same one on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt by a digest of all that they hold, for :func:`keep_one` over Parquet of narrow rows.

    Tasks sort their rows before the shuffle to keep one a key, and a task that reads Parquet may hold very many: rows with
    many absent or repeated values take a few bytes there. Here a task holds no more than a shuffle partition, and adaptive execution splits
    a large one.
    """
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "array", "struct"))]
    return df.withColumn("_spread", F.xxhash64(*plain)).hint("rebalance", "_spread").drop("_spread")


def keep_one(df: DataFrame, keys: list[str], prefer: list[Column] | None = None) -> DataFrame:
    """One row per key; null keys count as equal.

    ``prefer`` decides the survivor, then the columns that are no text, then the digests of the
    texts, so that no text is compared or carried as a sort key. Last comes which texts are absent rather than
    empty, and nested columns as JSON. The rank filter is also applied
    before the shuffle, so a key with very many copies leaves at most one row per task.
    """
    kinds = {c: t for c, t in df.dtypes if c not in keys}
    nested = [c for c, t in kinds.items() if t.startswith(("map", "array", "struct"))]
    short = [F.col(c).asc_nulls_last() for c, t in kinds.items() if t != "string" and c not in nested]
    texts = [c for c, t in kinds.items() if t == "string"]
    digest = [F.md5(F.concat_ws("\x1f", *[F.md5(F.coalesce(c, F.lit(""))) for c in texts])).asc()] if texts else []
    rest = [F.col(c).isNull().cast("string") for c in texts] + [F.coalesce(F.md5(F.to_json(c)), F.lit("")) for c in nested]
    digest += [F.concat_ws("\x1f", *rest).asc()] if rest else []
    window = Window.partitionBy(*keys).orderBy(*(prefer or []), *short, *digest)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and removed rows of a deduplication, without ranking any row."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("n_removed", F.col("n_rows") - F.col("n_distinct"))
