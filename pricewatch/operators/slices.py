"""Ordered windows over keys that may hold a large share of all rows.

``Window.partitionBy(commodity)`` would send every row of a commodity to one task. Here the rows
of a key are cut into slices along the order, the window runs inside each slice, and the few rows
at the start of a slice, whose look-back crosses into earlier slices, are computed again from the
rows at the slice borders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pricewatch.session import stored


def _slices(df: DataFrame, keys: list[str], order_by: list[str], slices: int | None) -> DataFrame:
    """Add ``_slice``: rows range-partitioned on key and order, which splits keys and even single
    instants of any size evenly."""
    ranged = [F.col(c) for c in keys + order_by]
    df = df.repartitionByRange(slices, *ranged) if slices else df.repartitionByRange(*ranged)
    return df.withColumn("_slice", F.spark_partition_id())


def sliced_window(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    depth: int,
    exprs: dict[str, Callable[[WindowSpec], Column]],
    slices: int | None = None,
) -> DataFrame:
    """Add window columns that look back at most ``depth`` rows; equal to the plain window.

    ``order_by`` must order the rows of a key completely (end it with a message id). The sliced
    result is written once as Parquet, since two steps read it and must see the same slices.
    """
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    marked = stored(
        _slices(df, keys, order_by, slices).select(
            *df.columns,
            *[make(inside).alias(name) for name, make in exprs.items()],
            F.row_number().over(inside).alias("_n"),
            F.lead(F.lit(1), depth).over(inside).isNull().alias("_tail"),
        ),
        "slices",
    )
    # Rows with a full look-back inside their slice are done.
    done = marked.filter(F.col("_n") > depth).drop("_n", "_tail")
    # Around the start of a slice all rows that count are first or last ones of a slice: at most
    # 2 x depth rows per key and slice, so this window per key stays small.
    border = marked.filter((F.col("_n") <= depth) | F.col("_tail")).select(*df.columns, "_n")
    across = Window.partitionBy(*keys).orderBy(*order_by)
    starts = border.select("*", *[make(across).alias(name) for name, make in exprs.items()])
    return done.unionByName(starts.filter(F.col("_n") <= depth).drop("_n"))


def newest_per_key(df: DataFrame, keys: list[str], order_by: list[Column], n: int, salts: int | None = None) -> DataFrame:
    """Newest ``n`` rows of each key with their ``rank`` (1 = newest).

    The first ranking works on salted keys, so the candidates of a hot key are cut down in
    parallel; the second sees at most ``salts * n`` rows of a key. There are as many salts as
    shuffle partitions unless told otherwise.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = Window.partitionBy(*keys, "_salt").orderBy(*order_by)
    final = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .withColumn("rank", F.row_number().over(salted))
        .filter(F.col("rank") <= n)
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= n)
        .drop("_salt")
    )
