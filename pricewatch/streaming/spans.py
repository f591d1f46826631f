"""Per-batch folders of which a reader opens a bounded number.

Batch N is written as ``_from=N/_to=N``. When ``FAN`` spans of one width are complete, they are merged into one of ``FAN`` times the width,
so ten thousand batches are read from some twenty folders. Which spans make up the batches 0 to N depends on N alone, so a replayed
batch writes the same folders again. Merged spans stay for one more batch, for readers that listed them before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricewatch.session import drop_folder, folder_exists, subfolders

FAN = 10
Span = tuple[int, int]


def cover(last: int, widest: int | None = None) -> list[Span]:
    """The spans, widest first, that make up the batches 0 to ``last``; none is wider than ``widest``."""
    out, at = [], 0
    while at <= last:
        width = 1
        while at % (width * FAN) == 0 and at + width * FAN - 1 <= last and (widest is None or width * FAN <= widest):
            width *= FAN
        out.append((at, at + width - 1))
        at += width
    return out


def _folder(path: str, span: Span) -> str:
    return f"{path}/_from={span[0]}/_to={span[1]}"


def _open(spark: SparkSession, path: str, spans: list[Span], schema: T.StructType | str | None, kind: str = "parquet") -> DataFrame:
    """Rows of the spans; without a schema, all columns that any of them has."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.option("basePath", path).format(kind).load([_folder(path, s) for s in spans]).drop("_from", "_to")


def write(df: DataFrame, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame] | None = None, partition_by: tuple[str, ...] = (), widest: int | None = None, kind: str = "parquet", evolving: bool = False) -> None:
    """Write a batch; ``merge`` reduces the rows of the spans that are put together. ``evolving``: batches may bring columns of their own."""
    spark, own = df.sparkSession, (batch_id, batch_id)
    spans = cover(batch_id, widest)
    df.write.mode("overwrite").partitionBy(*partition_by).format(kind).save(_folder(path, own))
    if spans[-1] != own:
        before = [s for s in cover(batch_id - 1, widest) if s[0] >= spans[-1][0]]
        rows = _open(spark, path, [*before, own], None if evolving else df.schema, kind)
        (merge(rows) if merge else rows).write.mode("overwrite").partitionBy(*partition_by).format(kind).save(_folder(path, spans[-1]))
    for gone in {*cover(batch_id - 2, widest), (batch_id - 1, batch_id - 1)} - {*cover(batch_id - 1, widest), *spans}:
        drop_folder(spark, _folder(path, gone))


def complete(spark: SparkSession, path: str) -> list[Span]:
    """The spans to read, from the names of the folders: the widest complete one from each batch on."""
    found: dict[int, int] = {}
    for start in subfolders(spark, path):
        for end in subfolders(spark, f"{path}/{start}"):
            if folder_exists(spark, f"{path}/{start}/{end}/_SUCCESS"):
                a, b = int(start.removeprefix("_from=")), int(end.removeprefix("_to="))
                found[a] = max(found.get(a, a), b)
    spans, at = [], 0
    while at in found:
        spans.append((at, found[at]))
        at = found[at] + 1
    if any(a >= at for a in found):
        raise ValueError(f"batch {at} is missing in {path}")
    return spans


def read(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The rows of all complete batches. ``schema`` may name partition columns."""
    spans, empty = complete(spark, path), spark.createDataFrame([], schema)
    return _open(spark, path, spans, schema, kind).select(*empty.columns) if spans else empty


def read_merged(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """The same without a schema: all columns that any batch has. ``last`` leaves out spans that begin after that batch."""
    return _open(spark, path, [s for s in complete(spark, path) if last is None or s[0] <= last], None)
