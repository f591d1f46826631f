"""Versions of a table as plain Parquet, for one writer.

An overwrite at version B begins a folder ``_base=B``; appends after it add to that folder. Rows carry the version that wrote them, so the table
as of version V is the newest base up to V, filtered on the version. What is complete is seen from the names of the folders: no log is
kept. Appends are merged as they pile up (:mod:`pricewatch.streaming.spans`), so a reader opens few folders, and columns that later versions
add are merged by Spark when it reads. A streaming job names versions by its batch ids, so a replayed batch is known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.session import drop_folder, subfolders
from pricewatch.streaming import spans

#: Versions that one merged folder of appends holds at most.
WIDEST = 1000


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        """``partition_by``: the columns that lay out the files of a version, such as a date. They come last when read."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = partition_by

    # -- versions ---------------------------------------------------------------------------
    def _base_path(self, base: int) -> str:
        return f"{self.path}/_base={base}"

    def _bases(self) -> list[int]:
        """Versions at which the table was written anew, oldest first; incomplete ones left out."""
        found = sorted(int(name.removeprefix("_base=")) for name in subfolders(self.spark, self.path))
        return [b for b in found if spans.complete(self.spark, self._base_path(b))]

    def _latest(self) -> int | None:
        bases = self._bases()
        return bases[-1] + spans.complete(self.spark, self._base_path(bases[-1]))[-1][1] if bases else None

    def empty(self) -> bool:
        """Whether there is no version yet."""
        return self._latest() is None

    def latest_version(self) -> int:
        version = self._latest()
        if version is None:
            raise ValueError(f"no complete version in {self.path}")
        return version

    def versions(self) -> list[int]:
        """All readable versions."""
        return [b + i for b in self._bases() for _, end in spans.complete(self.spark, self._base_path(b))[-1:] for i in range(end + 1)]

    def done(self, version: int) -> bool:
        """Whether a version is complete already: a streaming batch may be replayed."""
        latest = self._latest()
        return latest is not None and latest >= version

    # -- read -------------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: the latest)."""
        latest = self.latest_version()
        wanted = latest if version is None else version
        bases = [b for b in self._bases() if b <= wanted]
        if not bases or wanted > latest:
            raise ValueError(f"version {version} is not in {self.path}")
        rows = spans.read_merged(self.spark, self._base_path(bases[-1]), wanted - bases[-1])
        return rows.filter(F.col("_version") <= wanted).drop("_version", "_operation")

    def history(self, *measures: Column) -> DataFrame:
        """version, operation, mode, n_rows and the given aggregates of the rows that each readable version wrote."""
        parts = [spans.read_merged(self.spark, self._base_path(b)).withColumn("_base", F.lit(b)) for b in self._bases()]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        mode = F.when(F.col("_base") == F.col("_version"), "overwrite").otherwise("append")
        found = rows.groupBy(F.col("_version").alias("version"), F.col("_operation").alias("operation"), mode.alias("mode"))
        return found.agg(F.count(F.lit(1)).alias("n_rows"), *measures)

    # -- write ------------------------------------------------------------------------------
    def append(self, df: DataFrame, operation: str = "APPEND", version: int | None = None) -> int:
        """Add rows as a new version. A first append begins a base."""
        bases = self._bases()
        if not bases:
            return self.overwrite(df, operation, version)
        version = self.latest_version() + 1 if version is None else version
        self._write(df, bases[-1], version, operation)
        return version

    def overwrite(self, df: DataFrame, operation: str = "OVERWRITE", version: int | None = None) -> int:
        """Write the table anew; versions before stay readable until :meth:`vacuum`."""
        if version is None:
            latest = self._latest()
            version = 0 if latest is None else latest + 1
        self._write(df, version, version, operation)
        return version

    def _write(self, df: DataFrame, base: int, version: int, operation: str) -> None:
        rows = df.withColumns({"_version": F.lit(version), "_operation": F.lit(operation)})
        spans.write(rows, self._base_path(base), version - base, None, self.partition_by, WIDEST, evolving=True)

    def update(self, condition: Column, values: dict[str, Column]) -> int:
        """New version in which matching rows take the given values; a null test leaves a row as it is. Writes every row: for tables
        whose history matters; :class:`pricewatch.sources.partitioned.PartitionedTable` rewrites partitions with hits only."""
        hit = F.coalesce(condition, F.lit(False))
        changed = self.read().withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})
        return self.overwrite(changed, "UPDATE")

    def delete(self, condition: Column) -> int:
        return self.overwrite(self.read().filter(~F.coalesce(condition, F.lit(False))), "DELETE")

    def vacuum(self, keep: int) -> None:
        """Remove all but the ``keep`` newest bases. Older ones went at earlier calls, so only what is new to go is listed."""
        for base in self._bases()[:-keep]:
            drop_folder(self.spark, self._base_path(base))

    def diff(self, before: int, after: int, key: list[str], columns: list[str]) -> DataFrame:
        """Rows that differ between two versions: ``added``, ``removed`` or ``changed``."""
        return compare(self.read(before), self.read(after), key, columns)


def compare(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Differences of two tables by key, with the old and new value of each column.

    Both sides are put below each other and met in one aggregation, so a shuffle of each side serves, without a join. Keys are unique on each side.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, F.lit(name).alias("_side"), F.struct(*columns).alias("_row"))

    def only(name: str):
        return F.first(F.when(F.col("_side") == name, F.col("_row")), ignorenulls=True)

    both = side(before, "b").unionByName(side(after, "a")).groupBy(*key).agg(only("b").alias("_b"), only("a").alias("_a"))
    kind = (
        F.when(F.col("_b").isNull(), "added")
        .when(F.col("_a").isNull(), "removed")
        .when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    )
    return (
        both.withColumn("change", kind)
        .filter(F.col("change").isNotNull())
        .select(
            *key,
            "change",
            *[F.col(f"_b.{c}").alias(f"{c}_before") for c in columns],
            *[F.col(f"_a.{c}").alias(f"{c}_after") for c in columns],
        )
    )
