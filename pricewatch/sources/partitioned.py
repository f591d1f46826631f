"""A table in partitions of which a change rewrites only those it touches, by Spark's dynamic partition overwrite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.session import drop_folder, folder_exists, stored


class PartitionedTable:
    """Plain Parquet below ``path``, laid out by the columns ``partition_by``, which come last. One writer; the present state only."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, partition_by: tuple[str, ...]):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by
        named = spark.createDataFrame([], schema).schema
        self.schema = T.StructType([f for f in named if f.name not in partition_by] + [named[p] for p in partition_by])

    def read(self) -> DataFrame:
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def same_partition(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(Column.__and__, (left[p].eqNullSafe(right[p]) for p in self.partition_by))

    def in_partitions(self, partitions: DataFrame) -> DataFrame:
        """The rows of the named partitions; Spark prunes the others."""
        rows = self.read()
        return rows.join(partitions, self.same_partition(rows, partitions), "left_semi")

    def _files(self, partitions: DataFrame) -> dict[str, set[str]]:
        """The files of the named partitions by folder."""
        found: dict[str, set[str]] = {}
        if folder_exists(self.spark, self.path):
            for (file,) in self.in_partitions(partitions).select("_metadata.file_path").distinct().collect():
                found.setdefault(file.rpartition("/")[0], set()).add(file)
        return found

    def replace(self, rows: DataFrame, touched: DataFrame) -> None:
        """Put ``rows`` in the place of all rows of the ``touched`` partitions. Others are neither read nor written.

        ``rows`` may come from this table, whose old files stay until all new ones are written. Partitions left without rows are removed.
        """
        before = self._files(touched)
        rows = rows.select(*self.schema.names).hint("rebalance", *self.partition_by)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by).parquet(self.path)
        after = self._files(touched) if before else {}
        for folder, files in before.items():
            if after.get(folder) == files:  # not written anew
                drop_folder(self.spark, folder)

    def _rewrite(self, condition: Column, change) -> None:
        hit = F.coalesce(condition, F.lit(False))
        touched = stored(self.read().filter(hit).select(*self.partition_by).distinct(), "touched")
        if not touched.isEmpty():
            self.replace(change(self.in_partitions(touched), hit), touched)

    def update(self, condition: Column, values: dict[str, Column]) -> None:
        """Matching rows take the given values; a null test leaves a row as it is. Partition columns stay."""
        self._rewrite(condition, lambda rows, hit: rows.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}))

    def delete(self, condition: Column) -> None:
        self._rewrite(condition, lambda rows, hit: rows.filter(~hit))
