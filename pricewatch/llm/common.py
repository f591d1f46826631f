"""Helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.session import new_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def utf8(text: Column) -> Column:
    """The text's bytes, empty for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe when executors go."""
    spark, path = df.sparkSession, new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions of at most about ``rows_each`` rows, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))


def names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def pick_rows(docs: DataFrame, id_col: str, key: Column, keepers: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``keepers`` (keep_id, key, keep_rows) name by id and content key, one of each.

    Rows that repeat both the id and the content are one document: where ``keep_rows`` is over 1, one of them is taken.
    """
    doc_key, doc_id, keep_key, keep_id = (fresh(c, docs) for c in ("_key", "_id", "_keep_key", "_keep_id"))
    keyed = docs.withColumns({doc_id: F.col(f"`{id_col}`").cast("long"), doc_key: key})

    def of(some: Column) -> DataFrame:
        side = keepers.filter(some).select(F.col("keep_id").alias(keep_id), F.col("key").alias(keep_key))
        return keyed.join(side, (F.col(doc_key) == F.col(keep_key)) & F.col(doc_id).eqNullSafe(F.col(keep_id)), "left_semi")

    repeated = of(F.col("keep_rows") > 1).dropDuplicates([doc_key, doc_id])
    return of(F.col("keep_rows") == 1).unionByName(repeated).select(*names(docs))


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """All of ``rows`` if they are at most ``n``, else about ``n`` by a hash of the key: no sort, and no
    task sends more than its share."""
    share = min(1.0, n / max(1, rows.count()))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids fall into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))
