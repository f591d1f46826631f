"""Batch readers for landed message files and live views."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.streaming import spans

CORRUPT = "_corrupt_record"


def rename_wire(df: DataFrame) -> DataFrame:
    """Wire field names to column names."""
    return df.withColumnsRenamed({w: o for w, o in schemas.WIRE_NAMES.items() if w in df.columns})


def read_messages(spark: SparkSession, path: str, wire: bool = False, multi_line: bool = True) -> DataFrame:
    """All message files of a folder in the mixed shape, absent fields null.

    A file that is not valid JSON gives one row whose ``_corrupt_record`` holds its text; use
    :func:`well_formed` to leave such rows out. ``multi_line`` is for files holding one JSON
    array; line-delimited files are read with ``multi_line=False`` and can be split. Folders named
    ``key=value`` below the path are followed.
    """
    schema = schemas.MIXED_WIRE if wire else schemas.MIXED
    df = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    df = df.select(*[c for c in df.columns if c != "_topic"])
    return rename_wire(df) if wire else df


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Messages that :func:`pricewatch.streaming.jobs.land_grouped` has landed, in the mixed shape, with the columns of their layout, by which
    Spark prunes folders."""
    return spans.read(spark, path, f"{schemas.MIXED}, _topic string, _date string", "json")


def well_formed(df: DataFrame) -> DataFrame:
    """Rows of valid files. (Spark wants a data column in the query too: count a named column.)"""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_live(spark: SparkSession, path: str, schema: str, wire: bool = False) -> tuple[DataFrame, str]:
    """A live view and its status: ``local``, ``empty`` or ``failed``.

    Accepts a JSON array of rows and the envelope ``{topic, timestamp, count, data: [...]}``. A
    missing or unreadable file gives an empty table of the same schema.
    """
    empty = spark.createDataFrame([], schema)
    enveloped = f"{schema}, data array<struct<{_nested(schema)}>>, count bigint, {CORRUPT} string"
    try:
        raw = (
            spark.read.schema(enveloped)
            .option("multiLine", True)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
        )
    except AnalysisException:
        return _named(empty, wire), "failed"
    columns = empty.columns
    inside = raw.filter(F.col("data").isNotNull()).select(F.inline("data"))
    plain = raw.filter(F.col("data").isNull() & F.col("count").isNull() & F.col(CORRUPT).isNull()).select(*columns)
    rows = plain.unionByName(inside)
    if not rows.isEmpty():
        return _named(rows, wire), "local"
    seen = raw.agg(F.count(CORRUPT).alias("broken"), F.count("count").alias("envelopes")).first()
    return _named(empty, wire), "failed" if seen.broken else "empty"


def _named(df: DataFrame, wire: bool) -> DataFrame:
    return rename_wire(df) if wire else df


def _nested(schema: str) -> str:
    return ", ".join("{}: {}".format(*field.split(" ", 1)) for field in schema.split(", "))


def count_rows(**tables: DataFrame) -> DataFrame:
    """One row per named table with its row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")) for df in tables.values()]
    named = [n.select(F.lit(k).alias("table_name"), "n_rows") for k, n in zip(tables, counts)]
    return reduce(DataFrame.unionByName, named)
