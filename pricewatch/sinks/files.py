"""Batch output of messages, straight to the shared file system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land(messages: DataFrame, path: str) -> None:
    """Messages as line-delimited JSON in one folder per topic. The folder is named by a copy of the
    topic, so that each record keeps its own."""
    messages.withColumn("_topic", F.col("topic")).write.mode("append").partitionBy("_topic").json(path)
