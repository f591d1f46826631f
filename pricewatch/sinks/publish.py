"""Keyed message output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.functions import text


def keyed_prices(messages: DataFrame) -> DataFrame:
    """Key = commodity, value = the message as JSON."""
    return messages.select(F.col("commodity").alias("key"), F.to_json(F.struct("*")).alias("value"))


def keyed_news(messages: DataFrame) -> DataFrame:
    """Key = digest of the article id, value = the message as JSON."""
    key = F.md5(text.article_id(F.col("link"), F.col("title"), F.col("published")))
    return messages.select(key.alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Wait for all replicas, compress, batch for half a second."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.compression.type": "gzip",
        "kafka.linger.ms": "500",
    }


def write_kafka(keyed: DataFrame, servers: str, topic: str) -> None:
    """Needs Spark's Kafka package on the class path."""
    keyed.write.format("kafka").options(**kafka_options(servers, topic)).save()


def not_yet_sent(keyed: DataFrame, sent: DataFrame) -> DataFrame:
    """Messages whose key is not among the sent ones."""
    return keyed.join(sent.select("key").distinct(), "key", "left_anti")
