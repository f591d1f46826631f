"""The given test tables seen as price observations, news articles and mixed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.operators.enrich import keyword_tag

#: Keyword lists that stand in for commodity words: the texts are invented prose.
KEYWORDS = {"view": ["the"], "click": ["der"], "error": ["que"], "purchase": ["license"], "signup": ["purchase"]}
MENTIONS = {c: words[0] for c, words in KEYWORDS.items()}
VALID = ["view", "click", "error", "purchase", "general"]
EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations from ``events``: one commodity per event type."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("event_type").alias("commodity"),
        F.initcap("event_type").alias("label"),
        F.col("value").alias("price"),
        ts.alias("event_time"),
        F.hour(ts).alias("hour"),
        F.dayofweek(ts).alias("dow"),
        F.date_format(ts, "yyyy-MM-dd").alias("day"),
        F.col("props"),
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations from orders: commodity = priority, region = the customer's nation."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.col("o_orderkey").cast("string").alias("message_id"),
        F.col("o_orderpriority").alias("commodity"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("event_time"),
        F.col("n_name").alias("region"),
    )


def list_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations from ``part``: commodity = type, price = retail price."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("message_id"),
        F.col("p_type").alias("commodity"),
        F.initcap("p_type").alias("label"),
        F.col("p_retailprice").alias("price"),
        F.lit(EPOCH).cast("timestamp_ntz").alias("event_time"),
    )


def _news_time(doc_id: Column) -> Column:
    """Documents carry no time; their id spreads them over the 720 hours of the events."""
    return F.timestamp_add("HOUR", (doc_id % 720).cast("int"), F.lit(EPOCH).cast("timestamp_ntz"))


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries from ``documents``: first line as title, the whole text as summary."""
    at = _news_time(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.md5("text").alias("link"),
        F.col("text").alias("summary"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("published"),
        F.lit(None).cast("string").alias("updated"),
        F.col("source").alias("source_feed"),
        at.alias("event_time"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged articles: the commodity is the first keyword hit in the whole text."""
    entries = feed_entries(spark, sf_dir).withColumn("hour", F.hour("event_time"))
    tagged = keyword_tag(entries, F.col("summary"), KEYWORDS, "general")
    return tagged.select("doc_id", "title", "link", "summary", "event_time", "hour", "commodity")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages with the text of their title element."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("link"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("summary"),
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and news messages in one raw table, as two topics landing in one folder.

    Price messages carry only the ISO time, news messages only the plain one.
    """
    prices = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("event_type").alias("commodity"),
        F.initcap("event_type").alias("label"),
        F.col("value").alias("price"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_iso"),
        F.lit("prices").alias("topic"),
    )
    articles = feed_entries(spark, sf_dir).withColumns({"topic": F.lit("news"), "ts_text": F.col("published")})
    articles = keyword_tag(articles, F.col("summary"), KEYWORDS, "general")
    return schemas.to_mixed(prices).unionByName(schemas.to_mixed(articles))
