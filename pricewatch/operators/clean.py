"""Cleaning rules of the price and news tables, with per-rule row accounting.

Each table has an ordered list of rules. A row is tagged with the first rule it fails, so one pass
gives both the clean rows and the counts a step-by-step filter chain would report.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import dims
from pricewatch.functions import numbers, text, times
from pricewatch.operators.dedup import keep_one

PRICE_KEY = ["message_id", "commodity", "ts_text"]
NEWS_KEY = ["link"]


@dataclass(frozen=True)
class Settings:
    price_topic: str = "prices"
    news_topic: str = "news"
    price_min: float = dims.PRICE_MIN
    price_max: float = dims.PRICE_MAX
    valid: list[str] = field(default_factory=lambda: list(dims.VALID_COMMODITIES))
    #: True reads only the plain timestamp text; False also accepts the ISO and date+time fields.
    strict_time: bool = False


def priced(df: DataFrame, time_column: str | None = None) -> DataFrame:
    """Rows usable by the aggregates: a positive finite price and, if named, a known time. (NaN counts
    as larger than any number, so the upper bound takes it out too.)"""
    keep = F.col("price").isNotNull() & (F.col("price") > 0) & (F.col("price") < float("inf"))
    if time_column:
        keep &= F.col(time_column).isNotNull()
    return df.filter(keep)


def split_by_topic(df: DataFrame, topic: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of the topic, rows of other topics, and rows without a topic."""
    here = F.col("topic")
    return df.filter(here == topic), df.filter(here != topic), df.filter(here.isNull())


def price_in_range(price: Column, low: float = dims.PRICE_MIN, high: float = dims.PRICE_MAX) -> Column:
    return price.isNotNull() & (price > low) & (price < high)


def known_commodity(commodity: Column, valid: list[str]) -> Column:
    return commodity.isNotNull() & text.normal_key(commodity).isin(valid)


def event_time(s: Settings) -> Column:
    plain = times.parse_plain(F.col("ts_text"))
    if s.strict_time:
        return plain
    return times.resolve_event_time(F.col("ts_text"), F.col("ts_iso"), F.col("obs_date"), F.col("obs_time"))


def price_rules(s: Settings) -> list[tuple[str, Column]]:
    """(rule, condition a row must meet), in the order they apply after the duplicate rule."""
    is_price = F.col("topic") == s.price_topic
    return [
        ("missing_topic", F.col("topic").isNotNull()),
        ("invalid_price", ~is_price | price_in_range(F.col("price"), s.price_min, s.price_max)),
        ("invalid_commodity", known_commodity(F.col("commodity"), s.valid)),
        ("invalid_time", event_time(s).isNotNull()),
    ]


def news_rules(s: Settings) -> list[tuple[str, Column]]:
    return [
        ("blank_text", text.not_blank(F.col("title")) & text.not_blank(F.col("summary"))),
        ("invalid_commodity", known_commodity(F.col("commodity"), s.valid)),
        ("invalid_published", text.not_blank(F.col("published"), longer_than=10)),
        ("invalid_time", event_time(s).isNotNull()),
    ]


def tag(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add ``reject_reason``: the first failed rule, null for a clean row."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    return df.withColumn("reject_reason", reason)


def typed(df: DataFrame, s: Settings) -> DataFrame:
    """Final form of the columns: typed time, hour, day of week (1 = Sunday), plain commodity key."""
    return df.withColumn("event_time", event_time(s)).withColumns(
        {
            "hour": F.hour("event_time"),
            "dow": F.dayofweek("event_time"),
            "commodity": text.normal_key("commodity"),
        }
    )


def accepted(tagged: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def dedup_prices(df: DataFrame) -> DataFrame:
    return keep_one(df, PRICE_KEY, [F.col("ts_iso").desc_nulls_last()])


def dedup_news(df: DataFrame) -> DataFrame:
    return keep_one(df, NEWS_KEY, [F.col("ts_text").desc_nulls_last()])


def tagged_prices(df: DataFrame, s: Settings) -> DataFrame:
    """Deduplicated price rows in final form, each with its reject reason. Rows of other topics
    skip the price test."""
    return typed(tag(dedup_prices(df), price_rules(s)), s)


def tagged_news(df: DataFrame, s: Settings) -> DataFrame:
    return typed(tag(dedup_news(df), news_rules(s)), s)


def clean_prices(df: DataFrame, s: Settings) -> DataFrame:
    return accepted(tagged_prices(df, s))


def clean_news(df: DataFrame, s: Settings) -> DataFrame:
    return accepted(tagged_news(df, s))


def accounting(table: str, raw: DataFrame, tagged: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows before and after each rule, rows removed and the percentage (0 for no input).

    The counts come from two aggregations: the raw row count and one count per reason of the
    deduplicated, tagged rows.
    """
    order = ["duplicate"] + [name for name, _ in rules]
    names = ["n_raw", "n_unique"] + [f"n_{name}" for name, _ in rules]
    # The sum over a data column lets a JSON reader count without its corrupt-record column alone.
    total = raw.agg((F.count(raw.columns[0]) + F.count_if(F.col(raw.columns[0]).isNull())).alias("n_raw"))
    reasons = tagged.agg(
        F.count(F.lit(1)).alias("n_unique"),
        *[F.count_if(F.col("reject_reason") == name).alias(f"n_{name}") for name, _ in rules],
    )
    counts = total.unionByName(reasons, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])
    removed = [F.col("n_raw") - F.col("n_unique")] + [F.col(f"n_{name}") for name, _ in rules]
    steps, before = [], F.col("n_raw")
    for i, (name, gone) in enumerate(zip(order, removed), start=1):
        steps.append(
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("rule"),
                before.alias("n_before"),
                (before - gone).alias("n_after"),
                gone.alias("n_removed"),
            )
        )
        before = before - gone
    return (
        counts.select(F.inline(F.array(*steps)))
        .withColumn("removed_pct", F.coalesce(numbers.percent(F.col("n_removed"), F.col("n_before"), 1), F.lit(0.0)))
        .select(F.lit(table).alias("table_name"), "*")
    )


def price_accounting(raw: DataFrame, s: Settings) -> DataFrame:
    return accounting("prices", raw, tagged_prices(raw, s), price_rules(s))


def news_accounting(raw: DataFrame, s: Settings) -> DataFrame:
    return accounting("news", raw, tagged_news(raw, s), news_rules(s))


def cleaning_summary(steps: DataFrame) -> DataFrame:
    """First and last count per table and over all tables, from accounting rows."""
    tables = steps.groupBy("table_name").agg(
        F.max_by("n_before", -F.col("step")).alias("n_before"),
        F.max_by("n_after", "step").alias("n_after"),
    )
    total = tables.agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))
    both = tables.unionByName(total.withColumn("table_name", F.lit("ALL")))
    removed = F.col("n_before") - F.col("n_after")
    return both.select(
        "table_name",
        "n_before",
        "n_after",
        removed.alias("n_removed"),
        F.coalesce(numbers.percent(removed, F.col("n_before"), 1), F.lit(0.0)).alias("removed_pct"),
    )


def validate_prices(df: DataFrame, known: list[str], raw_price: str = "price") -> DataFrame:
    """Producer-side validation: add ``reject_reason``, the first failed test, null if valid.

    Tests in order: required fields, numeric, positive, upper bound, NaN, known commodity.
    """
    raw = F.col(raw_price)
    value = numbers.parsed(raw)
    tests = [
        ("missing_field", F.col("commodity").isNull() | raw.isNull() | F.col("unit").isNull()),
        ("not_numeric", value.isNull()),
        ("not_positive", value <= 0),
        ("too_high", ~F.isnan(value) & (value > dims.PRICE_MAX)),
        ("nan", F.isnan(value)),
        ("unknown_commodity", ~F.col("commodity").isin(known)),
    ]
    return df.withColumn("reject_reason", F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in tests]))


def validation_counts(validated: DataFrame) -> DataFrame:
    """Rows per outcome; valid rows appear as ``valid``."""
    outcome = F.coalesce("reject_reason", F.lit("valid")).alias("outcome")
    return validated.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))
