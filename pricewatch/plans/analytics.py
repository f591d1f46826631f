"""Batch analytics on live data: three analyses folded into one results document, and the page payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import dims
from pricewatch.operators import correlate, quality, volatility
from pricewatch.sinks import documents


def analyses(
    prices: DataFrame, news: DataFrame, keywords: Mapping[str, str] = dims.TITLE_KEYWORDS, column: str = "title"
) -> dict[str, tuple[DataFrame, list[Column]]]:
    """Each analysis with its report order."""
    ranges = volatility.range_volatility(prices)
    return {
        "volatility": (ranges, [F.desc("range_index"), F.asc("commodity"), F.asc("label")]),
        "price_trend": (
            volatility.trend_summary(prices).drop("range_pct", "is_high"),
            [F.desc("avg_price"), F.asc("commodity"), F.asc("label")],
        ),
        "news_correlation": (
            correlate.mention_correlation(ranges, news, keywords, column),
            [F.desc("n_mentions"), F.desc("range_index"), F.asc("commodity"), F.asc("label")],
        ),
    }


def analyses_row(
    prices: DataFrame, news: DataFrame, keywords: Mapping[str, str] = dims.TITLE_KEYWORDS, column: str = "title"
) -> DataFrame:
    sections = {
        name: documents.rows_as_array(documents.clean_numbers(df), order)
        for name, (df, order) in analyses(prices, news, keywords, column).items()
    }
    return documents.document(sections)


def results_document(
    prices: DataFrame,
    news: DataFrame,
    generated_at: Column,
    keywords: Mapping[str, str] = dims.TITLE_KEYWORDS,
    column: str = "title",
) -> DataFrame:
    """Metadata (time, source row counts) and the three analyses as one JSON row."""
    totals = quality.dashboard_totals(prices, news).select(
        F.struct(
            generated_at.alias("generated_at"),
            F.col("n_prices").alias("total_prices"),
            F.col("n_news").alias("total_news"),
        ).alias("metadata")
    )
    body = analyses_row(prices, news, keywords, column).select(F.struct("*").alias("analyses"))
    return documents.as_json(documents.document({"metadata": totals, "analyses": body}))


def dashboard_payload(
    live_prices: DataFrame,
    live_news: DataFrame,
    analyses_struct: DataFrame,
    server_time: Column,
    n: int = 20,
) -> DataFrame:
    """Newest prices and articles, the analyses and three status flags as one JSON row."""

    def newest(df: DataFrame, ties: list[str]) -> DataFrame:
        order = [F.col("arrived").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
        rows = documents.rows_as_array(df, order, n)
        return rows.select(F.transform("rows", lambda r: r.dropFields("arrived")).alias("rows"))

    merged = documents.document(
        {
            "live_prices": newest(live_prices, ["message_id"]),
            "news": newest(live_news, ["link", "title"]),
            "analyses": analyses_struct.select(F.struct("*").alias("analyses")),
        }
    )
    status = F.struct(
        F.col("analyses").isNotNull().alias("analyses_ok"),
        (F.size("live_prices") > 0).alias("live_ok"),
        (F.size("news") > 0).alias("news_ok"),
    )
    return documents.as_json(
        merged.select(server_time.alias("server_time"), "live_prices", "news", "analyses", status.alias("status"))
    )
