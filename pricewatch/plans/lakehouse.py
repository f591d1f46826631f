"""Raw -> cleaned -> aggregated tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.functions import times
from pricewatch.operators import alerts, clean, correlate, enrich, moments, volatility
from pricewatch.operators.dedup import spread
from pricewatch.session import stored
from pricewatch.sinks import documents
from pricewatch.sources.snapshots import SnapshotTable


#: File layout of the layers.
PARTITIONS = {"silver": ("reject_reason",)}


@dataclass(frozen=True)
class Lakehouse:
    spark: SparkSession
    root: str
    settings: clean.Settings = clean.Settings()

    def table(self, layer: str, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{layer}/{name}", partition_by=PARTITIONS.get(layer, ()))

    def bronze(self, name: str, messages: DataFrame, source: str) -> SnapshotTable:
        """Append messages with their provenance."""
        table = self.table("bronze", name)
        table.append(enrich.add_provenance(messages, source))
        return table

    def silver(self) -> None:
        """Rewrite both cleaned tables from the raw ones.

        Rejected rows are kept beside the clean ones, in partitions of their own: one pass gives
        the table, the rejects and the counts.
        """
        for name, rule in (("prices", clean.tagged_prices), ("news", clean.tagged_news)):
            rows = rule(spread(self.table("bronze", name).read()), self.settings)
            self.table("silver", name).overwrite(enrich.add_audit(rows))

    def cleaned(self, name: str) -> DataFrame:
        return clean.accepted(self.table("silver", name).read())

    def accounting(self) -> DataFrame:
        """Rows removed by each cleaning rule of both tables, counted from the written tables."""
        parts = [
            clean.accounting(name, self.table("bronze", name).read(), self.table("silver", name).read(), rules(self.settings))
            for name, rules in (("prices", clean.price_rules), ("news", clean.news_rules))
        ]
        return parts[0].unionByName(parts[1])

    def gold(self) -> None:
        """Rewrite the four aggregated tables. They are unsorted; readers sort what they show.

        The aggregates come from one moments table, for which the cleaned prices are read once; the alerts need their rows.
        """
        prices, news = self.cleaned("prices"), self.cleaned("news")
        hourly = stored(volatility.hourly_moments(prices), "hourly-moments")
        by_commodity = moments.combine(hourly, ["commodity"])
        tables = {
            "volatility": volatility.filled(volatility.cv_table(by_commodity)),
            "trend": volatility.trend_table(hourly),
            "alert": alerts.price_alert(prices),
            "news_correlation": correlate.news_dispersion(news, volatility.cv_table(by_commodity, mean_scale=0)),
        }
        for name, rows in tables.items():
            self.table("gold", name).overwrite(enrich.add_audit(rows, "_gold_created_at"))

    def review_critical(self, status: str = "CRITICAL - under review") -> int:
        """Mark critical commodities; the version before stays readable."""
        return self.table("gold", "volatility").update(F.col("status") == "CRITICAL", {"status": F.lit(status)})

    def export(self) -> DataFrame:
        return export_document(*[self.table("gold", name).read() for name in documents.EXPORT_LIMITS], source=self.root)


EXPORT_ORDER = {
    "volatility": [F.desc, "cv_index", "commodity"],
    "trend": [F.asc, "commodity", "obs_date", "hour"],
    "alert": [F.desc, "pct_change", "commodity", "event_time"],
    "news_correlation": [F.desc, "n_news", "commodity"],
}


def export_sections(*tables: DataFrame) -> dict[str, tuple[DataFrame, list, int]]:
    """Each gold table with its order and row limit for the export."""
    out = {}
    for (name, n), table in zip(documents.EXPORT_LIMITS.items(), tables):
        first, lead, *ties = EXPORT_ORDER[name]
        out[name] = (table, [first(lead), *[F.asc(c) for c in ties]], n)
    return out


def export_document(*tables: DataFrame, generated_at: Column | None = None, source: str = "gold", pipeline: str = "price-monitor") -> DataFrame:
    """The four gold tables as one JSON document, with when, from what and by which pipeline it was made."""
    at = generated_at if generated_at is not None else times.iso_text(F.current_timestamp().cast("timestamp_ntz"))
    meta = F.struct(at.alias("generated_at"), F.lit(source).alias("source"), F.lit(pipeline).alias("pipeline"))
    sections = {"metadata": tables[0].sparkSession.range(1).select(meta.alias("metadata"))}
    sections |= {
        name: documents.rows_as_array(documents.iso_times(table), order, n)
        for name, (table, order, n) in export_sections(*tables).items()
    }
    return documents.as_json(documents.document(sections))
