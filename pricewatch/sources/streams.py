"""Stream readers. Offsets live in the query's checkpoint, so no row is lost or read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.sources.files import rename_wire


def kafka_options(
    servers: str, topics: list[str], starting: str = "earliest", rows_per_trigger: int | None = None
) -> dict[str, str]:
    """Option map of the Kafka source: one topic from the earliest offset for landing, several from
    the latest with a row limit per trigger for the splitter."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    return options


def read_kafka(spark: SparkSession, options: dict[str, str], wire: bool = True) -> DataFrame:
    """Messages of the topics, decoded. Needs Spark's Kafka package on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return decode(raw, wire)


def decode(raw: DataFrame, wire: bool = True) -> DataFrame:
    """``value`` JSON to the mixed shape."""
    schema = schemas.MIXED_WIRE if wire else schemas.MIXED
    message = F.from_json(F.col("value").cast("string"), schema)
    rows = raw.select(message.alias("m")).filter(F.col("m").isNotNull()).select("m.*")
    return rename_wire(rows) if wire else rows


def read_files(spark: SparkSession, path: str, schema: str = schemas.MIXED, files_per_trigger: int | None = None) -> DataFrame:
    """Line-delimited JSON files of a folder, each file once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)
