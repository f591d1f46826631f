"""Lookups, keyword tagging, message envelopes and source fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import dims
from pricewatch.functions import numbers, text, times

SUMMARY_CHARS = 500  # length of a summary in the wire format of a news message; tagging reads the whole text


def add_provenance(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(source)})


def add_audit(df: DataFrame, column: str = "_cleaned_at", batch_time: str | None = None) -> DataFrame:
    """Audit time: the given batch time for repeatable runs, else the run's own clock."""
    at = F.lit(batch_time).cast("timestamp") if batch_time else F.current_timestamp()
    return df.withColumn(column, at)


def lookup(df: DataFrame, dim: DataFrame, key: str = "commodity") -> DataFrame:
    """Left lookup in a dimension; Spark broadcasts it if its measured bytes allow."""
    return df.join(dim, key, "left")


def normalise_name(name: Column, synonyms: Mapping[str, str] = dims.SYNONYMS) -> Column:
    """Feed name to commodity key: synonym if listed, else blanks become underscores."""
    plain = text.strip_space(F.lower(name))
    key = F.coalesce(*[F.when(plain == s, F.lit(k)) for s, k in synonyms.items()], text.underscored(plain))
    return key


def keyword_tag(
    df: DataFrame,
    body: Column,
    keywords: Mapping[str, Sequence[str]] = dims.NEWS_KEYWORDS,
    default: str = dims.GENERAL,
    whole_words: bool = False,
    out: str = "commodity",
) -> DataFrame:
    """Add the first commodity, in the order given, with a keyword in the text; ``default`` if none.

    Narrow expressions only: no join, no shuffle, any text length. The text is put in lower case
    once, in a projection of its own.
    """
    test = text.mentions_word if whole_words else text.mentions
    hits = []
    for commodity, words in keywords.items():
        any_word = test(F.col("_lower"), words[0])
        for word in words[1:]:
            any_word |= test(F.col("_lower"), word)
        hits.append(F.when(any_word, F.lit(commodity)))
    tag = F.coalesce(*hits, F.lit(default))
    return df.withColumn("_lower", F.lower(body)).withColumn(out, tag).drop("_lower")


def mention_tags(df: DataFrame, body: Column, keywords: Mapping[str, str] = dims.TITLE_KEYWORDS) -> DataFrame:
    """One row per text and mentioned commodity; a text may mention several."""
    low = F.col("_lower")
    hits = F.array_compact(F.array(*[F.when(text.mentions(low, w), F.lit(c)) for c, w in keywords.items()]))
    return df.withColumn("_lower", F.lower(body)).withColumn("mentioned", F.explode(hits)).drop("_lower")


def mention_counts(news: DataFrame, keywords: Mapping[str, str] = dims.TITLE_KEYWORDS, column: str = "title") -> DataFrame:
    """Texts mentioning each commodity: one pass, one row per commodity, zero counts included."""
    names = {c: f"n{i}" for i, c in enumerate(keywords)}
    lowered = news.select(F.lower(F.coalesce(column, F.lit(""))).alias("_lower"))
    totals = lowered.agg(*[F.count_if(text.mentions(F.col("_lower"), w)).alias(names[c]) for c, w in keywords.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("commodity"), F.lit(w).alias("keyword"), F.col(names[c]).alias("n_mentions"))
            for c, w in keywords.items()
        ]
    )
    return totals.select(F.inline(rows))


def price_envelope(df: DataFrame, now: Column, topic: str = "prices", pipeline: str = "price-monitor") -> DataFrame:
    """Complete price message for a validated record; absent optional fields get their default.

    ``now`` is the message time (zone-free).
    """
    have = set(df.columns)

    def get(name: str, dtype: str, default: Column | None = None) -> Column:
        c = F.col(name).cast(dtype) if name in have else F.lit(None).cast(dtype)
        return F.coalesce(c, default) if default is not None else c

    iso = times.iso_text(now)
    return df.select(
        F.substring(F.md5(F.concat("commodity", iso)), 1, 12).alias("message_id"),
        F.lit("1.0").alias("schema_version"),
        "commodity",
        get("label", "string").alias("label"),
        F.col("price").cast("double").alias("price"),
        get("unit", "string", F.lit("kg")).alias("unit"),
        get("region", "string", F.lit("Nasional")).alias("region"),
        get("ref_price", "bigint").alias("ref_price"),
        get("ref_change_pct", "double").alias("ref_change_pct"),
        get("source_name", "string", F.lit("unknown")).alias("source_name"),
        get("is_shock", "boolean", F.lit(False)).alias("is_shock"),
        get("obs_date", "string", F.date_format(now, "yyyy-MM-dd")).alias("obs_date"),
        get("obs_time", "string", F.date_format(now, "HH:mm:ss")).alias("obs_time"),
        iso.alias("ts_iso"),
        times.epoch_seconds(now).alias("ts_unix"),
        F.lit(pipeline).alias("pipeline"),
        F.lit(topic).alias("topic"),
    )


def news_envelope(
    df: DataFrame,
    now: Column,
    topic: str = "news",
    keywords: Mapping[str, Sequence[str]] = dims.NEWS_KEYWORDS,
    default: str = dims.GENERAL,
    summary_chars: int | None = SUMMARY_CHARS,
) -> DataFrame:
    """News message from a feed entry (title, link, summary, published, updated, source_feed).

    The commodity is found in the whole title and summary. ``summary_chars`` is the wire format's
    limit on the summary; None sends it whole. Raw tables fed without messages hold whole texts.
    """
    clean = df.select(
        text.strip_space(F.coalesce("title", F.lit(""))).alias("title"),
        text.strip_space(F.coalesce("link", F.lit(""))).alias("link"),
        text.strip_tags(F.coalesce("summary", F.lit(""))).alias("body"),
        times.first_published(
            F.col("published"), F.col("updated"), F.date_format(now, "yyyy-MM-dd HH:mm:ss")
        ).alias("published"),
        "source_feed",
        F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
    )
    tagged = keyword_tag(clean, F.concat_ws(" ", "title", "body"), keywords, default)
    return tagged.select(
        "title",
        "link",
        (F.col("body") if summary_chars is None else F.substring("body", 1, summary_chars)).alias("summary"),
        "published",
        "source_feed",
        "commodity",
        "ts_text",
        F.lit(topic).alias("topic"),
    )


def price_list_records(raw: DataFrame, today: Column, source_name: str) -> DataFrame:
    """Price-list responses to records. ``raw`` has ``data``: array of items as text-typed structs
    (nama_komoditi, harga_rata, harga, wilayah). Unknown commodities and prices that are not
    positive are skipped."""
    item = raw.select(F.explode("data").alias("i"))
    price = F.coalesce(
        F.when(F.col("i.harga_rata").isNotNull(), numbers.parsed(F.col("i.harga_rata")))
        .otherwise(numbers.parsed(F.col("i.harga"))),
        F.lit(0.0),
    )
    rows = item.select(
        normalise_name(F.coalesce("i.nama_komoditi", F.lit(""))).alias("commodity"),
        price.alias("price"),
        F.coalesce("i.wilayah", F.lit("Nasional")).alias("region"),
        F.date_format(today, "yyyy-MM-dd").alias("obs_date"),
        F.lit(source_name).alias("source_name"),
    ).filter(F.col("commodity").isin(list(dims.LABELS)) & (F.col("price") > 0))
    return _with_label(rows)


def indicator_records(raw: DataFrame, source_name: str, today: Column) -> DataFrame:
    """Indicator responses ``[meta, [{value, date}]]`` to records in local currency.

    ``raw`` has ``commodity`` and ``body`` (JSON text). Responses without a value are skipped.
    """
    entry = F.from_json(
        F.get_json_object("body", "$[1]"), "array<struct<value: double, date: string>>"
    )
    first = F.try_element_at(entry, F.lit(1))
    rows = raw.select("commodity", first["value"].alias("value"), first["date"].alias("date"))
    rows = rows.filter(F.col("value").isNotNull()).select(
        "commodity",
        F.round(numbers.local_price(F.col("value"), F.col("commodity")), 2).alias("price"),
        F.lit("Global").alias("region"),
        F.coalesce("date", F.date_format(today, "yyyy-MM")).alias("obs_date"),
        F.lit(source_name).alias("source_name"),
    )
    return _with_label(rows)


def _with_label(rows: DataFrame) -> DataFrame:
    """Label and unit of the listed commodities; the dimension has a fixed handful of rows."""
    dim = dims.commodity_dim(rows.sparkSession).select("commodity", "label", "unit")
    return rows.join(F.broadcast(dim), "commodity", "left")


def add_reference_change(df: DataFrame) -> DataFrame:
    """Change of ``price`` against ``ref_price`` in percent."""
    return df.withColumn("ref_change_pct", numbers.change_pct(F.col("price"), F.col("ref_price")))


def by_reference_change(df: DataFrame) -> DataFrame:
    """Largest rise first; a missing change counts as 0."""
    return df.orderBy(F.coalesce("ref_change_pct", F.lit(0.0)).desc(), "commodity")


def missing_keys(wanted: DataFrame, have: DataFrame, key: str = "commodity") -> DataFrame:
    """Keys of ``wanted`` that ``have`` lacks."""
    return wanted.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")


def priority_fill(sources: Sequence[DataFrame], key: str = "commodity") -> DataFrame:
    """For every key, all rows of the first source that has it.

    ``sources`` are in falling priority and share their columns. The keys are reduced to one
    row each before they are compared, so the rows themselves are not shuffled by key.
    """
    ranked = [s.withColumn("_priority", F.lit(i)) for i, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, ranked)
    best = rows.groupBy(key).agg(F.min("_priority").alias("_best"))
    picked = rows.join(best, key)
    return picked.filter(F.col("_priority") == F.col("_best")).drop("_priority", "_best")


def first_available(sources: Sequence[DataFrame], key: str = "commodity") -> DataFrame:
    """The feed's own fall-through: the first source alone if it has any row; else the second
    completed by the third for the keys it lacks; else the third."""
    first, second, third = sources
    if not first.isEmpty():
        return first
    if second.isEmpty():
        return third
    return priority_fill([second, third], key)

