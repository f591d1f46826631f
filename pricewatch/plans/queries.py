"""Registry of the checked queries: name -> function of (session, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.functions import classes, numbers, text, times
from pricewatch.operators import alerts, clean, correlate, dedup, enrich, keywords, quality, sketches, stats, volatility
from pricewatch.plans import analytics, incremental, lakehouse
from pricewatch.session import new_dir
from pricewatch.sinks import documents, files as file_sink, live, publish
from pricewatch.sources import adapters as A
from pricewatch.sources import files, streams
from pricewatch.sources.partitioned import PartitionedTable
from pricewatch.sources.snapshots import SnapshotTable
from pricewatch.streaming import early_warning, hours, jobs, runner, unique

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SETTINGS = clean.Settings(valid=A.VALID)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- volatility and trend ---------------------------------------------------------------------
@query
def volatility_cv(spark: SparkSession, sf: str) -> DataFrame:
    return volatility.cv_volatility(A.ticks(spark, sf))


def _all_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, list prices and daily means: all three classes occur."""
    columns = ["commodity", "price"]
    daily = alerts.daily_mean(A.ticks(spark, sf)).select(*columns)
    orders = A.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("commodity"), F.col("o_totalprice").alias("price")
    )
    return orders.unionByName(A.list_prices(spark, sf).select(*columns)).unionByName(daily)


@query
def volatility_cv_classes(spark: SparkSession, sf: str) -> DataFrame:
    out = volatility.cv_volatility(_all_prices(spark, sf))
    return out.withColumn("severity", classes.severity(F.col("status")))


@query
def volatility_range(spark: SparkSession, sf: str) -> DataFrame:
    out = volatility.range_volatility(A.order_prices(spark, sf).withColumn("label", F.col("region")))
    return out.withColumn("recommendation", classes.recommendation(F.col("range_index")))


@query
def trend_summary(spark: SparkSession, sf: str) -> DataFrame:
    return volatility.trend_summary(A.ticks(spark, sf))


@query
def trend_periodic(spark: SparkSession, sf: str) -> DataFrame:
    return volatility.trend_periodic(A.ticks(spark, sf))


@query
def most_volatile(spark: SparkSession, sf: str) -> DataFrame:
    ranked = volatility.cv_volatility(_all_prices(spark, sf))
    return volatility.most_volatile(ranked, top=3).select("commodity", "cv_index", "status")


@query
def commodity_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return volatility.distribution(A.mixed(spark, sf))


# -- alerts -----------------------------------------------------------------------------------
@query
def price_alert(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.price_alert_daily(alerts.daily_mean(A.ticks(spark, sf)))


@query
def price_alert_scaled(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.price_alert(A.ticks(spark, sf))


@query
def alert_last3(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_last3(A.ticks(spark, sf))


@query
def rolling_avg(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.rolling_mean(A.ticks(spark, sf))


@query
def report_format(spark: SparkSession, sf: str) -> DataFrame:
    """Alert lines as they are shown: numbers, signs, arrows, the part before a separator."""
    rows = alerts.price_alert_daily(alerts.daily_mean(A.ticks(spark, sf)))
    pct = F.col("pct_change")
    return rows.select(
        "commodity",
        "obs_date",
        F.format_number("price", 2).alias("price_text"),
        F.format_string("%+.1f%%", F.round(pct, 1)).alias("pct_text"),
        F.abs(pct).alias("pct_abs"),
        classes.arrow(pct).alias("arrow"),
        F.split_part(F.concat_ws(": ", "status", "direction"), F.lit(":"), F.lit(1)).alias("headline"),
        F.col("status").contains("RISE").alias("is_rise"),
    )


# -- news -------------------------------------------------------------------------------------
@query
def news_counts_by_daypart(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.news_counts(A.news(spark, sf))


@query
def news_price_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.news_price_correlation(A.news(spark, sf), A.ticks(spark, sf))


@query
def mention_correlation(spark: SparkSession, sf: str) -> DataFrame:
    ranges = volatility.range_volatility(A.ticks(spark, sf))
    out = correlate.mention_correlation(ranges, A.feed_entries(spark, sf), A.MENTIONS, "summary")
    return out.withColumn("note", classes.coverage_note(F.col("n_mentions"), F.col("range_index")))


@query
def price_news_join(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.pair_counts(A.ticks(spark, sf), A.news(spark, sf))


@query
def price_news_sample(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.pair_sample(A.ticks(spark, sf), A.news(spark, sf))


@query
def mention_change_corr(spark: SparkSession, sf: str) -> DataFrame:
    return correlate.mention_change_corr(A.ticks(spark, sf), A.feed_entries(spark, sf), A.MENTIONS, "summary")


@query
def keyword_tag_first(spark: SparkSession, sf: str) -> DataFrame:
    return A.news(spark, sf).select("doc_id", "commodity")


@query
def keyword_tag_words(spark: SparkSession, sf: str) -> DataFrame:
    entries = A.feed_entries(spark, sf)
    return enrich.keyword_tag(entries, F.col("summary"), A.KEYWORDS, "general", whole_words=True).select("doc_id", "commodity")


@query
def keyword_tag_multi(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.mention_tags(A.feed_entries(spark, sf), F.col("summary"), A.MENTIONS).select("doc_id", "mentioned")


def _keyword_table(spark: SparkSession) -> DataFrame:
    rows = [(w, c, i) for i, (c, ws) in enumerate(A.KEYWORDS.items()) for w in ws]
    return spark.createDataFrame(rows, "keyword string, tag string, rank int")


@query
def keyword_table_first(spark: SparkSession, sf: str) -> DataFrame:
    """The tags of ``keyword_tag_words`` by joins with a keyword table."""
    entries = A.feed_entries(spark, sf).select("doc_id", "summary")
    return keywords.first_tag(entries, _keyword_table(spark), "doc_id", "summary", "general").select("doc_id", "commodity")


@query
def keyword_table_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Articles that have each pair of words that stand next to each other in a benchmark item."""
    item = F.filter(F.split(F.lower("text"), f"{text.OUTSIDE}+"), lambda w: w != "")
    pairs = A.table(spark, sf, "benchmark").select(item.alias("w")).filter(F.size("w") > 1)
    pairs = pairs.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))).alias("keyword"))
    table = pairs.distinct().select("keyword", F.lit("phrase").alias("tag"), F.lit(0).alias("rank"))
    found = keywords.mentions(A.feed_entries(spark, sf).select("doc_id", "summary"), table, "doc_id", "summary")
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_docs"))


@query
def distinct_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Users per commodity from daily sketches: the exact number, and whether the estimate keeps its error bound."""
    rows = A.table(spark, sf, "events").select(F.col("event_type").alias("commodity"), F.to_date("ts").alias("obs_date"), "user_id")
    daily = sketches.daily_sketches(rows, F.col("user_id"), ["commodity", "obs_date"])
    about = sketches.merged(daily, ["commodity"]).select("commodity", sketches.estimate().alias("about"))
    exact = rows.groupBy("commodity").agg(F.count_distinct("user_id").alias("n_users"))
    off = F.abs(F.col("about") - F.col("n_users")) <= sketches.error_bound() * F.col("n_users")
    return exact.join(about, "commodity").select("commodity", "n_users", off.alias("within_bound"))


@query
def mention_totals(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.mention_counts(A.feed_entries(spark, sf), A.MENTIONS, "summary")


@query
def html_strip(spark: SparkSession, sf: str) -> DataFrame:
    return A.web_pages(spark, sf).select(
        "page_id", text.strip_space(F.col("title")).alias("title"), text.strip_tags(F.col("summary")).alias("body")
    )


# -- cleaning ---------------------------------------------------------------------------------
@query
def dedup_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "lineitem")
    return dedup.keep_one(rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])


@query
def dedup_link(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keep_one(A.feed_entries(spark, sf), ["link"], [F.col("event_time").desc(), F.col("doc_id").asc()])


@query
def dedup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_counts(A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def clean_prices(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_prices(A.mixed(spark, sf), SETTINGS).select(
        "message_id", "commodity", "price", "topic", "link", "source_feed", "event_time", "hour", "dow"
    )


@query
def clean_news(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_news(A.mixed(spark, sf), SETTINGS).select(
        "commodity", "title", "summary", "link", "source_feed", "event_time", "hour", "dow"
    )


def _in_batches(spark: SparkSession, sf: str, cleaning: incremental.Cleaning) -> DataFrame:
    """Raw rows cleaned in three batches, one of them repeated; the later half of the month comes first."""
    raw = A.mixed(spark, sf)
    table = incremental.IncrementalClean(spark, new_dir(spark, "cleaned"), schemas.MIXED, cleaning, SETTINGS, buckets=8)
    late = F.coalesce(F.col("ts_iso"), F.translate("ts_text", " ", "T")) >= "2024-01-16"
    for part in (raw.filter(late), raw.filter(~F.coalesce(late, F.lit(False))), raw.filter(late)):
        table.add(part)
    return table.cleaned()


@query
def clean_prices_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _in_batches(spark, sf, incremental.PRICES).select(
        "message_id", "commodity", "price", "topic", "link", "source_feed", "event_time", "hour", "dow"
    )


@query
def clean_news_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _in_batches(spark, sf, incremental.NEWS).select(
        "commodity", "title", "summary", "link", "source_feed", "event_time", "hour", "dow"
    )


@query
def clean_accounting(spark: SparkSession, sf: str) -> DataFrame:
    raw = A.mixed(spark, sf)
    return clean.price_accounting(raw, SETTINGS).unionByName(clean.news_accounting(raw, SETTINGS))


@query
def clean_summary(spark: SparkSession, sf: str) -> DataFrame:
    return clean.cleaning_summary(clean_accounting(spark, sf))


def _faulty(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks as raw records; some users send broken ones."""
    user = F.col("user_id")
    broken = {1: "abc", 2: "NaN", 3: "Infinity", 4: "-5", 6: "1000000.01", 9: "0", 10: "-Infinity", 11: "5d"}
    price = F.when(user == 5, F.lit(None).cast("string"))
    for u, value in broken.items():
        price = price.when(user == u, F.lit(value))
    return A.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.when(user == 7, F.lit("coffee")).otherwise(F.col("event_type")).alias("commodity"),
        price.otherwise(F.col("value").cast("string")).alias("price_text"),
        F.when(user != 8, F.lit("kg")).alias("unit"),
        F.col("ts").alias("event_time"),
    )


@query
def validate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    known = [*A.KEYWORDS]
    return clean.validate_prices(_faulty(spark, sf), known, "price_text").select("message_id", "reject_reason")


@query
def validation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.validation_counts(clean.validate_prices(_faulty(spark, sf), [*A.KEYWORDS], "price_text"))


@query
def safe_numbers(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.col("price_text")
    value = numbers.parsed(raw)
    return _faulty(spark, sf).select(
        "message_id",
        numbers.safe_float(raw).alias("as_float"),
        numbers.safe_int(raw).alias("as_int"),
        F.coalesce(numbers.finite(numbers.nan_as(value, "zero")), F.lit(-1.0)).alias("nan_zero"),
    )


def _faulty_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """The same records with their prices as numbers: NaN and infinite ones among them."""
    price = numbers.parsed(F.col("price_text"))
    return _faulty(spark, sf).select("message_id", "commodity", price.alias("price"), "event_time", F.hour("event_time").alias("hour"))


@query
def volatility_faulty(spark: SparkSession, sf: str) -> DataFrame:
    return volatility.cv_volatility(_faulty_ticks(spark, sf))


@query
def alert_faulty(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.price_alert(_faulty_ticks(spark, sf))


@query
def topic_split(spark: SparkSession, sf: str) -> DataFrame:
    """The three sides of the split."""
    rows = A.mixed(spark, sf).withColumn("topic", F.when(F.coalesce(F.col("commodity") != "signup", F.lit(True)), F.col("topic")))
    sides = zip(clean.split_by_topic(rows, "prices"), ("prices", "other", "none"))
    parts = [df.select("message_id", "link", "commodity", F.lit(side).alias("side")) for df, side in sides]
    return reduce(DataFrame.unionByName, parts)


@query
def guards(spark: SparkSession, sf: str) -> DataFrame:
    """Row predicates of the cleaned tables as columns."""
    return A.mixed(spark, sf).select(
        "message_id",
        "link",
        "source_feed",
        "ts_text",
        F.coalesce(F.col("price") > 0, F.lit(False)).alias("has_price"),
        clean.price_in_range(F.col("price")).alias("in_range"),
        clean.known_commodity(F.concat(F.lit(" "), F.upper("commodity"), F.lit(" ")), A.VALID).alias("is_known"),
        text.not_blank(F.col("title")).alias("has_title"),
        text.not_blank(F.col("published"), 10).alias("has_published"),
    )


@query
def event_time_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Each event type carries its time in another field; one carries none that parses."""
    ts, kind, nothing = F.col("ts"), F.col("event_type"), F.lit(None).cast("string")
    rows = A.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "purchase", F.date_format(ts, "yyyy"))
        .otherwise(nothing)
        .alias("ts_text"),
        F.when(kind == "click", times.iso_text(ts)).otherwise(nothing).alias("ts_iso"),
        F.when(kind.isin("error", "purchase"), F.date_format(ts, "yyyy-MM-dd")).otherwise(nothing).alias("obs_date"),
        F.when(kind == "error", F.date_format(ts, "HH:mm:ss")).otherwise(nothing).alias("obs_time"),
    )
    fields = [F.col(c) for c in ("ts_text", "ts_iso", "obs_date", "obs_time")]
    day, hour = times.day_and_hour(fields[2], fields[3])
    at = times.resolve_event_time(*fields)
    return rows.select("message_id", at.alias("event_time"), day.alias("day"), hour.alias("day_hour"))


# -- lookups and messages ---------------------------------------------------------------------
@query
def normalise_names(spark: SparkSession, sf: str) -> DataFrame:
    """Feed spelling of part names: upper case, white space around."""
    synonyms = {"small ring": "ring", "red widget": "widget", "blue bolt": "bolt"}
    spelled = F.concat(F.lit(" \t"), F.upper("p_name"), F.lit("\n"))
    return A.table(spark, sf, "part").select("p_partkey", enrich.normalise_name(spelled, synonyms).alias("commodity"))


def _reference_dim(spark: SparkSession, sf: str) -> DataFrame:
    means = volatility.cv_stats(A.ticks(spark, sf), mean_scale=0)
    return means.select("commodity", F.col("mean_price").cast("bigint").alias("ref_price"))


@query
def dimension_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.ticks(spark, sf).select("message_id", "commodity", "price")
    return enrich.lookup(rows, _reference_dim(spark, sf))


@query
def reference_change(spark: SparkSession, sf: str) -> DataFrame:
    daily = alerts.daily_mean(A.ticks(spark, sf)).select("commodity", "day", "price")
    return enrich.by_reference_change(enrich.add_reference_change(enrich.lookup(daily, _reference_dim(spark, sf))))


@query
def priority_fill(spark: SparkSession, sf: str) -> DataFrame:
    """High prices where a commodity has any, its daily means where it has none."""
    high = A.ticks(spark, sf).filter(F.col("price") > 340)
    daily = alerts.daily_mean(A.ticks(spark, sf))
    columns = ["commodity", "price", "event_time"]
    return enrich.priority_fill(
        [s.select(*columns, F.lit(n).alias("source_name")) for s, n in ((high, "ticks"), (daily, "daily"))]
    )


@query
def missing_commodities(spark: SparkSession, sf: str) -> DataFrame:
    prices = A.ticks(spark, sf)
    return enrich.missing_keys(prices, prices.filter(F.col("price") > 340))


@query
def currency_convert(spark: SparkSession, sf: str) -> DataFrame:
    local = numbers.local_price(F.col("price"), F.col("commodity"), {"ECONOMY": 1.8, "PROMO": 2.2})
    return A.list_prices(spark, sf).select("message_id", F.round(local, 2).alias("local_price"))


@query
def price_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.price_envelope(A.ticks(spark, sf).select("commodity", "label", "price", "event_time"), F.col("event_time"))


@query
def news_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.news_envelope(A.feed_entries(spark, sf), F.col("event_time"), keywords=A.KEYWORDS, default="general")


@query
def web_news_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Articles from raw web pages: no publication time, markup in title and body."""
    at = F.timestamp_add("MINUTE", F.col("page_id").cast("int"), F.lit(A.EPOCH).cast("timestamp_ntz"))
    none = F.lit(None).cast("string")
    pages = A.web_pages(spark, sf).withColumns({"published": none, "updated": none, "source_feed": F.lit("web")})
    return enrich.news_envelope(pages, at, keywords=A.KEYWORDS, default="general")


@query
def json_decode_props(spark: SparkSession, sf: str) -> DataFrame:
    return A.ticks(spark, sf).select("message_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query
def json_encode_kv(spark: SparkSession, sf: str) -> DataFrame:
    return publish.keyed_prices(A.ticks(spark, sf).select("message_id", "commodity", "price", "day"))


@query
def publish_kv(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed messages of both topics written, read back and decoded."""
    path = new_dir(spark, "publish")
    prices = publish.keyed_prices(price_envelope(spark, sf))
    news = publish.keyed_news(news_envelope(spark, sf))
    prices.unionByName(news).write.parquet(path)
    stored = spark.read.schema("key string, value string").parquet(path)
    message = F.from_json("value", "topic string, commodity string, price double, link string, ts_iso string")
    return stored.select("key", message.alias("m")).select("key", "m.*")


@query
def unsent_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of the second half of the feed that the first half had not sent."""
    keyed = publish.keyed_news(news_envelope(spark, sf)).withColumn("at", F.get_json_object("value", "$.ts_text"))
    half = F.lit("2024-01-16 00:00:00")
    fresh = publish.not_yet_sent(keyed.filter(F.col("at") >= half), keyed.filter(F.col("at") < half))
    return fresh.select("key", "at", F.get_json_object("value", "$.link").alias("link"))


@query
def add_provenance(spark: SparkSession, sf: str) -> DataFrame:
    rows = enrich.add_provenance(A.mixed(spark, sf), "mixed-feed")
    rows = enrich.add_audit(rows, batch_time="2024-02-01 00:00:00")
    return rows.select("topic", "message_id", "link", "_source", F.col("_ingested_at").isNotNull().alias("ingested"), F.date_format("_cleaned_at", "yyyy-MM-dd HH:mm:ss").alias("cleaned"))


@query
def raw_price_map(spark: SparkSession, sf: str) -> DataFrame:
    """Price-list responses and indicator responses derived from the list prices."""
    part = A.table(spark, sf, "part")
    names = {"ECONOMY": "Beras Medium", "PROMO": " cabe rawit ", "SMALL": "Gula", "LARGE": "unknown thing"}
    name = F.lit("Bawang Merah")
    for kind, spoken in names.items():
        name = F.when(F.col("p_type") == kind, F.lit(spoken)).otherwise(name)
    price = F.col("p_retailprice").cast("string")
    none = F.lit(None).cast("string")
    item = F.struct(
        name.alias("nama_komoditi"),
        F.when(F.col("p_size") <= 25, price).otherwise(none).alias("harga_rata"),
        F.when(F.col("p_size") <= 40, price).otherwise(none).alias("harga"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise(none).alias("wilayah"),
    )
    today = F.lit(A.EPOCH).cast("timestamp_ntz")
    listed = enrich.price_list_records(part.select(F.array(item).alias("data")), today, "list")
    body = F.concat(
        F.lit('[{"page":1},['),
        F.when(F.col("p_size") > 5, F.concat(F.lit('{"value":'), price, F.lit(',"date":"2024"}'))).otherwise(F.lit("")),
        F.lit("]]"),
    )
    commodity = F.when(F.col("p_type") == "PROMO", "jagung").otherwise("gula")
    indicator = enrich.indicator_records(part.select(commodity.alias("commodity"), body.alias("body")), "indicator", today)
    return listed.unionByName(indicator)


# -- live views -------------------------------------------------------------------------------
TIES = ["message_id", "link", "source_feed"]


@query
def live_latest_n(spark: SparkSession, sf: str) -> DataFrame:
    return live.newest(A.mixed(spark, sf), live.LIVE_ROWS, TIES).select(
        "topic", "rank", "message_id", "link", "source_feed", "commodity"
    )


@query
def live_latest_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Last ten messages per role of the conversations."""
    rows = A.table(spark, sf, "conversations")
    out = live.newest(rows, 10, ["turn"], by="role", arrived=F.col("conv_id"))
    return out.select("role", "rank", "conv_id", "turn", "text")


@query
def live_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Displayed fields of both topics with their defaults."""
    now = F.lit(A.EPOCH).cast("timestamp_ntz")
    rows = A.mixed(spark, sf)
    prices = live.live_prices(rows, now=now).select(
        F.lit("prices").alias("topic"), F.col("message_id").alias("id"), "commodity", "label", "price", "unit",
        "region", "source_name", "obs_date", "ts_iso",
    )
    news = live.live_news(rows, general="general", now=now).select(
        F.lit("news").alias("topic"), F.col("link").alias("id"), "commodity", "title", "summary", "ts_text",
        "published", "source_feed",
    )
    return prices.unionByName(news, allowMissingColumns=True)


@query
def tagged_feed(spark: SparkSession, sf: str) -> DataFrame:
    rows = live.tagged_feed(A.mixed(spark, sf))
    return rows.select(
        "type",
        "arrived",
        F.get_json_object("data", "$.message_id").alias("message_id"),
        F.get_json_object("data", "$.link").alias("link"),
        F.get_json_object("data", "$.summary").alias("summary"),
    )


@query
def envelope_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    """Newest prices by event time written as an envelope file and read back as rows."""
    rows = A.ticks(spark, sf).select("message_id", "commodity", "price", "day", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
    at = F.lit(A.EPOCH)
    wrapped = live.envelope(rows, "prices", at, [F.desc("at"), F.desc("message_id")], live.LIVE_ROWS)
    path = new_dir(spark, "envelope")
    documents.write_document(documents.as_json(wrapped, "value"), path)
    out, status = files.read_live(spark, path, "message_id string, commodity string, price double, day string, at string")
    return out.withColumn("status", F.lit(status))


@query
def source_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Messages landed as files per topic, and each large order as a damaged line, read back."""
    path = new_dir(spark, "landed")
    file_sink.land(A.mixed(spark, sf), path)
    damaged = A.table(spark, sf, "orders").filter(F.col("o_totalprice") > BIG_ORDER)
    damaged.select(F.concat(F.lit('{"message_id": "'), "o_orderkey").alias("value"), F.lit("broken").alias("_topic")).write.mode("append").partitionBy("_topic").text(path)
    rows = files.read_messages(spark, path, multi_line=False)
    return rows.select("topic", "message_id", "link", "commodity", "price", F.col(files.CORRUPT).alias("corrupt"))


@query
def landed_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Messages landed, read back, cleaned: the same rows as cleaning the messages at hand."""
    path = new_dir(spark, "landed")
    file_sink.land(A.mixed(spark, sf), path)
    rows = clean.clean_prices(files.well_formed(files.read_messages(spark, path, multi_line=False)), SETTINGS)
    return rows.select("message_id", "commodity", "price", "topic", "link", "source_feed", "event_time", "hour", "dow")


@query
def landed_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Rule accounting straight on a JSON read."""
    path = new_dir(spark, "landed")
    file_sink.land(A.mixed(spark, sf), path)
    return clean.price_accounting(files.well_formed(files.read_messages(spark, path, multi_line=False)), SETTINGS)


# -- documents --------------------------------------------------------------------------------
def _at() -> Column:
    return F.lit("2024-02-01T00:00:00")


@query
def results_document(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.results_document(A.ticks(spark, sf), A.feed_entries(spark, sf), _at(), A.MENTIONS, "summary")


@query
def dashboard_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.mixed(spark, sf)
    body = analytics.analyses_row(A.ticks(spark, sf), A.feed_entries(spark, sf), A.MENTIONS, "summary")
    return analytics.dashboard_payload(live.live_prices(rows), live.live_news(rows, general="general"), body, _at())


@query
def dashboard_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dashboard_totals(A.ticks(spark, sf), A.feed_entries(spark, sf))


def _gold(spark: SparkSession, sf: str) -> list[DataFrame]:
    prices = A.ticks(spark, sf)
    return [
        volatility.cv_volatility(prices),
        volatility.trend_periodic(prices),
        alerts.price_alert_daily(alerts.daily_mean(prices)),
        correlate.news_price_correlation(A.news(spark, sf), prices),
    ]


@query
def export_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the dashboard export: section, position, commodity and the leading value."""
    lead = {"volatility": "cv_index", "trend": "avg_price", "alert": "pct_change", "news_correlation": "n_news"}
    parts = []
    for name, (table, order, n) in lakehouse.export_sections(*_gold(spark, sf)).items():
        rows = documents.iso_times(documents.top(table, order, n))
        at = F.col("event_time") if "event_time" in rows.columns else F.lit(None).cast("string")
        value = F.col(lead[name]).cast("double").alias("value")
        parts.append(rows.select(F.lit(name).alias("section"), "position", "commodity", value, at.alias("at")))
    return reduce(DataFrame.unionByName, parts)


@query
def export_document(spark: SparkSession, sf: str) -> DataFrame:
    return lakehouse.export_document(*_gold(spark, sf), generated_at=_at())


# -- versioned tables -------------------------------------------------------------------------
BIG_ORDER = 400_000.0


def _versions(spark: SparkSession, sf: str) -> SnapshotTable:
    """Three versions of the orders: written, large ones marked, cancelled ones deleted."""
    table = SnapshotTable(spark, new_dir(spark, "orders"))
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    table.overwrite(orders, "CREATE")
    table.update(F.col("o_totalprice") > BIG_ORDER, {"o_orderstatus": F.lit("REVIEW")})
    table.delete(F.col("o_orderstatus") == "P")
    return table


@query
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(spark, sf).read(0)


def _by_month(spark: SparkSession, sf: str) -> PartitionedTable:
    """The orders in a partition a month, the large ones marked."""
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    rows = orders.withColumn("_month", F.date_format("o_orderdate", "yyyy-MM"))
    table = PartitionedTable(spark, new_dir(spark, "orders-by-month"), rows.schema, ("_month",))
    table.replace(rows, rows.select("_month").distinct())
    table.update(F.col("o_totalprice") > BIG_ORDER, {"o_orderstatus": F.lit("REVIEW")})
    return table


@query
def snapshot_update(spark: SparkSession, sf: str) -> DataFrame:
    """Large orders marked; months without one are not rewritten."""
    return _by_month(spark, sf).read().drop("_month")


@query
def snapshot_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Cancelled orders deleted after that; months without one are not rewritten."""
    table = _by_month(spark, sf)
    table.delete(F.col("o_orderstatus") == "P")
    return table.read().drop("_month")


@query
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(spark, sf).diff(0, 2, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    nulls = F.count_if(F.col("o_orderstatus").isNull())
    return _versions(spark, sf).history(nulls.alias("n_nulls"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))


@query
def snapshot_counts(spark: SparkSession, sf: str) -> DataFrame:
    table = _versions(spark, sf)
    return files.count_rows(**{f"v{v}": table.read(v) for v in table.versions()})


@query
def schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Older rows without the unit column read together with newer rows that have it."""
    table = SnapshotTable(spark, new_dir(spark, "merge"))
    rows = A.ticks(spark, sf).select("message_id", "commodity", "price", "event_time")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    table.append(rows.filter(F.col("event_time") < half))
    table.append(rows.filter(F.col("event_time") >= half).withColumn("unit", F.lit("kg")))
    return table.read()


@query
def gold_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Raw to gold for both feeds in one folder: the rows of the gold tables after all layers."""
    house = lakehouse.Lakehouse(spark, new_dir(spark, "house"), SETTINGS)
    rows = A.mixed(spark, sf)
    house.bronze("prices", rows, "mixed-feed")
    house.bronze("news", rows.filter(F.col("topic") == "news"), "news-feed")
    house.silver()
    house.gold()
    house.review_critical()
    lead = {"volatility": "cv_index", "trend": "avg_price", "alert": "pct_change", "news_correlation": "n_news"}
    parts = []
    for name, column in lead.items():
        rows = house.table("gold", name).read()
        hour = F.col("hour") if "hour" in rows.columns else F.lit(None).cast("int")
        day = F.date_format("obs_date", "yyyy-MM-dd") if "obs_date" in rows.columns else F.lit(None).cast("string")
        parts.append(rows.select(F.lit(name).alias("table_name"), "commodity", day.alias("day"), hour.alias("hour"), F.col(column).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


# -- quality ----------------------------------------------------------------------------------
@query
def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile(A.mixed(spark, sf))


@query
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = enrich.add_provenance(A.mixed(spark, sf), "mixed-feed")
    return quality.schema_check(rows, ["_ingested_at", "_source", "commodity", "event_time"])


@query
def cardinality_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.cardinality_check(A.ticks(spark, sf), "commodity", len(A.KEYWORDS))


# -- further statistics -----------------------------------------------------------------------
@query
def zscore_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return stats.zscore_anomaly(A.ticks(spark, sf))


@query
def weekly_volatility(spark: SparkSession, sf: str) -> DataFrame:
    return stats.weekly_volatility(A.ticks(spark, sf))


@query
def daily_volatility(spark: SparkSession, sf: str) -> DataFrame:
    return stats.weekly_volatility(A.ticks(spark, sf), "day")


@query
def trend_slope(spark: SparkSession, sf: str) -> DataFrame:
    return stats.trend_slope(A.ticks(spark, sf))


@query
def trend_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Commodity-days in two clusters by mean price."""
    return stats.trend_clusters(A.ticks(spark, sf), features=("mean_price",)).select("commodity", "period", "mean_price", "cluster")


@query
def sql_hourly_peak(spark: SparkSession, sf: str) -> DataFrame:
    """A query in SQL text over a view of the prices."""
    A.ticks(spark, sf).createOrReplaceTempView("price_ticks")
    return spark.sql("SELECT hour, count(*) AS n_obs, max(price) AS peak FROM price_ticks WHERE price > 0 GROUP BY hour HAVING count(*) > 1")


@query
def first_available(spark: SparkSession, sf: str) -> DataFrame:
    """The fall-through of the price sources in three states: first empty, first and second empty, none empty."""
    columns = ["commodity", "price"]
    prices = A.ticks(spark, sf)
    feeds = [prices.filter(F.col("price") > 340).select(*columns), alerts.daily_mean(prices).select(*columns), A.list_prices(spark, sf).select(*columns)]
    none = feeds[0].limit(0)
    states = {"all": feeds, "second": [none, feeds[0], feeds[1]], "third": [none, none, feeds[2]]}
    parts = [enrich.first_available(s).withColumn("state", F.lit(name)) for name, s in states.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def fill_standardise(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.mixed(spark, sf).select("message_id", "link", "source_feed", "commodity", "title", "price", "unit")
    return stats.fill_standardise(rows, {"price": 0.0, "unit": "kg", "title": ""}, ["commodity", "source_feed"])


# -- streams ----------------------------------------------------------------------------------
def _landed(spark: SparkSession, sf: str, label: str) -> str:
    """Mixed messages as one folder of line-delimited files, ready to be streamed."""
    path = new_dir(spark, label)
    A.mixed(spark, sf).write.json(path)
    return path


@query
def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of both topics landed in one folder per topic."""
    source = _landed(spark, sf, "stream-land")
    out = new_dir(spark, "stream-landed")
    runner.drain(jobs.land(streams.read_files(spark, source), out), f"{out}-checkpoint")
    landed = spark.read.schema(schemas.MIXED).json(out)
    return landed.select("topic", "message_id", "link", "commodity", "price", "ts_iso", "ts_text")


@query
def stream_land_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """The same landed by topic and day from many batches, whose files are regrouped on the way."""
    source, out = new_dir(spark, "stream-many"), new_dir(spark, "stream-grouped")
    A.mixed(spark, sf).repartition(12).write.json(source)
    runner.drain(jobs.land_grouped(streams.read_files(spark, source, files_per_trigger=1), out), f"{out}-checkpoint")
    landed = files.read_landed(spark, out)
    return landed.select("topic", "message_id", "link", "commodity", "price", "ts_iso", "ts_text")


@query
def stream_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records validated, completed and published as keyed messages, from a stream."""
    path, out = new_dir(spark, "stream-raw"), new_dir(spark, "stream-published")
    _faulty(spark, sf).write.parquet(path)
    schema = "message_id string, commodity string, price_text string, unit string, event_time timestamp_ntz"
    valid = jobs.validated(spark.readStream.schema(schema).parquet(path), [*A.KEYWORDS], "price_text")
    records = valid.withColumn("price", numbers.parsed(F.col("price_text"))).drop("message_id")
    messages = publish.keyed_prices(enrich.price_envelope(records, F.col("event_time")))
    runner.drain(messages.writeStream.format("parquet").option("path", out), f"{out}-checkpoint")
    message = F.from_json("value", "message_id string, price double, ts_iso string")
    return spark.read.schema("key string, value string").parquet(out).select("key", message.alias("m")).select("key", "m.*")


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files appended to the raw table once, although the job runs twice."""
    source = _landed(spark, sf, "stream-ingest")
    table = SnapshotTable(spark, new_dir(spark, "stream-bronze"))
    for _ in range(2):
        runner.drain(jobs.ingest(streams.read_files(spark, source), table, "landed"), f"{table.path}-checkpoint")
    return table.read().select("topic", "_source", "message_id", "link", "commodity", "price")


@query
def stream_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Newest ten of each topic and the size of the combined feed, from one stream."""
    source = _landed(spark, sf, "stream-fanout")
    out = new_dir(spark, "stream-views")
    prices, news = SnapshotTable(spark, f"{out}/prices"), SnapshotTable(spark, f"{out}/news")
    stream = streams.read_files(spark, source, files_per_trigger=2)
    runner.drain(jobs.fan_out(stream, prices, news, f"{out}/feed"), f"{out}/checkpoint")
    feed = spark.read.schema("type string, data string").json(f"{out}/feed")
    views = prices.read().select(F.lit("prices").alias("view"), F.col("message_id").alias("id"))
    views = views.unionByName(news.read().select(F.lit("news").alias("view"), F.col("link").alias("id")))
    views = views.withColumn("n", F.lit(1).cast("bigint"))
    sizes = feed.groupBy(F.concat(F.lit("feed:"), "type").alias("view")).agg(F.count(F.lit(1)).alias("n"))
    return views.unionByName(sizes.withColumn("id", F.lit(None).cast("string")))


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each article once, from three runs with copies; the earlier half of the month comes last."""
    path, out = new_dir(spark, "stream-news"), new_dir(spark, "stream-unique")
    rows = A.feed_entries(spark, sf).select("link", "title", "published", "event_time")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (rows.filter(F.col("event_time") >= half), rows.filter(F.col("event_time") < half)):
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        runner.drain(unique.dedup_news(stream, out), f"{out}-checkpoint")
    return spark.read.schema("link string, title string").parquet(f"{out}/articles").select("link", "title")


@query
def stream_dedup_archived(spark: SparkSession, sf: str) -> DataFrame:
    """As ``stream_dedup``, with a state that forgets at once: copies are found in the archive of keys."""
    path, out = new_dir(spark, "stream-news"), new_dir(spark, "stream-unique")
    rows = A.feed_entries(spark, sf).select("link", "title", "published", "event_time")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (rows.filter(F.col("event_time") >= half), rows.limit(0), rows):
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        runner.drain(unique.dedup_news(stream, out, remember=0), f"{out}-checkpoint")
    return spark.read.schema("link string, title string").parquet(f"{out}/articles").select("link", "title")


def _tick_files(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame, DataFrame]:
    """Ticks of the first and second half of the month as two folders to be streamed in turn."""
    rows = A.ticks(spark, sf).select("message_id", "commodity", "price", "event_time")
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    root = new_dir(spark, "stream-ticks")
    schema = "message_id string, commodity string, price double, event_time timestamp_ntz"
    return root, schema, rows.filter(F.col("event_time") < half), rows.filter(F.col("event_time") >= half)


@query
def stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of the month, from two runs: the earlier half comes last."""
    root, schema, first, second = _tick_files(spark, sf)
    out = f"{root}-trend"
    for rows in (second, first):
        rows.write.mode("append").parquet(root)
        stream = spark.readStream.schema(schema).parquet(root)
        runner.drain(hours.partial_sums(stream, out), f"{out}-checkpoint")
    return hours.totals(spark, out)


@query
def stream_closed_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hours published by a watermark, and what became of them when the earlier half of the month came last."""
    root, schema, first, second = _tick_files(spark, sf)
    out = f"{root}-hours"
    for rows in (second, first):
        rows.write.mode("append").parquet(root)
        stream = spark.readStream.schema(schema).parquet(root)
        runner.drain(hours.partial_sums(stream, f"{out}/sums"), f"{out}-checkpoint/sums")
        runner.drain(hours.closed_hours(stream, f"{out}/closed"), f"{out}-checkpoint/closed")
    return hours.standing(spark, f"{out}/sums", f"{out}/closed")


@query
def stream_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of two runs, of which the earlier half of the month comes last: late rows and their successors are put right."""
    root, schema, first, second = _tick_files(spark, sf)
    out = f"{root}-alert"
    for rows in (second, first):
        rows.write.mode("append").parquet(root)
        stream = spark.readStream.schema(schema).parquet(root)
        runner.drain(early_warning.changes(stream, out), f"{out}-checkpoint/changes")
        runner.drain(early_warning.edge_changes(spark, out), f"{out}-checkpoint/edges")
    return early_warning.current(spark, out)
