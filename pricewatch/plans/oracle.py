"""SQL equivalents of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from pricewatch.functions.text import OUTSIDE, SPACES
from pricewatch.schemas import MIXED as MIXED_FIELDS
from pricewatch.schemas import MIXED_COLUMNS
from pricewatch.sources.adapters import EPOCH, KEYWORDS, MENTIONS, VALID

SQL: dict[str, str] = {}


def rnd(x: str, n: int = 2) -> str:
    """Half-up rounding of the printed double, which is what Spark's ``round`` does."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def pct(part: str, whole: str, n: int = 2) -> str:
    return rnd(f"({part}) / NULLIF({whole}, 0) * 100", n)


def status(index: str) -> str:
    return f"CASE WHEN {index} > 20 THEN 'CRITICAL' WHEN {index} > 10 THEN 'WARNING' ELSE 'NORMAL' END"


def first_keyword(body: str) -> str:
    whens = " ".join(f"WHEN contains(lower({body}), '{w}') THEN '{c}'" for c, ws in KEYWORDS.items() for w in ws)
    return f"CASE {whens} ELSE 'general' END"


def label(c: str) -> str:
    return f"upper({c}[1]) || lower(substr({c}, 2))"


IN_VALID = ", ".join(f"'{v}'" for v in VALID)
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
BLANKS = " || ".join(f"chr({ord(c)})" for c in SPACES)


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def tags(x: str) -> str:
    return strip(f"regexp_replace({x}, '<[^>]+>', '', 'g')")


TICKS = f"""ticks AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS commodity, {label('event_type')} AS label,
         value AS price, ts AS event_time, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, strftime(ts, '%Y-%m-%d') AS day, props
  FROM events)"""
DAILY = f"""daily AS (
  SELECT commodity, CAST(event_time AS DATE) AS obs_date, {rnd('avg(price)')} AS price,
         CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS event_time, 0 AS hour
  FROM (SELECT commodity, CAST(event_time AS DATE) AS d, event_time, price FROM ticks WHERE price > 0)
  GROUP BY commodity, CAST(event_time AS DATE))"""
ENTRIES = f"""entries AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title, md5(text) AS link, text AS summary,
         TIMESTAMP '{EPOCH}' + to_hours(CAST(doc_id % 720 AS BIGINT)) AS event_time, source AS source_feed
  FROM documents)"""
NEWS = f"""{ENTRIES}, news AS (
  SELECT *, CAST(hour(event_time) AS INTEGER) AS hour, {first_keyword('summary')} AS commodity FROM entries)"""
MIXED = f"""{NEWS}, mixed AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS commodity, {label('event_type')} AS label,
         value AS price, strftime(ts, {ISO}) AS ts_iso, 'prices' AS topic, ts AS arrived,
         CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS link, CAST(NULL AS VARCHAR) AS summary,
         CAST(NULL AS VARCHAR) AS published, CAST(NULL AS VARCHAR) AS ts_text, CAST(NULL AS VARCHAR) AS source_feed
  FROM events
  UNION ALL
  SELECT NULL, commodity, NULL, NULL, NULL, 'news', event_time, title, link, summary,
         strftime(event_time, '%Y-%m-%d %H:%M:%S'), strftime(event_time, '%Y-%m-%d %H:%M:%S'), source_feed
  FROM news)"""


def cv(src: str, scale: int = 2, fill: bool = True) -> str:
    index = "coalesce(i, 0.0)" if fill else "i"
    return f"""SELECT commodity, mean_price, stddev_price, min_price, max_price, n_obs, {index} AS cv_index,
      {status('i')} AS status FROM (SELECT *, {pct('stddev_price', 'mean_price')} AS i FROM (
        SELECT commodity, {rnd('avg(price)', scale)} AS mean_price, {rnd('stddev_samp(price)')} AS stddev_price,
               {rnd('min(price)', 0)} AS min_price, {rnd('max(price)', 0)} AS max_price, count(price) AS n_obs
        FROM {src} WHERE price > 0 GROUP BY commodity))"""


ALL_PRICES = """all_prices AS (SELECT o_orderpriority AS commodity, o_totalprice AS price FROM orders
  UNION ALL SELECT p_type, p_retailprice FROM part UNION ALL SELECT commodity, price FROM daily)"""


def ranges(src: str) -> str:
    return f"""SELECT commodity, label, {rnd('hi')} AS max_price, {rnd('lo')} AS min_price, {rnd('mean')} AS avg_price,
      coalesce({rnd('dev')}, 0.0) AS stddev_price, n_obs,
      CASE WHEN mean > 0 THEN {pct('hi - lo', 'mean')} ELSE 0.0 END AS range_index
      FROM (SELECT commodity, label, max(price) AS hi, min(price) AS lo, avg(price) AS mean,
                   stddev_samp(price) AS dev, count(price) AS n_obs FROM {src} GROUP BY commodity, label)"""


SQL["volatility_cv"] = f"WITH {TICKS} {cv('ticks')}"
SQL["volatility_cv_classes"] = f"""WITH {TICKS}, {DAILY}, {ALL_PRICES}
  SELECT *, CASE status WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS severity FROM ({cv('all_prices')})"""
SQL["volatility_range"] = f"""WITH src AS (
    SELECT o_orderpriority AS commodity, n_name AS label, o_totalprice AS price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT *, CASE {status('range_index')} WHEN 'CRITICAL' THEN 'intervene in the supply chain now'
      WHEN 'WARNING' THEN 'monitor closely and check stock' ELSE 'stable, keep routine monitoring' END AS recommendation
  FROM ({ranges('src')})"""
SQL["trend_summary"] = f"""WITH {TICKS}, s AS (
    SELECT commodity, label, {rnd('avg(price)')} AS avg_price, {rnd('min(price)')} AS min_price,
           {rnd('max(price)')} AS max_price, count(DISTINCT day) AS n_days, count(*) AS n_obs
    FROM ticks WHERE commodity IS NOT NULL GROUP BY commodity, label)
  SELECT *, {rnd('CASE WHEN min_price > 0 THEN (max_price - min_price) / min_price * 100 ELSE 0.0 END', 1)} AS range_pct,
         avg_price > 30000 AS is_high FROM s"""
TREND = f"""SELECT commodity, CAST(event_time AS DATE) AS obs_date, hour, dow, {rnd('avg(price)', 0)} AS avg_price,
    {rnd('min(price)', 0)} AS min_price, {rnd('max(price)', 0)} AS max_price, count(price) AS n_obs
  FROM ticks WHERE price > 0 AND event_time IS NOT NULL GROUP BY ALL"""
SQL["trend_periodic"] = f"WITH {TICKS} {TREND}"
SQL["most_volatile"] = f"""WITH {TICKS}, {DAILY}, {ALL_PRICES}
  SELECT commodity, cv_index, status FROM ({cv('all_prices')}) ORDER BY cv_index DESC, commodity LIMIT 3"""
SQL["commodity_distribution"] = f"""WITH {MIXED}
  SELECT commodity, count(*) AS n FROM mixed GROUP BY 1 ORDER BY n DESC, commodity NULLS FIRST LIMIT 10"""


def alerts(src: str, order: str) -> str:
    return f"""SELECT commodity, price, prev_price, pct_change,
        CASE WHEN pct_change > 0 THEN 'UP' WHEN pct_change < 0 THEN 'DOWN' ELSE 'FLAT' END AS direction,
        CASE WHEN pct_change > 5 THEN 'SIGNIFICANT_RISE' ELSE 'SIGNIFICANT_FALL' END AS status,
        CAST(event_time AS DATE) AS obs_date, hour, event_time
      FROM (SELECT *, {pct('price - prev_price', 'prev_price')} AS pct_change
            FROM (SELECT *, lag(price) OVER (PARTITION BY commodity ORDER BY {order}) AS prev_price
                  FROM {src} WHERE price > 0)
            WHERE prev_price IS NOT NULL)
      WHERE pct_change > 5 OR pct_change < -5"""


SQL["price_alert"] = f"WITH {TICKS}, {DAILY} {alerts('daily', 'event_time')}"
SQL["price_alert_scaled"] = f"WITH {TICKS} {alerts('ticks', 'event_time, message_id')}"
SQL["stream_alert"] = SQL["price_alert_scaled"]
SQL["alert_last3"] = f"""WITH {TICKS} SELECT *, {pct('price - low3', 'low3')} AS rise_pct FROM (
    SELECT commodity, event_time, message_id, price, min(price) OVER (PARTITION BY commodity
      ORDER BY event_time, message_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS low3 FROM ticks WHERE price > 0)
  WHERE low3 IS NOT NULL AND {pct('price - low3', 'low3')} > 5"""
SQL["rolling_avg"] = f"""WITH {TICKS} SELECT commodity, event_time, message_id, price, {rnd('m')} AS rolling_avg FROM (
    SELECT *, avg(price) OVER (PARTITION BY commodity ORDER BY event_time, message_id
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS m FROM ticks WHERE price > 0)"""
SQL["report_format"] = f"""WITH {TICKS}, {DAILY}, a AS ({alerts('daily', 'event_time')})
  SELECT commodity, obs_date, format('{{:,.2f}}', price) AS price_text,
         format('{{:+.1f}}%', {rnd('pct_change', 1)}) AS pct_text, abs(pct_change) AS pct_abs,
         CASE WHEN pct_change > 0 THEN '↑' WHEN pct_change < 0 THEN '↓' ELSE '→' END AS arrow,
         status AS headline, contains(status, 'RISE') AS is_rise FROM a"""

COUNTS = """SELECT commodity, count(*) AS n_news, count(*) FILTER (hour BETWEEN 6 AND 12) AS news_morning,
    count(*) FILTER (hour BETWEEN 13 AND 18) AS news_afternoon, count(*) FILTER (hour BETWEEN 19 AND 23) AS news_evening
  FROM news WHERE commodity IS NOT NULL GROUP BY commodity"""
SQL["news_counts_by_daypart"] = f"WITH {NEWS} {COUNTS}"


def coverage(n: str, i: str) -> str:
    return f"""CASE WHEN {n} > 5 AND {i} > 10 THEN 'HIGH_COV_HIGH_VOL' WHEN {n} > 5 AND {i} <= 10 THEN 'HIGH_COV_LOW_VOL'
      WHEN {n} <= 5 AND {i} > 10 THEN 'LOW_COV_HIGH_VOL' ELSE 'LOW_COV_LOW_VOL' END"""


CORRELATION = f"""SELECT n.*, p.mean_price, p.stddev_price, p.cv_index, p.status, p.n_obs AS n_price_obs,
    {coverage('n.n_news', 'p.cv_index')} AS coverage_class
  FROM ({COUNTS}) n LEFT JOIN ({cv('ticks', 0, False)}) p USING (commodity)"""
SQL["news_price_correlation"] = f"WITH {TICKS}, {NEWS} {CORRELATION}"
MENTION_TOTALS = " UNION ALL ".join(
    f"SELECT '{c}' AS commodity, '{w}' AS keyword, count(*) FILTER (contains(lower(summary), '{w}')) AS n_mentions FROM entries"
    for c, w in MENTIONS.items()
)
SQL["mention_totals"] = f"WITH {ENTRIES} {MENTION_TOTALS}"
MENTION_CORR = f"""SELECT v.commodity, v.label, v.range_index, v.avg_price, coalesce(m.n_mentions, 0) AS n_mentions,
    {coverage('m.n_mentions', 'v.range_index')} AS coverage_class
  FROM ({ranges('ticks')}) v LEFT JOIN ({MENTION_TOTALS}) m USING (commodity)"""
SQL["mention_correlation"] = f"""WITH {TICKS}, {ENTRIES} SELECT *, CASE
    WHEN n_mentions > 5 AND range_index > 10 THEN 'often reported and very volatile'
    WHEN n_mentions > 5 THEN 'media attention, keep monitoring'
    WHEN range_index > 10 THEN 'volatile with little coverage' END AS note FROM ({MENTION_CORR})"""
SQL["price_news_join"] = f"""WITH {TICKS}, {NEWS},
  p AS (SELECT commodity, count(*) AS n_prices FROM ticks GROUP BY 1),
  n AS (SELECT commodity, count(*) AS n_news FROM news GROUP BY 1)
  SELECT commodity, n_prices, n_news, n_prices * n_news AS n_pairs FROM p JOIN n USING (commodity)"""
SQL["price_news_sample"] = f"""WITH {TICKS}, {NEWS}
  SELECT t.commodity, t.price, t.event_time AS price_time, t.message_id AS price_id, n.title AS news_title,
         n.event_time AS news_time, n.link FROM ticks t JOIN news n ON t.commodity = n.commodity
  ORDER BY t.commodity, price_time DESC, price_id, news_time DESC, n.link LIMIT 5"""
MULTI = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS mentioned, event_time FROM entries WHERE contains(lower(summary), '{w}')"
    for c, w in MENTIONS.items()
)
SQL["mention_change_corr"] = f"""WITH {TICKS}, {DAILY}, {ENTRIES}, change AS (
    SELECT commodity, obs_date, {pct('price - prev', 'prev')} AS change FROM (
      SELECT *, lag(price) OVER (PARTITION BY commodity ORDER BY obs_date) AS prev FROM daily) WHERE prev IS NOT NULL),
  m AS (SELECT mentioned AS commodity, CAST(event_time AS DATE) AS obs_date, count(*) AS mentions FROM ({MULTI}) GROUP BY ALL)
  SELECT commodity, count(*) AS n_days,
    {rnd("covar_pop(coalesce(mentions, 0), change) / NULLIF(stddev_pop(coalesce(mentions, 0)) * stddev_pop(change), 0)", 4)} AS corr
  FROM change LEFT JOIN m USING (commodity, obs_date) GROUP BY commodity"""
SQL["keyword_tag_first"] = f"WITH {NEWS} SELECT doc_id, commodity FROM news"
WORDS = " ".join(
    f"WHEN regexp_matches(lower(text), '(\\A|{OUTSIDE}){w}({OUTSIDE}|\\z)') THEN '{c}'" for c, ws in KEYWORDS.items() for w in ws
)
SQL["keyword_tag_words"] = f"SELECT doc_id, CASE {WORDS} ELSE 'general' END AS commodity FROM documents"
SQL["keyword_tag_multi"] = f"WITH {ENTRIES} SELECT doc_id, mentioned FROM ({MULTI})"
SQL["html_strip"] = f"""SELECT page_id, {strip("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
  {tags('html')} AS body FROM pages"""

FILLED = ["message_id", "commodity", "label", "price", "ts_iso", "topic", "title", "link", "summary", "published", "source_feed", "ts_text"]


def digest(columns: list[str]) -> str:
    """Digest of several text columns, which orders rows that agree in all else."""
    return "md5(concat_ws(chr(31), " + ", ".join(f"md5(coalesce({c}, ''))" for c in columns) + "))"


def mixed_digest(*keys: str) -> str:
    """The same over the text columns of a mixed message but for the keys; columns that are never filled are empty."""
    texts = [f.split("` ")[0].strip("` ") for f in MIXED_FIELDS.split(", ") if f.endswith(" string")]
    return digest([c if c in FILLED else "''" for c in texts if c not in keys])


SQL["dedup_composite"] = f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, {digest(["l_returnflag", "l_linestatus"])}) = 1"""
SQL["dedup_link"] = f"""WITH {ENTRIES} SELECT doc_id, title, link, summary, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS published,
    CAST(NULL AS VARCHAR) AS updated, source_feed, event_time FROM entries
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY event_time DESC, doc_id) = 1"""
SQL["dedup_counts"] = """SELECT CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_removed FROM lineitem"""
D_PRICES = f"""price_unique AS (SELECT * FROM mixed QUALIFY row_number() OVER (PARTITION BY message_id, commodity, ts_text
  ORDER BY ts_iso DESC NULLS LAST, price NULLS LAST, {mixed_digest("message_id", "commodity", "ts_text")}) = 1)"""
D_NEWS = f"""news_unique AS (SELECT * FROM mixed QUALIFY row_number() OVER (PARTITION BY link
  ORDER BY ts_text DESC NULLS LAST, price NULLS LAST, {mixed_digest("link")}) = 1)"""
BAD_PRICE = "(topic = 'prices' AND NOT coalesce(price > 100 AND price < 1000000, false))"
BAD_COMMODITY = f"NOT coalesce(trim(lower(commodity)) IN ({IN_VALID}), false)"
BAD_TEXT = "NOT coalesce(length(trim(title)) > 0 AND length(trim(summary)) > 0, false)"
BAD_PUBLISHED = "NOT coalesce(length(trim(published)) > 10, false)"
SQL["clean_prices"] = f"""WITH {MIXED}, {D_PRICES} SELECT message_id, commodity, price, topic, link, source_feed,
    arrived AS event_time, CAST(hour(arrived) AS INTEGER) AS hour, CAST(dayofweek(arrived) + 1 AS INTEGER) AS dow
  FROM price_unique WHERE NOT {BAD_PRICE} AND NOT ({BAD_COMMODITY})"""
SQL["clean_news"] = f"""WITH {MIXED}, {D_NEWS} SELECT commodity, title, summary, link, source_feed,
    arrived AS event_time, CAST(hour(arrived) AS INTEGER) AS hour, CAST(dayofweek(arrived) + 1 AS INTEGER) AS dow
  FROM news_unique WHERE NOT ({BAD_TEXT}) AND NOT ({BAD_COMMODITY}) AND NOT ({BAD_PUBLISHED})"""


def accounting(table: str, unique: str, rules: list[tuple[str, str]]) -> str:
    """Counts after a growing list of filters, one row per step."""
    steps, kept = [f"SELECT 1 AS step, 'duplicate' AS rule, (SELECT count(*) FROM mixed) AS n_before, (SELECT count(*) FROM {unique}) AS n_after"], "true"
    for i, (name, bad) in enumerate(rules, start=2):
        after = f"{kept} AND NOT ({bad})"
        steps.append(
            f"SELECT {i}, '{name}', (SELECT count(*) FROM {unique} WHERE {kept}), (SELECT count(*) FROM {unique} WHERE {after})"
        )
        kept = after
    return f"""SELECT '{table}' AS table_name, step, rule, n_before, n_after, n_before - n_after AS n_removed,
      coalesce({pct('n_before - n_after', 'n_before', 1)}, 0.0) AS removed_pct FROM ({' UNION ALL '.join(steps)})"""


ACCOUNTING = (
    accounting(
        "prices",
        "price_unique",
        [("missing_topic", "topic IS NULL"), ("invalid_price", BAD_PRICE), ("invalid_commodity", BAD_COMMODITY), ("invalid_time", "arrived IS NULL")],
    )
    + " UNION ALL "
    + accounting(
        "news",
        "news_unique",
        [("blank_text", BAD_TEXT), ("invalid_commodity", BAD_COMMODITY), ("invalid_published", BAD_PUBLISHED), ("invalid_time", "arrived IS NULL")],
    )
)
SQL["clean_accounting"] = f"WITH {MIXED}, {D_PRICES}, {D_NEWS} {ACCOUNTING}"
SQL["clean_summary"] = f"""WITH {MIXED}, {D_PRICES}, {D_NEWS}, steps AS ({ACCOUNTING}), t AS (
    SELECT table_name, max(n_before) AS n_before, min(n_after) AS n_after FROM steps GROUP BY 1),
  u AS (SELECT * FROM t UNION ALL SELECT 'ALL', CAST(sum(n_before) AS BIGINT), CAST(sum(n_after) AS BIGINT) FROM t)
  SELECT *, n_before - n_after AS n_removed, coalesce({pct('n_before - n_after', 'n_before', 1)}, 0.0) AS removed_pct FROM u"""
FAULTY = """faulty AS (SELECT CAST(event_id AS VARCHAR) AS message_id,
    CASE WHEN user_id = 7 THEN 'coffee' ELSE event_type END AS commodity,
    CASE user_id WHEN 5 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN 'NaN' WHEN 3 THEN 'Infinity' WHEN 4 THEN '-5'
      WHEN 6 THEN '1000000.01' WHEN 9 THEN '0' WHEN 10 THEN '-Infinity' WHEN 11 THEN '5d' ELSE CAST(value AS VARCHAR) END AS price_text,
    CASE WHEN user_id <> 8 THEN 'kg' END AS unit, ts FROM events), v AS (SELECT *, TRY_CAST(price_text AS DOUBLE) AS p FROM faulty)"""
REASON = f"""CASE WHEN commodity IS NULL OR price_text IS NULL OR unit IS NULL THEN 'missing_field'
    WHEN p IS NULL THEN 'not_numeric' WHEN p <= 0 THEN 'not_positive' WHEN NOT isnan(p) AND p > 1000000 THEN 'too_high'
    WHEN isnan(p) THEN 'nan' WHEN commodity NOT IN ({', '.join(f"'{k}'" for k in KEYWORDS)}) THEN 'unknown_commodity' END"""
SQL["validate_reasons"] = f"WITH {FAULTY} SELECT message_id, {REASON} AS reject_reason FROM v"
SQL["validation_counts"] = f"WITH {FAULTY} SELECT coalesce({REASON}, 'valid') AS outcome, count(*) AS n FROM v GROUP BY 1"
SQL["safe_numbers"] = f"""WITH {FAULTY} SELECT message_id,
    CASE WHEN p IS NULL OR NOT isfinite(p) THEN 0.0 ELSE {rnd('CASE WHEN isfinite(p) THEN p END')} END AS as_float,
    CASE WHEN regexp_matches(price_text, '^-?[0-9]+$') THEN CAST(price_text AS BIGINT) ELSE 0 END AS as_int,
    CASE WHEN isnan(p) THEN 0.0 WHEN p IS NULL OR isinf(p) THEN -1.0 ELSE p END AS nan_zero FROM v"""
SQL["topic_split"] = f"""WITH {MIXED} SELECT message_id, link, commodity,
    CASE WHEN NOT coalesce(commodity <> 'signup', true) THEN 'none' WHEN topic = 'prices' THEN 'prices' ELSE 'other' END AS side FROM mixed"""
SQL["volatility_faulty"] = f"WITH {FAULTY} {cv('(SELECT commodity, p AS price FROM v WHERE isfinite(p))')}"
SQL["alert_faulty"] = f"""WITH {FAULTY}, f AS (SELECT message_id, commodity, p AS price, ts AS event_time, CAST(hour(ts) AS INTEGER) AS hour
    FROM v WHERE isfinite(p)) {alerts('f', 'event_time, message_id')}"""
SQL["guards"] = f"""WITH {MIXED} SELECT message_id, link, source_feed, ts_text, coalesce(price > 0, false) AS has_price,
    coalesce(price > 100 AND price < 1000000, false) AS in_range,
    coalesce(trim(lower(' ' || upper(commodity) || ' ')) IN ({IN_VALID}), false) AS is_known,
    coalesce(length(trim(title)) > 0, false) AS has_title, coalesce(length(trim(published)) > 10, false) AS has_published
  FROM mixed"""
SQL["event_time_resolve"] = """SELECT CAST(event_id AS VARCHAR) AS message_id,
    CASE event_type WHEN 'click' THEN ts WHEN 'view' THEN date_trunc('second', ts) WHEN 'error' THEN date_trunc('second', ts) END AS event_time,
    CASE WHEN event_type IN ('error', 'purchase') THEN strftime(ts, '%Y-%m-%d') ELSE 'unknown' END AS day,
    CASE WHEN event_type = 'error' THEN CAST(hour(ts) AS INTEGER) ELSE 0 END AS day_hour FROM events"""

SQL["normalise_names"] = """SELECT p_partkey, CASE p_name WHEN 'small ring' THEN 'ring' WHEN 'red widget' THEN 'widget'
  WHEN 'blue bolt' THEN 'bolt' ELSE replace(lower(p_name), ' ', '_') END AS commodity FROM part"""
REF = f"ref AS (SELECT commodity, CAST(mean_price AS BIGINT) AS ref_price FROM ({cv('ticks', 0)}))"
SQL["dimension_lookup"] = f"WITH {TICKS}, {REF} SELECT message_id, commodity, price, ref_price FROM ticks LEFT JOIN ref USING (commodity)"
SQL["reference_change"] = f"""WITH {TICKS}, {DAILY}, {REF} SELECT commodity, strftime(obs_date, '%Y-%m-%d') AS day, price, ref_price,
  {pct('price - ref_price', 'ref_price')} AS ref_change_pct FROM daily LEFT JOIN ref USING (commodity)"""
SQL["priority_fill"] = f"""WITH {TICKS}, {DAILY}, high AS (SELECT * FROM ticks WHERE price > 340)
  SELECT commodity, price, event_time, 'ticks' AS source_name FROM high UNION ALL
  SELECT commodity, price, event_time, 'daily' FROM daily WHERE commodity NOT IN (SELECT commodity FROM high)"""
SQL["missing_commodities"] = f"""WITH {TICKS} SELECT DISTINCT commodity FROM ticks
  WHERE commodity NOT IN (SELECT commodity FROM ticks WHERE price > 340)"""
SQL["currency_convert"] = f"""SELECT CAST(p_partkey AS VARCHAR) AS message_id,
  {rnd("p_retailprice * 15800 * CASE p_type WHEN 'ECONOMY' THEN 1.8::DOUBLE WHEN 'PROMO' THEN 2.2::DOUBLE ELSE 1.5::DOUBLE END / 1000")} AS local_price FROM part"""
ENVELOPE = f"""SELECT substr(md5(commodity || strftime(event_time, {ISO})), 1, 12) AS message_id, '1.0' AS schema_version,
    commodity, label, price, 'kg' AS unit, 'Nasional' AS region, CAST(NULL AS BIGINT) AS ref_price,
    CAST(NULL AS DOUBLE) AS ref_change_pct, 'unknown' AS source_name, false AS is_shock,
    strftime(event_time, '%Y-%m-%d') AS obs_date, strftime(event_time, '%H:%M:%S') AS obs_time,
    strftime(event_time, {ISO}) AS ts_iso, CAST(floor(epoch(event_time)) AS BIGINT) AS ts_unix,
    'price-monitor' AS pipeline, 'prices' AS topic FROM ticks"""
SQL["price_envelope"] = f"WITH {TICKS} {ENVELOPE}"


def news_message(src: str) -> str:
    return f"""SELECT title, link, left(body, 500) AS summary, published, source_feed,
      {first_keyword("title || ' ' || body")} AS commodity, sent AS ts_text, 'news' AS topic FROM ({src})"""


FEED = f"""SELECT {strip('title')} AS title, {strip('link')} AS link, {tags('summary')} AS body, source_feed,
  strftime(event_time, '%Y-%m-%d %H:%M:%S') AS published, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS sent FROM entries"""
WEB = f"""SELECT {strip("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title, {strip('url')} AS link,
  {tags('html')} AS body, 'web' AS source_feed, strftime(TIMESTAMP '{EPOCH}' + to_minutes(page_id), '%Y-%m-%d %H:%M:%S') AS sent,
  sent AS published FROM pages"""
SQL["news_envelope"] = f"WITH {ENTRIES} {news_message(FEED)}"
SQL["web_news_envelope"] = news_message(WEB)
SQL["json_decode_props"] = "SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
SQL["json_encode_kv"] = f"""WITH {TICKS} SELECT commodity AS key, CAST(to_json({{'message_id': message_id,
  'commodity': commodity, 'price': price, 'day': day}}) AS VARCHAR) AS value FROM ticks"""
NEWS_KEY = "md5(CASE WHEN link = '' THEN md5(title || published) ELSE link END)"
SQL["publish_kv"] = f"""WITH {TICKS}, {ENTRIES}, p AS ({ENVELOPE}), n AS ({news_message(FEED)})
  SELECT commodity AS key, topic, commodity, price, NULL AS link, ts_iso FROM p UNION ALL
  SELECT {NEWS_KEY} AS key, topic, commodity, NULL, link, NULL FROM n"""
SQL["unsent_articles"] = f"""WITH {ENTRIES}, n AS (SELECT {NEWS_KEY} AS key, link, ts_text FROM ({news_message(FEED)}))
  SELECT key, ts_text AS at, link FROM n WHERE ts_text >= '2024-01-16 00:00:00'
    AND key NOT IN (SELECT key FROM n WHERE ts_text < '2024-01-16 00:00:00')"""
SQL["add_provenance"] = f"""WITH {MIXED} SELECT topic, message_id, link, 'mixed-feed' AS _source, true AS ingested,
  '2024-02-01 00:00:00' AS cleaned FROM mixed"""
SQL["raw_price_map"] = f"""WITH listed AS (
    SELECT CASE p_type WHEN 'ECONOMY' THEN 'beras' WHEN 'PROMO' THEN 'cabai' WHEN 'SMALL' THEN 'gula'
             WHEN 'LARGE' THEN 'unknown_thing' ELSE 'bawang_merah' END AS commodity,
           CASE WHEN p_size <= 40 THEN p_retailprice ELSE 0.0 END AS price,
           CASE WHEN p_size > 10 THEN p_brand ELSE 'Nasional' END AS region, '2024-01-01' AS obs_date, 'list' AS source_name FROM part),
  ind AS (SELECT CASE p_type WHEN 'PROMO' THEN 'jagung' ELSE 'gula' END AS commodity,
           {rnd("p_retailprice * 15800 * CASE p_type WHEN 'PROMO' THEN 1.8::DOUBLE ELSE 2.2::DOUBLE END / 1000")} AS price,
           'Global' AS region, '2024' AS obs_date, 'indicator' AS source_name FROM part WHERE p_size > 5)
  SELECT *, CASE commodity WHEN 'beras' THEN 'Beras' WHEN 'cabai' THEN 'Cabai' WHEN 'gula' THEN 'Gula'
    WHEN 'jagung' THEN 'Jagung' ELSE 'Bawang Merah' END AS label, 'kg' AS unit
  FROM (SELECT * FROM listed WHERE commodity <> 'unknown_thing' AND price > 0 UNION ALL SELECT * FROM ind)"""

SQL["live_latest_n"] = f"""WITH {MIXED} SELECT topic, CAST(r AS INTEGER) AS rank, message_id, link, source_feed, commodity FROM (
    SELECT *, row_number() OVER (PARTITION BY topic ORDER BY arrived DESC, message_id, link, source_feed) AS r FROM mixed) WHERE r <= 200"""
SQL["live_latest_roles"] = """SELECT role, CAST(r AS INTEGER) AS rank, conv_id, turn, text FROM (
    SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id DESC, turn) AS r FROM conversations) WHERE r <= 10"""
SQL["live_projection"] = f"""WITH {MIXED} SELECT topic, coalesce(message_id, link) AS id, commodity, label, price,
    CASE topic WHEN 'prices' THEN 'kg' END AS unit, CASE topic WHEN 'prices' THEN 'Nasional' END AS region,
    CASE topic WHEN 'prices' THEN 'simulator' END AS source_name, CASE topic WHEN 'prices' THEN '' END AS obs_date,
    ts_iso, title, left(summary, 300) AS summary, ts_text, published, source_feed FROM mixed"""
SQL["tagged_feed"] = f"""WITH {MIXED} SELECT CASE topic WHEN 'prices' THEN 'price' ELSE 'news' END AS type, arrived, message_id, link,
  summary FROM mixed"""
SQL["envelope_unwrap"] = f"""WITH {TICKS} SELECT message_id, commodity, price, day, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS at,
  'local' AS status FROM ticks ORDER BY event_time DESC, message_id DESC LIMIT 200"""
SQL["source_scan"] = f"""WITH {MIXED} SELECT topic, message_id, link, commodity, price, NULL AS corrupt FROM mixed UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, '{{"message_id": "' || o_orderkey FROM orders WHERE o_totalprice > 400000"""
SQL["landed_clean"] = SQL["clean_prices"]
SQL["landed_accounting"] = f"WITH {MIXED}, {D_PRICES}, {D_NEWS} SELECT * FROM ({ACCOUNTING}) WHERE table_name = 'prices'"

SQL["dashboard_totals"] = """SELECT *, n_prices > 0 AS live_ok, n_news > 0 AS news_ok FROM (SELECT (SELECT count(*) FROM events) AS n_prices,
  (SELECT count(DISTINCT event_type) FROM events) AS n_commodities, (SELECT count(*) FROM documents) AS n_news)"""


def section(name: str, src: str, order: str, value: str, n: int, at: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position, commodity,
      CAST({value} AS DOUBLE) AS value, {at} AS at FROM ({src}) QUALIFY row_number() OVER (ORDER BY {order}) <= {n}"""


SQL["export_tables"] = f"WITH {TICKS}, {DAILY}, {NEWS} " + " UNION ALL ".join(
    [
        section("volatility", cv("ticks"), "cv_index DESC, commodity", "cv_index", 50),
        section("trend", TREND, "commodity, obs_date, hour", "avg_price", 100),
        section("alert", alerts("daily", "event_time"), "pct_change DESC, commodity, event_time", "pct_change", 50, f"strftime(event_time, {ISO})"),
        section("news_correlation", CORRELATION, "n_news DESC, commodity", "n_news", 50),
    ]
)



def rows(src: str, columns: str, order: str, n: int | None = None) -> str:
    """Ordered rows of a query as a list of structs; columns may be ``name`` or ``name=expression``."""
    pairs = [c.partition("=") for c in columns.split("; ")]
    struct = ", ".join(f"'{k.strip()}': {v or k}" for k, _, v in pairs)
    return f"""coalesce((SELECT list({{{struct}}} ORDER BY pos) FROM (
      SELECT *, row_number() OVER (ORDER BY {order}) AS pos FROM ({src})){f" WHERE pos <= {n}" if n else ""}), [])"""


SUMMARY = SQL["trend_summary"].split(f"WITH {TICKS}, s AS (")[1].split(")\n  SELECT *")[0]
ANALYSES = f"""{{'volatility': {rows(ranges('ticks'), "commodity; label; max_price; min_price; avg_price; stddev_price; n_obs; range_index", "range_index DESC, commodity, label")},
  'price_trend': {rows(SUMMARY, "commodity; label; avg_price; min_price; max_price; n_days; n_obs", "avg_price DESC, commodity, label")},
  'news_correlation': {rows(MENTION_CORR, "commodity; label; range_index; avg_price; n_mentions; coverage_class", "n_mentions DESC, range_index DESC, commodity, label")}}}"""
SQL["results_document"] = f"""WITH {TICKS}, {ENTRIES} SELECT CAST(to_json({{'metadata': {{'generated_at': '2024-02-01T00:00:00',
  'total_prices': (SELECT count(*) FROM events), 'total_news': (SELECT count(*) FROM documents)}}, 'analyses': {ANALYSES}}}) AS VARCHAR) AS document"""
LIVE_P = rows(
    "SELECT * FROM mixed WHERE topic = 'prices'",
    "commodity; label; price; unit='kg'; region='Nasional'; ref_price=NULL; ref_change_pct=NULL; source_name='simulator'; "
    "obs_date=''; obs_time=''; ts_iso; message_id",
    "arrived DESC, message_id",
    20,
)
LIVE_N = rows(
    "SELECT * FROM mixed WHERE topic = 'news'",
    "title; link; summary=left(summary, 300); commodity; ts_text; published; source_feed",
    "arrived DESC, link, title",
    20,
)
SQL["dashboard_payload"] = f"""WITH {TICKS}, {MIXED} SELECT CAST(to_json({{'server_time': '2024-02-01T00:00:00',
  'live_prices': {LIVE_P}, 'news': {LIVE_N}, 'analyses': {ANALYSES},
  'status': {{'analyses_ok': true, 'live_ok': true, 'news_ok': true}}}}) AS VARCHAR) AS document"""
DAY = "strftime(obs_date, '%Y-%m-%d')"
SQL["export_document"] = f"""WITH {TICKS}, {DAILY}, {NEWS} SELECT CAST(to_json({{
  'metadata': {{'generated_at': '2024-02-01T00:00:00', 'source': 'gold', 'pipeline': 'price-monitor'}},
  'volatility': {rows(cv('ticks'), "commodity; mean_price; stddev_price; min_price; max_price; n_obs; cv_index; status", "cv_index DESC, commodity", 50)},
  'trend': {rows(TREND, f"commodity; obs_date={DAY}; hour; dow; avg_price; min_price; max_price; n_obs", "commodity, obs_date, hour", 100)},
  'alert': {rows(alerts('daily', 'event_time'), f"commodity; price; prev_price; pct_change; direction; status; obs_date={DAY}; hour; event_time=strftime(event_time, {ISO})", "pct_change DESC, commodity, event_time", 50)},
  'news_correlation': {rows(CORRELATION, "commodity; n_news; news_morning; news_afternoon; news_evening; mean_price; stddev_price; cv_index; status; n_price_obs; coverage_class", "n_news DESC, commodity", 50)}
  }}) AS VARCHAR) AS document"""

O = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
U = "SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'REVIEW' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate FROM orders"
SQL["snapshot_as_of"] = O
SQL["snapshot_update"] = U
SQL["snapshot_delete"] = f"SELECT * FROM ({U}) WHERE o_orderstatus <> 'P'"
SQL["snapshot_diff"] = f"""SELECT * FROM (SELECT b.o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'removed'
      WHEN a.o_orderstatus <> b.o_orderstatus THEN 'changed' END AS change, b.o_orderstatus AS o_orderstatus_before,
      b.o_totalprice AS o_totalprice_before, a.o_orderstatus AS o_orderstatus_after, a.o_totalprice AS o_totalprice_after
    FROM ({O}) b LEFT JOIN ({SQL['snapshot_delete']}) a USING (o_orderkey)) WHERE change IS NOT NULL"""
SQL["snapshot_history"] = " UNION ALL ".join(
    f"""SELECT {v} AS version, '{op}' AS operation, 'overwrite' AS mode, count(*) AS n_rows,
      count(*) FILTER (o_orderstatus IS NULL) AS n_nulls, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM ({src})"""
    for v, op, src in ((0, "CREATE", O), (1, "UPDATE", U), (2, "DELETE", SQL["snapshot_delete"]))
)
SQL["snapshot_counts"] = " UNION ALL ".join(
    f"SELECT 'v{v}' AS table_name, count(*) AS n_rows FROM ({src})" for v, src in enumerate((O, U, SQL["snapshot_delete"]))
)
SQL["schema_merge"] = f"""WITH {TICKS} SELECT message_id, commodity, price, event_time,
  CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN 'kg' END AS unit FROM ticks"""
CLEAN_P = f"cleaned_prices AS ({SQL['clean_prices'].split(D_PRICES)[1]})"
CLEAN_N = f"""cleaned_news AS (SELECT * FROM (SELECT * FROM mixed WHERE topic = 'news'
    QUALIFY row_number() OVER (PARTITION BY link ORDER BY ts_text DESC) = 1)
  WHERE NOT ({BAD_TEXT}) AND NOT ({BAD_COMMODITY}))"""
SQL["gold_tables"] = f"""WITH {MIXED}, {D_PRICES}, {CLEAN_P}, {CLEAN_N}
  SELECT 'volatility' AS table_name, commodity, NULL AS day, NULL AS hour, cv_index AS value FROM ({cv('cleaned_prices')}) UNION ALL
  SELECT 'trend', commodity, strftime(obs_date, '%Y-%m-%d'), hour, avg_price FROM ({TREND.replace('FROM ticks', 'FROM cleaned_prices')}) UNION ALL
  SELECT 'alert', commodity, strftime(obs_date, '%Y-%m-%d'), hour, pct_change FROM ({alerts('cleaned_prices', 'event_time, message_id')}) UNION ALL
  SELECT 'news_correlation', commodity, NULL, NULL, CAST(count(*) AS DOUBLE) FROM cleaned_news GROUP BY commodity"""

SQL["quality_profile"] = f"WITH {MIXED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, CAST(min({c}) AS VARCHAR) AS min_value,
      CAST(max({c}) AS VARCHAR) AS max_value FROM mixed"""
    if c in FILLED
    else f"SELECT '{c}', count(*), count(*), NULL, NULL FROM mixed"
    for c in MIXED_COLUMNS
)
SQL["schema_check"] = f"""WITH {MIXED}, n AS (SELECT count(*) AS n_rows FROM mixed)
  SELECT n_rows, column_name, column_name <> 'event_time' AS present FROM n,
    (VALUES ('_ingested_at'), ('_source'), ('commodity'), ('event_time')) c(column_name)"""
SQL["cardinality_check"] = """SELECT n_distinct, CAST(5 AS BIGINT) AS expected, n_distinct = 5 AS ok
  FROM (SELECT count(DISTINCT event_type) AS n_distinct FROM events)"""
SQL["zscore_anomaly"] = f"""WITH {TICKS}, s AS (SELECT commodity, avg(price) AS m, stddev_samp(price) AS d FROM ticks WHERE price > 0 GROUP BY 1)
  SELECT commodity, message_id, price, event_time, {rnd('(price - m) / NULLIF(d, 0)', 3)} AS zscore FROM ticks JOIN s USING (commodity)
  WHERE price > 0 AND abs({rnd('(price - m) / NULLIF(d, 0)', 3)}) > 3"""


def periods(unit: str) -> str:
    return f"""WITH {TICKS} SELECT *, {status('cv_index')} AS status FROM (
      SELECT *, coalesce({pct('stddev_price', 'mean_price')}, 0.0) AS cv_index FROM (
        SELECT commodity, CAST(date_trunc('{unit}', CAST(event_time AS DATE)) AS DATE) AS period, {rnd('avg(price)')} AS mean_price,
               {rnd('stddev_samp(price)')} AS stddev_price, count(price) AS n_obs FROM ticks WHERE price > 0 GROUP BY ALL))"""


SQL["weekly_volatility"] = periods("week")
SQL["daily_volatility"] = periods("day")
# The best split of the daily means in two, found by trying each.
SQL["trend_clusters"] = f"""WITH d AS ({periods('day')}), v AS (
    SELECT mean_price, count(*) OVER w AS n, sum(mean_price) OVER w AS s, sum(mean_price * mean_price) OVER w AS q,
      count(*) OVER () AS n_all, sum(mean_price) OVER () AS s_all, sum(mean_price * mean_price) OVER () AS q_all
    FROM d WINDOW w AS (ORDER BY mean_price RANGE UNBOUNDED PRECEDING)),
  best AS (SELECT mean_price AS cut FROM v WHERE n < n_all
    ORDER BY q - s * s / n + q_all - q - (s_all - s) * (s_all - s) / (n_all - n) LIMIT 1)
  SELECT commodity, period, mean_price, CASE WHEN mean_price > (SELECT cut FROM best) THEN 1 ELSE 0 END AS cluster FROM d"""
SQL["sql_hourly_peak"] = "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_obs, max(value) AS peak FROM events WHERE value > 0 GROUP BY 1 HAVING count(*) > 1"
SQL["first_available"] = f"""WITH {TICKS}, {DAILY}, high AS (SELECT * FROM ticks WHERE price > 340)
  SELECT commodity, price, 'all' AS state FROM high UNION ALL SELECT commodity, price, 'second' FROM high UNION ALL
  SELECT commodity, price, 'all' FROM daily WHERE NOT EXISTS (FROM high) UNION ALL
  SELECT p_type, p_retailprice, 'all' FROM part WHERE NOT EXISTS (FROM high) AND p_type NOT IN (SELECT commodity FROM daily) UNION ALL
  SELECT commodity, price, 'second' FROM daily WHERE commodity NOT IN (SELECT commodity FROM high) UNION ALL
  SELECT p_type, p_retailprice, 'third' FROM part"""
DAYS = f"(floor(epoch(event_time)) - epoch(TIMESTAMP '{EPOCH}')) / 86400.0::DOUBLE"
SQL["trend_slope"] = f"""WITH {TICKS} SELECT commodity, {rnd(f'regr_slope(price, {DAYS})', 4)} AS slope_per_day,
  {rnd(f'regr_intercept(price, {DAYS})', 4)} AS intercept, count(price) AS n_obs FROM ticks WHERE price > 0 GROUP BY commodity"""
SQL["fill_standardise"] = f"""WITH {MIXED} SELECT message_id, link, upper(source_feed) AS source_feed,
  regexp_replace(upper(trim(commodity)), '\\s+', ' ', 'g') AS commodity,
  coalesce(title, '') AS title, coalesce(price, 0.0) AS price, 'kg' AS unit FROM mixed"""

SQL["stream_land"] = f"WITH {MIXED} SELECT topic, message_id, link, commodity, price, ts_iso, ts_text FROM mixed"
SQL["stream_publish"] = f"""WITH {FAULTY} SELECT commodity AS key, substr(md5(commodity || strftime(ts, {ISO})), 1, 12) AS message_id,
  p AS price, strftime(ts, {ISO}) AS ts_iso FROM v WHERE {REASON} IS NULL"""
SQL["stream_ingest"] = f"WITH {MIXED} SELECT topic, 'landed' AS _source, message_id, link, commodity, price FROM mixed"
SQL["stream_fanout"] = f"""WITH {MIXED}, r AS (SELECT *, row_number() OVER (PARTITION BY topic
      ORDER BY arrived DESC, message_id, link, title) AS r FROM mixed)
  SELECT topic AS view, coalesce(message_id, link) AS id, CAST(1 AS BIGINT) AS n FROM r WHERE r <= 10 UNION ALL
  SELECT CASE topic WHEN 'prices' THEN 'feed:price' ELSE 'feed:news' END, NULL, count(*) FROM mixed GROUP BY topic"""
SQL["stream_dedup"] = f"WITH {ENTRIES} SELECT DISTINCT link, title FROM entries"
SQL["stream_trend"] = f"""WITH {TICKS}, h AS (SELECT commodity, date_trunc('hour', event_time) AS hour_start,
    {rnd('avg(price)', 0)} AS avg_price, {rnd('min(price)', 0)} AS min_price, {rnd('max(price)', 0)} AS max_price,
    count(price) AS n_obs FROM ticks WHERE price > 0 GROUP BY commodity, date_trunc('hour', event_time))
  SELECT * FROM h"""
SQL["stream_dedup_archived"] = SQL["stream_dedup"]
SQL["stream_closed_hours"] = f"""WITH {TICKS}, h AS (SELECT commodity, date_trunc('hour', event_time) AS hour_start,
    {rnd('avg(price)', 0)} AS avg_price, {rnd('min(price)', 0)} AS min_price, {rnd('max(price)', 0)} AS max_price,
    count(price) AS n_obs FROM ticks WHERE price > 0 GROUP BY commodity, date_trunc('hour', event_time)),
  m AS (SELECT max(event_time) - INTERVAL 1 HOUR AS mark FROM ticks WHERE price > 0)
  SELECT h.*, CASE WHEN hour_start < TIMESTAMP '2024-01-16' THEN 'late' WHEN hour_start + INTERVAL 1 HOUR <= mark THEN 'closed' ELSE 'open' END AS state
  FROM h, m"""
SQL["keyword_table_first"] = SQL["keyword_tag_words"]
SQL["keyword_table_phrases"] = r"""WITH w AS (SELECT [x FOR x IN string_split_regex(lower(text), '[^\p{L}\p{N}_]+') IF x <> ''] AS w FROM benchmark),
  k AS (SELECT DISTINCT array_to_string(w[i : i + 1], ' ') AS keyword FROM (SELECT w, unnest(generate_series(1, len(w) - 1)) AS i FROM w WHERE len(w) > 1)),
  c AS (SELECT doc_id, string_split(lower(text), ' ') AS c FROM documents),
  p AS (SELECT DISTINCT doc_id, regexp_extract(c[i], '[\p{L}\p{N}_]+$') || ' ' || regexp_extract(c[i + 1], '^[\p{L}\p{N}_]+') AS keyword
        FROM (SELECT doc_id, c, unnest(generate_series(1, len(c) - 1)) AS i FROM c WHERE len(c) > 1))
  SELECT keyword, count(*) AS n_docs FROM k JOIN p USING (keyword) GROUP BY keyword"""
SQL["distinct_sketch"] = "SELECT event_type AS commodity, count(DISTINCT user_id) AS n_users, true AS within_bound FROM events GROUP BY event_type"
SQL["clean_prices_batches"] = SQL["clean_prices"]
SQL["clean_news_batches"] = SQL["clean_news"]
SQL["stream_land_grouped"] = SQL["stream_land"]
