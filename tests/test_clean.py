"""Golden rows of the cleaning rules."""

import itertools
import random

from pyspark.sql import functions as F

from pricewatch import schemas
from pricewatch.operators import clean, dedup

S = clean.Settings()


def price_row(i, **kw):
    base = {
        "message_id": f"m{i}", "commodity": "beras", "price": 5000.0, "topic": "prices", "ts_iso": "2026-03-06T08:00:00.000001",
    }
    return {**base, **kw}


def frame(spark, rows):
    df = spark.createDataFrame([], schemas.MIXED)
    rows = [tuple(r.get(c) for c in df.columns) for r in rows]
    return spark.createDataFrame(rows, schemas.MIXED)


def kept(df):
    return {r.message_id for r in df.select("message_id").collect()}


def test_price_interval_is_open(spark):
    prices = [None, 0.0, -1.0, 100.0, 100.01, 999999.99, 1000000.0, float("nan"), float("inf"), float("-inf")]
    df = frame(spark, [price_row(i, price=p) for i, p in enumerate(prices)])
    assert kept(clean.clean_prices(df, S)) == {"m4", "m5"}


def test_commodity_is_normalised(spark):
    values = [None, " Beras ", "UMUM", "kopi"]
    df = frame(spark, [price_row(i, commodity=v) for i, v in enumerate(values)])
    out = {r.message_id: r.commodity for r in clean.clean_prices(df, S).collect()}
    assert out == {"m1": "beras", "m2": "umum"}


def test_topics(spark):
    rows = [price_row(0, topic=None), price_row(1, topic="news", price=None), price_row(2, price=None)]
    df = frame(spark, rows)
    assert kept(clean.clean_prices(df, S)) == {"m1"}
    counts = {r.rule: r.n_removed for r in clean.price_accounting(df, S).collect()}
    assert counts == {"duplicate": 0, "missing_topic": 1, "invalid_price": 1, "invalid_commodity": 0, "invalid_time": 0}


def test_event_time(spark):
    rows = [
        price_row(0),
        price_row(1, ts_iso=None, ts_text="2026-03-06 08:00:00"),
        price_row(2, ts_iso=None, obs_date="2026-03-06", obs_time="21:30:00"),
        price_row(3, ts_iso="2026"),
        price_row(4, ts_iso=None, ts_text="06/03/2026"),
        price_row(5, ts_iso=None, ts_text="2026-13-45 08:00:00"),
    ]
    out = {r.message_id: (r.event_time.hour, r.hour, r.dow) for r in clean.clean_prices(frame(spark, rows), S).collect()}
    assert out == {"m0": (8, 8, 6), "m1": (8, 8, 6), "m2": (21, 21, 6)}
    strict = clean.clean_prices(frame(spark, rows), clean.Settings(strict_time=True))
    assert kept(strict) == {"m1"}


def test_news_rules(spark):
    base = {
        "topic": "news", "title": "t", "summary": "s", "commodity": "cabai", "published": "12345678901",
        "ts_text": "2026-03-06 08:00:00",
    }
    changes = [{}, {"title": "   "}, {"summary": None}, {"published": "1234567890"}, {"commodity": "kopi"}, {"ts_text": "x"}]
    rows = [{**base, "link": f"l{i}", **c} for i, c in enumerate(changes)]
    rows += [{**base, "link": None, "title": None}, {**base, "link": None, "title": ""}]
    df = frame(spark, rows)
    assert [r.link for r in clean.clean_news(df, S).collect()] == ["l0"]
    counts = [(r.rule, r.n_before, r.n_after) for r in clean.news_accounting(df, S).orderBy("step").collect()]
    assert counts == [
        ("duplicate", 8, 7), ("blank_text", 7, 4), ("invalid_commodity", 4, 3), ("invalid_published", 3, 2), ("invalid_time", 2, 1),
    ]


def test_accounting_of_nothing(spark):
    rows = clean.price_accounting(frame(spark, []), S).collect()
    assert {(r.n_before, r.n_removed, r.removed_pct) for r in rows} == {(0, 0, 0.0)}
    assert clean.cleaning_summary(clean.price_accounting(frame(spark, []), S)).count() == 2


def test_accounting_equals_step_filters(spark):
    rng = random.Random(3)
    rows = [
        price_row(
            rng.randrange(40),
            price=rng.choice([50.0, 500.0, None, 2e6]),
            commodity=rng.choice(["beras", "kopi", None, "telur"]),
            topic=rng.choice(["prices", "news", None]),
            ts_iso=rng.choice(["2026-03-06T08:00:00", "bad"]),
        )
        for _ in range(300)
    ]
    df = frame(spark, rows)
    left = clean.dedup_prices(df)
    counts = [(df.count(), left.count())]
    for _, ok in clean.price_rules(S):
        before = counts[-1][1]
        left = left.filter(ok)
        counts.append((before, left.count()))
    got = [(r.n_before, r.n_after) for r in clean.price_accounting(df, S).orderBy("step").collect()]
    assert got == counts
    assert clean.clean_prices(df, S).count() == counts[-1][1]


def test_dedup_is_deterministic_and_whole(spark):
    rows = [(k, p, f"t{p}") for k, p in itertools.product(["a", "b", None], range(50))]
    df = spark.createDataFrame(rows, "k string, price int, t string")
    for seed in (1, 2):
        out = dedup.keep_one(df.orderBy(F.rand(seed)).repartition(7), ["k"], [F.desc("price")]).collect()
        assert sorted((r.k or "", r.price, r.t) for r in out) == [("", 49, "t49"), ("a", 49, "t49"), ("b", 49, "t49")]


def test_cleaning_is_idempotent(spark):
    df = frame(spark, [price_row(i % 5, price=100.0 * i) for i in range(20)])
    once = clean.clean_prices(df, S)
    again = clean.clean_prices(once.drop("event_time", "hour", "dow"), S)
    assert kept(once) == kept(again)


def test_validation_order(spark):
    cases = [
        ("beras", "5000", "kg", None), (None, "5000", "kg", "missing_field"), ("beras", None, "kg", "missing_field"),
        ("beras", "1", None, "missing_field"), ("beras", "abc", "kg", "not_numeric"), ("kopi", "0", "kg", "not_positive"),
        ("beras", "-Infinity", "kg", "not_positive"), ("beras", "1000000", "kg", None), ("beras", "1000000.01", "kg", "too_high"),
        ("beras", "Infinity", "kg", "too_high"), ("kopi", "NaN", "kg", "nan"), ("kopi", "5", "kg", "unknown_commodity"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "commodity string, price string, unit string")
    got = [r.reject_reason for r in clean.validate_prices(df, ["beras"]).collect()]
    assert got == [c[3] for c in cases]
