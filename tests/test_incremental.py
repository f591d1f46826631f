"""Partition-wise changes, cleaning in batches, mergeable statistics, keyword tables."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from settings import SF
from pricewatch import schemas
from pricewatch.operators import clean, dedup, enrich, keywords, moments, sketches, volatility
from pricewatch.plans import incremental, queries
from pricewatch.session import new_dir, stored
from pricewatch.sources import adapters, partitioned
from pricewatch.sources.partitioned import PartitionedTable


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda row: [(x is None, 0 if x is None else x) for x in row])


def files_by(df, column):
    found = df.select(column, F.col("_metadata.file_path")).distinct().collect()
    return {r[0]: sorted(x[1] for x in found if x[0] == r[0]) for r in found}


def test_only_partitions_with_hits_are_rewritten(spark):
    rows = spark.createDataFrame([(i, f"k{i % 4}" if i % 4 else None, "a", None if i == 5 else i) for i in range(40)], "id int, part string, name string, n int")
    table = PartitionedTable(spark, new_dir(spark, "p"), rows.schema, ("part",))
    table.replace(rows, rows.select("part").distinct())
    before = files_by(table.read(), "part")
    assert set(before) == {None, "k1", "k2", "k3"}
    table.update(F.col("n") % 20 == 6, {"name": F.lit("z")})
    after = files_by(table.read(), "part")
    assert [p for p in before if before[p] != after[p]] == ["k2"]
    assert rows_of(table.read().select("id").filter("name = 'z'")) == [(6,), (26,)]
    table.delete(F.col("part") == "k3")  # a partition left empty
    table.delete(F.col("n") == 8)  # the one without a value
    left = files_by(table.read(), "part")
    assert set(left) == {None, "k1", "k2"} and left["k2"] == after["k2"] and left[None] != after[None]
    assert table.read().count() == 29
    table.delete(F.col("n") == -1)
    assert files_by(table.read(), "part") == left


def mixed(spark):
    """Messages with copies whose times differ, also across days, and equal copies with other texts."""
    rows = adapters.mixed(spark, SF)
    again = rows.filter("topic = 'news'").withColumn("ts_text", F.concat(F.lit("2024-02-2"), F.substring("ts_text", 10, 10)))
    other = rows.filter("topic = 'prices'").withColumn("label", F.lit("other"))
    return rows.unionByName(again).unionByName(other.filter(F.pmod(F.hash("message_id"), F.lit(3)) == 0))


@pytest.mark.parametrize("cleaning, whole", [(incremental.PRICES, clean.clean_prices), (incremental.NEWS, clean.clean_news)])
def test_batches_equal_a_full_rebuild(spark, cleaning, whole):
    raw = mixed(spark)
    table = incremental.IncrementalClean(spark, new_dir(spark, "clean"), schemas.MIXED, cleaning, queries.SETTINGS, buckets=4)
    part = F.pmod(F.hash("message_id", "link", "ts_text", "label"), F.lit(3))
    for i in (2, 0, 1):
        table.add(raw.filter(part == i))
    columns = ["message_id", "commodity", "price", "title", "link", "ts_text", "label", "event_time", "hour", "dow"]
    want = whole(raw, queries.SETTINGS).select(*columns)
    assert rows_of(table.cleaned().select(*columns)) == rows_of(want)
    keys = table.keys.read()
    assert keys.count() == keys.select("_digest").distinct().count() == table.rows.read().count()


def test_a_batch_rewrites_touched_dates_only(spark):
    raw = adapters.mixed(spark, SF).filter("topic = 'prices'")
    table = incremental.IncrementalClean(spark, new_dir(spark, "clean"), schemas.MIXED, incremental.PRICES, queries.SETTINGS, buckets=4)
    table.add(raw)
    before = files_by(table.rows.read(), "_date")
    new = raw.filter("ts_iso like '2024-01-05%'").limit(3).withColumn("message_id", F.concat("message_id", F.lit("-new")))
    table.add(new)
    after = files_by(table.rows.read(), "_date")
    assert [str(d) for d in after if before.get(d) != after[d]] == ["2024-01-05"]
    assert table.rows.read().count() == raw.count() + 3


def test_a_batch_writes_its_rows_once(spark, monkeypatch):
    """Beside the table itself, only keys and dates are written; the rows that a change reads are those of the table."""
    written = []
    for module in (incremental, partitioned):
        monkeypatch.setattr(module, "stored", lambda df, label: written.append(set(df.columns)) or stored(df, label))
    table = incremental.IncrementalClean(spark, new_dir(spark, "clean"), schemas.MIXED, incremental.NEWS, queries.SETTINGS, buckets=4)
    raw = adapters.mixed(spark, SF).filter("topic = 'news'")
    for part in (raw.limit(50), raw, raw.limit(50)):
        table.add(part)
    assert len(written) == 9 and set().union(*written) == {"_digest", "_date", "_bucket"}
    assert table.rows.read().count() == raw.select("link").distinct().count()


def test_moments_merge_exactly(spark):
    ticks = adapters.ticks(spark, SF).withColumn("price", F.col("price") + 1e6)  # far from zero: naive sums of squares would lose digits
    fine = moments.collect(ticks, ["commodity", "day", "hour"])
    merged = {r.commodity: r for r in moments.combine(fine, ["commodity"]).select("*", moments.deviation().alias("dev")).collect()}
    for r in ticks.groupBy("commodity").agg(F.count("price").alias("n"), F.avg("price").alias("m"), F.stddev("price").alias("d"), F.min("price").alias("lo")).collect():
        got = merged[r.commodity]
        assert got.n_obs == r.n and got.low == r.lo
        assert math.isclose(got.total / got.n_obs, r.m, rel_tol=1e-12) and math.isclose(got.dev, r.d, rel_tol=1e-9)


def test_moments_of_empty_groups(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 4.0), ("a", 3, 6.0), ("b", 1, None), ("c", 1, 5.0)], "commodity string, day int, price double")
    got = moments.combine(moments.collect(df, ["commodity", "day"]), ["commodity"]).select("commodity", "n_obs", "total", "squares", "low", moments.deviation().alias("dev"))
    assert rows_of(got) == [("a", 2, 10.0, 2.0, 4.0, math.sqrt(2)), ("b", 0, 0.0, 0.0, None, None), ("c", 1, 5.0, 0.0, 5.0, None)]
    assert [r.commodity for r in volatility.cv_table(moments.combine(moments.collect(df, ["commodity", "day"]), ["commodity"])).orderBy("commodity").collect()] == ["a", "c"]


def test_sketches_keep_their_bound(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("commodity"), (F.col("id") % 7).alias("day"), (F.col("id") % 21_000).alias("user"))
    rows = rows.unionByName(spark.createDataFrame([(9, 1, None)], "commodity long, day long, user long"))
    got = {r.commodity: r.n for r in sketches.merged(sketches.daily_sketches(rows, F.col("user"), ["commodity", "day"]), ["commodity"]).select("commodity", sketches.estimate().alias("n")).collect()}
    assert got.pop(9) == 0
    assert all(abs(n - 7000) <= 7000 * sketches.error_bound() for n in got.values()) and len(got) == 3


def test_keyword_table_equals_the_chain_of_tests(spark):
    texts = ["Beras dan padi", "harga minyak  goreng", "Minyak goreng naik, beras", "minyakgoreng", "CPO_x tahu-tempe", "bawang merah.", "bawang", "", None, "x telur ayam", "telur_ayam", "GULA!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    known = [(w, c, i) for i, (c, ws) in enumerate(enrich.dims.NEWS_KEYWORDS.items()) for w in ws]
    table = spark.createDataFrame(known, "keyword string, tag string, rank int")
    got = keywords.first_tag(df, table, "id", "body", "umum").select("id", "commodity")
    want = enrich.keyword_tag(df, F.col("body"), default="umum", whole_words=True).select("id", "commodity")
    assert rows_of(got) == rows_of(want)


def test_a_hundred_thousand_keywords(spark):
    table = spark.range(100_000).select(F.concat(F.lit("Key "), F.col("id")).alias("keyword"), F.lit("t").alias("tag"), F.lit(0).alias("rank"))
    df = spark.range(200).select("id", F.concat(F.lit("the key "), F.col("id") * 700, F.lit(" and key-"), F.col("id") + 1, F.lit(" end")).alias("body"))
    got = keywords.mentions(df, table, "id", "body")
    assert rows_of(got.select("id", "keyword")) == [(i, f"key {i * 700}") for i in range(143)]


def test_keywords_with_odd_characters(spark):
    table = spark.createDataFrame([("a\\Eb c", "x", 0), ("...", "y", 1), ("(d", "z", 2)], "keyword string, tag string, rank int")
    df = spark.createDataFrame([(1, "see a\\Eb c here"), (2, "..."), (3, "(d)"), (4, "a.Eb c")], "id int, body string")
    assert rows_of(keywords.mentions(df, table, "id", "body").select("id", "tag")) == [(1, "x"), (3, "z")]


def test_words_that_stand_apart_are_no_candidates(spark, monkeypatch):
    """Frequent words of a phrase, none of them rare, do not bring their texts in; texts are not looked at for pairs."""
    seen = {}
    monkeypatch.setattr(keywords, "stored", lambda df, label: seen.setdefault(label, stored(df, label)))
    monkeypatch.setattr(keywords, "_stands", None)
    body = F.when(F.col("id") % 50 == 0, F.lit("no, The  Big end")).otherwise(F.lit("big is the end"))
    df = spark.range(500).select("id", body.alias("body"))
    table = spark.createDataFrame([("the  big", "x", 0), ("big end", "x", 0), ("the big", "x", 0), ("end", "y", 1)], "keyword string, tag string, rank int")
    got = keywords.mentions(df, table, "id", "body").groupBy("keyword").count()
    assert rows_of(got) == [("big end", 10), ("end", 500), ("the  big", 10)]
    assert seen["keyword-candidates"].count() == 520


def test_keywords_of_any_length_against_brute_force(spark):
    rng = random.Random(3)
    make = lambda low, high: "".join(rng.choice(["a", "B", "ç", "x1", "_"]) + rng.choice([" ", " ", ", ", "-", "\n"]) for _ in range(rng.randint(low, high)))
    texts = [rng.choice(["", "("]) + make(0, 30) + rng.choice(["", "b"]) for _ in range(150)] + [None]
    keys = sorted({rng.choice(["", "("]) + make(1, 4)[: rng.choice([-1, None])] for _ in range(300)})
    table = spark.createDataFrame([(k, "t", 0) for k in keys], "keyword string, tag string, rank int")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    got = {(r.id, r.keyword) for r in keywords.mentions(df, table, "id", "body").collect()}
    lowered = {k.lower() for k in keys if re.search(r"\w", k)}
    want = {(i, k) for i, t in enumerate(texts) if t for k in lowered if re.search(rf"(?<!\w){re.escape(k)}(?!\w)" if k[0] != "(" and k[-1].isalnum() else rf"(?:\A|\W){re.escape(k)}(?:\W|\Z)", t.lower())}
    assert got == want and len(got) > 300


def test_null_and_empty_texts_do_not_tie(spark):
    rows = [("k", None, "b", {"x": 1}), ("k", "", "b", {"x": 1}), ("k", "", "b", {"x": 2})]
    df = spark.createDataFrame(rows, "k string, a string, z string, m map<string,int>")
    kept = {tuple(dedup.keep_one(d, ["k"]).select("a", "z", F.to_json("m")).first()) for d in (df, df.coalesce(1).orderBy(F.desc("a")), df.repartition(3))}
    assert len(kept) == 1
