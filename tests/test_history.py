"""Versioned dimensions, as-of joins, mergeable distinct counts and rolling windows over blocks of days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from adtally import catalog
from adtally.plans import distinct, history, timeseries
from adtally.plans.models import Models
from tests.compare import assert_same, spark_rows
from tests.conftest import SF_SMALL

DAY = lambda d, h=0: dt.datetime(2024, 1, d, h)
VERSION = "publisher_id int, name string, country string, valid_from timestamp_ntz"


def versions(spark, rows):
    return spark.createDataFrame(rows, VERSION)


def merged(spark, *loads):
    done = history.intervals(versions(spark, loads[0]), ["publisher_id"], ["name", "country"])
    for load in loads[1:]:
        done = history.merge_versions(done, versions(spark, load), ["publisher_id"], ["name", "country"])
    return sorted(map(tuple, done.collect()), key=str)


def test_merging_opens_closes_and_ignores_what_did_not_change(spark):
    first = [(1, "a", "GB", DAY(1)), (2, "x", None, DAY(1)), (None, "n", "US", DAY(1))]
    assert merged(spark, first, [(1, "b", "GB", DAY(5)), (1, "b", "GB", DAY(7)), (2, "x", None, DAY(9)), (3, "new", "US", DAY(2))]) == sorted([
        (1, "a", "GB", DAY(1), DAY(5), 0), (1, "b", "GB", DAY(5), None, 1), (2, "x", None, DAY(1), None, 1),
        (None, "n", "US", DAY(1), None, 1), (3, "new", "US", DAY(2), None, 1)], key=str)


def test_any_split_and_order_of_the_loads_gives_the_same_history(spark):
    pick = random.Random(2)
    rows = [(i % 3, pick.choice("ab"), pick.choice(["GB", "US"]), DAY(1 + n)) for i in range(3) for n in range(6)]
    whole = merged(spark, rows)
    for _ in range(3):
        mixed = pick.sample(rows, len(rows))
        found = merged(spark, mixed[:6], mixed[6:12], mixed[12:])
        # a version folded into its predecessor is not known any more when one comes between: compare what was valid when
        for key in range(3):
            for day in range(1, 8):
                at = lambda h: [r[1:3] for r in h if r[0] == key and r[3] <= DAY(day, 12) and (r[4] is None or DAY(day, 12) < r[4])]
                assert len(at(whole)) == len(at(found)) <= 1
        assert {r[0] for r in found} == {r[0] for r in whole}


def test_as_of_against_a_plain_search(spark):
    pick = random.Random(4)
    rows = [(k, f"v{n}", "GB", DAY(1 + 3 * n + k, 5)) for k in range(4) for n in range(4)]
    facts = [(i, pick.choice([0, 1, 2, 3, 9, None]), pick.choice([None, DAY(pick.randint(1, 25), pick.randint(0, 23))]) if i % 9 == 0
              else DAY(pick.randint(1, 25), pick.randint(0, 23))) for i in range(400)] + [(900, 1, DAY(2, 5)), (900, 1, DAY(2, 5))]
    expected = []
    for i, key, at in facts:
        valid = [r for r in rows if r[0] == key and at is not None and r[3] <= at]
        expected.append((i, key, at, max(valid, key=lambda r: r[3])[1] if valid else None))
    frame = spark.createDataFrame(facts, "fact int, publisher_id int, at timestamp_ntz")
    held = history.intervals(versions(spark, rows), ["publisher_id"], ["name", "country"])
    for options in ({}, {"salts": 3}, {"block": "hour"}, {"block": "month", "salts": 2}):
        found = history.as_of(frame, held, "publisher_id", "at", ["name"], **options)
        assert sorted([(r.fact, r.publisher_id, r.at, r.version and r.version.name) for r in found.collect()], key=str) == sorted(expected, key=str)


def test_as_of_empty_sides(spark):
    facts = spark.createDataFrame([(1, 1, DAY(1))], "id int, publisher_id int, at timestamp_ntz")
    held = history.intervals(versions(spark, []), ["publisher_id"], ["name", "country"])
    assert [r.version for r in history.as_of(facts, held, "publisher_id", "at", ["name"]).collect()] == [None]
    assert history.as_of(facts.limit(0), held, "publisher_id", "at", ["name"]).collect() == []


def test_as_of_plan_merges_sorted_sides_and_splits_keys(spark):
    p = catalog.run("revenue_by_publisher_version", spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "Window" in p and "hashpartitioning(key" in p and "block" in p.split("hashpartitioning(key")[1][:60]


def test_estimates_of_united_sketches(spark):
    rows = spark.range(60_000).select(
        F.timestamp_add("DAY", (F.col("id") % 30).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("event_timestamp"),
        (F.col("id") % 4).cast("int").alias("publisher_id"), (F.col("id") % 20_011).cast("string").alias("event_id"), (F.col("id") % 3).cast("string").alias("site_domain"))
    daily = distinct.daily_sketches(rows.withColumn("site_domain", F.when(F.col("publisher_id") > 0, F.col("site_domain"))), ("event_id", "site_domain"))
    whole = distinct.united(daily).first()
    assert abs(whole.event_id_estimate - 20_011) <= 4 * distinct.RELATIVE_ERROR * 20_011 and whole.rows == 60_000 and whole.site_domain_estimate == 3
    by_publisher = {r.publisher_id: r for r in distinct.united(daily.where("event_date < '2024-01-08'"), ["publisher_id"]).collect()}
    exact = {r.publisher_id: r.n for r in rows.where("event_timestamp < timestamp_ntz '2024-01-08 00:00:00'").groupBy("publisher_id")
             .agg(F.count_distinct("event_id").alias("n")).collect()}
    for publisher, n in exact.items():
        assert abs(by_publisher[publisher].event_id_estimate - n) <= 4 * distinct.RELATIVE_ERROR * n
    assert by_publisher[0].site_domain_estimate == 0
    assert distinct.united(daily.limit(0)).first().event_id_estimate == 0


def test_united_sketches_estimate_like_the_sketch_of_the_whole(spark):
    events = catalog.models_for(spark, SF_SMALL).raw.ad_events
    parts = distinct.united(distinct.daily_sketches(events)).first()
    whole = events.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(distinct.LG_K))).alias(c) for c in distinct.COUNTED]).first()
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in distinct.COUNTED]).first()
    for c in distinct.COUNTED:
        for estimate in (parts[f"{c}_estimate"], whole[c]):
            assert abs(estimate - exact[c]) <= 2 * distinct.RELATIVE_ERROR * exact[c]


def test_blocks_of_days_change_nothing(spark, monkeypatch):
    pick = random.Random(8)
    rows = [(dt.date(2023, 1, 1) + dt.timedelta(days=d), p, pick.randint(0, 9), pick.randint(0, 9), 1, 1.5) for p in (1, 2) for d in range(200) if pick.random() < 0.6]
    perf = spark.createDataFrame(rows, "event_date date, publisher_id int, impressions long, clicks long, filled_impressions long, revenue double").selectExpr(
        "event_date", "publisher_id", "impressions", "clicks", "filled_impressions", "cast(revenue as decimal(38,6)) as total_revenue_usd")
    m = Models(None, overrides={"fct_publisher_performance": perf})
    for missing in (False, True):
        expected = None
        for block in (10_000, 1, 2, 5):  # the first: one block for all days
            monkeypatch.setattr(timeseries, "ROLLING_BLOCK", block)
            found = spark_rows(timeseries.rolling_metrics(m, 7, missing_days=missing))
            expected = expected or found
            assert_same(found, expected, str(block))


def test_rolling_windows_are_not_partitioned_by_publisher_alone(spark):
    p = catalog.run("rolling_7d_metrics", spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(publisher_id" in p
    assert all("block" in part[:60] for part in p.split("hashpartitioning(publisher_id")[1:])
