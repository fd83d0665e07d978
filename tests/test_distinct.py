import random
from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from terrasse.operators import distinct as D
from terrasse.sources import readers



def span():
    return F.lit("2024-01-03").cast("date"), F.lit("2024-01-12").cast("date")


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.choice([None, 0, 1, 5, 32767, 32768, 10**6, rng.randrange(200)]), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(300))) for _ in range(2000)]
    return data + [("a", 3, None)], spark.createDataFrame([*data, ("a", 3, None)], "k string, id bigint, ts timestamp")


def brute(data, window):
    out = {}
    for day in (date(2024, 1, d) for d in range(3, 13)):
        for k in "ab":
            ids = {i for key, i, ts in data if key == k and i is not None and ts is not None and day - timedelta(days=window - 1) <= ts.date() <= day}
            if ids:
                out[k, day] = len(ids)
    return out


@pytest.mark.parametrize("window", [1, 3, 30])
def test_bitmaps_are_exact(spark, log, window):
    data, df = log
    got = D.trailing_exact(D.daily_bitmaps(df.repartition(3), ["k"], "id", "ts"), ["k"], window, *span())
    assert {(r.k, r.day): r.users for r in got.collect()} == brute(data, window)


def test_days_merge_without_their_rows(spark, log):
    """Bitmaps of two halves of a table, united later, count as those of the whole."""
    data, df = log
    halves = D.daily_bitmaps(df.filter("id % 2 = 0"), ["k"], "id", "ts").unionByName(D.daily_bitmaps(df.filter("id % 2 = 1"), ["k"], "id", "ts"))
    assert {(r.k, r.day): r.users for r in D.trailing_exact(halves, ["k"], 3, *span()).collect()} == brute(data, 3)
    assert "ObjectHashAggregate" in plan(halves) or "partial" in plan(halves)


def test_sketches_stay_within_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("id"), F.lit("x").alias("k"), F.timestamp_add("DAY", (F.col("id") % 3).cast("int"), F.lit("2024-01-03").cast("timestamp")).alias("ts"))
    got = {r.day.day: r.users for r in D.trailing_estimate(D.daily_sketches(df, ["k"], "id", "ts"), ["k"], 3, *span()).collect()}
    exact = {r.day.day: r.users for r in D.trailing_exact(D.daily_bitmaps(df, ["k"], "id", "ts"), ["k"], 3, *span()).collect()}
    assert got.keys() == exact.keys() and all(abs(got[d] - n) <= 4 * 0.0163 * n for d, n in exact.items())


def test_no_rows(spark, log):
    _, df = log
    assert D.trailing_exact(D.daily_bitmaps(df.limit(0), ["k"], "id", "ts"), ["k"], 3, *span()).count() == 0
    assert D.trailing_estimate(D.daily_sketches(df.filter("id IS NULL"), [], "id", "ts"), [], 3, *span()).count() == 0


def test_footers_answer_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.5, "x"), (None, -1.0, None), (7, None, "y")], "a int, b double, s string").repartition(2).write.parquet(path)
    found = readers.footer_values(spark, path, ["a", "b"])
    assert rows(found) == [(3, 2, 1, 7, 2, -1.0, 2.5)]
    text = plan(found)
    assert "PushedAggregation: [COUNT(*), COUNT(a), MIN(a), MAX(a), COUNT(b), MIN(b), MAX(b)]" in text
    assert "PushedAggregation" not in plan(spark.read.parquet(path).agg(F.max("a")))  # other reads stay as they are
    with pytest.raises(ValueError, match="s"):
        readers.footer_values(spark, path, ["s"])
