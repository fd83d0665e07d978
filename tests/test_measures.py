import random
import struct

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from terrasse.functions.ordering import double_of_key, with_double_key
from terrasse.operators import history, lookup, measures
from terrasse.plans.models import fit_and_score, in_training, linear_model


def test_share_of_total_and_in_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), (None, 1, 4)], "g string, h int, n bigint")
    assert rows(measures.share_of_total(df, "n", "p"), "n", "p") == [(1, 12.5), (3, 37.5), (4, 50.0)]
    assert rows(measures.share_in_group(df, ["g"], "n", "p"), "g", "n", "p") == [(None, 4, 100.0), ("a", 1, 25.0), ("a", 3, 75.0)]


def test_rates_with_zero_base(spark):
    df = spark.createDataFrame([(1, 0), (1, 8)], "a int, b int")
    assert rows(df.select(measures.rate("a", "b"))) == [(None,), (12.5,)]
    assert rows(measures.ratio_of_sums(df, [], {"r": ("a", F.lit(0))})) == [(None,)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(31)] + [(None,)], "v double")
    got = dict(rows(measures.histogram(df, "v")))
    assert sum(got.values()) == 31 and got[30] == 2 and max(got) == 30
    assert rows(measures.histogram(spark.createDataFrame([(5.0,), (5.0,)], "v double"), "v")) == [(1, 2)]
    assert measures.histogram(df.limit(0), "v").count() == 0


def test_density(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, None)], "x double, y double")
    assert rows(measures.density_2d(df, "x", "y")) == [(1, 1, 1), (30, 30, 1)]


def test_quantiles_are_exact(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, float(rng.randint(0, 30)), rng.random() * 30, -rng.random() * 1e-9, rng.choice([-1, 1]) * 10.0 ** rng.randint(-320, 300)]), float(i), 7, None) for i in range(401)]
    df = spark.createDataFrame(data, "a double, b double, c int, d double")
    wanted = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column, r.p): r.value for r in measures.exact_quantiles(df, ["a", "b", "c", "d"], wanted).collect()}
    known = sorted(r[0] for r in data if r[0] is not None)
    for p in wanted:
        pos = p * (len(known) - 1)
        low = int(pos)
        high = min(low + (pos > low), len(known) - 1)
        assert got["a", p] == known[low] + (known[high] - known[low]) * (pos - low)
        assert got["b", p] == pytest.approx(400 * p, abs=1e-12) and got["c", p] == 7.0 and ("d", p) not in got
    assert measures.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0 == measures.exact_quantiles(df, [], [0.5]).count()


def test_keys_order_as_doubles_and_lead_back(spark):
    rng = random.Random(8)
    powers = [s * 2.0**e * f for e in range(-1074, 1024, 7) for s in (1, -1) for f in (1.0, 1.0 + 2**-52, 2.0 - 2**-52)]
    values = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, 0.1, 1 / 3, *powers]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    df = with_double_key(spark.createDataFrame([(v,) for v in values] + [(None,)], "v double"), "v", "k").withColumn("back", double_of_key(F.col("k")))
    found = df.collect()
    assert all((r.back == r.v or (r.v != r.v and r.back != r.back)) and (r.v is None) == (r.k is None) for r in found)
    plain = [(r.v, r.k) for r in found if r.v is not None and r.v == r.v]
    for v, k in plain:
        assert abs(k) == struct.unpack("<q", struct.pack("<d", abs(v)))[0] and (k < 0) == (v < 0)
    assert max(k for _, k in plain) < min(r.k for r in found if r.v is not None and r.v != r.v)


def test_a_selection_reads_values_once_and_counts(spark):
    spark.range(1000).select((F.col("id") * 7919 % 1000 / 10).alias("v")).createOrReplaceTempView("few")
    r = measures.exact_quantiles(spark.table("few"), ["v"], [0.25, 0.999])
    assert {x.p: x.value for x in r.collect()} == pytest.approx({0.25: 24.975, 0.999: 99.8001})
    assert "few" not in plan(r) and "Python" not in plan(r)


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    r = measures.describe_numeric(df, ["v"]).first()
    assert (r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0)
    assert measures.describe_numeric(df, ["v"], approximate=True).first()["q50"] == 2.0
    empty = measures.describe_numeric(df.limit(0), ["v"]).first()
    assert empty["count"] == 0 and empty["q50"] is None


@pytest.mark.parametrize("hot", [False, True])
def test_rank_with_ties_and_nulls(spark, hot, request):
    if hot:
        request.getfixturevalue("small_runs")
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(40)], "id int, v int")
    df.createOrReplaceTempView("ranked")
    expected = spark.sql("SELECT id, rank() OVER (ORDER BY v DESC) FROM ranked")
    assert [(a, b) for a, b in rows(measures.global_rank(df, "v", "r"), "id", "r")] == rows(expected)
    up = spark.sql("SELECT id, rank() OVER (ORDER BY v NULLS LAST) FROM ranked")
    assert rows(measures.global_rank(df, "v", "r", descending=False), "id", "r") == rows(up)


def test_tails_and_series(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}") for i in range(6)], "v int, g string")
    assert rows(measures.both_tails(df, "v", ["g"], 2), "v") == [(0,), (1,), (4,), (5,)]
    assert measures.both_tails(df, "v", ["g"], 5).count() == 6
    assert rows(measures.top_group_series(df, "g", "v", 1), "g", "v") == [("g2", 2), ("g2", 5)]


def test_pivot_and_shares(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "z")], "k string, c string")
    wide = measures.row_shares(measures.pivot_sum(df, ["k"], "c", ["x", "y"]), ["x", "y"])
    assert rows(wide, "k", "x", "y", "x_pct", "y_pct") == [("a", 2, 1, 66.7, 33.3), ("b", 0, 0, None, None)]


def test_null_rates_and_months(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(measures.null_rates(df)) == [("a", 0.0), ("b", 0.5)]
    months = spark.sql("SELECT * FROM VALUES (date'2024-01-05'), (date'2024-03-01'), (NULL) t(d)")
    counted = measures.monthly_counts(months, "d")
    assert counted.count() == 2
    assert [r.n for r in measures.fill_months(counted).orderBy("period").collect()] == [1, 0, 1]


def test_hash_sample_repeats_and_bounds(spark):
    df = spark.range(20_000)
    first = rows(measures.hash_sample(df, ["id"], 100))
    assert len(first) == 100 and first == rows(measures.hash_sample(df.repartition(7), ["id"], 100))
    assert measures.hash_sample(spark.range(5), ["id"], 100).count() == 5
    assert first != rows(measures.hash_sample(df, ["id"], 100, seed=7))
    repeated = spark.range(300_000).selectExpr("id % 3 as k", "id")
    assert measures.hash_sample(repeated, ["k"], 1000).count() == 1000


def test_net_aligned_modes(spark):
    a = spark.createDataFrame([("x", 5), ("y", 1), (None, 2)], "k string, n int")
    b = spark.createDataFrame([("x", 3), ("z", 4), (None, 1)], "k string, n int")
    assert rows(history.net_aligned(a, b, ["k"], "n")) == [(None, 1), ("x", 2), ("y", 0), ("z", 0)]
    assert rows(history.net_aligned(a, b, ["k"], "n", "zero_side")) == [(None, 1), ("x", 2), ("y", 1), ("z", -4)]
    with pytest.raises(ValueError):
        history.net_aligned(a, b, ["k"], "n", "other")


def test_growth(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 15), ("b", 1, 0), ("b", 2, 5), ("c", 2, 1)], "k string, y int, v int")
    assert rows(lookup.growth_first_last(df, ["k"], "y", "v", 1, 2), "k", "growth_pct") == [("a", 50.0)]


def test_distinct_counts_and_partitions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2)], "k string, u int")
    assert rows(measures.distinct_count(df, ["k"], "u")) == [("a", 1), ("b", 1)]
    assert measures.distinct_count(df, [], "u", approximate=True).first()[0] == 2
    assert sum(r.n for r in measures.partition_sizes(df.repartition(3)).collect()) == 4


def test_linear_fit_and_model(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3 + 2).cast("double").alias("y"))
    fit = measures.linear_fit(df, "x", "y").first()
    assert (fit.slope, fit.intercept, fit.r2, fit.n) == (3.0, 2.0, 1.0, 200)
    model = fit_and_score(df, ["x"], "y")
    assert abs(model["coefficients"][0] - 3) < 1e-6 and model["r2"] > 0.999


def test_model_on_held_out_rows(spark):
    import numpy as np

    rng = random.Random(2)
    data = [(i, float(a), b, 2.0 * a - 3.0 * b + 5 + rng.gauss(0, 1) if i % 11 else None) for i, (a, b) in enumerate((rng.randint(0, 9), rng.random()) for _ in range(600))]
    df = spark.createDataFrame(data, "id int, a double, b double, y double").repartition(5)
    chosen = {r["id"] for r in df.filter(in_training(["id"])).collect()}
    assert 440 < len(chosen) < 520 and chosen == {r["id"] for r in df.coalesce(1).orderBy("y").filter(in_training(["id"])).collect()}
    known = [r for r in data if r[3] is not None]
    x, y, t = (np.array([[1, r[1], r[2]] for r in known]), np.array([r[3] for r in known]), np.array([r[0] in chosen for r in known]))
    w = np.linalg.lstsq(x[t], y[t], rcond=None)[0]
    left = y[~t] - x[~t] @ w
    want = {"intercept": w[0], "a": w[1], "b": w[2], "r2": 1 - (left**2).sum() / ((y[~t] - y[~t].mean()) ** 2).sum(), "n_train": t.sum(), "n_test": (~t).sum()}
    assert {r.term: r.value for r in linear_model(df, ["a", "b"], "y", ["id"]).collect()} == pytest.approx(want, abs=2e-6)
    twice = linear_model(df.withColumn("c", F.col("a") * 2), ["a", "c"], "y", ["id"])
    assert {r.term: r.value for r in twice.collect()}["a"] is None
    assert {r.term: r.value for r in linear_model(df.limit(0), ["a"], "y", ["id"]).collect()} == {"a": None, "intercept": None, "n_train": 0.0, "n_test": 0.0, "r2": None}
