import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from terrasse.operators.ordered import over_order, split_hot, trailing_stats


def _events(spark, seed, n=120):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        data.append((key, rng.randint(0, 8), i, rng.choice([None, rng.randint(0, 9)]), float(rng.randint(0, 50))))
    return spark.createDataFrame(data, "k string, ts int, id int, v int, x double")


def _brute(data):
    out = []
    for k in {r.k for r in data}:
        mine = sorted((r for r in data if r.k == k), key=lambda r: (r.ts, r.id))
        known, total = None, 0.0
        for i, r in enumerate(mine):
            known = r.v if r.v is not None else known
            total += r.x
            nxt = mine[i + 1] if i + 1 < len(mine) else None
            prev = mine[i - 1] if i else None
            out.append((r.k, r.id, known, nxt and nxt.v, nxt and nxt.ts, prev and prev.v, total, i + 1))
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def _ours(df):
    out = over_order(df, ["k"], ["ts", "id"], last={"l": "v"}, lead={"nv": "v", "nts": "ts"}, lag={"pv": "v"}, total={"t": "x"}, index="i")
    return rows(out, "k", "id", "l", "nv", "nts", "pv", "t", "i")


@pytest.mark.parametrize("seed", [1, 2])
def test_plain_matches_brute_force(spark, seed):
    df = _events(spark, seed)
    assert _ours(df) == _brute(df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_split_keys_match_brute_force(spark, small_runs, seed):
    df = _events(spark, seed)
    assert _ours(df) == _brute(df.collect())


def test_hot_key_is_split_into_several_runs(spark, small_runs):
    calm, hot = split_hot(_events(spark, 3), ["k"], ["ts", "id"])
    assert calm.filter("k = 'hot'").isEmpty()
    per_run = hot.filter("k = 'hot'").groupBy("__run").count().collect()
    assert len(per_run) > 5
    # runs follow the order: no run starts before the previous one ends
    spans = sorted(tuple(r) for r in hot.filter("k = 'hot'").groupBy("__run").agg(F.min(F.struct("ts", "id")), F.max(F.struct("ts", "id"))).collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))


def test_whole_table_order_without_keys(spark, small_runs):
    df = spark.createDataFrame([(i * 7 % 40,) for i in range(40)], "v int")
    assert rows(over_order(df, [], ["v"], index="i")) == rows(spark.createDataFrame([(v, v + 1) for v in range(40)], "v int, i bigint"))


@pytest.mark.parametrize("hot", [False, True])
def test_trailing_stats(spark, hot, request):
    if hot:
        request.getfixturevalue("small_runs")
    df = spark.createDataFrame([("k", i, float(i % 7)) for i in range(60)] + [("z", 1, 5.0)], "k string, i int, x double")
    got = {(r.k, r.i): (r.trailing_n, r.trailing_mean) for r in trailing_stats(df, ["k"], ["i"], "x", 10).collect()}
    assert len(got) == 61
    for i in range(60):
        before = [float(j % 7) for j in range(max(0, i - 10), i)]
        n, mean = got["k", i]
        assert n == len(before)
        assert mean is None if not before else abs(mean - sum(before) / len(before)) < 1e-9
    assert got["z", 1] == (0, None)


def test_small_keys_use_one_shuffle(spark):
    df = spark.range(50).select((F.col("id") % 5).alias("k"), F.col("id").alias("ts"), F.rand(1).alias("x"))
    text = plan(over_order(df, ["k"], ["ts"], last={"l": "x"}, lead={"n": "x"}, lag={"p": "x"}))
    assert text.count("Exchange hashpartitioning") == 1
