import random
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from terrasse.operators import graph


def edge_frame(spark, pairs):
    return spark.createDataFrame(pairs, "ancestor_id string, descendant_id string")


def test_closure_on_diamond_cycle_and_duplicates(spark):
    edges = edge_frame(spark, [("a", "b"), ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("x", "x"), ("y", None)])
    got = rows(graph.closure(edges))
    assert got == sorted([
        ("a", "b", 1), ("a", "c", 1), ("b", "d", 1), ("c", "d", 1), ("d", "a", 1), ("a", "d", 2), ("b", "a", 2),
        ("c", "a", 2), ("d", "b", 2), ("d", "c", 2), ("b", "c", 3), ("c", "b", 3),
    ])


def test_closure_stops_at_depth(spark):
    chain = edge_frame(spark, [(str(i), str(i + 1)) for i in range(9)])
    out = graph.closure(chain, max_depth=5)
    assert out.agg(F.max("generation_depth")).first()[0] == 5 and out.count() == 9 + 8 + 7 + 6 + 5


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = {(str(rng.randint(0, 12)), str(rng.randint(0, 12))) for _ in range(22)}
    pairs = {(a, b) for a, b in pairs if a != b}
    depth = {p: 1 for p in pairs}
    for d in range(2, 6):
        for a, m in pairs:
            for m2, b in [k for k, v in depth.items() if v == d - 1]:
                if m == m2 and a != b and (a, b) not in depth:
                    depth[a, b] = d
    assert rows(graph.closure(edge_frame(spark, sorted(pairs)))) == sorted((a, b, d) for (a, b), d in depth.items())


def test_mirror(spark):
    df = spark.createDataFrame([("a", "b", 1)], "x string, y string, d int")
    assert rows(graph.mirror_edges(df, "x", "y", "UP", "DOWN")) == [("a", "b", "UP", 1), ("b", "a", "DOWN", 1)]


PAIR = "id int, a string, b string, t timestamp"


def day(n):
    return datetime(2024, 1, n)


@pytest.fixture(scope="module")
def pairs(spark):
    opened = spark.createDataFrame([(1, "x", "y", day(1)), (2, "x", "y", day(10)), (3, None, "y", day(1)), (4, "p", "q", day(3))], PAIR)
    closed = spark.createDataFrame([(9, "y", "x", day(5)), (8, "x", "y", day(20)), (7, "y", None, day(2)), (6, "q", "p", day(3))], PAIR)
    return opened, closed


def test_pair_join_matches_or_condition(pairs):
    opened, closed = pairs
    ours = graph.symmetric_pair_join(opened, closed, "a", "b", "t", "t", "all")
    o, c = opened.alias("o"), closed.alias("c")
    either = ((F.col("o.a") == F.col("c.a")) & (F.col("o.b") == F.col("c.b"))) | ((F.col("o.a") == F.col("c.b")) & (F.col("o.b") == F.col("c.a")))
    naive = o.join(c, either, "left").select("o.id", "c.t")
    assert rows(ours, "id", "valid_to") == rows(naive)
    assert "NestedLoop" not in plan(ours) and "Cartesian" not in plan(ours)


@pytest.mark.parametrize("hot", [False, True])
def test_first_close_after_open(pairs, spark, hot, request):
    if hot:
        request.getfixturevalue("small_runs")
        spark.conf.set("spark.terrasse.runRows", "1")
    out = graph.symmetric_pair_join(*pairs, "a", "b", "t", "t", "first_after")
    assert rows(out, "id", "valid_to") == [(1, day(5)), (2, day(20)), (3, None), (4, None)]
    assert rows(out.filter("is_current"), "id") == [(3,), (4,)]


def test_pair_join_rejects_unknown_mode(pairs):
    with pytest.raises(ValueError):
        graph.symmetric_pair_join(*pairs, "a", "b", "t", "t", "some")


def test_hierarchy(spark):
    codes = spark.createDataFrame([
        ("I", None, "KAPITTEL"), ("A00-A09", "I", "BLOKK"), ("A00", "A00-A09", "KODE"), ("A00.1", "A00", "KODE"), ("A00-in", "A00-A09", "BLOKK"),
        ("A01", "A00-in", "KODE"), ("lost", "nowhere", "KODE"), ("c1", "c2", "KODE"), ("c2", "c1", "KODE"), ("r", "c1", "KODE"), ("B", None, "KODE"),
    ], "identifier string, parent string, type string")
    got = {r.identifier: (r.chapter_code, r.block_code) for r in graph.resolve_hierarchy(codes).collect()}
    assert got == {
        "I": ("I", None), "A00-A09": ("I", None), "A00": ("I", "A00-A09"), "A00.1": ("I", "A00-A09"),
        "A00-in": ("A00-A09", None),  # a block names its direct parent, whatever that is
        "A01": ("I", "A00-in"), "lost": (None, None), "c1": (None, None), "c2": (None, None), "r": (None, None), "B": (None, None),
    }


def test_lineage(spark):
    products = spark.createDataFrame([("gold", ["silver", "ref"]), ("silver", ["bronze"]), ("bronze", []), ("ref", None)], "product_id string, source_products array<string>")
    assert rows(graph.lineage(products)) == [
        ("bronze", "silver", "downstream", 1), ("gold", "bronze", "upstream", 2), ("gold", "ref", "upstream", 1), ("gold", "silver", "upstream", 1),
        ("ref", "gold", "downstream", 1), ("silver", "bronze", "upstream", 1), ("silver", "gold", "downstream", 1),
    ]


def test_hierarchy_raises_beyond_its_depth(spark):
    codes = spark.createDataFrame([("c", None, "KAPITTEL"), *[(f"n{i}", "c" if i == 0 else f"n{i - 1}", "KATEGORI") for i in range(6)]], "identifier string, parent string, type string")
    with pytest.raises(ValueError):
        graph.resolve_hierarchy(codes, max_depth=4)
    assert {r.chapter_code for r in graph.resolve_hierarchy(codes).collect()} == {"c"}
