import time

import numpy as np
import pyarrow as pa
from edge_cases import edge, nothing, prose, rows_to_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from terrasse.llm import string_tiling as t


def brute_tiles(a, b, size):
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k >= size and (best is None or (-k, i, j) < best):
                    best = (-k, i, j)
        if best is None:
            return tiles
        k, i, j = -best[0], best[1], best[2]
        free_a[i : i + k] = free_b[j : j + k] = [False] * k
        tiles.append((k, i, j))


@given(st.lists(st.integers(0, 2), max_size=24), st.lists(st.integers(0, 2), max_size=40), st.integers(2, 4))
@settings(max_examples=150, deadline=None)
def test_tiles_match_brute_force(a, b, size):
    """Few letters, so that ties and overlaps abound: tile lengths are those of the exhaustive greedy search."""
    got = t.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), size)
    assert got == brute_tiles(a, b, size)
    used_a, used_b = set(), set()
    for k, i, j in got:
        assert a[i : i + k] == b[j : j + k] and k >= size
        assert not used_a & set(range(i, i + k)) and not used_b & set(range(j, j + k))
        used_a |= set(range(i, i + k))
        used_b |= set(range(j, j + k))
    left_a, left_b = [x if p not in used_a else -1 - p for p, x in enumerate(a)], [x if p not in used_b else -1000 - p for p, x in enumerate(b)]
    assert not brute_tiles(left_a, left_b, size)
    want = brute_tiles(a, b, size)
    assert max((x[0] for x in got), default=0) == max((x[0] for x in want), default=0)


@given(st.lists(st.integers(1, 3), min_size=2, max_size=9), st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=4), st.integers(1, 90)), max_size=4), st.integers(2, 4))
@settings(max_examples=150, deadline=None)
def test_essential_texts_give_the_same_tiles(a, runs, size):
    """Texts of long repetitions, shortened or not: the same lengths of tiles at the same places of the item."""
    b = [x for part, times in runs for x in part * times]
    a, b = np.array(a, np.uint64), np.array(b, np.uint64)
    short = t.essential(a, b, size)
    assert len(short) <= len(b) and [x[:2] for x in t.greedy_tiles(a, short, size)] == [x[:2] for x in t.greedy_tiles(a, b, size)]


def test_a_megabyte_of_one_word_takes_seconds(spark):
    bench = spark.createDataFrame([(1, "same " * 300), (2, "one two " * 100), (3, prose(50, 40)), (4, "tiny item"), (5, "x")], "item_id long, text string")
    docs = [(1, "same " * 200_000), (2, "one two " * 125_000), (3, "a" * 1_000_000), (4, " " * 1_000_000), (5, "same " * 100_000 + prose(50, 40) + " other" * 100_000), (6, "a tiny Item."), (7, "tiny other item")]
    began = time.time()
    got = {(r["doc_id"], r["item_id"]): r for r in t.contaminated(rows_to_docs(spark, docs), bench).collect()}
    assert set(got) == {(1, 1), (5, 1), (2, 2), (5, 3), (6, 4)} and got[6, 4]["coverage"] == 1.0 and got[1, 1]["n_tiles"] == 1
    assert time.time() - began < 60


def test_distinct_words_give_the_exhaustive_tiling():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a = rng.permutation(60).astype(np.uint64)
        b = np.concatenate([p for p in np.array_split(a, 6)][::-1] + [np.arange(100, 140, dtype=np.uint64)])
        assert sorted(t.greedy_tiles(a, b, 4)) == sorted(brute_tiles(a.tolist(), b.tolist(), 4))


def test_reordered_and_dressed_passages_are_found(spark):
    item = prose(50, 40)
    w = item.split()
    docs = [
        (1, prose(51, 100) + " " + item + " " + prose(52, 100)), (2, " ".join(w[30:] + ["x"] + w[20:30] + ["y"] + w[:10] + ["z"] + w[10:20])),
        (3, '"' + "!, (".join(item.upper().split()) + '"'), (4, " ".join(w[:15])), (5, prose(53, 300)), (6, None),
    ]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (10, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in t.contaminated(rows_to_docs(spark, docs), bench).collect()}
    assert set(got) == {(1, 7), (2, 7), (3, 7)}
    assert got[1, 7]["n_tiles"] == 1 and got[2, 7]["n_tiles"] == 4 and got[2, 7]["coverage"] == 1.0
    kept = t.drop_contaminated(rows_to_docs(spark, docs), bench)
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6} and kept.columns == rows_to_docs(spark, docs).columns


def test_blocks_of_items_give_the_same(spark, edge, nothing, monkeypatch):
    bench = spark.createDataFrame([(i, prose(k, 30)) for i, k in enumerate((1, 2, 3, 99))] + [(4, prose(1, 120))], "item_id long, text string")
    whole = sorted(map(str, t.contaminated(edge, bench).collect()))
    assert len(whole) >= 8
    small = [x.tokens for x in t.benchmark_blocks(bench, limit=50)]
    assert len(small) > 1 and sum(map(len, small)) == 5
    monkeypatch.setattr(t.benchmark_blocks, "__defaults__", (4, "item_id", "text", 50))
    assert sorted(map(str, t.contaminated(edge, bench).collect())) == whole
    assert t.contaminated(nothing, bench).count() == t.contaminated(edge, bench.limit(0)).count() == 0
    assert t.drop_contaminated(edge, bench.limit(0)).count() == edge.count()


def test_tokens_are_bare_lower_words():
    starts, h = t.tokens(pa.array(["Hello, World!", "-- hello WORLD", None], pa.string()))
    assert np.diff(starts).tolist() == [2, 2, 0] and h[:2].tolist() == h[2:4].tolist()
