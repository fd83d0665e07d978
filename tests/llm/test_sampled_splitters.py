import random
import zlib
from collections import defaultdict

import pytest
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import sampled_splitters as s


def check(docs, got, shards=8):
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == sorted(
        str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in docs)
    slots, size = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return size


@pytest.mark.parametrize("ranges", [16, 256])
def test_sizes_are_near_equal_and_groups_stay_whole(spark, ranges):
    rng = random.Random(4)
    docs = [(i, "word " * rng.randint(1, 80) + str(i)) for i in range(4000)]
    docs += [(5000 + i, "a third of a shard") for i in range(900)] + [(9000 + i, f"copy {i % 50} " * 9) for i in range(300)]
    got = s.shards_by_bytes(spark.createDataFrame(docs, "doc_id long, text string"), ranges=ranges).collect()
    size = check(docs, got)
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 8
    text, homes = dict(docs), defaultdict(set)
    for r in got:
        homes[text[r["doc_id"]]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_a_group_larger_than_a_shard_is_cut(spark):
    docs = [(i, "the same text in very many documents") for i in range(3000)] + [(3000 + i, f"other {i} " * 5) for i in range(2000)]
    got = s.shards_by_bytes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    size = check(docs, got)
    assert max(size.values()) - min(size.values()) < 0.03 * sum(size.values()) / 8


def test_edge_documents(spark, edge, nothing):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    check(docs, s.shards_by_bytes(edge).collect())
    assert s.shards_by_bytes(nothing).count() == 0
    same = spark.createDataFrame([(1, "x")] * 50, "doc_id long, text string")
    check([(1, "x")] * 50, s.shards_by_bytes(same).collect())


def test_a_third_of_all_rows_without_text(spark):
    """One byte each, so a small group in bytes, but no range may hold it whole; nor may the ranges of one very common id."""
    docs = [(i, None if i % 6 else "") for i in range(6000)] + [(7, f"text {i} " * 20) for i in range(12000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    size = check(docs, s.shards_by_bytes(frame).collect())
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 8
    rows = s.keyed(frame)
    plan = s.plan_ranges(rows, 8, 64)
    held = [r["count"] for r in rows.withColumn("range", s.range_of(plan.splitters)).groupBy("range").count().collect()]
    assert max(held) <= 2 * 2 * len(docs) / 64 + 1


def test_placing_against_a_list(spark):
    """The same records placed one after the other in plain Python, from the plan's borders alone."""
    rng = random.Random(9)
    docs = [(i, rng.choice(["same", None, f"t{i % 40} " * rng.randint(1, 30), "x" * rng.randint(1, 400)])) for i in range(2500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = s.keyed(frame)
    plan = s.plan_ranges(rows, 8, 32)
    listed = sorted(((r["range"], r["g"], r["k"], r["row"], r["doc_id"], r["size"]) for r in rows.withColumn("range", s.range_of(plan.splitters)).collect()))
    table, at, start, want = {t[0]: t for t in plan.table}, defaultdict(int), {}, defaultdict(list)
    for n, g, _, _, doc, size in listed:
        _, home, before, by_record = table[n]
        mine = at[n]
        at[n] += size
        if not by_record:
            mine = start.setdefault((n, g), mine)
        want[home if home >= 0 else sum(before + mine >= b for b in plan.borders)].append(doc)
    got = defaultdict(dict)
    for r in s.shards_by_bytes(frame, ranges=32).collect():
        got[r["shard"]][r["slot"]] = r["doc_id"]
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v.values()) for k, v in got.items()}
    for shard, docs_there in want.items():
        assert [got[shard][i] for i in range(len(docs_there))] == docs_there


def test_ranges_that_stay_overfull_raise(spark, monkeypatch):
    monkeypatch.setattr(s, "_quantiles", lambda *a: [])  # samples that find no splitter
    rows = s.keyed(spark.createDataFrame([(i, f"t{i}") for i in range(5000)], "doc_id long, text string"))
    with pytest.raises(RuntimeError, match="overfull"):
        s.plan_ranges(rows, 8, 16, rounds=2)
