"""Tables dealt to parts: what a write touches, what it counts, and that results are those of a whole rewrite."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.sinks import merge
from terrasse.sources import snapshots
from terrasse.sources.snapshots import Layout

SCHEMA = "id int, v string, n double"


def files(spark, table):
    return {f.split("/snapshot=")[1] for f in snapshots.read_version(spark, table).inputFiles()}


def counts(spark, table):
    r = snapshots.history(spark, table).first()
    return r["operation"], r["rows"], r["inserted"], r["updated"], r["deleted"]


@pytest.fixture
def hundred(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"v{i}", float(i)) for i in range(100)], SCHEMA)
    assert merge.upsert_table(df, table, ["id"], buckets=8) == 0
    assert counts(spark, table) == ("create", 100, 100, 0, 0)
    return table


def test_upsert_writes_changed_buckets_only(spark, hundred):
    before = files(spark, hundred)
    new = spark.createDataFrame([(5, "new", 5.0), (6, "v6", 6.0), (200, "x", None)], SCHEMA)
    merge.upsert_table(new, hundred, ["id"])
    assert counts(spark, hundred) == ("upsert", 101, 1, 1, 0)
    after = files(spark, hundred)
    assert 6 <= len(before & after) < 8 and len(after) == 8
    assert rows(snapshots.read_version(spark, hundred), "id", "v") == sorted([(i, "new" if i == 5 else f"v{i}") for i in range(100)] + [(200, "x")], key=lambda r: tuple((True, str(v)) for v in r))
    # the same batch again changes nothing and writes no file
    merge.upsert_table(new, hundred, ["id"])
    assert counts(spark, hundred) == ("upsert", 101, 0, 0, 0) and files(spark, hundred) == after
    assert snapshots.read_version(spark, hundred, 0).count() == 100


def test_sync_counts_and_keeps_files(spark, hundred):
    source = spark.createDataFrame([(i, f"v{i}", float(i) if i != 7 else -1.0) for i in range(100) if i != 9] + [(300, "n", 0.0)], SCHEMA)
    before = files(spark, hundred)
    merge.sync_table(source, hundred, ["id"])
    assert counts(spark, hundred) == ("sync", 100, 1, 1, 1)
    assert rows(snapshots.read_version(spark, hundred)) == rows(source)
    assert len(files(spark, hundred) & before) >= 5
    merge.sync_table(source, hundred, ["id"])
    assert counts(spark, hundred) == ("sync", 100, 0, 0, 0)
    merge.sync_table(source.limit(0), hundred, ["id"])
    assert counts(spark, hundred) == ("sync", 0, 0, 0, 100) and snapshots.read_version(spark, hundred).count() == 0
    merge.upsert_table(source, hundred, ["id"])
    assert rows(snapshots.read_version(spark, hundred)) == rows(source)


def test_update_writes_parts_with_a_match(spark, hundred):
    before = files(spark, hundred)
    merge.update_table(spark, hundred, F.col("id").isin(3, 4), {"n": F.lit(-5.0)})
    assert counts(spark, hundred) == ("update", 100, 0, 2, 0) and len(before & files(spark, hundred)) >= 6
    merge.update_table(spark, hundred, F.col("id") == -1, {"n": F.lit(0.0)})
    assert counts(spark, hundred) == ("update", 100, 0, 0, 0)
    merge.update_table(spark, hundred, F.col("id") == 3, {"id": F.lit(1000)})  # moves the row to another part
    merge.upsert_table(spark.createDataFrame([(1000, "moved", 1.0)], SCHEMA), hundred, ["id"])
    assert counts(spark, hundred) == ("upsert", 100, 0, 1, 0)


def test_rows_without_key(spark, tmp_path):
    table = str(tmp_path / "t")
    first = spark.createDataFrame([(None, f"a{i}", None) for i in range(40)] + [(1, "x", 1.0)], SCHEMA)
    merge.upsert_table(first, table, ["id"], buckets=4)
    assert len(files(spark, table)) == 4  # not all in one bucket
    merge.update_table(spark, table, F.col("v") < "a2", {"v": F.concat(F.lit("b"), "v")})
    assert snapshots.read_version(spark, table).count() == 41
    merge.upsert_table(spark.createDataFrame([(None, "a0", None)], SCHEMA), table, ["id"])
    assert counts(spark, table)[1:] == (42, 1, 0, 0)
    merge.sync_table(spark.createDataFrame([(None, "z", None), (1, "x", 1.0)], SCHEMA), table, ["id"])
    assert counts(spark, table)[1:] == (2, 1, 0, 41) and rows(snapshots.read_version(spark, table), "v") == [("x",), ("z",)]


def test_new_columns_and_types(spark, hundred):
    wide = spark.createDataFrame([(1, "one", 1.0, "w")], SCHEMA + ", w string")
    before = files(spark, hundred)
    merge.upsert_table(wide, hundred, ["id"])
    assert len(before & files(spark, hundred)) == 7
    assert rows(snapshots.read_version(spark, hundred).filter("id < 3"), "id", "v", "w") == [(0, "v0", None), (1, "one", "w"), (2, "v2", None)]
    merge.upsert_table(spark.createDataFrame([(2, "two", 2)], "id int, v string, n bigint"), hundred, ["id"])  # another type: all is written
    assert rows(snapshots.read_version(spark, hundred).filter("id = 2"), "id", "v", "n") == [(2, "two", 2.0)]


def test_grown_tables_are_dealt_anew(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.conf.set("spark.terrasse.bucketRows", "10")
    try:
        merge.upsert_table(spark.range(15), table, ["id"])
        assert snapshots.layout_of(spark, table).buckets == 2
        merge.upsert_table(spark.range(10, 100), table, ["id"])
        merge.upsert_table(spark.range(100, 101), table, ["id"])
        assert snapshots.layout_of(spark, table).buckets == 11 and rows(snapshots.read_version(spark, table)) == rows(spark.range(101))
    finally:
        spark.conf.unset("spark.terrasse.bucketRows")


def test_retention_by_day_drops_parts(spark, tmp_path):
    table = str(tmp_path / "t")
    data = [(i, f"2024-01-{1 + i % 20:02d} {i % 24:02d}:00:00" if i % 7 else "?") for i in range(140)]
    df = spark.createDataFrame(data, "id int, at string")
    snapshots.commit(df, table, "create", layout=Layout(("at",)))
    before = files(spark, table)
    limit = F.lit("2024-01-15 12:00:00").cast("timestamp")
    merge.apply_retention(spark, table, "at", 5, limit)
    want = [(i, t) for i, t in data if t >= "2024-01-10 12:00:00" and t != "?"]
    assert rows(snapshots.read_version(spark, table)) == rows(spark.createDataFrame(want, "id int, at string"))
    after = files(spark, table)
    assert len(after) == 11 and len(after - before) == 1  # only the day of the limit is written
    assert counts(spark, table) == ("retention", len(want), 0, 0, 140 - len(want))
    merge.apply_retention(spark, table, "at", 5, limit)
    assert files(spark, table) == after and rows(snapshots.read_version(spark, table, 0)) == rows(df)


def test_a_failed_write_leaves_the_table_as_it_was(spark, hundred, monkeypatch):
    new = spark.createDataFrame([(5, "new", 5.0), (400, "y", None)], SCHEMA)
    log = snapshots._log
    monkeypatch.setattr(snapshots, "_log", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge.upsert_table(new, hundred, ["id"])
    monkeypatch.setattr(snapshots, "_log", log)
    assert snapshots.current_version(spark, hundred) == 0 and snapshots.read_version(spark, hundred).count() == 100
    other = spark.createDataFrame([(90, "other", 5.0)], SCHEMA)
    merge.upsert_table(other, hundred, ["id"])  # takes the number of the failed version
    assert counts(spark, hundred) == ("upsert", 100, 0, 1, 0)
    assert rows(snapshots.read_version(spark, hundred).filter("id in (5, 90)"), "v") == [("other",), ("v5",)]


def test_random_merges_equal_whole_rewrites(spark, tmp_path):
    rng, table, state = random.Random(3), str(tmp_path / "t"), {}
    for step in range(5):
        batch = {rng.randrange(40): f"s{step}{rng.randrange(3)}" for _ in range(12)}
        df = spark.createDataFrame([(k, v, None) for k, v in batch.items()], SCHEMA)
        if step % 2:
            merge.sync_table(df, table, ["id"])
            inserted, deleted = len(batch.keys() - state.keys()), len(state.keys() - batch.keys())
            updated = sum(state[k] != batch[k] for k in batch.keys() & state.keys())
            state = batch
        else:
            merge.upsert_table(df, table, ["id"], buckets=5)
            inserted, deleted = len(batch.keys() - state.keys()), 0
            updated = sum(state[k] != batch[k] for k in batch.keys() & state.keys())
            state = {**state, **batch}
        assert counts(spark, table)[1:] == (len(state), inserted, updated, deleted)
        assert {r["id"]: r["v"] for r in snapshots.read_version(spark, table).collect()} == state
