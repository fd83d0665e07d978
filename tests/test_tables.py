import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.plans import curate, jobs, products
from terrasse.settings import drop_stages, durable, fresh_path, path_exists, shared_dir
from terrasse.sinks import merge, writers
from terrasse.sources import readers, snapshots

EMPLOYEES = "id,name,department,salary,hire_date\n1,Ada,engineering,100,2020-01-01\n2,Bo,sales,200,2021-02-02\n"


@pytest.fixture
def sample(tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text(EMPLOYEES)
    (tmp_path / "csv" / "b.csv").write_text(EMPLOYEES.replace("1,Ada", "3,Åse"))
    (tmp_path / "csv" / "note.txt").write_text("ignored")
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id":1,"name":"Ada"}\n{"id":2,"name":"Bo"}\n')
    return tmp_path


def test_csv_and_json_readers(spark, sample):
    df = readers.read_files(spark, str(sample / "csv"), "csv")
    assert dict(df.dtypes) == {"id": "int", "name": "string", "department": "string", "salary": "int", "hire_date": "date"}
    assert df.count() == 4 and "Åse" in {r.name for r in df.collect()}
    assert readers.read_files(spark, str(sample / "json"), "json").count() == 2
    assert readers.read_files(spark, str(sample / "json"), "json", "id string").dtypes == [("id", "string")]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="Unsupported format"):
        readers.read_files(spark, "x", "xml")


def test_json_records_array_or_object(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "b.json").write_text('{"a": 3}')
    assert rows(readers.read_json_records(spark, str(tmp_path))) == [(1,), (2,), (3,)]


def test_code_file(spark, tmp_path):
    (tmp_path / "k.csv").write_text("Fylke;KommuneNr\nOslo;301\nVest;4601\n")
    df = readers.read_code_file(spark, str(tmp_path / "k.csv"), padded={"kommunenr": 4})
    assert df.dtypes == [("fylke", "string"), ("kommunenr", "string")]
    assert rows(df) == [("Oslo", "0301"), ("Vest", "4601")]


def test_config_is_unwrapped(spark, tmp_path):
    inner = {"source": "s3://b/x", "target": "s3a://s/x", "primary_key": "id"}
    (tmp_path / "a.json").write_text(json.dumps({"slug": "x", "config": inner}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(inner))
    expected = {**inner, "source": "s3a://b/x"}
    assert readers.read_config(spark, str(tmp_path / "a.json")) == expected
    assert readers.read_config(spark, str(tmp_path / "b.json")) == expected


def test_sql_over_file_and_frame(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    assert readers.sql_on_file(spark, str(tmp_path / "t"), "SELECT sum(id) AS s FROM {table}").first()[0] == 10
    assert readers.sql_on_frame(spark.range(3), "SELECT count(*) AS n FROM {df}").first()[0] == 3
    assert readers.row_count(spark.read.parquet(str(tmp_path / "t"))) == 5


def test_synthetic_rows_repeat(spark):
    assert rows(readers.synthetic_rows(spark, 20)) == rows(readers.synthetic_rows(spark, 20))


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, d string")
    writers.overwrite_partitions(df, path, ["d"])
    writers.overwrite_partitions(df.filter("d = 'a'"), path, ["d"])
    assert rows(spark.read.parquet(path), "id", "d") == [(1, "a"), (2, "a"), (3, "b")]
    writers.overwrite_partitions(spark.createDataFrame([(9, "b")], "id int, d string"), path, ["d"])
    assert rows(spark.read.parquet(path), "id", "d") == [(1, "a"), (2, "a"), (9, "b")]


def test_append_with_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(spark.createDataFrame([(1,)], "a int"), path)
    writers.append_table(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert rows(writers.read_evolved(spark, path), "a", "b") == [(1, None), (2, "x")]


def test_overwrite_replaces_schema_and_rereads(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(spark.range(3), path)
    again = writers.write_then_read(spark.createDataFrame([("x", "p")], "n string, k string"), path, ["k"])
    assert rows(again, "n", "k") == [("x", "p")]
    assert writers.write_checked(spark.range(7), path) == 7


def test_comments_survive(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(writers.with_comments(spark.range(1), {"id": "the key"}), path)
    assert spark.read.parquet(path).schema["id"].metadata["comment"] == "the key"


def test_table_comments(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS terrasse_tests LOCATION '%s'" % fresh_path(spark, "db"))
    spark.sql("CREATE OR REPLACE TEMP VIEW v AS SELECT 1 AS a")
    spark.sql("DROP TABLE IF EXISTS terrasse_tests.t")
    spark.sql("CREATE TABLE terrasse_tests.t USING parquet AS SELECT * FROM v")
    writers.comment_table(spark, "terrasse_tests.t", "it's a table", {"a": "col's"})
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE terrasse_tests.t").collect()}
    assert described["a"] == "col's"
    spark.sql("DROP TABLE terrasse_tests.t")
    spark.sql("DROP DATABASE terrasse_tests")


def test_csv_export_and_layout(spark, tmp_path):
    writers.export_csv(writers.sized(spark.range(4), 1), str(tmp_path / "c"))
    assert readers.read_files(spark, str(tmp_path / "c"), "csv").count() == 4
    assert writers.sized(spark.range(10), 3, ["id"]).rdd.getNumPartitions() == 3
    writers.append_result(spark.range(1), str(tmp_path / "r"), F.lit(datetime(2024, 1, 1)))
    assert spark.read.parquet(str(tmp_path / "r")).columns == ["id", "recorded_at"]


def test_upsert_and_sync(spark):
    target = spark.createDataFrame([(1, "a", "n1"), (2, "b", "n2"), (None, "z", "n0")], "id int, v string, note string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert rows(merge.upsert(target, new, ["id"])) == [(None, "z", "n0"), (1, "a", "n1"), (2, "B", None), (3, "C", None)]
    assert rows(merge.full_sync(target, new, ["id"])) == [(2, "B", "n2"), (3, "C", None)]
    assert rows(merge.full_sync(target.drop("note"), new, ["id"])) == [(2, "B"), (3, "C")]


def test_snapshot_table_life(spark, tmp_path):
    table = str(tmp_path / "t")
    assert not snapshots.exists(spark, table) and snapshots.history(spark, table).count() == 0
    with pytest.raises(LookupError):
        snapshots.read_version(spark, table)
    first = spark.createDataFrame([(1, 10), (2, 20)], "id int, v int")
    assert merge.upsert_table(first, table, ["id"]) == 0
    with pytest.raises(ValueError):
        merge.upsert_table(spark.createDataFrame([(1, 1), (1, 2)], "id int, v int"), table, ["id"])
    assert merge.upsert_table(spark.createDataFrame([(2, 21), (3, 30)], "id int, v int"), table, ["id"]) == 1
    assert merge.update_table(spark, table, F.col("id") == 1, {"v": F.col("v") * 2}) == 2
    assert merge.sync_table(spark.createDataFrame([(3, 31)], "id int, v int"), table, ["id"]) == 3
    assert rows(snapshots.read_version(spark, table)) == [(3, 31)]
    assert rows(snapshots.read_version(spark, table, 2)) == [(1, 20), (2, 21), (3, 30)]
    assert [(r.version, r.operation, r.rows) for r in snapshots.history(spark, table).collect()] == [
        (3, "sync", 1), (2, "update", 3), (1, "upsert", 3), (0, "create", 2)]
    # new columns replace the schema
    assert merge.sync_table(spark.createDataFrame([(3, 1, "x")], "id int, v int, w string"), table, ["id"]) == 4
    assert snapshots.history(spark, table).first().operation == "overwrite"


def test_plain_reader_sees_the_current_version_only(spark, tmp_path):
    table, plain = str(tmp_path / "t"), str(tmp_path / "p")
    snapshots.commit(spark.range(5), table, "create")
    snapshots.commit(spark.range(2), table, "overwrite")
    spark.range(3).write.parquet(plain)
    assert readers.read_table(spark, table).count() == 2 and readers.read_table(spark, table).columns == ["id"]
    assert readers.read_table(spark, plain).count() == 3


def test_time_travel_by_time(spark, tmp_path):
    table = str(tmp_path / "t")
    for day in (1, 2, 3):
        snapshots.commit(spark.range(day), table, "write", ts=datetime(2024, 1, day))
    assert snapshots.read_version(spark, table, as_of=datetime(2024, 1, 2, 12)).count() == 2
    with pytest.raises(LookupError):
        snapshots.read_version(spark, table, as_of=datetime(2023, 1, 1))


def test_retention_job(spark, tmp_path):
    table = str(tmp_path / "t")
    snapshots.commit(spark.createDataFrame([(1, "2024-01-10"), (2, "2023-01-01")], "id int, d string"), table, "create")
    as_of = F.lit("2024-01-12").cast("timestamp")
    assert merge.apply_retention(spark, table, "gone", 5, as_of) is None
    assert merge.apply_retention(spark, table, "d", 5, as_of) == 1
    assert rows(snapshots.read_version(spark, table), "id") == [(1,)]


def test_bronze_to_silver_to_gold(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    source = tmp_path / "landing"
    source.mkdir()
    (source / "a.csv").write_text("id,name,department,salary\n1,Ada,engineering,100\n2,Bo,,not_a_number\n3,,sales,5\n1,Ada,engineering,100\n")
    curate.ingest_files(spark, str(source), "csv", bronze, "2024-01-01", ingested_at=datetime(2024, 1, 1))
    curate.ingest_files(spark, str(source), "csv", bronze, "2024-01-01", ingested_at=datetime(2024, 1, 1))
    assert spark.read.parquet(bronze).count() == 4
    config = {"source": bronze, "target": silver, "primary_key": "id", "cast": {"salary": "int", "id": "int"},
              "null_handling": {"drop_if_null": ["name"], "fill": {"department": "unknown", "salary": 0}}}
    assert curate.bronze_to_silver(spark, config) == {"rows_read": 4, "rows_written": 2, "version": 0}
    assert curate.bronze_to_silver(spark, config)["version"] == 1
    stored = snapshots.read_version(spark, silver)
    assert rows(stored, "id", "department", "salary") == [(1, "engineering", 100), (2, "unknown", 0)]
    assert curate.silver_quality(stored, config).filter("NOT passed").count() == 0
    curate.silver_to_gold(spark, silver, gold, {"headcount": "people"})
    assert rows(snapshots.read_version(spark, gold), "department", "headcount", "avg_salary", "total_payroll") == [("engineering", 1, 100.0, 100), ("unknown", 1, 0.0, 0)]


def test_department_metrics(spark):
    df = spark.createDataFrame([("e", 90), ("e", 100), ("e", 108), ("m", None)], "department string, salary int")
    assert rows(curate.department_metrics(df)) == [("e", 3, 99.33, 90, 108, 298), ("m", 1, None, None, None, None)]


def test_publish_and_read_product(spark, tmp_path):
    path, registry = str(tmp_path / "t"), str(tmp_path / "registry")
    df = spark.createDataFrame([(1, None, 1.5), (2, "x", 2.5)], "id bigint, name string, v double")
    manifest = products.publish(df, path, registry, "analytics.t", "T", "d", "analytics", "team", ["a.b"])
    assert [(c["name"], c["type"], c["nullable"]) for c in manifest["schema"]] == [("id", "long", False), ("name", "string", True), ("v", "double", False)]
    stored = spark.read.parquet(registry)
    assert stored.columns == ["product_id", "domain", "name", "owner", "version", "access", "manifest_json", "registered_at"]
    read = readers.read_product(stored, "analytics.t", ["id"])
    assert read.columns == ["id"] and read.count() == 2
    with pytest.raises(KeyError):
        readers.read_product(stored, "no.such")


def test_job_runner(spark, tmp_path):
    silver, out = str(tmp_path / "s"), str(tmp_path / "o")
    spark.createDataFrame([("e", 1), ("e", 3)], "department string, salary int").write.parquet(silver)
    jobs.run(spark, "department_metrics", {"silver": silver}, out)
    assert rows(spark.read.parquet(out), "department", "headcount") == [("e", 2)]
    with pytest.raises(ValueError, match="needs registry, as_of_year"):
        jobs.run(spark, "population_stats", {}, out)


def test_stage_tables_live_in_the_shared_folder(spark):
    stage = durable(spark.range(3), "t")
    where = stage.inputFiles()[0]
    assert shared_dir(spark).split(":")[-1] in where and stage.count() == 3
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    path = fresh_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path)
    drop_stages(spark)
    assert not path_exists(spark, path)
