import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.functions import schemas as S
from terrasse.operators.keys import drop_duplicate_events
from terrasse.sinks.writers import read_evolved
from terrasse.streaming import events as st


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = lambda i, salary: json.dumps({"event_id": f"e{i}", "event_type": "hired", "employee_id": i, "department": "x", "salary": salary, "event_timestamp": f"2024-01-0{i}T00:00:00"})
    (folder / "a.json").write_text("\n".join([line(1, 10), line(2, None), line(3, 30)]))
    return folder


def test_stream_schema_is_fixed(spark, landing):
    stream = st.file_stream(spark, str(landing))
    assert stream.isStreaming
    assert [f.name for f in stream.schema] == ["event_id", "event_type", "employee_id", "department", "salary", "event_timestamp"]


def test_file_stream_restarts_without_repeats(spark, landing, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    st.files_to_bronze(spark, str(landing), out, check, trigger=None).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    (landing / "b.json").write_text(json.dumps({"event_id": "e4", "event_type": "left", "employee_id": 4}))
    st.files_to_bronze(spark, str(landing), out, check, trigger=None).awaitTermination()
    st.files_to_bronze(spark, str(landing), out, check, trigger=None).awaitTermination()
    stored = spark.read.parquet(out)
    assert rows(stored, "event_id", "salary") == [("e1", 10), ("e2", None), ("e3", 30), ("e4", None)]
    assert {"_processed_at", "_source_path"} <= set(stored.columns)


MESSAGES = [
    ("t", 0, 1, datetime(2024, 5, 1), json.dumps({"eventId": "1", "eventType": "a", "occurredAt": "2024-01-02T03:04:05Z", "source": "s", "version": "1", "payload": {"x": {"y": 1}}})),
    ("t", 0, 2, datetime(2024, 5, 2), "not json"),
    ("t", 1, 3, datetime(2024, 5, 3), json.dumps({"eventId": "3", "eventType": "b", "occurredAt": "never", "payload": "text"})),
    ("t", 1, 4, datetime(2024, 5, 4), None),
]


def test_envelopes_unpack_and_keep_raw_values(spark):
    out = st.add_broker_metadata(st.unpack_envelopes(spark.createDataFrame(MESSAGES, S.BROKER_MESSAGE)), ["t"], "g")
    got = rows(out, "kafka_offset", "event_id", "event_type", "payload_json", "event_date", "_raw_value")
    assert [r[:5] for r in got] == [
        (1, "1", "a", '{"x":{"y":1}}', date(2024, 1, 2)), (2, None, None, None, date(2024, 5, 2)),
        (3, "3", "b", "text", date(2024, 5, 3)), (4, None, None, None, date(2024, 5, 4)),
    ]
    assert got[1][5] == "not json"
    assert out.columns[-4:] == ["_processed_at", "_source_topics", "_consumer_group", "event_date"]


def test_envelope_stream_is_partitioned(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(MESSAGES[:3], S.BROKER_MESSAGE).write.parquet(source)
    stream = spark.readStream.schema(S.BROKER_MESSAGE).parquet(source)
    for _ in range(2):
        rows_ = st.add_broker_metadata(st.unpack_envelopes(stream), ["t"], "g")
        st.append_stream(rows_, out, str(tmp_path / "check"), st.PARTITION_BY).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 3 and stored.filter("event_type = 'a'").first().event_date == date(2024, 1, 2)


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        st.broker_stream(spark, "localhost:1", ["t"], "g")


def test_duplicates_drop_in_stream_and_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "event_id string, n int").withColumn(
        "event_timestamp", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.col("n"), F.lit(0)))
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    st.append_stream(st.drop_late_duplicates(stream), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == [("a",), ("b",)]
    assert rows(drop_duplicate_events(df, "event_id", ["event_timestamp"]), "event_id", "n") == [("a", 1), ("b", 3)]


def test_a_failed_batch_is_written_whole_and_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(30).repartitionByRange(3, "id").write.parquet(source)
    calls = []

    def sink(rows_, folder):
        calls.append(folder.rsplit("=")[-1])
        if calls == ["0", "1"]:
            rows_.limit(2).write.parquet(f"{folder}/_temporary_part")
            raise OSError("lost")
        rows_.write.mode("overwrite").parquet(folder)

    def run():
        st.append_batches(st.file_stream(spark, source, "id bigint", "parquet", files_per_batch=1), out, str(tmp_path / "check"), sink=sink).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    assert rows(st.read_batches(spark, out), "batch") == [(0,)] * 10  # the broken batch is not seen
    run()
    run()
    assert calls == ["0", "1", "1", "2"]
    assert sorted(r["id"] for r in st.read_batches(spark, out).collect()) == list(range(30))


def test_a_batch_the_checkpoint_does_not_know_is_skipped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    spark.range(5).write.parquet(f"{out}/batch=0")  # written, but the run ended before its commit
    st.append_batches(st.file_stream(spark, source, "id bigint", "parquet"), out, str(tmp_path / "check")).awaitTermination()
    assert st.read_batches(spark, out).count() == 5
    with pytest.raises(LookupError):
        (tmp_path / "none").mkdir()
        st.read_batches(spark, str(tmp_path / "none"))


def test_restart_with_more_columns(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    (source / "a.json").write_text('{"id": 1}')
    st.append_stream(st.file_stream(spark, str(source), "id int"), out, check).awaitTermination()
    (source / "b.json").write_text('{"id": 2, "v": "x"}')
    st.append_stream(st.file_stream(spark, str(source), "id int, v string"), out, check).awaitTermination()
    assert rows(read_evolved(spark, out), "id", "v") == [(1, None), (2, "x")]
    (tmp_path / "empty").mkdir()
    st.append_stream(st.file_stream(spark, str(source), "id int"), str(tmp_path / "empty"), str(tmp_path / "other")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "empty")).count() == 2
    for narrow in ("v string", "id bigint, v string"):
        with pytest.raises(ValueError, match="id"):
            st.append_stream(st.file_stream(spark, str(source), narrow), out, check)


def test_batches_with_more_columns(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    (source / "a.json").write_text('{"id": 1, "d": "a"}')
    st.append_batches(st.file_stream(spark, str(source), "id int, d string"), out, check, ["d"]).awaitTermination()
    (source / "b.json").write_text('{"id": 2, "d": "b", "v": "x"}')
    st.append_batches(st.file_stream(spark, str(source), "id int, d string, v string"), out, check, ["d"]).awaitTermination()
    assert rows(st.read_batches(spark, out), "batch", "id", "d", "v") == [(0, 1, "a", None), (1, 2, "b", "x")]
