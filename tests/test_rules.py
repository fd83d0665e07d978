import hashlib
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.functions import scalars, versions
from terrasse.operators import keys, lookup, rules


@pytest.fixture(scope="module")
def bronze(spark):
    data = [
        (1, "Ada", "eng", "100", "2020-01-01"), (2, "Bo", None, "200", "2020-13-01"), (3, None, "ops", "not_a_number", "x"),
        (4, "Dag", "eng", " 12.9 ", None), (5, "Eli", "ops", None, "2021-05-05"),
    ]
    df = spark.createDataFrame(data, "id bigint, name string, department string, salary string, hire_date string")
    return df.withColumns({"ingestion_date": F.lit("2024-01-01"), "_source_path": F.lit("p")})


def test_casts_give_null_instead_of_failing(bronze):
    out = rules.apply_casts(bronze, {"salary": "int", "hire_date": "date", "missing": "int"})
    assert dict(out.dtypes)["salary"] == "int"
    assert rows(out, "id", "salary", "hire_date") == [
        (1, 100, date(2020, 1, 1)), (2, 200, None), (3, None, None), (4, 12, None), (5, None, date(2021, 5, 5)),
    ]


def test_cast_report_counts_only_introduced_nulls(bronze):
    got = rows(rules.cast_report(bronze, {"salary": "int", "hire_date": "date", "missing": "int"}))
    assert got == [("hire_date", "date", 2), ("salary", "int", 1)]


def test_cast_report_without_rules_is_empty(bronze):
    assert rules.cast_report(bronze, {"missing": "int"}).count() == 0


def test_null_rules_drop_then_fill(bronze):
    out = rules.apply_null_rules(bronze, ["name"], {"department": "unknown"})
    assert rows(out, "id", "department") == [(1, "eng"), (2, "unknown"), (4, "eng"), (5, "ops")]


def test_null_rules_without_rules_change_nothing(bronze):
    assert rules.apply_null_rules(bronze).count() == 5


def test_bronze_metadata_round_trip(bronze):
    bare = rules.drop_bronze_metadata(bronze)
    assert bare.columns == ["id", "name", "department", "salary", "hire_date"]
    again = rules.add_bronze_metadata(bare, "2024-02-02", "src")
    assert again.columns[-3:] == list(rules.BRONZE_METADATA)
    assert rows(again.select("ingestion_date", "_source_path").distinct()) == [("2024-02-02", "src")]
    assert rules.add_updated_at(bare).columns[-1] == "_silver_updated_at"


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame(
        [("t", "2024-01-01", "i1", '{"id":"a","v":"1"}'), ("t", "2024-01-02", "i2", '{"id":"b"}'), ("u", "2024-01-03", "i3", "broken"), ("u", None, None, None)],
        "event_type string, event_timestamp string, _ingested_at string, payload_json string",
    )


def test_payload_extract_keeps_pass_through_columns(payloads):
    out = rules.extract_payload(payloads, {"id": "$.id", "v": ["$.w", "$.v"]})
    assert out.columns == ["id", "v", "_ingested_at", "event_type", "event_timestamp"]
    assert rows(out, "id", "v") == [(None, None), (None, None), ("a", "1"), ("b", None)]


def test_payload_extract_without_source_column(bronze):
    assert rules.extract_payload(bronze, {"a": "$.a"}).columns == bronze.columns


def test_conditional_path_and_event_filter(payloads):
    only = payloads.select(rules.path_for_type("payload_json", "$.id", "event_type", "t").alias("x"))
    assert rows(only) == [(None,), (None,), ("a",), ("b",)]
    assert rules.keep_events(payloads, "event_type", ["u"], ["event_timestamp"]).count() == 1


def test_event_time_falls_back(spark):
    df = spark.sql("SELECT * FROM VALUES ('2024-01-01T10:00:00', timestamp'2020-01-01'), ('bad', timestamp'2020-01-01'), (NULL, timestamp'2020-01-02') t(a, b)")
    assert rows(df.select(rules.event_time("a", "b").alias("t"))) == [(datetime(2020, 1, 1),), (datetime(2020, 1, 2),), (datetime(2024, 1, 1, 10),)]


def test_pseudonym(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "s string").select(rules.pseudonym("s").alias("h"))
    assert rows(df) == [(None,), (None,), (hashlib.sha256(b"x").hexdigest(),)]


def test_mask_columns(bronze):
    assert rows(rules.mask_columns(bronze, ["name", "nope"]).select("name").distinct()) == [("***",)]
    assert rows(rules.mask_columns(bronze, ["name"], allowed=True), "name") == rows(bronze, "name")


def test_bands_and_decades(spark):
    df = spark.createDataFrame([(0,), (17,), (18,), (44,), (45,), (65,), (None,)], "a int")
    assert rows(df.select("a", rules.band(F.col("a"), rules.AGE_BANDS, rules.AGE_TOP))) == rows(spark.createDataFrame(
        [(0, "0-17"), (17, "0-17"), (18, "18-29"), (44, "30-44"), (45, "45-64"), (65, "65+"), (None, "65+")], "a int, b string"))
    sizes = spark.createDataFrame([(i,) for i in range(1, 7)], "s int")
    assert [r[0] for r in sizes.orderBy("s").select(rules.band(F.col("s"), rules.SIZE_BANDS, rules.SIZE_TOP)).collect()] == ["1", "2", "3-4", "3-4", "5+", "5+"]
    assert rows(spark.createDataFrame([(1979,), (1980,)], "y int").select(rules.decade(F.col("y")))) == [(1970,), (1980,)]


def test_fixed_schema(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rules.fixed_schema(df, {"x": "a", "y": "a"}).columns == ["x", "y"]


def test_retention(spark):
    df = spark.createDataFrame([(1, "2024-01-10"), (2, "2024-01-01"), (3, "junk"), (4, None)], "id int, d string")
    as_of = F.lit("2024-01-12").cast("timestamp")
    assert rows(rules.retain_recent(df, "d", 5, as_of), "id") == [(1,)]
    assert rows(rules.retain_recent(df, "d", 5, as_of, keep_null=True), "id") == [(1,), (3,), (4,)]
    for kept in (rules.retain_recent(df, "gone", 5, as_of), rules.retain_recent(df, "d", None, as_of), rules.retain_recent(df, "d", 5, as_of, "archive")):
        assert kept.count() == 4


def test_latest_per_key_defaults(spark):
    df = spark.createDataFrame([("a", 1, "2024"), ("a", 2, "2025"), ("b", 3, None), (None, 4, "2024"), (None, 5, "2024")], "k string, v int, _ingested_at string")
    assert rows(keys.latest_per_key(df, ["k"]), "k", "v") == [(None, 5), ("a", 2), ("b", 3)]
    # no time column: the remaining columns decide
    assert rows(keys.latest_per_key(df.drop("_ingested_at"), ["k"]), "k", "v") == [(None, 5), ("a", 2), ("b", 3)]
    assert keys.latest_per_key(df.limit(0), ["k"]).count() == 0


def test_keep_last_n_and_flags(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, t int")
    assert rows(keys.keep_last_n(df, ["k"], ["t"], 2)) == [("a", 3), ("a", 4), ("b", 9)]
    members = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(keys.with_existence_flag(df.filter("t > 3"), members, ["k"], "m"), "k", "m") == [("a", True), ("b", False)]
    assert keys.seen_before(df, members, ["k"]).count() == 5


def test_padded_code_keeps_long_codes(spark):
    df = spark.createDataFrame([("7",), ("1234",), ("12345",), (None,)], "c string").select(lookup.padded_code("c").alias("c"))
    assert rows(df) == [(None,), ("0007",), ("1234",), ("12345",)]


def test_reference_never_loses_or_multiplies_rows(spark):
    own = spark.createDataFrame([("1", "own1"), ("2", "own2"), ("99999", "x"), (None, "n")], "code string, name string")
    ref = spark.createDataFrame([("0001", "ref1"), ("0001", "ref1b"), ("0002", None)], "ref string, ref_name string")
    out = lookup.prefer_reference(own, ref, "code", "ref", {"name": "ref_name"})
    assert rows(out) == [(None, "n"), ("1", "ref1"), ("2", "own2"), ("99999", "x")]


def test_scalars(spark):
    names = spark.createDataFrame([("FNR",), ("firstname",), ("first_name",), ("surname",), ("dobx",)], "n string")
    assert [r[0] for r in names.select(scalars.pii_hint(F.col("n"))).collect()] == [True, True, True, False, False]
    s = spark.createDataFrame([("@hourly",), ("@weekly",), ("5 * * * *",), (None,)], "s string")
    assert [r[0] for r in s.select(scalars.schedule_hours(F.col("s"))).collect()] == [2, 192, None, None]
    long = spark.createDataFrame([("x" * 121,), ("y" * 120,)], "t string")
    assert [len(r[0]) for r in long.select(scalars.shorten(F.col("t"))).collect()] == [121, 120]
    assert scalars.object_store_path("s3://b/k") == "s3a://b/k" and scalars.object_store_path("/x") == "/x"


def test_versions(spark):
    df = spark.createDataFrame(
        [("1.0.0", None), ("1.10.0", "1.9.9"), ("1.0.0", "1.0.0"), ("0.9.0", "1.2.3")], "p string, l string"
    )
    assert [r[0] for r in df.select(versions.resolve_version("p", "l")).collect()] == ["1.0.0", "1.10.0", "1.0.1", "1.2.4"]
    assert spark.range(1).select(versions.bump_patch(F.lit("odd"))).first()[0] == "1.0.1"
