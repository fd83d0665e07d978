from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.operators import lookup, profile
from terrasse.plans import health


def test_table_profile(spark):
    df = spark.createDataFrame([(i, "x" * 130 if i == 0 else f"v{i % 6}", "me@x", None if i % 2 else i) for i in range(10)], "id int, text string, email string, half int")
    got = {r.name: r for r in profile.table_profile(df).collect()}
    assert got["half"].null_rate == 0.5 and set(got["half"].sample_values) <= {"0", "2", "4", "6", "8"} and len(got["half"].sample_values) >= 2
    assert got["email"].pii_hint and got["email"].sample_values == ["***"]
    assert set(got["text"].sample_values) <= {"x" * 120 + "…", *[f"v{i}" for i in range(6)]}


def test_profile_of_an_empty_table(spark):
    r = profile.table_profile(spark.createDataFrame([], "a int")).first()
    assert (r.name, r.null_rate, r.sample_values) == ("a", None, [])


def test_payload_profile_types(spark):
    docs = ['{"a": 1, "b": true, "c": "x", "d": null, "o": {"k": 1}, "ssn": "1"}', '{"a": 1.5, "b": null, "c": "y", "l": [1]}', "broken", "[1]", None, '{"a": 2}']
    df = spark.createDataFrame([(d,) for d in docs], "p string")
    got = {r.name: (r.json_path, r.inferred_type, r.null_rate, r.pii_hint) for r in profile.payload_profile(df, "p").collect()}
    assert got == {
        "a": ("$.a", "double", 0.0, False), "b": ("$.b", "boolean", 0.667, False), "c": ("$.c", "string", 0.333, False), "d": ("$.d", "string", 1.0, False),
        "o": ("$.o", "string", 0.667, False), "l": ("$.l", "string", 0.667, False), "ssn": ("$.ssn", "string", 0.667, True),
    }
    assert rows(profile.payload_samples(df, "p").filter("name IN ('c', 'ssn')")) == [("c", "x"), ("c", "y"), ("ssn", "***")]


def test_column_roles(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), i, f"k{i % 3}", f"id{i}", "2024-01-0%d" % (i % 9 + 1), "2024-01-01" if i % 2 else "odd") for i in range(100)],
                               "dato timestamp, antall bigint, kommune string, name string, day string, mixed string")
    assert dict(rows(profile.column_roles(df))) == {"dato": "date", "antall": "numeric", "kommune": "categorical", "name": "other", "day": "date", "mixed": "categorical"}


def test_chart_choice(spark):
    df = spark.range(40).select(F.timestamp_seconds(F.col("id") * 86400).alias("d"), F.col("id").alias("n"), (F.col("id") * 2.5).alias("m"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"), F.concat(F.lit("u"), F.col("id")).alias("u"))
    kinds = {cols: profile.chart_data(df.select(*cols), points=True)[0] for cols in [("d", "n"), ("c", "n"), ("n", "m"), ("n",)]}
    assert kinds == {("d", "n"): "line", ("c", "n"): "bar", ("n", "m"): "scatter", ("n",): "histogram"}
    assert profile.chart_data(df.select("u")) is None and profile.chart_data(df.limit(0)) is None
    many = spark.range(6000).select("id", (F.col("id") % 7).alias("m"))
    kind, data = profile.chart_data(many)
    assert kind == "density" and data.agg(F.sum("n")).first()[0] == 6000


def test_nothing_is_sampled_or_cut(spark):
    """300,000 rows: sums, counts, samples and roles cover all of them."""
    many = spark.range(300_000)
    kind, data = profile.chart_data(many.select(F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.lit(1.0).alias("v")))
    assert kind == "bar" and {r["v"] for r in data.collect()} == {100_000.0}
    kind, data = profile.chart_data(many.select("id"))
    assert kind == "histogram" and data.agg(F.sum("n")).first()[0] == 300_000
    late = many.select(F.when(F.col("id") >= 500, F.lit("there")).alias("late"), F.when(F.col("id") < 50, "2024-01-01").otherwise(F.concat(F.lit("no date "), "id")).alias("odd"))
    found = {r.name: r for r in profile.table_profile(late).collect()}
    assert found["late"].sample_values == ["there"] and found["late"].null_rate == round(500 / 300_000, 3)
    assert dict(rows(profile.column_roles(late)))["odd"] == "other"


def test_templates_and_types(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 5), 1), ("a", datetime(2024, 3, 5), 2), (None, None, 3)], "c string, created_at timestamp, count int")
    assert [tuple(r) for r in profile.analysis(df, "cohort").collect()] == [("a", 2), (None, 1)]
    assert [r.n for r in profile.analysis(df, "timeseries").collect()] == [1, 0, 1]
    assert profile.analysis(df, "distribution").first()["mean"] == 2.0
    assert profile.analysis(df, "explore").first()["null_rate"] == 33.3
    with pytest.raises(ValueError):
        profile.analysis(df, "other")
    assert rows(profile.column_types(df), "name", "type") == [("c", "string"), ("count", "int"), ("created_at", "timestamp")]
    assert rows(profile.preview(df, ["c"], ["count"], 2)) == [("a",), ("a",)]


@pytest.fixture(scope="module")
def codes(spark):
    source = spark.createDataFrame([
        ("I", None, "KAPITTEL", "Kap", "Chap", None, "true"), ("A0", "I", "BLOKK", "Blokk", None, "FALSE", None), ("A00", "A0", "KODE", "Kolera", "Cholera", "True", "maybe"),
    ], "identifier string, parent string, type string, tittel_no string, tittel_en string, gyldig_underliggende string, gyldig_ekstern string")
    return health.code_list(source, "2024")


def test_code_list(codes):
    assert rows(codes, "code", "chapter_code", "block_code", "valid_as_underlying", "valid_as_external") == [
        ("A0", "I", None, False, False), ("A00", "I", "A0", True, None), ("I", "I", None, False, True)]
    assert codes.columns == ["code", "parent_code", "type", "name_no", "name_en", "chapter_code", "block_code", "valid_as_underlying", "valid_as_external", "icd10_version", "_ingested_at"]


@pytest.fixture(scope="module")
def deaths(spark):
    return spark.createDataFrame([
        ("d1", "p1", "80", "M", "0301", "Oslo", "t", "k", "v", '{"icd10Kode":"A00"}', '{"skadeKode":"A0","skademekanismeKode":"??"}', '[{"sekvens":1,"kapittel":"I","icd10Kode":"A00","icd10Tittel":"x"},{"sekvens":2,"icd10Kode":"Z9"}]'),
        ("d2", "p2", "old", "F", "0301", "Oslo", "t", "k", "v", None, "broken", "[]"), ("d3", "p3", None, "F", None, None, None, None, None, "{}", None, None),
        ("d4", "p4", "5", "F", None, None, None, None, None, "{}", None, "broken"),
    ], "dodsfallId string, personSyntId string, alder string, kjonn string, kommune string, fylke string, tidspunkt string, klassifisertTidspunkt string, icd10Versjon string, underliggendeArsak string, eksternArsak string, medvirkendeArsaker string")


def test_death_facts(deaths, codes):
    out = health.death_facts(deaths, codes)
    assert out.count() == 4 and out.columns[9:12] == ["underliggende_arsak_kode", "underliggende_arsak_navn", "underliggende_arsak_kapittel"]
    one = out.filter("dodsfall_id = 'd1'").first()
    assert (one.alder, one.underliggende_arsak_navn, one.ekstern_skade_navn, one.ekstern_skademekanisme_kode, one.ekstern_skademekanisme_navn) == (80, "Kolera", "Blokk", "??", None)
    assert out.filter("dodsfall_id = 'd2'").first().alder is None


def test_contributing_causes(deaths, codes):
    assert rows(health.contributing_causes(deaths, codes)) == [("d1", 1, "A00", "Kolera", "I"), ("d1", 2, "Z9", None, None)]


def test_role_lookups_keep_rows(spark):
    fact = spark.createDataFrame([(1, "a", None), (2, "zz", "b")], "id int, x string, y string")
    listed = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    out = lookup.role_lookups(fact, listed, "code", ["name"], {"x": "first", "y": "second"})
    assert rows(out, "id", "first_name", "second_name") == [(1, "A", None), (2, None, "B")]


@pytest.mark.parametrize("most", [1, 6, 10**6])
def test_lookups_of_frequent_and_missing_codes(spark, most):
    """All, some and no codes are rare; missing codes and frequent ones do not share one task, and rows keep every match."""
    names = ("spark.terrasse.hotCodes", most), ("spark.sql.autoBroadcastJoinThreshold", -1), ("spark.sql.adaptive.enabled", "false")
    before = {name: spark.conf.get(name, None) for name, _ in names}
    code = lambda i: None if i % 2 else "a" if i % 4 else "zz" if i % 8 else f"c{i % 3}"
    fact = [(i, code(i), code(i // 3)) for i in range(400)]
    listed = [("a", "A"), ("b", "B"), ("c0", "C"), ("c0", "also C"), (None, "nothing")]
    df, codes = spark.createDataFrame(fact, "id int, x string, y string"), spark.createDataFrame(listed, "code string, name string")
    named = lambda c: [n for k, n in listed if c is not None and k == c] or [None]
    try:
        for name, value in names:
            spark.conf.set(name, str(value))
        out = lookup.role_lookups(df, codes, "code", ["name"], {"x": "first", "y": "second"})
        assert out.columns == ["y", "x", "id", "first_name", "second_name"]
        wanted = [(i, x, y, n, m) for i, x, y in fact for n in named(x) for m in named(y)]
        assert rows(out, "id", "x", "y", "first_name", "second_name") == rows(spark.createDataFrame(wanted, "id int, x string, y string, n string, m string"))
        assert out.filter("y IS NULL").select(F.spark_partition_id()).distinct().count() > 1
        if most > 1:
            assert out.filter("x = 'a'").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_lookup_steps_spread_missing_codes(spark):
    fact = spark.createDataFrame([(i, None, None) for i in range(300)], "id int, x string, y string")
    listed = spark.createDataFrame([("a", "A")], "code string, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        roles = lookup.role_lookups(fact, listed, "code", ["name"], {"x": "first", "y": "second"})
        for out in (roles, lookup.bridge(fact, listed, "x", {"name": "name"}, "code")):
            assert out.select(F.spark_partition_id()).distinct().count() > 1 and out.count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
