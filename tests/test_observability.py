import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.functions import schemas as S
from terrasse.operators import profile
from terrasse.plans import observability as O
from terrasse.plans import persons


def as_of():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def registry(spark):
    def row(pid, version, at, **extra):
        doc = {"id": pid, "name": pid, "domain": pid.split(".")[0], "owner": "t", "version": version, **extra}
        return (pid, doc["domain"], pid, "t", version, "public", json.dumps(doc), at)
    contract = {"slo": {"freshness_hours": 24}}
    return spark.createDataFrame([
        row("hr.a", "1.0.0", "2023-01-01T00:00:00+00:00", quality_sla={"freshness_hours": 1}),
        row("hr.a", "1.1.0", "2024-01-30T00:00:00+00:00", quality_sla={"freshness_hours": 24}, contract=contract, schema=[{"name": "x", "type": "int"}]),
        row("it.b", "1.0.0", "2024-01-28T00:00:00+00:00", quality_sla={"freshness_hours": 24}, contract=contract),
        row("it.c", "1.0.0", "2023-01-01T00:00:00+00:00"),
    ], S.REGISTRY)


@pytest.fixture(scope="module")
def sla(spark, registry):
    commits = spark.createDataFrame([("hr.a", datetime(2024, 1, 31, 3))], "product_id string, committed_at timestamp")
    return O.sla_check(registry, commits, as_of())


def test_sla_results(sla):
    assert rows(sla, "product_id", "hours_since_update", "freshness_hours", "compliant") == [("hr.a", 21.0, 24, True), ("it.b", None, 24, False)]


def test_contract_report(registry, sla):
    assert [(r.product_id, r.contract_status) for r in O.contract_report(registry, sla).collect()] == [("it.b", "breach"), ("hr.a", "warning"), ("it.c", "none")]


def test_manifest_products(registry):
    got = {r.product_id: r for r in O.manifest_products(registry).collect()}
    assert got["hr.a"].columns == ["x"] and got["hr.a"].version == "1.1.0" and not got["it.c"].has_contract


def test_rule_sets(spark, tmp_path):
    good = spark.createDataFrame([("ENSLIG", 3, 60.0), ("EKTEPAR", 2, 140.0)], "household_type string, count int, pct_of_total double")
    good.write.parquet(str(tmp_path / "h"))
    spark.createDataFrame([(None, "x")], "dodsfall_id string, icd10_kode string").write.parquet(str(tmp_path / "c"))
    scores = O.table_scores(spark, {"household_structure": str(tmp_path / "h"), "contributing_causes": str(tmp_path / "c"), "person_registry": str(tmp_path / "none")})
    assert rows(scores, "product_id", "score_pct", "status", "severity") == [
        ("contributing_causes", 66.7, "failed", "critical"), ("household_structure", 75.0, "failed", "warning"), ("person_registry", 0.0, "failed", "critical")]
    assert set(O.RULE_SETS) >= {"person_registry", "migration_flows"} and persons.MARRIED == "GIFT"


def test_platform_snapshot(spark, registry, sla):
    log = spark.createDataFrame([("hr.a", "view", "u", datetime(2024, 1, 31)), ("it.b", "view", None, datetime(2024, 1, 20))], "product_id string, action string, user_id string, ts timestamp")
    scores = spark.createDataFrame([("hr.a", datetime(2024, 1, 31), 40.0)], "product_id string, validated_at timestamp, score_pct double")
    feedback = spark.createDataFrame([(datetime(2024, 1, 31), "why", "thumbs_up")], "ts timestamp, question string, rating string")
    snap = {}
    for r in O.platform_snapshot(registry, log, sla, scores, feedback, as_of()).collect():
        snap.setdefault(r.section, []).append(json.loads(r.payload))
    assert snap["platform_totals"] == [{"products": 3, "domains": 2, "new_products": 1, "avg_quality_pct": 40.0}]
    assert snap["active_users"] == [{"n": 1}] and snap["trending_up"][0]["product_id"] == "hr.a"
    assert snap["health"][0]["sla_compliance_pct"] == 50.0 and len(snap["incidents"]) == 2
    assert sorted((p["product_id"], p["event"]) for p in snap["recent_publications"]) == [("hr.a", "version_bump"), ("it.b", "new")]


def test_histories_are_trimmed(spark):
    entries = spark.range(200).select(F.lit("health").alias("section"), F.timestamp_seconds("id").alias("generated_at"), F.lit("{}").alias("payload"))
    assert O.trim_history(entries).count() == 168
    configs = spark.range(15).select(F.lit("s").alias("slug"), F.timestamp_seconds("id").alias("saved_at"), F.lit("{}").alias("config"))
    assert O.trim_configs(configs).count() == 10


def test_dashboards(spark):
    df = spark.createDataFrame([("1", "A", date(2024, 1, 3)), ("1", "A", date(2024, 1, 9)), ("2", "B", date(2024, 2, 1))], "municipality_code string, municipality_name string, moved_date date")
    assert profile.dashboard(df, "overview").first()[0] == 3
    assert [r.antall for r in profile.dashboard(df, "timeseries").collect()] == [2, 1]
    assert [tuple(r) for r in profile.dashboard(df, "geo").collect()] == [("1", "A", 2), ("2", "B", 1)]
    assert profile.dashboard(df, "table", columns=["municipality_code"]).count() == 3
    with pytest.raises(ValueError):
        profile.dashboard(df, "other")
