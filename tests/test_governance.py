import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.functions import schemas as S
from terrasse.operators import governance as G
from terrasse.operators import quality as Q
from terrasse.operators import search
from terrasse.operators import usage as U

GOOD = {"id": "hr.emp", "name": "Employees", "domain": "hr", "owner": "team", "version": "1.2.3", "description": "d", "source_path": "s3://gold/hr/emp",
        "format": "delta", "access": "restricted", "quality_sla": {"max_null_rate": 0.1, "freshness_hours": 24}, "retention": {"days": 30, "strategy": "delete"},
        "schema": [{"name": "ssn", "type": "string", "pii": True, "sensitivity": "high"}, {"name": "mail", "type": "string", "pii": True, "sensitivity": "low"}, {"name": "n", "type": "long"}],
        "contract": {"slo": {"freshness_hours": 24, "completeness_pct": 99}, "schema_compatibility": "FULL", "guaranteed_columns": ["ssn"]}}


def manifests(spark, docs):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in docs.items()], "product_id string, manifest_json string")


def test_manifest_rules(spark):
    def but(**changes):
        return {**GOOD, **changes}
    docs = {
        "good": GOOD, "id": but(id="Hr.Emp"), "none": {k: v for k, v in GOOD.items() if k != "owner"}, "fmt": but(format="xlsx"), "extra": but(colour="red"),
        "rate": but(quality_sla={"max_null_rate": 2}), "days": but(retention={"days": 0, "mode": "x"}), "compat": but(contract={"schema_compatibility": "MAYBE", "slo": {"x": 1}}),
        "cols": but(schema=[{"type": "string"}]), "sens": but(schema=[{"name": "a", "type": "b", "sensitivity": "huge"}]), "broken": "{", "version": but(version="1.2"),
    }
    got = rows(G.manifest_violations(manifests(spark, docs), "product_id", "manifest_json"))
    assert got == sorted([
        ("broken", "(root)", "not_an_object"),
        ("cols", "schema[0].name", "required"), ("compat", "contract.schema_compatibility", "choice"), ("compat", "contract.slo.x", "unknown"),
        ("days", "retention.days", "range"), ("days", "retention.mode", "unknown"), ("extra", "colour", "unknown"), ("fmt", "format", "choice"),
        ("id", "id", "pattern"), ("none", "owner", "required"), ("rate", "quality_sla.max_null_rate", "range"),
        ("sens", "schema[0].sensitivity", "choice"), ("version", "version", "pattern"),
    ])


def test_registry_latest_and_versions(spark):
    docs = spark.createDataFrame([(json.dumps(GOOD),), (json.dumps({**GOOD, "version": "1.3.0"}),)], "manifest_json string")
    reg = G.registry_rows(docs, "manifest_json", F.lit("2024-01-01"))
    assert reg.columns == [c.split()[0] for c in S.REGISTRY.split(", ")]
    later = reg.withColumn("registered_at", F.when(F.col("version") == "1.3.0", "2024-02-01").otherwise(F.col("registered_at")))
    assert rows(G.latest_products(later), "version") == [("1.3.0",)]
    assert G.product(later, "hr.emp").first().access == "restricted"
    assert [r.version for r in G.product_versions(later, "hr.emp").collect()] == ["1.3.0", "1.2.3"]
    with pytest.raises(KeyError):
        G.product(later, "x.y")
    proposed = spark.createDataFrame([("hr.emp", "1.2.0"), ("hr.emp", "2.0.0"), ("new.p", "1.0.0")], "product_id string, version string")
    assert rows(G.publish_versions(proposed, later), "product_id", "resolved_version") == [("hr.emp", "1.3.1"), ("hr.emp", "2.0.0"), ("new.p", "1.0.0")]


def test_pii_map_and_patch(spark):
    declared = G.schema_rows(manifests(spark, {"p": GOOD, "q": {"schema": [{"name": "a", "type": "x", "pii": True}]}, "r": {"id": "r"}}), ["product_id"])
    assert rows(G.pii_map(declared)) == [("p", 2, "high"), ("q", 1, "unknown")]
    assert rows(G.pii_columns(declared), "product_id", "name") == [("p", "mail"), ("p", "ssn"), ("q", "a")]
    updates = spark.createDataFrame([("p", "n", True, "number")], "product_id string, name string, pii boolean, description string")
    patched = G.patch_columns(declared, updates, ["pii", "description"])
    assert rows(patched.filter("name = 'n'"), "pii", "description", "type") == [(True, "number", "long")]
    with pytest.raises(ValueError, match="unknown column"):
        G.patch_columns(declared, updates.withColumn("name", F.lit("zz")), ["pii"])


@pytest.mark.parametrize(("mode", "expected"), [
    ("BACKWARD", [("p", "gone", "removed"), ("p", "t", "type_changed")]), ("FORWARD", [("p", "new", "added")]),
    ("FULL", [("p", "gone", "removed"), ("p", "new", "added"), ("p", "t", "type_changed")]), ("NONE", []),
])
def test_schema_compatibility(spark, mode, expected):
    old = spark.createDataFrame([("p", "same", "int"), ("p", "t", "int"), ("p", "gone", "int"), ("only_old", "x", "int")], "product_id string, name string, type string")
    new = spark.createDataFrame([("p", "same", "int"), ("p", "t", "long"), ("p", "new", "int"), ("only_new", "x", "int")], "product_id string, name string, type string")
    assert rows(G.schema_compatibility(old, new, mode), "product_id", "name", "violation") == expected


@pytest.mark.parametrize("hot", [False, True])
def test_version_changes(spark, hot, request):
    if hot:
        request.getfixturevalue("small_runs")
        spark.conf.set("spark.terrasse.runRows", "1")
    v = spark.createDataFrame([("p", "1", "o1", ["a", "b"]), ("p", "2", "o2", ["b", "c"]), ("p", "3", "o2", ["b", "c"]), ("q", "1", None, [])],
                              "product_id string, registered_at string, owner string, cols array<string>")
    out = G.version_changes(v, ["owner"], columns="cols")
    got = {(r.product_id, r.registered_at): (r.changes, r.added, r.removed) for r in out.collect()}
    assert got == {("p", "1"): (["first"], None, None), ("p", "2"): (["owner: o1 -> o2"], ["c"], ["a"]), ("p", "3"): ([], [], []), ("q", "1"): (["first"], None, None)}


def test_version_changes_report_tags_and_types(spark):
    v = spark.createDataFrame([("p", "1", ["x"], [("a", "int")]), ("p", "2", ["x", "y"], [("a", "int")]), ("p", "3", ["x", "y"], [("a", "long")]), ("p", "4", ["x", "y"], [("a", "long"), ("b", "int")])],
                              "product_id string, registered_at string, tags array<string>, schema array<struct<name:string,type:string>>")
    got = {r.registered_at: (r.changes, r.added) for r in G.version_changes(v, ["tags"], columns="schema").collect()}
    assert got == {"1": (["first"], None), "2": (["tags changed"], []), "3": (["schema: types changed"], []), "4": ([], ["b"])}


def test_columns_of_a_product_without_table_are_not_pending(spark):
    physical = spark.createDataFrame([("p", "a", "int", False)], "product_id string, name string, type string, nullable boolean")
    declared = spark.createDataFrame([("p", "later", "date", None, None, None, None), ("q", "x", "int", None, None, None, None)],
                                     "product_id string, name string, type string, nullable boolean, pii boolean, sensitivity string, description string")
    assert rows(G.merged_schema(physical, declared), "name", "pending") == [("a", False), ("later", True), ("x", False)]


def test_merged_schema_marks_pending(spark):
    physical = spark.createDataFrame([("p", "a", "int", False), ("p", "raw", "int", True)], "product_id string, name string, type string, nullable boolean")
    declared = spark.createDataFrame([("p", "a", "string", True, True, "low", "d"), ("p", "later", "date", None, None, None, None)],
                                     "product_id string, name string, type string, nullable boolean, pii boolean, sensitivity string, description string")
    assert rows(G.merged_schema(physical, declared), "name", "type", "nullable", "pending", "pii") == [
        ("a", "int", False, False, True), ("later", "date", True, True, False), ("raw", "int", True, False, False)]


def test_column_lineage(spark):
    out = G.column_lineage(spark, {"a": "$.x"}, {"b": "int", "a": "int"}, "id", "bronze.t")
    assert rows(out) == [("a", "bronze.t", "$.x", "payload_json-extract + cast"), ("b", "bronze.t", "b", "cast/null-handling"), ("id", "bronze.t", "id", "cast/null-handling")]


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([
        ("a", "hr", "t1", ["x", "y", "z", "w"], ["b"], "s3://silver/a", "Alpha pay", "pay roll data", ["pay"]),
        ("b", "hr", "t2", ["x", "y", "z", "w"], [], "s3a://gold/b", "Beta", "pay", []),
        ("c", "it", "t1", ["q"], ["a"], "s3://gold/c", "Gamma", "other things", ["roll"]),
        ("d", "it", "t9", ["q"], None, "s3://gold/d", "Delta", "nothing", []),
        ("e", "hr", "t9", [], None, "odd/e", "Eps", "pay-roll", []),
    ], "product_id string, domain string, owner string, columns array<string>, source_products array<string>, source_path string, name string, description string, tags array<string>")


def test_related_products(catalogue):
    # b: domain 3 + columns 6 + lineage 2; e: domain 3; c: owner 1 + lineage 2
    assert [tuple(r) for r in G.related_products(catalogue, "a").collect()] == [("b", 11), ("c", 3), ("e", 3)]


def test_candidates_guard_and_access(spark, catalogue):
    assert rows(G.gold_candidates(catalogue.filter("product_id = 'a'"), catalogue), "product_id") == [("b",)]
    counts = spark.createDataFrame([(600_000,), (None,), (500_000,)], "row_count bigint")
    assert tuple(G.row_guard(counts).first()) == (1_100_000, True)
    products = spark.createDataFrame([("a", "public"), ("b", "restricted"), ("c", "restricted")], "product_id string, access string")
    grants = spark.createDataFrame([("b",), ("b",)], "product_id string")
    assert rows(G.split_access(products, grants), "product_id", "accessible") == [("a", True), ("b", True), ("c", False)]


def test_products_per_group(spark):
    df = spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d1", "y"), (None, "z")], "dag string, name string")
    assert rows(G.products_per_group(df, "dag", "name"), "dag", "name", "n_products") == [("d1", "x", 2), ("d1", "y", 2)]


def test_product_search(spark, catalogue):
    usage = spark.createDataFrame([("a", 7)], "product_id string, views int")
    found = search.product_search(catalogue, "PAY roll", usage)
    assert rows(found, "product_id", "views") == [("a", 7), ("e", 0)]
    assert found.filter("product_id = 'e'").first().snippet == "Eps <mark>pay</mark>-roll hr t9"
    assert rows(search.product_search(catalogue, "x"), "product_id", "column_matches") == [("a", ["x"]), ("b", ["x"])]
    assert rows(search.keyword_search(catalogue, "product_id", "description", "-"), "product_id") == [("e",)]
    assert search.keyword_search(catalogue, "product_id", "description", "absent").count() == 0


def test_search_prefers_short_and_frequent(spark):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat " + "word " * 50), (3, "Cat, CAT! dog"), (4, None), (5, "dog")], "id int, t string")
    assert [r.id for r in search.keyword_search(docs, "id", "t", "cat").collect()] == [3, 1, 2]


def test_checks_and_score(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (None, "c", None)], "id int, s string, n int")
    checks = [Q.row_count_between(1, 2), Q.not_null(df, "id"), Q.unique(df, "id"), Q.values_between(df, "n", 0, 10), Q.values_between(df, "n"),
              Q.null_rate_at_most(df, "s"), Q.column_exists(df, "zz"), Q.not_null(df, "zz")]
    got = {r.check_name: (r.passed, r.observed) for r in Q.run_checks(df, checks[:4] + checks[5:]).collect()}
    assert got == {"row_count": (False, 3.0), "not_null[id]": (False, 1.0), "unique[id]": (False, 1.0), "values_between[n]": (False, 1.0),
                   "null_rate[s]": (True, 0.3333), "column_exists[zz]": (False, None), "not_null[zz]": (False, None)}
    score = Q.quality_score(Q.run_checks(df, checks[:4] + checks[5:])).first()
    assert (score.total_expectations, score.passed, score.score_pct, score.status, score.severity) == (7, 1, 14.3, "failed", "critical")
    assert Q.run_checks(df, [checks[4]]).first().passed


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, s string")
    out = {r.check_name: r.passed for r in Q.run_checks(df, Q.silver_checks(df, "id", ["id", "s"], ["x", "s"])).collect()}
    assert out == {"row_count": False}
    assert Q.quality_score(Q.run_checks(df, Q.silver_checks(df, "id", ["s"]))).first().score_pct == 0.0
    assert Q.run_checks(df, [Q.unique(df, "id")]).first().passed
    nothing = Q.unreadable_result(spark, {"product_id": "p"}).first()
    assert nothing.severity == "critical" and nothing.score_pct == 0.0


def test_score_levels(spark):
    def score(*passed):
        frame = spark.createDataFrame([(p, s) for p, s in passed], "passed boolean, severity string")
        r = Q.quality_score(frame).first()
        return r.score_pct, r.status, r.severity
    assert score((True, "critical")) == (100.0, "ok", "ok")
    assert score((True, "critical"), (False, "warning")) == (50.0, "warning", "warning")
    assert score((False, "critical"), (True, "critical"), (True, "critical")) == (66.7, "failed", "warning")
    empty = Q.quality_score(spark.createDataFrame([], "passed boolean, severity string")).first()
    assert empty.score_pct == 100.0 and empty.status == "ok"
    health = Q.quality_score(spark.createDataFrame([(True, "critical"), (False, "critical"), (True, "critical")], "passed boolean, severity string"), critical_below=Q.CRITICAL_BELOW["health"]).first()
    assert health.severity == "critical"


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def ts(d, h=0):
    return datetime(2024, 1, d, h)


def test_freshness_and_contracts(spark):
    products = spark.createDataFrame([("a", 24), ("b", 24), ("c", 24), ("d", None)], "product_id string, freshness_hours int")
    commits = spark.createDataFrame([("a", ts(31, 12)), ("a", ts(1)), ("b", ts(30)), ("z", ts(31))], "product_id string, committed_at timestamp")
    out = U.freshness(products, commits, now())
    assert rows(out, "product_id", "hours_since_update", "compliant") == [("a", 12.0, True), ("b", 48.0, False), ("c", None, False)]
    status = spark.createDataFrame([(False, True, 1.0, 10), (True, None, 1.0, 10), (True, False, 99.0, 10), (True, True, 8.0, 10), (True, True, 8.1, 10)],
                                   "has_contract boolean, compliant boolean, hours_since_update double, freshness_hours int")
    assert [r.contract_status for r in U.contract_status(status).collect()] == ["none", "none", "breach", "ok", "warning"]


def test_compliance_and_mttr(spark):
    checks = spark.createDataFrame([("a", ts(31), True), ("a", ts(30), False), ("a", ts(29), None), ("a", ts(1), True), ("b", ts(1), True)],
                                   "product_id string, checked_at timestamp, compliant boolean")
    assert rows(U.compliance_window(checks, now())) == [("a", 33.3)]
    inc = spark.createDataFrame([("a", "resolved", ts(1), ts(1, 5)), ("a", "resolved", ts(2), ts(1)), ("a", "open", ts(1), None), ("a", "resolved", ts(1), None), ("b", "resolved", ts(3), ts(1))],
                                "product_id string, status string, created_at timestamp, resolved_at timestamp")
    assert rows(U.mean_hours_to_resolve(inc, ["product_id"])) == [("a", 5.0)]
    assert rows(U.list_incidents(inc, "a", "open"), "status") == [("open",)]


def test_trending_and_publications(spark):
    log = spark.createDataFrame([("up", ts(30)), ("up", ts(31)), ("up", ts(20)), ("new", ts(31)), ("down", ts(20)), ("down", ts(21)), ("down", ts(31)), ("__platform__", ts(31)), ("flat", ts(19)), ("flat", ts(28))],
                                "product_id string, ts timestamp")
    assert [tuple(r) for r in U.trending(log, now()).collect()] == [("new", 1, 0, 100.0), ("up", 2, 1, 100.0)]
    versions = spark.createDataFrame([("p", ts(1)), ("p", ts(25)), ("q", ts(28))], "product_id string, registered_at timestamp")
    assert [(r.product_id, r.event) for r in U.recent_publications(versions, now()).collect()] == [("q", "new"), ("p", "version_bump")]


def test_questions_views_users(spark):
    fb = spark.createDataFrame([(ts(31), " why ", "thumbs_up"), (ts(31), "why", "thumbs_up"), (ts(31), "  ", "thumbs_up"), (ts(31), "no", "thumbs_down"), (ts(1), "old", "thumbs_up")],
                               "ts timestamp, question string, rating string")
    assert rows(U.popular_questions(fb, now())) == [("why", 2)]
    log = spark.createDataFrame([
        ("a", "view", "u", ts(31)), ("a", "view", "u", ts(1)), ("b", "view", "u", ts(30)), ("c", "view", "u", ts(2)), ("__platform__", "agent_ask", "u", ts(31)),
        ("__platform__", "view", "u", ts(31)), ("a", "view", None, ts(31)), ("a", "publish", "w", ts(31)),
    ], "product_id string, action string, user_id string, ts timestamp")
    assert rows(U.usage_by_user(log, now())) == [("u", 2, 3, 1, 1, 2), ("w", 0, 0, 0, 0, 0)]
    assert rows(U.top_viewed(log, now())) == [("__platform__", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert U.active_users(log, ts_col(25), now()).first().n == 2
    assert rows(U.usage_window(log, ts_col(25), now())) == [("a", 3), ("b", 1)]


def ts_col(d):
    return F.lit(f"2024-01-{d} 00:00:00").cast("timestamp")


def test_health_timeline_and_snapshot(spark):
    sla = spark.createDataFrame([("a", ts(1), True), ("a", ts(2), False), ("b", ts(1), True), ("c", ts(1), None)], "product_id string, checked_at timestamp, compliant boolean")
    quality = spark.createDataFrame([("a", ts(1), 40.0), ("b", ts(1), 10.0), ("b", ts(2), 90.0)], "product_id string, validated_at timestamp, score_pct double")
    assert tuple(U.platform_health(sla, quality).first()) == (50.0, 65.0, 2, 2, 2)
    assert rows(U.incident_rows(sla, quality), "product_id", "type") == [("a", "quality"), ("a", "sla_breach")]
    runs = spark.createDataFrame([(ts(31), "success"), (ts(31), "failed"), (ts(30), "unheard"), (ts(29), "queued")], "ts timestamp, state string")
    line = U.daily_worst_state(runs, F.lit("2024-01-31").cast("date"), days=4)
    assert [r.state for r in line.orderBy("date").collect()] == ["none", "queued", "none", "failed"]
    snap = U.metrics_snapshot({"health": U.platform_health(sla, quality), "incidents": U.incident_rows(sla, quality)}, now())
    assert rows(snap.groupBy("section").count()) == [("health", 1), ("incidents", 2)]


def test_incident_transitions(spark):
    inc = spark.createDataFrame([("1", "open", "x", ts(1), None), ("2", "resolved", "x", ts(1), ts(2)), ("3", "open", "x", ts(1), None)],
                                "id string, status string, updated_by string, updated_at timestamp, resolved_at timestamp")
    changes = spark.createDataFrame([("1", "resolved", "y"), ("2", "acknowledged", "y"), ("3", "nonsense", "y"), ("9", "open", "y")], "id string, status string, updated_by string")
    out = U.change_incident_status(inc, changes, now())
    assert rows(out, "id", "status", "updated_by", "resolved_at") == [("1", "resolved", "y", datetime(2024, 2, 1)), ("2", "acknowledged", "y", ts(2)), ("3", "open", "x", None)]


def test_anomalies(spark, small_runs):
    df = spark.createDataFrame([("p", i, 10.0 + i % 2) for i in range(40)] + [("p", 40, 99.0)], "product_id string, i int, v double")
    out = U.anomalies(df, ["product_id"], ["i"], "v")
    assert rows(out.filter("is_anomaly"), "i") == [(40,)] and out.count() == 41


def test_publications_are_whole_or_refused(spark, tmp_path):
    from terrasse.plans import products
    from terrasse.sources import snapshots

    path, registry = str(tmp_path / "t"), str(tmp_path / "registry")
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0)], "id bigint, name string, v double")
    manifest = {**GOOD, "source_path": path, "format": "parquet", "version": "1.0.0", "schema": [{"name": "name", "type": "?", "pii": True, "sensitivity": "high"}],
                "contract": {"schema_compatibility": "FULL", "guaranteed_columns": ["id"]}, "quality_sla": {"max_null_rate": 0.0}}

    def refused(rows_, changed):
        before = spark.read.parquet(registry).count() if path_is_there() else 0
        with pytest.raises(products.PublicationRefused) as e:
            products.publish_checked(rows_, registry, {**manifest, **changed})
        assert (spark.read.parquet(registry).count() if path_is_there() else 0) == before
        return e.value.problems

    def path_is_there():
        return (tmp_path / "registry").exists()

    assert refused(df, {"owner": None}) == [("manifest", "owner", "type")] and not (tmp_path / "t").exists()
    assert refused(df, {"contract": {"guaranteed_columns": ["id", "name", "gone"]}}) == [("contract", "column_exists[gone]", "critical"), ("contract", "null_rate[name]", "warning")]
    assert not snapshots.exists(spark, path)  # staged only
    made = products.publish_checked(df, registry, manifest)
    assert [(c["name"], c["type"], c["nullable"], c.get("pii")) for c in made["schema"]] == [("id", "long", False, None), ("name", "string", True, True), ("v", "double", False, None)]
    assert refused(df.withColumn("more", F.lit(1)), {}) == [("schema", "more", "added")]
    assert refused(df.drop("v").withColumn("id", F.col("id").cast("int")), {}) == [("schema", "id", "type_changed"), ("schema", "v", "removed")]
    again = products.publish_checked(df.filter("id = 1"), registry, manifest)
    assert again["version"] == "1.0.1" and snapshots.read_version(spark, path).count() == 1 and snapshots.read_version(spark, path, 0).count() == 2
    assert rows(G.latest_products(spark.read.parquet(registry)), "version") == [("1.0.1",)]
    forward = {"contract": {"schema_compatibility": "FORWARD"}}
    assert refused(df.withColumn("more", F.lit(1)), forward) == [("schema", "more", "added")]
    products.publish_checked(df.drop("v"), registry, {**manifest, **forward, "version": "2.0.0"})
    products.publish_checked(df.withColumn("w", F.lit(1)).limit(0), registry, {**manifest, "contract": {}, "version": "3.0.0"})  # no rule, no promise, no rows
    assert snapshots.read_version(spark, path).columns == ["id", "name", "v", "w"]
