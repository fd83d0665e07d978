"""Sources, sinks, row rules and key choice."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from terrasse.catalogue.base import AS_OF_SQL, as_of, query, table
from terrasse.operators import history, keys, profile, rules
from terrasse.plans import curate
from terrasse.settings import fresh_path
from terrasse.sinks import merge, writers
from terrasse.sources import readers, snapshots
from terrasse.streaming import events as streaming

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query(CUSTOMER)
def src_csv_roundtrip(spark, sf):
    path = fresh_path(spark, "csv")
    writers.export_csv(table(spark, sf, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return readers.read_files(spark, path, "csv", schema)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_json_roundtrip(spark, sf):
    path = fresh_path(spark, "json")
    table(spark, sf, "supplier").write.json(path)
    return readers.read_files(spark, path, "json").select(
        "s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"), "s_acctbal"
    )


@query("""SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS avg_price, min(p_size) AS min_size
          FROM part GROUP BY p_brand""")
def sql_on_files(spark, sf):
    return readers.sql_on_file(
        spark, f"{sf}/part.parquet",
        "SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS avg_price, min(p_size) AS min_size "
        "FROM {table} GROUP BY p_brand",
    )


@query("SELECT p_partkey, p_name FROM part")
def product_read_pruned(spark, sf):
    manifest = json.dumps({"id": "shop.part", "source_path": f"{sf}/part.parquet", "format": "parquet"})
    registry = spark.range(1).select(
        F.lit("shop.part").alias("product_id"), F.lit("1.0.0").alias("version"),
        F.lit(manifest).alias("manifest_json"), F.lit("2024-01-01").alias("registered_at"),
    )
    return readers.read_product(registry, "shop.part", ["p_partkey", "p_name"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def preview_ordered(spark, sf):
    return profile.preview(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderkey"])


@query(f"""SELECT event_id, event_type, '2024-01-31' AS ingestion_date, 'landing/events' AS _source_path,
                  {AS_OF_SQL} AS _ingested_at FROM events""")
def bronze_metadata(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type")
    return rules.add_bronze_metadata(rows, "2024-01-31", "landing/events", as_of())


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('signup', 'purchase') AND value IS NOT NULL")
def filter_isin(spark, sf):
    return rules.keep_events(table(spark, sf, "events"), "event_type", ["signup", "purchase"], ["value"]).select(
        "event_id", "user_id", "event_type", "value"
    )


CASTS = {"prio": "int", "status": "int", "day": "date", "price": "double", "gone": "int"}
CAST_INPUT_SQL = """SELECT o_orderkey, substring(o_orderpriority, 1, 1) AS prio, o_orderstatus AS status,
    CASE WHEN o_orderstatus = 'P' THEN 'not_a_date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE '12.50' END AS price FROM orders"""


def _cast_input(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("prio"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "P", "not_a_date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise("12.50").alias("price"),
    )


@query(f"""SELECT o_orderkey, TRY_CAST(prio AS INTEGER) AS prio, TRY_CAST(status AS INTEGER) AS status,
                  TRY_CAST(day AS DATE) AS day, TRY_CAST(price AS DOUBLE) AS price FROM ({CAST_INPUT_SQL})""")
def cast_rules(spark, sf):
    return rules.apply_casts(_cast_input(spark, sf), CASTS)


@query(f"""WITH t AS ({CAST_INPUT_SQL})
    SELECT 'prio' AS "column", 'int' AS target, count(*) FILTER (WHERE TRY_CAST(prio AS INTEGER) IS NULL) AS introduced FROM t
    UNION ALL SELECT 'status', 'int', count(*) FILTER (WHERE TRY_CAST(status AS INTEGER) IS NULL) FROM t
    UNION ALL SELECT 'day', 'date', count(*) FILTER (WHERE TRY_CAST(day AS DATE) IS NULL) FROM t
    UNION ALL SELECT 'price', 'double', count(*) FILTER (WHERE TRY_CAST(price AS DOUBLE) IS NULL) FROM t""")
def cast_null_report(spark, sf):
    return rules.cast_report(_cast_input(spark, sf), CASTS)


@query("""SELECT event_id, event_type AS kind, CASE WHEN value >= 10 THEN value ELSE -1 END AS amount
          FROM events WHERE event_type <> 'error'""")
def null_rules(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        F.when(F.col("value") >= 10, F.col("value")).alias("amount"),
    )
    return rules.apply_null_rules(rows, ["kind"], {"amount": -1.0})


@query("""SELECT json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing,
                 json_extract_string(props, '$.k') AS k_alt, event_type FROM events""")
def payload_extract(spark, sf):
    rows = table(spark, sf, "events").select(F.col("props").alias("payload_json"), "event_type")
    return rules.extract_payload(rows, {"k": "$.k", "missing": "$.none", "k_alt": ["$.none", "$.k"]})


@query("""SELECT event_id AS kafka_offset,
       CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k,
       CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) ELSE DATE '2024-01-31' END AS event_date
  FROM events""")
def cloudevent_unpack(spark, sf):
    envelope = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("occurredAt"), F.lit("shop").alias("source"),
        F.lit("1").alias("version"), F.from_json("props", "k int").alias("payload"),
    ))
    messages = table(spark, sf, "events").select(
        F.lit("shop.events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        as_of().cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "error", "not json").otherwise(envelope).alias("value"),
    )
    rows = streaming.add_broker_metadata(streaming.unpack_envelopes(messages), ["shop.events"], "g")
    return rows.select("kafka_offset", "event_id", "event_type", rules.path("payload_json", "$.k").alias("k"), "event_date")


@query("""SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN sha256(c_name) END AS c_hash FROM customer""")
def pseudonymise(spark, sf):
    # an empty identifier has no pseudonym
    name = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "").otherwise(F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", rules.pseudonym(name).alias("c_hash"))


@query("""SELECT c_custkey, '***' AS c_name, c_nationkey, '***' AS c_acctbal, c_mktsegment FROM customer""")
def mask_flagged(spark, sf):
    return rules.mask_columns(table(spark, sf, "customer"), ["c_name", "c_acctbal", "not_there"])


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return keys.latest_per_key(rows, ["user_id"], ["ts"], ["event_id"])


@query("""WITH twice AS (SELECT event_id, ts, user_id FROM events
                         UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, user_id FROM events)
          SELECT event_id, ts, user_id FROM twice QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1""")
def dedup_event_id(spark, sf):
    once = table(spark, sf, "events").select("event_id", "ts", "user_id")
    again = once.withColumn("ts", F.col("ts") + F.make_dt_interval(hours=F.lit(1)))
    return keys.drop_duplicate_events(once.unionByName(again), "event_id", ["ts"])


@query("""WITH known AS (SELECT DISTINCT user_id, props FROM events WHERE event_type = 'error')
          SELECT DISTINCT user_id, props FROM events WHERE event_type = 'purchase'
          AND (user_id, props) NOT IN (SELECT (user_id, props) FROM known)""")
def insert_if_absent(spark, sf):
    events = table(spark, sf, "events")
    fresh = events.filter(F.col("event_type") == "purchase").select("user_id", "props").distinct()
    return keys.insert_if_absent(fresh, events.filter(F.col("event_type") == "error"), ["user_id", "props"])


@query("""WITH incoming AS (
            SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
            UNION ALL SELECT -c_custkey - 1, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY')
          SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM (
            SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM incoming)
            UNION ALL SELECT * FROM incoming)""")
def upsert_by_key(spark, sf):
    target = table(spark, sf, "customer")
    changed = target.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    added = target.filter(F.col("c_mktsegment") == "MACHINERY").withColumn("c_custkey", -F.col("c_custkey") - 1)
    picked = ["c_custkey", "c_name", "c_acctbal"]
    out = merge.upsert(target.select(picked), changed.unionByName(added).select(picked), ["c_custkey"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("""SELECT c_custkey, c_acctbal, c_mktsegment AS c_note FROM customer WHERE c_acctbal >= 0""")
def full_sync(spark, sf):
    customer = table(spark, sf, "customer")
    target = customer.select("c_custkey", F.lit(0.0).alias("c_acctbal"), F.col("c_mktsegment").alias("c_note"))
    source = customer.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_acctbal")
    return merge.full_sync(target, source, ["c_custkey"])


@query("""SELECT c_custkey, round(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal * 1.10 ELSE c_acctbal END, 4) AS c_acctbal
          FROM customer""")
def conditional_update(spark, sf):
    out = rules.update_where(
        table(spark, sf, "customer"), F.col("c_mktsegment") == "MACHINERY", {"c_acctbal": F.col("c_acctbal") * 1.10}
    )
    return out.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def partition_overwrite_idempotent(spark, sf):
    path = fresh_path(spark, "partitions")
    events = table(spark, sf, "events")
    writers.overwrite_partitions(events, path, ["event_type"])
    # the second write of one partition must change nothing
    writers.overwrite_partitions(events.filter(F.col("event_type") == "click"), path, ["event_type"])
    stored = spark.read.parquet(path)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal FROM customer""")
def schema_evolution_union(spark, sf):
    path = fresh_path(spark, "evolving")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    newer = F.col("c_mktsegment") == "BUILDING"
    writers.append_table(customer.filter(~newer).drop("c_acctbal", "c_mktsegment"), path)
    writers.append_table(customer.filter(newer).drop("c_mktsegment"), path)
    return writers.read_evolved(spark, path).select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT c_mktsegment, round(sum(c_acctbal), 2) AS before, round(sum(c_acctbal + 1), 2) AS after FROM customer GROUP BY 1""")
def snapshot_as_of(spark, sf):
    path, start = fresh_path(spark, "snapshots"), datetime(2024, 1, 1)
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    snapshots.commit(customer, path, "create", ts=start)
    snapshots.commit(customer.withColumn("c_acctbal", F.col("c_acctbal") + 1), path, "update", ts=start + timedelta(days=1))
    old = snapshots.read_version(spark, path, as_of=start + timedelta(hours=1))
    new = snapshots.read_version(spark, path)
    total = lambda df, name: df.groupBy("c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias(name))
    return total(old, "before").join(total(new, "after"), "c_mktsegment")


@query(f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events
           WHERE event_type <> 'error' AND strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') >= {AS_OF_SQL} - INTERVAL 14 DAY""")
def retention_keep(spark, sf):
    # unreadable dates are removed too
    text = F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = table(spark, sf, "events").select("event_id", text.alias("ts_text"))
    return rules.retain_recent(rows, "ts_text", 14, as_of())


@query("""SELECT event_type, event_id, ts FROM events
          QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 168""")
def history_keep_last_n(spark, sf):
    return keys.keep_last_n(table(spark, sf, "events").select("event_type", "event_id", "ts"), ["event_type"], ["ts", "event_id"])


@query("""SELECT o_orderkey, o_orderdate AS ts, 'opened' AS kind, CAST(NULL AS VARCHAR) AS status FROM orders
          UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY, 'closed', o_orderstatus FROM orders""")
def event_timeline_union(spark, sf):
    key = {"o_orderkey": F.col("o_orderkey")}
    return history.fan_out(table(spark, sf, "orders"), [
        {**key, "ts": F.col("o_orderdate"), "kind": F.lit("opened"), "status": F.lit(None).cast("string")},
        {**key, "ts": F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30)), "kind": F.lit("closed"), "status": F.col("o_orderstatus")},
    ])


@query("""SELECT event_id, event_type, user_id, value FROM events""")
def stream_file_events(spark, sf):
    source, target = fresh_path(spark, "landing"), fresh_path(spark, "stream")
    schema = "event_id bigint, event_type string, user_id bigint, value double"
    table(spark, sf, "events").select("event_id", "event_type", "user_id", "value").write.json(source)
    for _ in range(2):  # the restart finds nothing new
        streaming.files_to_bronze(spark, source, target, f"{target}-checkpoint", schema, None).awaitTermination()
    return spark.read.schema(schema).parquet(target)


@query("""SELECT k, event_type, CASE WHEN seq IS NULL THEN 0 ELSE seq END AS seq FROM (
            SELECT json_extract_string(props, '$.k') AS k, event_type, ts, event_id,
                   CASE WHEN event_type <> 'error' THEN CAST(event_id AS INTEGER) END AS seq FROM events)
          WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_type DESC, seq DESC) = 1""")
def silver_curate(spark, sf):
    seq = F.when(F.col("event_type") == "error", "bad").otherwise(F.col("event_id").cast("string"))
    bronze = table(spark, sf, "events").select(
        F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), seq.alias("seq"))).alias("payload_json"),
        "event_type", F.col("ts").alias("_ingested_at"),
    )
    spec = curate.CurationRules.from_config({
        "primary_key": "k", "cast": {"seq": "int"}, "null_handling": {"drop_if_null": ["k"], "fill": {"seq": 0}},
        "payload_extract": {"from_column": "payload_json", "fields": {"k": "$.k", "seq": "$.seq"}},
    })
    return curate.curate(bronze, spec)
