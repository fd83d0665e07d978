"""Table writes, gold and health plans and streams, run to the end and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from terrasse.catalogue.base import AS_OF_SQL, as_of, query, table
from terrasse.operators import keys, lookup, measures, rules
from terrasse.plans import curate, health
from terrasse.settings import fresh_path
from terrasse.sinks import merge, writers
from terrasse.sources import readers, snapshots
from terrasse.streaming import events as streaming

ACCOUNTS = ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def _accounts(spark, sf):
    return table(spark, sf, "customer").select(*ACCOUNTS)


@query("""SELECT c_custkey, c_name, round(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END, 2) AS c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT -c_custkey - 1, c_name, round(c_acctbal, 2), c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def upsert_table(spark, sf):
    path, rows = fresh_path(spark, "upserted"), _accounts(spark, sf)
    changed = rows.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    added = rows.filter("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", -F.col("c_custkey") - 1)
    for batch in (rows, changed.unionByName(added), changed.unionByName(added)):  # the second run of a batch changes nothing
        merge.upsert_table(batch, path, ["c_custkey"], buckets=8)
    return snapshots.read_version(spark, path).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT c_custkey, c_acctbal, c_mktsegment AS note FROM customer WHERE c_acctbal >= 0")
def sync_table(spark, sf):
    path, rows = fresh_path(spark, "synced"), _accounts(spark, sf)
    merge.sync_table(rows.select("c_custkey", F.lit(0.0).alias("c_acctbal"), F.col("c_mktsegment").alias("note")), path, ["c_custkey"], buckets=8)
    for _ in range(2):
        merge.sync_table(rows.filter("c_acctbal >= 0").select("c_custkey", "c_acctbal"), path, ["c_custkey"])
    return snapshots.read_version(spark, path)


@query("SELECT c_custkey, round(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal * 1.1 ELSE c_acctbal END, 4) AS c_acctbal FROM customer")
def update_table(spark, sf):
    path = fresh_path(spark, "updated")
    snapshots.commit(_accounts(spark, sf), path, "create")
    merge.update_table(spark, path, F.col("c_mktsegment") == "MACHINERY", {"c_acctbal": F.col("c_acctbal") * 1.10})
    return snapshots.read_version(spark, path).select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


@query(f"""SELECT event_id, event_type FROM events WHERE event_type <> 'error' AND ts >= {AS_OF_SQL} - INTERVAL 14 DAY""")
def retention_table(spark, sf):
    path = fresh_path(spark, "retained")
    text = F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    snapshots.commit(table(spark, sf, "events").select("event_id", "event_type", text.alias("at")), path, "create", layout=snapshots.Layout(("at",)))
    for _ in range(2):
        merge.apply_retention(spark, path, "at", 14, as_of())
    return snapshots.read_version(spark, path).drop("at")


@query("""WITH n AS (
      SELECT count(*) AS all_rows, count(*) FILTER (c_mktsegment = 'BUILDING') AS changed, count(*) FILTER (c_mktsegment = 'MACHINERY') AS added,
             count(*) FILTER (c_acctbal >= 0) AS kept, count(*) FILTER (c_acctbal >= 0 AND c_mktsegment = 'BUILDING') AS restored,
             count(*) FILTER (c_acctbal >= 0 AND c_mktsegment = 'MACHINERY') AS raised FROM customer)
    SELECT 'create' AS operation, CAST(0 AS BIGINT) AS version, all_rows AS rows, all_rows AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted FROM n
    UNION ALL SELECT 'upsert', 1, all_rows + added, added, changed, 0 FROM n
    UNION ALL SELECT 'upsert', 2, all_rows + added, 0, 0, 0 FROM n
    UNION ALL SELECT 'sync', 3, kept, 0, restored, all_rows + added - kept FROM n
    UNION ALL SELECT 'update', 4, kept, 0, raised, 0 FROM n""")
def table_history(spark, sf):
    """Every write with its changed rows; the second run of the upsert finds nothing to change."""
    path, rows = fresh_path(spark, "history"), _accounts(spark, sf)
    changed = rows.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    added = rows.filter("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", -F.col("c_custkey") - 1)
    for batch in (rows, changed.unionByName(added), changed.unionByName(added)):
        merge.upsert_table(batch, path, ["c_custkey"], buckets=8)
    merge.sync_table(rows.filter("c_acctbal >= 0"), path, ["c_custkey"])
    merge.update_table(spark, path, F.col("c_mktsegment") == "MACHINERY", {"c_acctbal": F.col("c_acctbal") * 1.10})
    return snapshots.history(spark, path).select("operation", "version", "rows", *snapshots.COUNTS)


@query("""WITH e AS (SELECT json_extract_string(props, '$.k') AS k, event_type, ts, CASE WHEN event_type <> 'error' THEN CAST(event_id AS INTEGER) ELSE 0 END AS seq, event_type = 'purchase' AS late FROM events),
    one AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY k, late ORDER BY ts DESC, event_type DESC, seq DESC) = 1)
    SELECT k, event_type, seq FROM one QUALIFY row_number() OVER (PARTITION BY k ORDER BY late DESC) = 1""")
def bronze_to_silver(spark, sf):
    """The whole job, run for two bronze deliveries and again for the second: read, extract, cast, fill, latest per key, upsert."""
    silver = fresh_path(spark, "silver")
    seq = F.when(F.col("event_type") == "error", "bad").otherwise(F.col("event_id").cast("string"))
    events = table(spark, sf, "events").select(
        F.to_json(F.struct(F.get_json_object("props", "$.k").alias("k"), seq.alias("seq"))).alias("payload_json"), "event_type", F.col("ts").alias("_ingested_at"))
    for late in (False, True, True):
        bronze = fresh_path(spark, "bronze")
        events.filter((F.col("event_type") == "purchase") == late).write.parquet(bronze)
        curate.bronze_to_silver(spark, {
            "source": bronze, "target": silver, "primary_key": "k", "cast": {"seq": "int"}, "null_handling": {"drop_if_null": ["k"], "fill": {"seq": 0}},
            "payload_extract": {"from_column": "payload_json", "fields": {"k": "$.k", "seq": "$.seq"}}})
    return readers.read_table(spark, silver).select("k", "event_type", "seq")


@query("""SELECT c_mktsegment AS department, count(*) AS headcount, round(avg(c_acctbal), 2) AS avg_salary, min(c_acctbal) AS min_salary,
           max(c_acctbal) AS max_salary, round(sum(c_acctbal), 2) AS total_payroll FROM customer GROUP BY 1""")
def silver_to_gold(spark, sf):
    silver, gold = fresh_path(spark, "silver"), fresh_path(spark, "gold")
    staff = _accounts(spark, sf).select("c_custkey", F.col("c_mktsegment").alias("department"), F.col("c_acctbal").alias("salary"))
    merge.upsert_table(staff, silver, ["c_custkey"])
    for _ in range(2):
        curate.silver_to_gold(spark, silver, gold, {"headcount": "persons"})
    return snapshots.read_version(spark, gold).drop("_gold_updated_at").withColumn("total_payroll", F.round("total_payroll", 2))


@query("""SELECT c_custkey, c_name, day AS ingestion_date FROM customer, (SELECT unnest(['2024-01-01', '2024-01-02']) AS day)""")
def ingest_files(spark, sf):
    source, target = fresh_path(spark, "landed"), fresh_path(spark, "bronze")
    _accounts(spark, sf).select("c_custkey", "c_name").write.option("header", True).csv(source)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):  # a rerun replaces its day only
        curate.ingest_files(spark, source, "csv", target, day, "c_custkey bigint, c_name string", datetime(2024, 1, 3))
    return spark.read.parquet(target).select("c_custkey", "c_name", F.col("ingestion_date").cast("string").alias("ingestion_date"))


CODES_SQL = """codes AS (
    SELECT 'R' || r_regionkey AS code, CAST(NULL AS VARCHAR) AS parent_code, 'KAPITTEL' AS type, r_name AS name_no, 'R' || r_regionkey AS chapter_code, CAST(NULL AS VARCHAR) AS block_code FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'BLOKK', n_name, 'R' || n_regionkey, NULL FROM nation
    UNION ALL SELECT 'P' || p_partkey, 'N' || (p_partkey % 25), 'KODE', p_name, 'R' || n_regionkey, 'N' || n_nationkey FROM part JOIN nation ON n_nationkey = p_partkey % 25)"""


def _codes(spark, sf):
    def level(name, code, parent, kind, title):
        return table(spark, sf, name).select(
            code.alias("identifier"), parent.cast("string").alias("parent"), F.lit(kind).alias("type"), F.col(title).alias("tittel_no"), F.lit(None).cast("string").alias("tittel_en"),
            F.lit("TRUE").alias("gyldig_underliggende"), F.lit(None).cast("string").alias("gyldig_ekstern"))

    def mark(letter, column):
        return F.concat(F.lit(letter), column)

    source = level("region", mark("R", F.col("r_regionkey")), F.lit(None), "KAPITTEL", "r_name").unionByName(
        level("nation", mark("N", F.col("n_nationkey")), mark("R", F.col("n_regionkey")), "BLOKK", "n_name")).unionByName(
        level("part", mark("P", F.col("p_partkey")), mark("N", F.col("p_partkey") % 25), "KODE", "p_name"))
    return health.code_list(source, "2024", F.lit("2024-01-01").cast("timestamp"))


@query(f"WITH {CODES_SQL} SELECT *, CAST(NULL AS VARCHAR) AS name_en, true AS valid_as_underlying, false AS valid_as_external, '2024' AS icd10_version FROM codes")
def code_list(spark, sf):
    return _codes(spark, sf).drop("_ingested_at")


def _deaths(spark, sf):
    order, part = F.col("o_orderkey"), F.lit("P")
    cause = F.to_json(F.struct(F.concat(part, order % 300).alias("icd10Kode")))
    outer = F.to_json(F.struct(F.concat(part, order % 7).alias("skadeKode"), F.when(order % 2 == 0, F.concat(part, order % 11)).alias("skademekanismeKode")))
    more = F.to_json(F.transform(F.sequence(F.lit(1), (order % 3 + 1).cast("int")), lambda i: F.struct(i.alias("sekvens"), F.concat(part, order % 50 + i).alias("icd10Kode"))))
    return table(spark, sf, "orders").select(
        order.cast("string").alias("dodsfallId"), F.col("o_custkey").cast("string").alias("personSyntId"), (order % 100).cast("string").alias("alder"),
        F.col("o_orderstatus").alias("kjonn"), F.col("o_orderpriority").alias("kommune"), F.lit("f").alias("fylke"), F.lit("t").alias("tidspunkt"),
        F.lit("k").alias("klassifisertTidspunkt"), F.lit("2024").alias("icd10Versjon"), cause.alias("underliggendeArsak"), outer.alias("eksternArsak"), more.alias("medvirkendeArsaker"))


@query(f"""WITH {CODES_SQL}, d AS (SELECT *, 'P' || (o_orderkey % 300) AS a, 'P' || (o_orderkey % 7) AS b, CASE WHEN o_orderkey % 2 = 0 THEN 'P' || (o_orderkey % 11) END AS c FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS dodsfall_id, CAST(o_custkey AS VARCHAR) AS person_synt_id, CAST(o_orderkey % 100 AS INTEGER) AS alder, o_orderstatus AS kjonn,
           o_orderpriority AS kommune_kode, 'f' AS fylke, 't' AS tidspunkt, 'k' AS klassifisert_tidspunkt, '2024' AS icd10_versjon,
           a AS underliggende_arsak_kode, x.name_no AS underliggende_arsak_navn, x.chapter_code AS underliggende_arsak_kapittel,
           b AS ekstern_skade_kode, y.name_no AS ekstern_skade_navn, y.chapter_code AS ekstern_skade_kapittel,
           c AS ekstern_skademekanisme_kode, z.name_no AS ekstern_skademekanisme_navn, z.chapter_code AS ekstern_skademekanisme_kapittel
    FROM d LEFT JOIN codes x ON a = x.code LEFT JOIN codes y ON b = y.code LEFT JOIN codes z ON c = z.code""")
def death_facts(spark, sf):
    return health.death_facts(_deaths(spark, sf), _codes(spark, sf))


@query(f"""WITH {CODES_SQL}, m AS (SELECT o_orderkey, unnest(generate_series(1, o_orderkey % 3 + 1)) AS i FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS dodsfall_id, CAST(i AS INTEGER) AS sekvens, 'P' || (o_orderkey % 50 + i) AS icd10_kode, name_no AS icd10_navn, chapter_code AS icd10_kapittel
    FROM m LEFT JOIN codes ON code = 'P' || (o_orderkey % 50 + i)""")
def contributing_causes(spark, sf):
    return health.contributing_causes(_deaths(spark, sf), _codes(spark, sf))


def _messages(spark, sf):
    envelope = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("occurredAt"),
        F.lit("shop").alias("source"), F.lit("1").alias("version"), F.from_json("props", "k int").alias("payload")))
    return table(spark, sf, "events").select(
        F.lit("shop.events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), as_of().cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "error", "not json").otherwise(envelope).alias("value"))


@query(f"""SELECT event_id AS kafka_offset, CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
           CAST(CASE WHEN event_type <> 'error' THEN ts ELSE {AS_OF_SQL} END AS DATE) AS event_date FROM events""")
def stream_broker_unpack(spark, sf):
    """Rows as a broker sends them, from files, through unpacking and the partitioned append; the restart finds nothing new."""
    source, target = fresh_path(spark, "messages"), fresh_path(spark, "unpacked")
    _messages(spark, sf).write.parquet(source)
    for _ in range(2):
        messages = spark.readStream.schema("topic string, partition int, offset bigint, timestamp timestamp, value string").parquet(source)
        rows = streaming.add_broker_metadata(streaming.unpack_envelopes(messages), ["shop.events"], "g")
        streaming.append_stream(rows, target, f"{target}-checkpoint", ["event_date"]).awaitTermination()
    return spark.read.parquet(target).select("kafka_offset", "event_id", "event_type", F.to_date("event_date").alias("event_date"))


@query("SELECT CAST(event_id AS VARCHAR) AS event_id FROM events")
def stream_dedup(spark, sf):
    """Every event twice; the second is within the watermark and drops out."""
    source, target = fresh_path(spark, "repeated"), fresh_path(spark, "deduplicated")
    once = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"))
    once.unionByName(once).write.json(source)
    stream = streaming.drop_late_duplicates(spark.readStream.schema("event_id string, event_timestamp string").json(source), delay="100 days")
    streaming.append_stream(stream, target, f"{target}-checkpoint").awaitTermination()
    return spark.read.parquet(target).select("event_id")


@query("SELECT event_id, event_type, CAST(1 AS BIGINT) AS times FROM events")
def stream_failed_batch(spark, sf):
    """Three batches; the second breaks off after half its rows, the run ends, and a restart finishes it: every event is there once."""
    source, target = fresh_path(spark, "batches"), fresh_path(spark, "landed")
    events = table(spark, sf, "events").select("event_id", "event_type")
    events.repartitionByRange(3, "event_id").write.parquet(source)
    broken = []

    def flaky(rows, folder):
        if folder.endswith("batch=1") and not broken:
            broken.append(folder)
            rows.filter("event_id % 2 = 0").write.parquet(f"{folder}/event_type=lost")
            raise OSError("the executor's disk is gone")
        rows.write.mode("overwrite").partitionBy("event_type").parquet(folder)

    for _ in range(2):
        stream = streaming.file_stream(spark, source, "event_id bigint, event_type string", "parquet", files_per_batch=1)
        try:
            streaming.append_batches(stream, target, f"{target}-checkpoint", sink=flaky).awaitTermination()
        except StreamingQueryException:
            if not broken:
                raise
    return streaming.read_batches(spark, target).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("times"))


@query("SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value END AS value FROM events")
def stream_schema_evolution(spark, sf):
    """A stream that is started again with one more column: rows of the first run have none."""
    source, target = fresh_path(spark, "growing"), fresh_path(spark, "evolved")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    clicks, schema = F.col("event_type") == "click", "event_id bigint, event_type string"
    for rows, wide in ((events.filter(~clicks).drop("value"), schema), (events.filter(clicks), schema + ", value double")):
        rows.write.mode("append").json(source)
        streaming.append_stream(streaming.file_stream(spark, source, wide), target, f"{target}-checkpoint").awaitTermination()
    return writers.read_evolved(spark, target)


@query("""SELECT c_custkey, o_orderkey IS NOT NULL AS there FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o_orderkey FROM orders) ON c_custkey = o_orderkey""")
def existence_flag(spark, sf):
    members = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return keys.with_existence_flag(table(spark, sf, "customer").select("c_custkey"), members, ["c_custkey"], "there")


@query("SELECT event_type, event_id, value FROM events WHERE event_type IN ('click', 'purchase') AND value IS NOT NULL")
def kept_events(spark, sf):
    return rules.keep_events(table(spark, sf, "events"), "event_type", ["click", "purchase"], ["value"]).select("event_type", "event_id", "value")


@query("SELECT o_orderkey AS id, o_custkey AS customer FROM orders")
def renamed_schema(spark, sf):
    return rules.fixed_schema(table(spark, sf, "orders"), {"id": "o_orderkey", "customer": "o_custkey"})


@query("SELECT event_id, CASE WHEN event_type = 'signup' THEN json_extract_string(props, '$.k') END AS k FROM events")
def payload_of_one_type(spark, sf):
    return table(spark, sf, "events").select("event_id", rules.path_for_type("props", "$.k", "event_type", "signup").alias("k"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def sql_on_frame(spark, sf):
    return readers.sql_on_frame(table(spark, sf, "part"), "SELECT p_brand, count(*) AS n FROM {df} GROUP BY p_brand")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def seen_before(spark, sf):
    return keys.seen_before(table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def distinct_users(spark, sf):
    return measures.distinct_count(table(spark, sf, "events"), ["event_type"], "user_id", "users")


@query("""SELECT count(*) AS rows, count(l_orderkey) AS n_l_orderkey, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey,
    count(l_quantity) AS n_l_quantity, min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem""")
def footer_values(spark, sf):
    return readers.footer_values(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query("SELECT c_mktsegment AS segment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def overwritten_table(spark, sf):
    """A table whose rows and columns are replaced: nothing of the first write stays."""
    path, rows = fresh_path(spark, "overwritten"), _accounts(spark, sf)
    writers.overwrite_table(rows, path, ["c_mktsegment"])
    segments = measures.counts_by(rows.filter("c_acctbal > 0"), ["c_mktsegment"]).withColumnRenamed("c_mktsegment", "segment")
    return writers.write_then_read(segments, path)


@query("""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS n, row_number() OVER (ORDER BY date_trunc('month', o_orderdate) DESC) = 1 AS latest FROM orders GROUP BY date_trunc('month', o_orderdate)""")
def result_history(spark, sf):
    """Monthly results appended year by year, latest found by time."""
    path = fresh_path(spark, "results")
    orders = table(spark, sf, "orders")
    for early in (True, False):
        part = orders.filter((F.year("o_orderdate") < 1998) == early)
        months = measures.monthly_counts(part, "o_orderdate")
        writers.append_result(months.withColumn("period", F.to_date("period")), path, F.col("period").cast("timestamp"))
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("recorded_at")).scalar()
    return stored.select("period", "n", (F.col("recorded_at") == newest).alias("latest"))


@query("SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1")
def checked_write(spark, sf):
    """All orders written in four files by status and read back; the counts must agree."""
    path = fresh_path(spark, "checked")
    written = writers.write_checked(writers.sized(table(spark, sf, "orders"), 4, ["o_orderstatus"]), path)
    return measures.counts_by(spark.read.parquet(path), ["o_orderstatus"]).withColumn("written", F.lit(written).cast("bigint"))


@query("""SELECT n_name AS nation, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def json_records(spark, sf):
    """Documents that are arrays of records, one file per nation and block of customers, read as one table."""
    path = fresh_path(spark, "json-records")
    customers = lookup.join_dimension(table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    block = F.floor(F.col("c_custkey") / 1000)
    arrays = customers.groupBy("n_nationkey", block.alias("block")).agg(F.to_json(F.collect_list(F.struct(F.col("n_name").alias("nation"), "c_custkey"))).alias("value"))
    arrays.write.partitionBy("n_nationkey", "block").text(path)  # a folder, and so a file, for each document
    return readers.read_json_records(spark, path, "nation string, c_custkey bigint").select("nation", "c_custkey")
