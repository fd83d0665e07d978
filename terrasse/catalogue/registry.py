"""The person plans as a whole, over event tables built from all customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasse.catalogue.base import query, table
from terrasse.plans import persons

# A customer is created on a day given by its nation, moves with every order, and dies if in debt.
# Every urgent order is a marriage with the next customer, every low one a divorce told the other way round.
# The order key gives the second of the day, so no two events of a person have one time.
EVENTS_SQL = """moved AS (
  SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS ts FROM orders),
person AS (
  SELECT CAST(c_custkey AS VARCHAR) AS person_id, TIMESTAMP '1980-01-01' + to_days(c_nationkey) AS ts, 'citizen.created' AS event_type,
         sha256(c_name) AS fnr, c_mktsegment AS first_name, c_name AS last_name,
         CAST(1920 + c_custkey % 90 AS VARCHAR) || '-06-15' AS birth_date,
         CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender, 'k' || c_nationkey AS code, 'n' || c_nationkey AS place,
         'f' || (c_nationkey % 5) AS county, CAST(NULL AS VARCHAR) AS death, CAST(NULL AS VARCHAR) AS status,
         CAST(c_custkey // 2 AS VARCHAR) AS mother, CAST(c_custkey // 3 AS VARCHAR) AS father, 'street ' || c_nationkey AS street FROM customer
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), ts, 'event.relocation', NULL, NULL, NULL, NULL, NULL, 'k' || (o_orderkey % 25), 'n' || (o_orderkey % 25),
         'f' || (o_orderkey % 5), NULL, NULL, NULL, NULL, CASE WHEN o_orderkey % 3 > 0 THEN 'road ' || (o_orderkey % 7) END FROM moved
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), TIMESTAMP '2002-01-02 12:00:00', 'citizen.died', NULL, NULL, NULL, '2002-01-01', NULL, NULL, NULL, NULL, '2002-01-01', NULL, NULL, NULL, NULL
  FROM customer WHERE c_acctbal < 0),
couple AS (
  SELECT CAST(o_custkey AS VARCHAR) AS a, CAST(o_custkey + 1 AS VARCHAR) AS b, ts, CASE o_orderpriority WHEN '1-URGENT' THEN 'GIFT' ELSE 'SKILT' END AS status
  FROM moved WHERE o_orderpriority IN ('1-URGENT', '5-LOW')),
ev AS (
  SELECT * FROM person
  UNION ALL SELECT unnest([a, b]), ts, 'SivilstatusEndret', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, status, NULL, NULL, NULL FROM couple)"""

REGISTRY_SQL = f"""{EVENTS_SQL},
state AS (
  SELECT person_id, last_value(fnr IGNORE NULLS) OVER r AS fnr_masked, last_value(first_name IGNORE NULLS) OVER r AS first_name,
         last_value(last_name IGNORE NULLS) OVER r AS last_name, CAST(last_value(birth_date IGNORE NULLS) OVER r AS DATE) AS birth_date,
         last_value(gender IGNORE NULLS) OVER r AS gender, last_value(code IGNORE NULLS) OVER r AS municipality_code,
         last_value(place IGNORE NULLS) OVER r AS municipality_name, last_value(county IGNORE NULLS) OVER r AS county,
         coalesce(last_value(status IGNORE NULLS) OVER r, 'UGIFT') AS marital_status, CAST(last_value(death IGNORE NULLS) OVER r AS DATE) AS death_date,
         last_value(mother IGNORE NULLS) OVER r AS mother_id, last_value(father IGNORE NULLS) OVER r AS father_id, last_value(street IGNORE NULLS) OVER r AS street_address,
         event_type AS change_event_type, ts AS valid_from, lead(ts) OVER w AS valid_to
  FROM ev WINDOW w AS (PARTITION BY person_id ORDER BY ts, event_type),
    r AS (PARTITION BY person_id ORDER BY ts, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
registry AS (
  SELECT *, concat_ws(' ', first_name, last_name) AS full_name, death_date IS NULL AS is_alive, valid_to IS NULL AS is_current FROM state)"""

STAYS_SQL = f"""{EVENTS_SQL},
stays AS (
  SELECT person_id, code AS municipality_code, place AS municipality_name, county, event_type AS change_event_type, CAST(ts AS DATE) AS moved_in_date,
         coalesce(CAST(lead(ts) OVER (PARTITION BY person_id ORDER BY ts) AS DATE), d.died) AS moved_out_date, lead(ts) OVER (PARTITION BY person_id ORDER BY ts) AS nxt
  FROM person LEFT JOIN (SELECT person_id AS pid, CAST(death AS DATE) AS died FROM person WHERE death IS NOT NULL) d ON person_id = d.pid
  WHERE event_type <> 'citizen.died'),
residence AS (SELECT * EXCLUDE (nxt), nxt IS NULL AND moved_out_date IS NULL AS is_current, CAST(datediff('day', moved_in_date, moved_out_date) AS INTEGER) AS duration_days FROM stays)"""


def _payload(kind: str, ts, **fields):
    return F.lit(kind).alias("event_type"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"), F.to_json(F.struct(*[v.cast("string").alias(k) for k, v in fields.items()])).alias("payload_json")


def _moved(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("ts", F.timestamp_add("second", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate")))


def _events(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.withColumn("kafka_timestamp", F.lit(None).cast("timestamp"))


def _person_events(spark: SparkSession, sf: str) -> DataFrame:
    who, orders = table(spark, sf, "customer"), _moved(spark, sf)
    nation, number = F.col("c_nationkey"), F.col("o_orderkey")

    def place(n):
        return {"municipalityCode": F.concat(F.lit("k"), n), "municipalityName": F.concat(F.lit("n"), n), "county": F.concat(F.lit("f"), n % 5)}

    created = who.select(*_payload(
        persons.CREATED, F.timestamp_add("day", nation, F.lit("1980-01-01").cast("timestamp")), citizenId=F.col("c_custkey"), ssn=F.col("c_name"),
        firstName=F.col("c_mktsegment"), lastName=F.col("c_name"), birthDate=F.concat(1920 + F.col("c_custkey") % 90, F.lit("-06-15")),
        sex=F.when(nation % 3 == 0, "M").when(nation % 3 == 1, "F"), parent1Id=F.floor(F.col("c_custkey") / 2), parent2Id=F.floor(F.col("c_custkey") / 3),
        streetAddress=F.concat(F.lit("street "), nation), **place(nation)))
    moves = orders.select(*_payload(
        persons.MOVE, F.col("ts"), citizenId=F.col("o_custkey"), address=F.when(number % 3 > 0, F.concat(F.lit("road "), number % 7)), **place(number % 25)))
    died = who.where("c_acctbal < 0").select(*_payload(
        persons.DEATH, F.lit("2002-01-02 12:00:00").cast("timestamp"), citizenId=F.col("c_custkey"), birthDate=F.lit("2002-01-01")))
    return _events(created, moves, died)


def _family_events(spark: SparkSession, sf: str) -> DataFrame:
    orders, one, two = _moved(spark, sf), F.col("o_custkey"), F.col("o_custkey") + 1
    married = orders.where("o_orderpriority = '1-URGENT'").select(*_payload(persons.MARRIAGE, F.col("ts"), citizen1Id=one, citizen2Id=two))
    parted = orders.where("o_orderpriority = '5-LOW'").select(*_payload(persons.DIVORCE, F.col("ts"), citizen1Id=two, citizen2Id=one))
    child = F.col("c_custkey")
    born = table(spark, sf, "customer").where("c_custkey > 0").select(*_payload(
        persons.BIRTH, F.timestamp_add("day", F.col("c_nationkey"), F.lit("1980-01-01").cast("timestamp")), childId=child, parent1Id=F.floor(child / 2), parent2Id=F.floor(child / 3)))
    return _events(married, parted, born)


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return persons.person_registry(_person_events(spark, sf), _family_events(spark, sf))


def _residence(spark: SparkSession, sf: str) -> DataFrame:
    return persons.residence_history(_person_events(spark, sf))


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


@query(f"""WITH {REGISTRY_SQL}
    SELECT person_id, fnr_masked, full_name, first_name, last_name, birth_date, gender, municipality_code, municipality_name, county, marital_status,
           is_alive, death_date, change_event_type, valid_from, valid_to, is_current, mother_id, father_id, street_address FROM registry""")
def person_registry(spark, sf):
    return _plain(_registry(spark, sf))


@query(f"WITH {STAYS_SQL} SELECT * FROM residence")
def residence_history(spark, sf):
    return _residence(spark, sf)


@query(f"""WITH {STAYS_SQL}, sides AS (
      SELECT municipality_code, municipality_name, county, date_trunc('month', moved_in_date) AS period, 1 AS i, 0 AS o FROM residence
      UNION ALL SELECT municipality_code, municipality_name, county, date_trunc('month', moved_out_date), 0, 1 FROM residence WHERE moved_out_date IS NOT NULL)
    SELECT municipality_code, municipality_name, county, CAST(period AS DATE) AS period, CAST(sum(i) AS BIGINT) AS innflyttinger,
           CAST(sum(o) AS BIGINT) AS utflyttinger, CAST(sum(i) - sum(o) AS BIGINT) AS netto FROM sides GROUP BY 1, 2, 3, 4""")
def municipality_migration(spark, sf):
    return persons.municipality_migration(_residence(spark, sf)).withColumn("period", F.to_date("period"))


@query(f"""WITH {STAYS_SQL}, prev AS (
      SELECT person_id, municipality_code AS t, municipality_name AS tn, county AS tc, CAST(year(moved_in_date) AS INTEGER) AS reference_year,
             lag(municipality_code) OVER w AS f, lag(municipality_name) OVER w AS fn, lag(county) OVER w AS fc
      FROM residence WINDOW w AS (PARTITION BY person_id ORDER BY moved_in_date, change_event_type, municipality_code)),
    fwd AS (SELECT f, fn, fc, t, tn, tc, reference_year, count(*) AS n FROM prev WHERE f IS NOT NULL AND f <> t GROUP BY ALL)
    SELECT a.f AS from_municipality_code, a.fn AS from_municipality_name, a.fc AS from_county, a.t AS to_municipality_code, a.tn AS to_municipality_name,
           a.tc AS to_county, a.reference_year, a.n AS flow_count, coalesce(b.n, 0) AS return_flow_count, a.n - coalesce(b.n, 0) AS net_flow
    FROM fwd a LEFT JOIN fwd b ON a.f = b.t AND a.t = b.f AND a.reference_year = b.reference_year""")
def migration_flows(spark, sf):
    return persons.migration_flows(_residence(spark, sf))


@query(f"""WITH {REGISTRY_SQL}, c AS (
      SELECT CAST(year(valid_from) AS INTEGER) AS reference_year, marital_status, year(valid_from) - year(birth_date) AS age FROM registry),
    n AS (SELECT reference_year, CASE WHEN age < 18 THEN '0-17' WHEN age < 30 THEN '18-29' WHEN age < 45 THEN '30-44' WHEN age < 65 THEN '45-64' ELSE '65+' END AS age_group,
                 marital_status, count(*) AS "count" FROM c WHERE age >= 0 GROUP BY ALL)
    SELECT *, round("count" / sum("count") OVER (PARTITION BY reference_year, age_group) * 100, 1) AS pct_of_age_group FROM n""")
def marital_status_trends(spark, sf):
    return persons.marital_status_trends(_registry(spark, sf))


@query(f"""WITH {REGISTRY_SQL},
    moves AS (SELECT person_id AS pid, count(*) - 1 AS m FROM person WHERE event_type <> 'citizen.died' GROUP BY 1),
    p AS (SELECT CAST(floor(year(birth_date) / 10) * 10 AS INTEGER) AS birth_decade, coalesce(gender, 'UKJENT') AS gender, is_alive, marital_status, coalesce(m, 0) AS m
          FROM registry LEFT JOIN moves ON person_id = pid WHERE is_current AND birth_date IS NOT NULL),
    g AS (SELECT birth_decade, gender, count(*) AS cohort_size, count(*) FILTER (is_alive) AS alive_count, count(*) FILTER (marital_status = 'GIFT') AS married_count,
                 count(*) FILTER (marital_status = 'SKILT') AS divorced_count, round(avg(m), 2) AS avg_municipality_changes FROM p GROUP BY 1, 2)
    SELECT *, round(alive_count / cohort_size * 100, 1) AS survival_rate_pct, round(married_count / cohort_size * 100, 1) AS married_rate_pct FROM g""")
def cohort_demographics(spark, sf):
    events = persons.read_person_events(_person_events(spark, sf))  # parsed once for both
    return persons.cohort_demographics(persons.person_registry(events, _family_events(spark, sf)), persons.residence_history(events))


@query(f"""WITH RECURSIVE {EVENTS_SQL}, d AS (SELECT *, row_number() OVER () AS i FROM couple),
    wed AS (
      SELECT w.a AS person_id_a, w.b AS person_id_b, 'GIFT' AS relation_type, w.ts AS valid_from, min(x.ts) AS valid_to, min(x.ts) IS NULL AS is_current
      FROM d w LEFT JOIN d x ON x.status = 'SKILT' AND x.a = w.a AND x.b = w.b AND x.ts > w.ts WHERE w.status = 'GIFT' GROUP BY ALL
      UNION ALL SELECT b, a, 'SKILT', ts, NULL, true FROM couple WHERE status = 'SKILT'),
    edge AS (SELECT c_custkey // 2 AS p, c_custkey AS c FROM customer WHERE c_custkey > 0 UNION SELECT c_custkey // 3, c_custkey FROM customer WHERE c_custkey > 0),
    up(p, c, depth) AS (SELECT p, c, 1 FROM edge UNION SELECT edge.p, up.c, depth + 1 FROM up JOIN edge ON edge.c = up.p WHERE depth < 5),
    kin AS (SELECT up.p, up.c, min(depth) AS depth, TIMESTAMP '1980-01-01' + to_days(max(c_nationkey)) AS born FROM up JOIN customer ON c_custkey = up.c GROUP BY 1, 2)
    SELECT person_id_a || '_' || person_id_b || '_' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS relation_id, person_id_a, person_id_b, relation_type,
           CAST(NULL AS INTEGER) AS generation_depth, valid_from, valid_to, is_current FROM wed
    UNION ALL SELECT p || '_' || c || '_FORELDER_AV_' || depth, CAST(p AS VARCHAR), CAST(c AS VARCHAR), 'FORELDER_AV', depth, born, NULL, true FROM kin
    UNION ALL SELECT c || '_' || p || '_BARN_AV_' || depth, CAST(c AS VARCHAR), CAST(p AS VARCHAR), 'BARN_AV', depth, born, NULL, true FROM kin""")
def family_relations(spark, sf):
    return _plain(persons.family_relations(_family_events(spark, sf)))


@query(f"""WITH {STAYS_SQL}, known AS (SELECT 'k' || n_nationkey AS code, n_name AS name, 'region ' || n_regionkey AS county FROM nation WHERE n_nationkey < 20)
    SELECT r.* REPLACE (coalesce(k.name, r.municipality_name) AS municipality_name, coalesce(k.county, r.county) AS county)
    FROM residence r LEFT JOIN known k ON k.code = r.municipality_code""")
def residence_by_reference(spark, sf):
    """Stays with the names of a reference table, where it has the municipality."""
    known = table(spark, sf, "nation").filter("n_nationkey < 20").select(
        F.concat(F.lit("k"), "n_nationkey").alias("kommunenr"), F.col("n_name").alias("kommunenavn"), F.concat(F.lit("region "), "n_regionkey").alias("fylke"))
    return persons.residence_history(_person_events(spark, sf), known)


@query(f"""WITH {REGISTRY_SQL},
    y AS (SELECT *, unnest(generate_series(year(valid_from), least(coalesce(year(valid_to) - 1, 2003), 2003))) AS reference_year FROM registry),
    p AS (SELECT municipality_code, municipality_name, county, CAST(reference_year AS INTEGER) AS reference_year, count(person_id) AS population_total,
                 count(*) FILTER (gender = 'M') AS population_male, count(*) FILTER (gender = 'F') AS population_female, round(avg(reference_year - year(birth_date)), 1) AS avg_age
          FROM y WHERE is_alive AND municipality_code IS NOT NULL GROUP BY 1, 2, 3, 4),
    b AS (SELECT municipality_code, year(valid_from) AS reference_year, count(*) AS births FROM registry WHERE change_event_type IN ('event.birth', 'citizen.created') GROUP BY 1, 2),
    d AS (SELECT municipality_code, year(death_date) AS reference_year, count(*) AS deaths FROM registry WHERE death_date IS NOT NULL GROUP BY 1, 2)
    SELECT p.*, coalesce(births, 0) AS births, coalesce(deaths, 0) AS deaths FROM p LEFT JOIN b USING (municipality_code, reference_year) LEFT JOIN d USING (municipality_code, reference_year)""")
def population_plan(spark, sf):
    return persons.population_stats(_registry(spark, sf), 2003)
