"""Histories, flows, cohorts, graphs and code lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrasse.catalogue.base import query, table
from terrasse.operators import graph, history, keys, lookup, measures, rules
from terrasse.plans import persons
from terrasse.settings import fresh_path
from terrasse.sources import readers

STATE = """SELECT user_id, event_id, ts,
    CASE WHEN event_type = 'signup' THEN json_extract_string(props, '$.k') END AS plan,
    CASE WHEN event_type = 'purchase' THEN value END AS last_purchase,
    CASE WHEN event_type = 'error' THEN event_id END AS last_error FROM events"""


@query(f"""WITH e AS ({STATE})
    SELECT user_id, event_id, coalesce(last_value(plan IGNORE NULLS) OVER r, 'none') AS plan,
           last_value(last_purchase IGNORE NULLS) OVER r AS last_purchase,
           last_value(last_error IGNORE NULLS) OVER r AS last_error,
           ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
      r AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def scd2_accumulate(spark, sf):
    def only(kind, value):
        return F.when(F.col("event_type") == kind, value)
    events = table(spark, sf, "events").select(
        "user_id", "event_id", "ts", only("signup", F.get_json_object("props", "$.k")).alias("plan"),
        only("purchase", F.col("value")).alias("last_purchase"), only("error", F.col("event_id")).alias("last_error"),
    )
    return history.accumulate_state(
        events, "user_id", "ts", ["plan", "last_purchase", "last_error"], ["event_id"], {"plan": "none"}, ["event_id"]
    )


# Stays: a customer stays with a priority from one order to the next; customers in debt end in 2002.
SPELLS_SQL = """spells AS (
  SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) AS moved_in_date,
         CAST(coalesce(nxt, CASE WHEN c_acctbal < 0 THEN DATE '2002-01-01' END) AS DATE) AS moved_out_date,
         nxt IS NULL AND NOT coalesce(c_acctbal < 0, false) AS is_current
  FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders)
  LEFT JOIN customer ON o_custkey = c_custkey)"""


def _spells(spark, sf):
    ends = table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("2002-01-01").cast("date").alias("end_date")
    )
    return history.spells(
        table(spark, sf, "orders"), "o_custkey", "o_orderdate", ["o_orderpriority", "o_orderkey"], ["o_orderkey"], ends
    )


@query(f"""WITH {SPELLS_SQL} SELECT *, CAST(datediff('day', moved_in_date, moved_out_date) AS INTEGER) AS duration_days FROM spells""")
def spells(spark, sf):
    return _spells(spark, sf)


NET_SQL = f"""{SPELLS_SQL}, both_sides AS (
  SELECT o_orderpriority, CAST(date_trunc('month', moved_in_date) AS DATE) AS period, 1 AS i, 0 AS o FROM spells
  UNION ALL SELECT o_orderpriority, CAST(date_trunc('month', moved_out_date) AS DATE), 0, 1 FROM spells
  WHERE moved_out_date IS NOT NULL),
net AS (SELECT o_orderpriority, period, CAST(sum(i) AS BIGINT) AS moved_in, CAST(sum(o) AS BIGINT) AS moved_out,
               CAST(sum(i) - sum(o) AS BIGINT) AS net FROM both_sides GROUP BY 1, 2)"""


def _net(spark, sf):
    net = history.in_out_net(_spells(spark, sf), ["o_orderpriority"])
    return net.withColumn("period", F.to_date("period"))


@query(f"WITH {NET_SQL} SELECT * FROM net")
def inflow_outflow_net(spark, sf):
    return _net(spark, sf)


@query(f"""WITH {NET_SQL} SELECT o_orderpriority, CAST(sum(net) AS BIGINT) AS net FROM net
           WHERE period >= DATE '2000-01-01' GROUP BY 1""")
def net_recent(spark, sf):
    recent = _net(spark, sf).filter(F.col("period") >= F.lit("2000-01-01").cast("date"))
    return recent.groupBy("o_orderpriority").agg(F.sum("net").alias("net")).orderBy(F.col("net").desc(), "o_orderpriority")


@query(f"""WITH {NET_SQL}, ranked AS (
    SELECT o_orderpriority, period, net, row_number() OVER (ORDER BY net, o_orderpriority, period) AS lo,
           row_number() OVER (ORDER BY net DESC, o_orderpriority, period) AS hi FROM net)
    SELECT o_orderpriority, period, net FROM ranked WHERE lo <= 10 OR hi <= 10""")
def both_tails(spark, sf):
    net = _net(spark, sf).select("o_orderpriority", "period", "net")
    return measures.both_tails(net, "net", ["o_orderpriority", "period"], 10)


@query("SELECT o_custkey, count(*) - 1 AS moves FROM orders GROUP BY o_custkey")
def moves_per_key(spark, sf):
    return history.moves_per_key(table(spark, sf, "orders"), "o_custkey")


FLOW_SQL = """prev AS (
  SELECT o_custkey, o_orderpriority AS t, CAST(year(o_orderdate) AS INTEGER) AS reference_year,
         lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS f FROM orders),
fwd AS (SELECT f, t, reference_year, count(*) AS flow_count FROM prev WHERE f IS NOT NULL AND f <> t GROUP BY ALL),
flows AS (SELECT a.f AS from_place, a.t AS to_place, a.reference_year, a.flow_count,
                 coalesce(b.flow_count, 0) AS return_flow_count, a.flow_count - coalesce(b.flow_count, 0) AS net_flow
          FROM fwd a LEFT JOIN fwd b ON a.f = b.t AND a.t = b.f AND a.reference_year = b.reference_year)"""


def _flows(spark, sf):
    stays = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("place"))
    return history.flow_matrix(stays, "o_custkey", "o_orderdate", "place", tie_breakers=["o_orderkey"])


@query(f"WITH {FLOW_SQL} SELECT * FROM flows")
def flow_matrix(spark, sf):
    return _flows(spark, sf)


@query(f"""WITH {FLOW_SQL} SELECT from_place, to_place, reference_year, flow_count FROM flows
           ORDER BY flow_count DESC, from_place, to_place, reference_year LIMIT 15""")
def top_flows(spark, sf):
    flows = _flows(spark, sf).select("from_place", "to_place", "reference_year", "flow_count")
    return measures.top_k(flows, [F.col("flow_count").desc(), F.col("from_place"), F.col("to_place"), F.col("reference_year")], 15)


NET_ALIGNED_SQL = """WITH i AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    o AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
    SELECT coalesce(i.k, o.k) AS k, {net} AS net FROM i FULL JOIN o ON i.k = o.k"""


def _sides(spark, sf):
    lines = table(spark, sf, "lineitem")
    inflow = measures.counts_by(lines.filter("l_returnflag = 'R'"), [F.col("l_suppkey").alias("k")])
    outflow = measures.counts_by(lines.filter("l_returnflag = 'N'"), [F.col("l_partkey").alias("k")])
    return inflow, outflow


@query(NET_ALIGNED_SQL.format(net="coalesce(i.n - o.n, 0)"))
def net_aligned(spark, sf):
    return history.net_aligned(*_sides(spark, sf), ["k"], "n")


@query(NET_ALIGNED_SQL.format(net="coalesce(i.n, 0) - coalesce(o.n, 0)"))
def net_aligned_zero_side(spark, sf):
    return history.net_aligned(*_sides(spark, sf), ["k"], "n", "zero_side")


# Order history as person history.
HISTORY_SQL = """h AS (SELECT o_custkey AS person_id, o_orderkey, o_orderpriority AS code, o_orderdate AS valid_from,
       lead(o_orderdate) OVER w AS valid_to, lead(o_orderdate) OVER w IS NULL AS is_current, o_orderstatus <> 'P' AS is_alive,
       CASE WHEN o_totalprice < 250000 THEN 'M' ELSE 'F' END AS gender, o_orderstatus AS kind,
       CAST(year(o_orderdate) - 30 - c_nationkey AS INTEGER) AS birth_year,
       CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) END AS death_date
  FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
y AS (SELECT h.*, CAST(yr AS INTEGER) AS reference_year FROM h, range(1995, 2003) t(yr)
      WHERE year(valid_from) <= yr AND (valid_to IS NULL OR year(valid_to) > yr)
      QUALIFY row_number() OVER (PARTITION BY person_id, yr ORDER BY is_current DESC, valid_from DESC, o_orderkey DESC) = 1)"""


def _history(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    dead = F.col("o_orderstatus") == "P"
    events = orders.select(
        F.col("o_custkey").alias("person_id"), "o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("code"),
        (~dead).alias("is_alive"), F.when(F.col("o_totalprice") < 250000, "M").otherwise("F").alias("gender"),
        F.col("o_orderstatus").alias("kind"), (F.year("o_orderdate") - 30 - F.col("c_nationkey")).alias("birth_year"),
        F.when(dead, F.to_date("o_orderdate")).alias("death_date"),
    )
    carried = ["o_orderkey", "code", "is_alive", "gender", "kind", "birth_year", "death_date"]
    return history.accumulate_state(events, "person_id", "o_orderdate", [], ["o_orderkey"], carry=carried)


@query(f"WITH {HISTORY_SQL} SELECT person_id, reference_year, code, o_orderkey FROM y")
def year_end_snapshot(spark, sf):
    snap = history.year_end_snapshot(_history(spark, sf), "person_id", 2002, tie_breakers=["o_orderkey"])
    return snap.select("person_id", "reference_year", "code", "o_orderkey")


@query(f"""WITH {HISTORY_SQL},
    p AS (SELECT code, reference_year, count(person_id) AS population_total,
                 count(*) FILTER (WHERE gender = 'M') AS population_male, count(*) FILTER (WHERE gender = 'F') AS population_female,
                 round(avg(reference_year - birth_year), 3) AS avg_age FROM y WHERE is_alive AND code IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT code, year(valid_from) AS reference_year, count(*) AS births FROM h WHERE kind = 'O' GROUP BY 1, 2),
    d AS (SELECT code, year(death_date) AS reference_year, count(*) AS deaths FROM h WHERE death_date IS NOT NULL GROUP BY 1, 2)
    SELECT p.*, coalesce(births, 0) AS births, coalesce(deaths, 0) AS deaths
    FROM p LEFT JOIN b USING (code, reference_year) LEFT JOIN d USING (code, reference_year)""")
def population_stats(spark, sf):
    people = _history(spark, sf)
    snap = history.year_end_snapshot(people, "person_id", 2002, disjoint=True)
    return history.population_by_year(
        snap, people, ["code"], "code", "person_id", F.col("is_alive"),
        {"population_male": F.col("gender") == "M", "population_female": F.col("gender") == "F"},
        F.col("birth_year"), F.col("kind") == "O", "death_date", digits=3,
    )


@query("""WITH m AS (SELECT o_custkey, count(*) - 1 AS moves FROM orders GROUP BY 1),
    c AS (SELECT c_custkey, CAST(floor((1940 + c_nationkey * 2) / 10) * 10 AS INTEGER) AS birth_decade,
                 coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS gender, c_acctbal > 0 AS alive, coalesce(moves, 0) AS moves
          FROM customer LEFT JOIN m ON c_custkey = o_custkey)
    SELECT birth_decade, gender, count(*) AS cohort_size, count(*) FILTER (WHERE alive) AS alive_count,
           round(avg(moves), 4) AS avg_moves, round(count(*) FILTER (WHERE alive) / count(*) * 100, 4) AS survival_rate_pct
    FROM c GROUP BY 1, 2""")
def cohort_profile(spark, sf):
    moves = history.moves_per_key(table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")
    people = table(spark, sf, "customer").select(
        "c_custkey", rules.decade(1940 + F.col("c_nationkey") * 2).alias("birth_decade"),
        rules.or_default(F.nullif("c_mktsegment", F.lit("BUILDING")), "UNKNOWN").alias("gender"), (F.col("c_acctbal") > 0).alias("alive"),
    )
    cohorts = people.join(moves, "c_custkey", "left").fillna(0, subset=["moves"]).groupBy("birth_decade", "gender").agg(
        F.count(F.lit(1)).alias("cohort_size"), F.count_if("alive").alias("alive_count"), F.round(F.avg("moves"), 4).alias("avg_moves")
    )
    return cohorts.withColumn("survival_rate_pct", measures.rate("alive_count", "cohort_size", 4))


BAND_SQL = """CASE WHEN o_totalprice / 5000 < 18 THEN '0-17' WHEN o_totalprice / 5000 < 30 THEN '18-29'
     WHEN o_totalprice / 5000 < 45 THEN '30-44' WHEN o_totalprice / 5000 < 65 THEN '45-64' ELSE '65+' END"""


def _band():
    return rules.band(F.col("o_totalprice") / 5000, rules.AGE_BANDS, rules.AGE_TOP)


@query(f"SELECT o_orderkey, {BAND_SQL} AS age_group FROM orders")
def banding(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", _band().alias("age_group"))


@query(f"""WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS reference_year, {BAND_SQL} AS age_group,
                            o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL)
    SELECT *, round(n / sum(n) OVER (PARTITION BY reference_year, age_group) * 100, 4) AS pct FROM c""")
def status_share_by_year(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("reference_year"), _band().alias("age_group"), F.col("o_orderstatus").alias("status")
    )
    counted = measures.counts_by(rows, ["reference_year", "age_group", "status"])
    return measures.share_in_group(counted, ["reference_year", "age_group"], "n", "pct", 4)


@query("""WITH p AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
    k AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    c AS (SELECT p.o_custkey IS NOT NULL AS partner, coalesce(n, 0) AS n FROM customer
          LEFT JOIN p ON c_custkey = p.o_custkey LEFT JOIN k ON c_custkey = k.o_custkey),
    g AS (SELECT CASE WHEN partner AND n > 0 THEN 'EKTEPAR_MED_BARN' WHEN partner THEN 'EKTEPAR_UTEN_BARN'
                      WHEN n > 0 THEN 'ENSLIG_FORSØRGER' ELSE 'ENSLIG' END AS household_type,
                 CASE 1 + n + CAST(partner AS INTEGER) WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3-4' WHEN 4 THEN '3-4' ELSE '5+' END AS size_category
          FROM c)
    SELECT household_type, size_category, count(*) AS "count", round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_of_total
    FROM g GROUP BY 1, 2""")
def household_structure(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    children = measures.counts_by(orders.filter(F.col("o_orderstatus") == "P"), ["c_custkey"], "child_count")
    people = keys.with_existence_flag(table(spark, sf, "customer"), urgent, ["c_custkey"], "has_partner")
    return persons.classify_households(people.join(children, "c_custkey", "left"), "c_custkey")


# Pairs (user, k): opened by signup, closed by error; odd events name the sides the other way round.
PAIRS_SQL = """pairs AS (SELECT event_id, ts, event_type,
      CASE WHEN event_id % 2 = 1 THEN k ELSE user_id END AS a, CASE WHEN event_id % 2 = 1 THEN user_id ELSE k END AS b
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) WHERE k <> user_id),
m AS (SELECT o.event_id, o.a, o.b, o.ts AS valid_from, c.ts AS valid_to FROM (SELECT * FROM pairs WHERE event_type = 'signup') o
      LEFT JOIN (SELECT * FROM pairs WHERE event_type = 'error') c ON (o.a = c.a AND o.b = c.b) OR (o.a = c.b AND o.b = c.a))"""


def _pairs(spark, sf):
    rows = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).filter(F.col("k") != F.col("user_id"))
    odd = F.col("event_id") % 2 == 1
    pairs = rows.select(
        "event_id", "event_type", F.col("ts").alias("valid_from"), F.when(odd, F.col("k")).otherwise(F.col("user_id")).alias("a"),
        F.when(odd, F.col("user_id")).otherwise(F.col("k")).alias("b"),
    )
    def kind(t):
        return pairs.filter(F.col("event_type") == t).drop("event_type")
    return kind("signup"), kind("error")


@query(f"WITH {PAIRS_SQL} SELECT event_id, a, b, valid_from, valid_to, valid_to IS NULL AS is_current FROM m")
def symmetric_pair_join(spark, sf):
    return graph.symmetric_pair_join(*_pairs(spark, sf), "a", "b", "valid_from", "valid_from", "all").select(
        "event_id", "a", "b", "valid_from", "valid_to", "is_current"
    )


@query(f"""WITH {PAIRS_SQL} SELECT event_id, a, b, valid_from, min(valid_to) FILTER (WHERE valid_to > valid_from) AS valid_to,
             min(valid_to) FILTER (WHERE valid_to > valid_from) IS NULL AS is_current FROM m GROUP BY 1, 2, 3, 4""")
def symmetric_pair_first_after(spark, sf):
    return graph.symmetric_pair_join(*_pairs(spark, sf), "a", "b", "valid_from", "valid_from", "first_after").select(
        "event_id", "a", "b", "valid_from", "valid_to", "is_current"
    )


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS c, c_custkey // 2 AS p FROM customer WHERE c_custkey > 0),
    t AS (SELECT p, c, 1 AS d FROM e UNION ALL SELECT e.p, t.c, t.d + 1 FROM t JOIN e ON t.p = e.c WHERE t.d < 5)
    SELECT p AS person_id_a, c AS person_id_b, 'FORELDER_AV' AS relation_type, d AS generation_depth FROM t
    UNION ALL SELECT c, p, 'BARN_AV', d FROM t""")
def closure_depth_n(spark, sf):
    edges = table(spark, sf, "customer").select(
        F.floor(F.col("c_custkey") / 2).cast("bigint").alias("ancestor_id"), F.col("c_custkey").alias("descendant_id")
    )
    return graph.mirror_edges(graph.closure(edges), "ancestor_id", "descendant_id", persons.PARENT_OF, persons.CHILD_OF)


@query("""SELECT 'R' || r_regionkey AS identifier, 'KAPITTEL' AS type, 'R' || r_regionkey AS chapter_code, CAST(NULL AS VARCHAR) AS block_code FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'BLOKK', 'R' || n_regionkey, NULL FROM nation
    UNION ALL SELECT 'C' || c_custkey, 'KODE', 'R' || n_regionkey, 'N' || n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def hierarchy_levels(spark, sf):
    def level(name, key, prefix, up, up_prefix, kind):
        parent = F.concat(F.lit(up_prefix), F.col(up)) if up else F.lit(None).cast("string")
        return table(spark, sf, name).select(F.concat(F.lit(prefix), F.col(key)).alias("identifier"), parent.alias("parent"), F.lit(kind).alias("type"))
    codes = level("region", "r_regionkey", "R", None, None, "KAPITTEL").unionByName(
        level("nation", "n_nationkey", "N", "n_regionkey", "R", "BLOKK")
    ).unionByName(level("customer", "c_custkey", "C", "c_nationkey", "N", "KODE"))
    return graph.resolve_hierarchy(codes).drop("parent")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT c, p FROM (
      SELECT c_custkey AS c, c_custkey // 2 AS p FROM customer UNION ALL SELECT c_custkey, c_custkey // 3 FROM customer) WHERE c > 0 AND c <> p),
    t AS (SELECT c, p, 1 AS d FROM e UNION SELECT t.c, e.p, t.d + 1 FROM t JOIN e ON t.p = e.c WHERE t.d < 5),
    u AS (SELECT c, p, min(d) AS d FROM t GROUP BY c, p)
    SELECT c AS product_id, 'upstream' AS direction, count(*) AS n, max(d) AS depth FROM u GROUP BY c
    UNION ALL SELECT p, 'downstream', count(*), 1 FROM e GROUP BY p""")
def lineage_up_down(spark, sf):
    c = F.col("c_custkey")
    products = table(spark, sf, "customer").select(
        c.alias("product_id"),
        F.array_distinct(F.array(F.floor(c / 2).cast("bigint"), F.floor(c / 3).cast("bigint"))).alias("source_products"),
    )
    found = graph.lineage(products)
    return found.groupBy("product_id", "direction").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"))


@query("""SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code, coalesce(CASE WHEN n_regionkey > 0 THEN n_name END, c_mktsegment) AS place,
                 CASE WHEN n_regionkey > 0 THEN 'R' || n_regionkey ELSE 'own' END AS county
          FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_fallback(spark, sf):
    own = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("code"), F.col("c_mktsegment").alias("place"), F.lit("own").alias("county")
    )
    reference = table(spark, sf, "nation").filter("n_regionkey > 0").select(
        lookup.padded_code("n_nationkey").alias("ref_code"), "n_name", F.concat(F.lit("R"), F.col("n_regionkey")).alias("ref_county")
    )
    return lookup.prefer_reference(own, reference, "code", "ref_code", {"place": "n_name", "county": "ref_county"})


@query("""SELECT s_name, CASE WHEN length(CAST(s_suppkey AS VARCHAR)) >= 4 THEN CAST(s_suppkey AS VARCHAR)
                              ELSE lpad(CAST(s_suppkey AS VARCHAR), 4, '0') END AS code FROM supplier""")
def ref_codes_padded(spark, sf):
    path = fresh_path(spark, "codes")
    table(spark, sf, "supplier").select(F.col("s_suppkey").alias("CODE"), F.col("s_name").alias("S_Name")).write.option(
        "header", True
    ).option("sep", ";").csv(path)
    return readers.read_code_file(spark, path, padded={"code": 4})


@query("""SELECT c_custkey, a.n_name AS home_name, b.n_name AS trade_name, b.n_regionkey AS trade_region, c.n_name AS debt_name
    FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN c_nationkey + 5 END AS trade, CASE WHEN c_acctbal <= 0 THEN c_nationkey END AS debt FROM customer) t
    LEFT JOIN nation a ON a.n_nationkey = t.c_nationkey LEFT JOIN nation b ON b.n_nationkey = t.trade LEFT JOIN nation c ON c.n_nationkey = t.debt""")
def role_playing_lookup(spark, sf):
    fact = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("home"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey") + 5).alias("trade"),
        F.when(F.col("c_acctbal") <= 0, F.col("c_nationkey")).alias("debt"),
    )
    codes = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    out = lookup.role_lookups(fact, codes, "code", ["name", "region"], {"home": "home", "trade": "trade", "debt": "debt"})
    return out.select("c_custkey", "home_name", "trade_name", "trade_region", "debt_name")


@query("""WITH r AS (SELECT 1 AS sekvens, l_suppkey AS code FROM lineitem WHERE l_quantity > 5
                     UNION ALL SELECT 2, l_partkey FROM lineitem WHERE l_quantity > 5)
    SELECT r.sekvens, r.code, s_name AS name, count(*) AS n FROM r LEFT JOIN supplier ON code = s_suppkey GROUP BY ALL""")
def json_array_bridge(spark, sf):
    def item(i, c):
        return F.struct(F.lit(i).alias("sekvens"), F.col(c).alias("code"))
    full = F.to_json(F.array(item(1, "l_suppkey"), item(2, "l_partkey")))
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") > 5, full).when(F.col("l_quantity") > 3, "[]").when(F.col("l_quantity") > 2, "broken").alias("codes")
    )
    rows = lookup.json_array_rows(lines, [], "codes", "struct<sekvens:int,code:bigint>")
    # counted per code before the lookup, so the join meets each code once
    counted = measures.counts_by(rows, ["sekvens", "code"])
    return lookup.bridge(counted, table(spark, sf, "supplier"), "code", {"name": "s_name"}, "s_suppkey").select("sekvens", "code", "name", "n")
