import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from terrasse.operators import history
from terrasse.plans import persons as P

EVENT = "event_type string, event_timestamp string, kafka_timestamp timestamp, payload_json string"
BROKER = datetime(2024, 6, 1)


def events(spark, data):
    return spark.createDataFrame([(t, ts, BROKER, json.dumps(p) if isinstance(p, dict) else p) for t, ts, p in data], EVENT)


@pytest.fixture(scope="module")
def person_events(spark):
    return events(spark, [
        ("citizen.created", "2000-01-01T00:00:00", {"citizenId": "a", "ssn": "1", "firstName": "Ada", "lastName": "L", "sex": "F", "birthDate": "1970-05-05", "postalCode": "301", "city": "Oslo"}),
        ("event.relocation", "2005-03-01T00:00:00", {"citizenId": "a", "municipalityCode": "4601", "municipalityName": "Bergen", "county": "Vestland"}),
        ("event.relocation", "2007-04-01T00:00:00", {"citizenId": "a", "municipalityCode": "0301", "municipalityName": "OSLO", "county": "x"}),
        ("citizen.died", "2010-07-01T00:00:00", {"citizenId": "a", "birthDate": "2010-06-30"}),
        ("event.birth", "2002-02-02T00:00:00", {"childId": "c", "childSsn": "", "birthDate": "2002-02-02", "parent1Id": "a", "parent2Id": "b", "municipalityCode": "0301"}),
        ("citizen.created", "unreadable", {"citizenId": "b", "ssn": "2", "sex": "M", "birthDate": "1971-01-01"}),
        ("something.else", "2001-01-01T00:00:00", {"citizenId": "a", "firstName": "No"}),
        ("event.birth", "2003-01-01T00:00:00", "broken json"),
    ])


@pytest.fixture(scope="module")
def family_events(spark):
    return events(spark, [
        ("event.marriage", "2001-01-01T00:00:00", {"citizen1Id": "a", "citizen2Id": "b"}),
        ("event.divorce", "2004-01-01T00:00:00", {"citizen1Id": "b", "citizen2Id": "a"}),
        ("event.marriage", "2006-01-01T00:00:00", {"citizen1Id": "a", "citizen2Id": "d"}),
        ("event.birth", "2002-02-02T00:00:00", {"childId": "c", "parent1Id": "a", "parent2Id": "b"}),
        ("event.birth", "1970-05-05T00:00:00", {"childId": "a", "parent1Id": "g"}),
        ("event.birth", "1940-05-05T00:00:00", {"childId": "g", "parent1Id": "h", "parent2Id": "h"}),
    ])


@pytest.fixture(scope="module")
def registry(person_events, family_events):
    return P.person_registry(person_events, family_events)


def test_registry_accumulates_state(registry):
    mine = rows(registry.filter("person_id = 'a'"), "valid_from", "valid_to", "full_name", "municipality_name", "marital_status", "is_alive", "is_current", "change_event_type")
    assert [(r[0].year, r[1] and r[1].year, *r[2:]) for r in mine] == [
        (2000, 2001, "Ada L", "Oslo", "UGIFT", True, False, "citizen.created"),
        (2001, 2004, "Ada L", "Oslo", "GIFT", True, False, "SivilstatusEndret"),
        (2004, 2005, "Ada L", "Oslo", "SKILT", True, False, "SivilstatusEndret"),
        (2005, 2006, "Ada L", "Bergen", "SKILT", True, False, "event.relocation"),
        (2006, 2007, "Ada L", "Bergen", "GIFT", True, False, "SivilstatusEndret"),
        (2007, 2010, "Ada L", "OSLO", "GIFT", True, False, "event.relocation"),
        (2010, None, "Ada L", "OSLO", "GIFT", False, True, "citizen.died"),
    ]
    last = registry.filter("person_id = 'a' AND is_current").first()
    # the death event carries its date under the birth-date path, which also overwrites the birth date
    assert last.death_date == date(2010, 6, 30) and last.birth_date == date(2010, 6, 30)


def test_registry_pseudonyms_and_times(registry):
    child = registry.filter("person_id = 'c'").first()
    assert child.fnr_masked is None and child.mother_id == "a" and child.father_id == "b"
    b = registry.filter("person_id = 'b' AND change_event_type = 'citizen.created'").first()
    assert b.valid_from == BROKER  # unreadable event time


def test_registry_without_family_events(person_events):
    only = P.person_registry(person_events)
    assert rows(only.select("marital_status").distinct()) == [("UGIFT",)]


def test_registry_with_split_keys(person_events, family_events, registry, small_runs):
    again = P.person_registry(person_events, family_events)
    assert rows(again) == rows(registry)


def test_equal_times_keep_every_row(spark):
    ev = spark.createDataFrame([("p", 1, 1, "x", None), ("p", 1, 2, None, "y"), ("p", 2, 3, None, None)], "k string, ts int, id int, a string, b string")
    out = history.accumulate_state(ev, "k", "ts", ["a", "b"], ["id"])
    assert rows(out) == [("p", "x", None, 1, 1, False), ("p", "x", "y", 1, 2, False), ("p", "x", "y", 2, None, True)]


@pytest.fixture(scope="module")
def relations(family_events):
    return P.family_relations(family_events)


def test_marriage_is_closed_by_divorce_in_either_order(relations):
    wed = rows(relations.filter("relation_type = 'GIFT'"), "person_id_a", "person_id_b", "valid_to", "is_current")
    assert wed == [("a", "b", datetime(2004, 1, 1), False), ("a", "d", None, True)]
    assert rows(relations.filter("relation_type = 'SKILT'"), "person_id_a", "person_id_b", "is_current") == [("b", "a", True)]


def test_generations_and_mirrors(relations):
    up = rows(relations.filter("relation_type = 'FORELDER_AV'"), "person_id_a", "person_id_b", "generation_depth")
    assert up == [("a", "c", 1), ("b", "c", 1), ("g", "a", 1), ("g", "c", 2), ("h", "a", 2), ("h", "c", 3), ("h", "g", 1)]
    down = rows(relations.filter("relation_type = 'BARN_AV'"), "person_id_b", "person_id_a", "generation_depth")
    assert down == up
    ids = rows(relations.filter("generation_depth = 3"), "relation_id", "valid_from")
    assert ids == [("c_h_BARN_AV_3", datetime(2002, 2, 2)), ("h_c_FORELDER_AV_3", datetime(2002, 2, 2))]


@pytest.fixture(scope="module")
def municipalities(spark):
    return spark.createDataFrame([("Oslo", "0301", "Oslo fylke"), ("Bergen", "4601", "Vestland")], "kommunenavn string, kommunenr string, fylke string")


@pytest.fixture(scope="module")
def residence(person_events, municipalities):
    return P.residence_history(person_events, municipalities)


def test_residence_closes_the_open_stay_at_death(residence):
    got = rows(residence.filter("person_id = 'a'"), "moved_in_date", "moved_out_date", "municipality_code", "municipality_name", "county", "is_current", "duration_days")
    assert got == [
        (date(2000, 1, 1), date(2005, 3, 1), "301", "Oslo", "Oslo fylke", False, 1886),
        (date(2005, 3, 1), date(2007, 4, 1), "4601", "Bergen", "Vestland", False, 761),
        (date(2007, 4, 1), date(2010, 6, 30), "0301", "Oslo", "Oslo fylke", False, 1186),
    ]
    open_stay = residence.filter("person_id = 'c'").first()
    assert open_stay.is_current and open_stay.duration_days is None and open_stay.moved_out_date is None


def test_migration_counts_both_directions(residence):
    out = P.municipality_migration(residence)
    got = rows(out.filter("municipality_name = 'Bergen'").select(F.to_date("period"), "innflyttinger", "utflyttinger", "netto"))
    assert got == [(date(2005, 3, 1), 1, 0, 1), (date(2007, 4, 1), 0, 1, -1)]


def test_null_places_meet_in_migration(spark):
    stays = spark.createDataFrame([("x", None, date(2020, 1, 5), date(2020, 1, 9)), ("x", None, date(2020, 1, 7), None)], "code string, name string, moved_in_date date, moved_out_date date")
    out = history.in_out_net(stays, ["code", "name"])
    assert rows(out, "moved_in", "moved_out", "net") == [(2, 1, 1)]


def test_flows_have_return_and_net(spark):
    stays = spark.createDataFrame(
        [("p", "A", "a1", date(2020, 1, 1)), ("p", "B", "b1", date(2020, 2, 1)), ("p", "A", "a2", date(2020, 3, 1)), ("p", "A", "a3", date(2020, 4, 1)),
         ("q", "A", "a1", date(2020, 1, 1)), ("q", "B", "b2", date(2020, 5, 1))], "person_id string, code string, name string, d date")
    out = history.flow_matrix(stays, "person_id", "d", "code", ["name"])
    assert rows(out, "from_code", "to_code", "to_name", "flow_count", "return_flow_count", "net_flow") == [
        ("A", "B", "b1", 1, 1, 0), ("A", "B", "b2", 1, 1, 0), ("B", "A", "a2", 1, 2, -1),
    ]
    full = P.migration_flows(stays.select("person_id", F.col("code").alias("municipality_code"), F.col("name").alias("municipality_name"),
                                          F.lit("c").alias("county"), F.col("d").alias("moved_in_date"), F.lit("e").alias("change_event_type")))
    assert full.columns[:3] == ["from_municipality_code", "from_municipality_name", "from_county"]


def test_year_end_snapshot_and_population(registry):
    stats = P.population_stats(registry, 2011)
    got = {(r.municipality_name, r.reference_year): r for r in stats.collect()}
    assert got["Oslo", 2000].population_total == 1 and got["Oslo", 2000].population_female == 1
    assert got["Oslo", 2000].births == 1 and got["Oslo", 2000].avg_age == 30.0
    assert ("OSLO", 2010) not in got  # dead by the end of that year
    assert got["Bergen", 2005].population_total == 1 and got["Bergen", 2005].births == 0


def test_snapshot_equals_cross_join_form(registry, spark):
    snap = history.year_end_snapshot(registry, "person_id", 2012, tie_breakers=["change_event_type"])
    years = spark.range(1990, 2013).toDF("y")
    naive = registry.crossJoin(years).filter((F.year("valid_from") <= F.col("y")) & (F.col("valid_to").isNull() | (F.year("valid_to") > F.col("y"))))
    pairs = naive.select("person_id", F.col("y").cast("int").alias("y")).distinct()
    assert rows(snap, "person_id", "reference_year") == rows(pairs)


def test_disjoint_histories_need_no_choice(registry):
    assert rows(P.population_stats(registry, 2011, disjoint=True)) == rows(P.population_stats(registry, 2011, disjoint=False))


def test_deaths_count_rows_or_persons(registry, spark):
    doubled = registry.unionByName(registry.filter("death_date IS NOT NULL"))
    alive = doubled.withColumn("is_alive", F.lit(True))
    by = {m: P.population_stats(alive, 2010, m).filter("municipality_name = 'OSLO' AND reference_year = 2010").first().deaths for m in ("rows", "entities")}
    assert by == {"rows": 2, "entities": 1}


def test_cohorts(registry, residence):
    got = {(r.birth_decade, r.gender): r for r in P.cohort_demographics(registry, residence).collect()}
    dead = got[2010, "F"]  # birth date replaced by the death event
    assert (dead.cohort_size, dead.alive_count, dead.survival_rate_pct, dead.avg_municipality_changes) == (1, 0, 0.0, 2.0)
    # b is registered long after the family events, at the broker's time
    assert got[1970, "M"].divorced_count == 1 and got[1970, "M"].married_rate_pct == 0.0
    assert got[2000, "UKJENT"].cohort_size == 1


def test_marital_trends_share(registry):
    out = P.marital_status_trends(registry)
    total = out.groupBy("reference_year", "age_group").agg(F.round(F.sum("pct_of_age_group"), 0).alias("t"))
    assert rows(total.select("t").distinct()) == [(100.0,)]
    assert out.filter("age_group = '0-17'").count() > 0


def test_households(registry, relations):
    one = rows(P.household_structure(registry, relations), "household_type", "size_category", "count", "pct_of_total")
    assert one == [("ENSLIG", "1", 2, 50.0), ("ENSLIG_FORSØRGER", "2", 1, 25.0)]  # the row without an id counts in the total only
    both = rows(P.household_structure(registry, relations, symmetric=True), "household_type", "count")
    assert both == [("EKTEPAR_UTEN_BARN", 1), ("ENSLIG", 1), ("ENSLIG_FORSØRGER", 1)]
