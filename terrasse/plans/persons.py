"""Person registry, family relations, residence history and the gold tables built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.operators import graph, history, measures, rules
from terrasse.operators.keys import with_existence_flag
from terrasse.operators.lookup import prefer_reference
from terrasse.settings import durable

# Event types, statuses, relation types and household labels.
CREATED, BIRTH, MOVE, DEATH = "citizen.created", "event.birth", "event.relocation", "citizen.died"
MARRIAGE, DIVORCE = "event.marriage", "event.divorce"
STATE_EVENTS = (CREATED, BIRTH, DEATH, MOVE)
ADDRESS_EVENTS = (CREATED, BIRTH, MOVE)
STATUS_EVENT, SINGLE, MARRIED, DIVORCED = "SivilstatusEndret", "UGIFT", "GIFT", "SKILT"
PARENT_OF, CHILD_OF = "FORELDER_AV", "BARN_AV"
COUPLE_WITH_CHILDREN, COUPLE, LONE_PARENT, ALONE = "EKTEPAR_MED_BARN", "EKTEPAR_UTEN_BARN", "ENSLIG_FORSØRGER", "ENSLIG"
UNKNOWN_GENDER = "UKJENT"
MAX_GENERATIONS = 5

# Payload paths of person events, in order of preference.
PERSON_PATHS = {
    "person_id": ("$.citizenId", "$.childId"),
    "ssn": ("$.ssn", "$.childSsn"),
    "first_name": ("$.firstName",),
    "last_name": ("$.lastName",),
    "birth_date": ("$.birthDate",),
    "gender": ("$.sex",),
    "mother_id": ("$.parent1Id",),
    "father_id": ("$.parent2Id",),
    "street_address": ("$.streetAddress", "$.address"),
    "municipality_code": ("$.municipalityCode", "$.postalCode"),
    "municipality_name": ("$.municipalityName", "$.city"),
    "county": ("$.county",),
}
FAMILY_PATHS = {
    "person_id_a": ("$.citizen1Id",),
    "person_id_b": ("$.citizen2Id",),
    "child_id": ("$.childId",),
    "mother_id": ("$.parent1Id",),
    "father_id": ("$.parent2Id",),
}
# The death event carries its date under this path.
DEATH_DATE_PATH = "$.birthDate"

STATE_COLUMNS = (
    "fnr_hash", "first_name", "last_name", "birth_date", "gender", "mother_id", "father_id", "street_address",
    "municipality_code", "municipality_name", "county", "death_date", "civil_status",
)
PLACE = ("municipality_code", "municipality_name", "county")


def _event_columns() -> dict[str, Column]:
    return {"event_type": F.col("event_type"), "event_ts": rules.event_time("event_timestamp", "kafka_timestamp")}


def person_fields(events: DataFrame, death_path: str = DEATH_DATE_PATH) -> DataFrame:
    parsed, found = rules.parsed_fields(events, "payload_json", {**PERSON_PATHS, "death_date": death_path})
    found["fnr_hash"] = rules.pseudonym(found.pop("ssn"))
    found["death_date"] = F.when(F.col("event_type") == DEATH, found["death_date"])
    return parsed.select(*[c.alias(n) for n, c in {**_event_columns(), **found}.items()])


def family_fields(events: DataFrame) -> DataFrame:
    parsed, found = rules.parsed_fields(events, "payload_json", FAMILY_PATHS)
    return parsed.select(*[c.alias(n) for n, c in {**_event_columns(), **found}.items()])


def read_person_events(events: DataFrame) -> DataFrame:
    """The fields of all person events, their JSON parsed once and written narrow.

    `person_registry` and `residence_history` take this table or the events themselves; give it where both are wanted.
    """
    return durable(person_fields(events).filter(F.col("event_type").isin(*STATE_EVENTS)), "person-fields")


def read_family_events(events: DataFrame) -> DataFrame:
    """As `read_person_events`, for `person_registry` and `family_relations`."""
    return durable(family_fields(events).filter(F.col("event_type").isin(MARRIAGE, DIVORCE, BIRTH)), "family-fields")


def _persons(events: DataFrame) -> DataFrame:
    return events if "fnr_hash" in events.columns else read_person_events(events)


def _family(events: DataFrame) -> DataFrame:
    return events if "person_id_a" in events.columns else read_family_events(events)


def _status_events(family: DataFrame) -> DataFrame:
    status = F.when(F.col("event_type") == MARRIAGE, MARRIED).otherwise(DIVORCED)
    one = {"event_ts": F.col("event_ts"), "event_type": F.lit(STATUS_EVENT), "civil_status": status}
    partners = [{"person_id": F.col(c), **one} for c in ("person_id_a", "person_id_b")]
    return history.fan_out(family.filter(F.col("event_type").isin(MARRIAGE, DIVORCE)), partners)


def person_registry(person_events: DataFrame, family_events: DataFrame | None = None) -> DataFrame:
    """Slowly changing person history from both event tables.

    Without family events every status is the single one.
    """
    states = _persons(person_events)
    frames = [states.withColumn("civil_status", F.lit(None).cast("string"))]
    if family_events is not None:
        frames.append(_status_events(_family(family_events)))
    timeline = history.union_frames(frames)
    # Equal times are ordered by event type and then by content, so the result is repeatable.
    timeline = timeline.withColumn("__tie", F.xxhash64(*STATE_COLUMNS))
    states = history.accumulate_state(
        timeline, "person_id", "event_ts", STATE_COLUMNS, ["event_type", "__tie"], {"civil_status": SINGLE}, ["event_type"]
    )
    return states.select(
        "person_id", F.col("fnr_hash").alias("fnr_masked"),
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "first_name", "last_name",
        _date("birth_date").alias("birth_date"), "gender", "mother_id", "father_id", "street_address", *PLACE,
        F.col("civil_status").alias("marital_status"), F.col("death_date").isNull().alias("is_alive"),
        _date("death_date").alias("death_date"), F.col("event_type").alias("change_event_type"),
        "valid_from", "valid_to", "is_current",
    )


def _date(column: str) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(column)))


def family_relations(family_events: DataFrame, max_generations: int = MAX_GENERATIONS, divorce_match: str = "first_after") -> DataFrame:
    """Marriages, divorces and ancestor relations as one directed edge list.

    A marriage ends with the first divorce after it; ``divorce_match="all"`` lists it once per divorce of the pair.
    """
    family = _family(family_events)
    open_end, no_depth = F.lit(None).cast("timestamp"), F.lit(None).cast("int")

    def relation_id(*parts):
        return F.concat_ws("_", *parts)

    pair = ["person_id_a", "person_id_b"]
    married = family.filter(F.col("event_type") == MARRIAGE).select(*pair, F.col("event_ts").alias("valid_from"))
    divorced = family.filter(F.col("event_type") == DIVORCE).select(*pair, F.col("event_ts").alias("valid_from"))
    marriages = graph.symmetric_pair_join(married, divorced, *pair, "valid_from", "valid_from", divorce_match).withColumn(
        "relation_type", F.lit(MARRIED)
    )
    divorces = divorced.select("*", open_end.alias("valid_to"), F.lit(True).alias("is_current"), F.lit(DIVORCED).alias("relation_type"))
    couples = marriages.unionByName(divorces).select(
        relation_id(*[F.col(c) for c in pair], F.col("valid_from").cast("string")).alias("relation_id"),
        *pair, "relation_type", no_depth.alias("generation_depth"), "valid_from", "valid_to", "is_current",
    )

    births = family.filter(F.col("event_type") == BIRTH)
    parents = history.fan_out(
        births,
        [{"ancestor_id": F.col(p), "descendant_id": F.col("child_id"), "event_ts": F.col("event_ts")} for p in ("mother_id", "father_id")],
    )
    ancestors = graph.closure(parents, max_depth=max_generations)
    directed = graph.mirror_edges(ancestors, "ancestor_id", "descendant_id", PARENT_OF, CHILD_OF)
    generations = directed.select(
        relation_id(F.col("person_id_a"), F.col("person_id_b"), F.col("relation_type"), F.col("generation_depth").cast("string")).alias("relation_id"),
        *pair, "relation_type", "generation_depth", F.col("event_ts").alias("valid_from"),
        open_end.alias("valid_to"), F.lit(True).alias("is_current"),
    )
    return couples.unionByName(generations)


def residence_history(person_events: DataFrame, municipalities: DataFrame | None = None) -> DataFrame:
    """Stays per person; the open stay of a dead person ends on the day of death."""
    persons = _persons(person_events)
    moves = persons.filter(F.col("event_type").isin(*ADDRESS_EVENTS) & F.col("municipality_code").isNotNull())
    if municipalities is not None:
        moves = prefer_reference(
            moves, municipalities, "municipality_code", "kommunenr", {"municipality_name": "kommunenavn", "county": "fylke"}
        )
    died = F.to_date(F.coalesce(F.try_to_timestamp(F.col("death_date")), F.col("event_ts")))
    deaths = persons.filter(F.col("event_type") == DEATH).select("person_id", died.alias("end_date"))
    stays = history.spells(
        moves, "person_id", "event_ts", [*PLACE, "event_type"], ["event_type", "municipality_code"], deaths
    )
    return stays.withColumnRenamed("event_type", "change_event_type")


def municipality_migration(residence: DataFrame) -> DataFrame:
    """Arrivals, departures and net per municipality and month."""
    return history.in_out_net(residence, PLACE, names=("innflyttinger", "utflyttinger", "netto"))


def population_stats(registry: DataFrame, as_of_year: int, count_deaths: str = "rows", disjoint: bool = True) -> DataFrame:
    """Residents, births and deaths per municipality and year.

    A registry built by ``person_registry`` holds one row per person at any time, so its yearly
    rows need no choice between candidates; pass ``disjoint=False`` for other histories.
    """
    used = ["person_id", *PLACE, "gender", "birth_date", "death_date", "is_alive", "is_current", "change_event_type", "valid_from", "valid_to"]
    registry = durable(registry.select(*used), "registry")  # read for the yearly rows and for births and deaths
    snapshot = history.year_end_snapshot(
        registry, "person_id", as_of_year, tie_breakers=["change_event_type"], disjoint=disjoint
    )
    return history.population_by_year(
        snapshot, registry, PLACE, "municipality_code", "person_id", F.col("is_alive"),
        {"population_male": F.col("gender") == "M", "population_female": F.col("gender") == "F"},
        F.year("birth_date"), F.col("change_event_type").isin(BIRTH, CREATED), "death_date", count_deaths,
    )


def cohort_demographics(registry: DataFrame, residence: DataFrame) -> DataFrame:
    """Profile per birth decade and gender of the current persons."""
    persons = registry.filter("is_current").select(
        "person_id", rules.decade(F.year("birth_date")).alias("birth_decade"),
        rules.or_default("gender", UNKNOWN_GENDER).alias("gender"), "is_alive", "marital_status",
    ).filter(F.col("birth_decade").isNotNull())
    moves = history.moves_per_key(residence, "person_id", "municipality_changes")
    cohorts = persons.join(moves, "person_id", "left").fillna(0, subset=["municipality_changes"]).groupBy("birth_decade", "gender").agg(
        F.count("person_id").alias("cohort_size"),
        F.count_if("is_alive").alias("alive_count"),
        F.count_if(F.col("marital_status") == MARRIED).alias("married_count"),
        F.count_if(F.col("marital_status") == DIVORCED).alias("divorced_count"),
        F.round(F.avg("municipality_changes"), 2).alias("avg_municipality_changes"),
    )
    return cohorts.withColumns({
        "survival_rate_pct": measures.rate("alive_count", "cohort_size"),
        "married_rate_pct": measures.rate("married_count", "cohort_size"),
    })


def marital_status_trends(registry: DataFrame) -> DataFrame:
    """Status shares of the state changes per year and age band."""
    year = F.year("valid_from")
    age = year - F.year("birth_date")
    changes = registry.filter(age >= 0).select(
        year.alias("reference_year"), rules.band(age, rules.AGE_BANDS, rules.AGE_TOP).alias("age_group"),
        rules.or_default("marital_status", SINGLE).alias("marital_status"), "person_id",
    )
    counted = changes.groupBy("reference_year", "age_group", "marital_status").agg(F.count("person_id").alias("count"))
    return measures.share_in_group(counted, ["reference_year", "age_group"], "count", "pct_of_age_group")


def migration_flows(residence: DataFrame) -> DataFrame:
    """Directed flows between municipalities per year, with return flow and net."""
    flows = history.flow_matrix(
        residence, "person_id", "moved_in_date", "municipality_code", ["municipality_name", "county"],
        ["change_event_type", "municipality_code"],
    )
    order = [f"{side}_{c}" for side in ("from", "to") for c in PLACE]
    return flows.select(*order, "reference_year", "flow_count", "return_flow_count", "net_flow")


def household_type(has_partner: Column, has_children: Column) -> Column:
    return (
        F.when(has_partner & has_children, COUPLE_WITH_CHILDREN)
        .when(has_partner, COUPLE)
        .when(has_children, LONE_PARENT)
        .otherwise(ALONE)
    )


def household_structure(registry: DataFrame, relations: DataFrame, symmetric: bool = False) -> DataFrame:
    """Household types and sizes of the living, with their share of all.

    Only side A of a marriage counts as having a partner unless ``symmetric``.
    """
    persons = registry.filter(F.col("is_current") & F.col("is_alive")).select("person_id")
    wed = relations.filter((F.col("relation_type") == MARRIED) & F.col("is_current"))
    sides = ["person_id_a", "person_id_b"] if symmetric else ["person_id_a"]
    partners = wed.select(F.explode(F.array(*sides)).alias("person_id"))
    children = relations.filter((F.col("relation_type") == PARENT_OF) & (F.col("generation_depth") == 1)).groupBy(
        F.col("person_id_a").alias("person_id")
    ).agg(F.count(F.lit(1)).alias("child_count"))
    return classify_households(with_existence_flag(persons, partners, ["person_id"], "has_partner").join(children, "person_id", "left"))


def classify_households(
    persons: DataFrame, key: str = "person_id", child_count: str = "child_count", has_partner: str = "has_partner"
) -> DataFrame:
    """Counts of known persons per type and size; the share is taken of all rows, known or not."""
    n = F.coalesce(F.col(child_count), F.lit(0))
    size = 1 + F.col(has_partner).cast("int") + n
    labelled = persons.select(
        household_type(F.col(has_partner), n > 0).alias("household_type"),
        rules.band(size, rules.SIZE_BANDS, rules.SIZE_TOP).alias("size_category"), key,
    )
    counted = labelled.groupBy("household_type", "size_category").agg(
        F.count(key).alias("count"), F.count(F.lit(1)).alias("__rows")
    )
    counted = durable(counted, "households")
    total = counted.agg(F.sum("__rows")).scalar()
    return counted.withColumn("pct_of_total", F.round(F.col("count") / total * 100, 2)).drop("__rows")

