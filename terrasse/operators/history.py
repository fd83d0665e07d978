"""Event histories: accumulated state, spells, year-end snapshots, flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.operators.keys import first_per_key
from terrasse.operators.ordered import over_order
from terrasse.settings import durable


def fan_out(df: DataFrame, roles: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per role from one scan: each role maps output names to expressions.

    Names missing in a role become NULL; all roles must agree on types.
    """
    names = list(dict.fromkeys(n for role in roles for n in role))
    rows = F.array(*[F.struct(*[role.get(n, F.lit(None)).alias(n) for n in names]) for role in roles])
    return df.select(F.inline(rows))


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def accumulate_state(
    events: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    tie_breakers: Sequence[str] = (),
    defaults: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Slowly changing history: one row per event with the state known at that time.

    Every attribute holds its last non-NULL value so far.  A row is valid from its event to the
    next one; the last row of a key is current.  Events with equal time all stay, the earlier
    ones with zero length.
    """
    defaults = defaults or {}
    state = over_order(
        events.select(key, ts, *tie_breakers, *attributes, *[c for c in carry if c not in tie_breakers]),
        [key],
        [ts, *tie_breakers],
        last={f"__s_{a}": a for a in attributes},
        lead={"__next": ts},
    )
    def value(a):
        held = F.col(f"__s_{a}")
        return (F.coalesce(held, F.lit(defaults[a])) if a in defaults else held).alias(a)

    return state.select(
        key,
        *[value(a) for a in attributes],
        *carry,
        F.col(ts).alias("valid_from"),
        F.col("__next").alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
    )


def spells(
    moves: DataFrame,
    key: str,
    ts: str,
    carry: Sequence[str],
    tie_breakers: Sequence[str] = (),
    ends: DataFrame | None = None,
    end_date: str = "end_date",
) -> DataFrame:
    """Stays between consecutive moves; the open stay ends at the key's end date, if any.

    The end dates ride in the same ordered pass behind all moves of their key, so closing the
    open stay needs no join.
    """
    known = moves.select(key, ts, *tie_breakers, *[c for c in carry if c not in tie_breakers])
    timeline = known.withColumn("__end", F.lit(0))
    if ends is not None:
        marks = ends.select(key, F.col(end_date).cast(known.schema[ts].dataType).alias(ts), F.lit(1).alias("__end"))
        timeline = timeline.unionByName(marks.filter(F.col(key).isNotNull()), allowMissingColumns=True)
    ordered = over_order(
        timeline, [key], ["__end", ts, *tie_breakers], lead={"__next": ts, "__next_end": "__end"}
    ).filter(F.col("__end") == 0)
    moved_in, moved_out = F.to_date(ts), F.to_date("__next")
    return ordered.select(
        key,
        *carry,
        moved_in.alias("moved_in_date"),
        moved_out.alias("moved_out_date"),
        F.col("__next").isNull().alias("is_current"),
        F.when(moved_out.isNotNull(), F.datediff(moved_out, moved_in)).alias("duration_days"),
    )


def moves_per_key(stays: DataFrame, key: str, name: str = "moves") -> DataFrame:
    """Number of stays minus one."""
    return stays.groupBy(key).agg((F.count(F.lit(1)) - 1).alias(name))


def in_out_net(
    stays: DataFrame,
    place: Sequence[str],
    moved_in: str = "moved_in_date",
    moved_out: str = "moved_out_date",
    period: str = "month",
    names: tuple[str, str, str] = ("moved_in", "moved_out", "net"),
) -> DataFrame:
    """Arrivals, departures and net per place and period.

    Both directions come from one scan and one shuffle; NULL place names stay together.
    """
    arrivals, departures, net = names
    place_cols = {p: F.col(p) for p in place}
    both = fan_out(
        stays,
        [
            {**place_cols, "period": F.date_trunc(period, F.col(moved_in)), arrivals: F.lit(1), departures: F.lit(0)},
            {
                **place_cols,
                "period": F.date_trunc(period, F.col(moved_out)),
                arrivals: F.lit(0),
                # a stay that has not ended leaves no departure row
                departures: F.when(F.col(moved_out).isNotNull(), F.lit(1)),
            },
        ],
    ).filter(F.col(departures).isNotNull())
    return (
        both.groupBy(*place, "period")
        .agg(F.sum(arrivals).alias(arrivals), F.sum(departures).alias(departures))
        .withColumn(net, F.col(arrivals) - F.col(departures))
    )


def net_aligned(
    inflow: DataFrame, outflow: DataFrame, on: Sequence[str], value: str, missing: str = "zero_result", name: str = "net"
) -> DataFrame:
    """``inflow - outflow`` aligned on keys.

    ``missing="zero_result"`` gives 0 where one side has no row, ``"zero_side"`` counts the
    missing side as 0.
    """
    both = inflow.select(*on, F.col(value).alias("__in")).unionByName(
        outflow.select(*on, F.col(value).alias("__out")), allowMissingColumns=True
    )
    sides = both.groupBy(*on).agg(F.sum("__in").alias("__in"), F.sum("__out").alias("__out"))
    zero = F.lit(0)
    if missing == "zero_result":
        net = F.coalesce(F.col("__in") - F.col("__out"), zero)
    elif missing == "zero_side":
        net = F.coalesce("__in", zero) - F.coalesce("__out", zero)
    else:
        raise ValueError(f"unknown missing mode {missing!r}")
    return sides.select(*on, net.alias(name))


def year_end_snapshot(
    history: DataFrame,
    key: str,
    as_of_year: int | Column,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    tie_breakers: Sequence[str] = (),
    year: str = "reference_year",
    disjoint: bool = False,
) -> DataFrame:
    """The row of each key that holds at 31 December, for every year it holds.

    Each row lists its own years, so no row meets a year it does not cover.  Where rows of a key
    overlap, the current and then the latest one is kept; ``disjoint=True`` states that they never
    do, which saves the shuffle.
    """
    first = F.year(valid_from)
    final = F.least(
        F.coalesce(F.year(valid_to) - 1, F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year),
        F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year,
    )
    yearly = history.filter(final >= first).withColumn(year, F.explode(F.sequence(first, final)))
    if disjoint:
        return yearly
    order = [F.col("is_current").desc(), F.col(valid_from).desc(), *[F.col(c).desc() for c in tie_breakers]]
    return first_per_key(yearly, [key, year], order)


def population_by_year(
    snapshot: DataFrame,
    history: DataFrame,
    place: Sequence[str],
    code: str,
    key: str,
    alive: Column,
    groups: Mapping[str, Column],
    birth_year: Column,
    birth_events: Column,
    death_date: str,
    count_deaths: str = "rows",
    year: str = "reference_year",
    digits: int = 1,
) -> DataFrame:
    """Residents, groups, mean age, births and deaths per place and year.

    ``count_deaths="rows"`` counts every history row that carries a death date, ``"entities"``
    counts each key once per place and year.
    """
    residents = (
        snapshot.filter(alive & F.col(code).isNotNull())
        .groupBy(*place, year)
        .agg(
            F.count(key).alias("population_total"),
            *[F.count_if(c).alias(n) for n, c in groups.items()],
            F.round(F.avg(F.col(year) - birth_year), digits).alias("avg_age"),
        )
    )
    # Births and deaths of a history row come from one scan.
    changes = fan_out(
        history,
        [
            {code: F.col(code), year: F.year("valid_from"), "birth": F.when(birth_events, F.col(key)), "death": F.lit(None).cast(history.schema[key].dataType)},
            {code: F.col(code), year: F.year(death_date), "birth": F.lit(None).cast(history.schema[key].dataType), "death": F.col(key)},
        ],
    ).filter(F.col(code).isNotNull() & F.col(year).isNotNull() & (F.col("birth").isNotNull() | F.col("death").isNotNull()))
    counted = changes.groupBy(code, year).agg(
        F.count("birth").alias("births"),
        (F.count("death") if count_deaths == "rows" else F.count_distinct("death")).alias("deaths"),
    )
    return residents.join(counted, [code, year], "left").fillna(0, subset=["births", "deaths"])


def flow_matrix(
    stays: DataFrame,
    key: str,
    date: str,
    code: str,
    labels: Sequence[str] = (),
    tie_breakers: Sequence[str] = (),
    year: str = "reference_year",
) -> DataFrame:
    """Directed moves between places per year, with the return flow and the net.

    Labels travel with the codes; the return side is summed per code pair first, so varying
    labels cannot multiply rows.
    """
    parts = [code, *labels]
    # Read by the count of the keys and by the ordered pass.
    narrow = durable(stays.select(key, date, *tie_breakers, *[p for p in parts if p not in tie_breakers]), "stays")
    previous = over_order(
        narrow, [key], [date, *tie_breakers], lag={f"from_{p}": p for p in parts},
    )
    forward = (
        previous.filter(F.col(f"from_{code}").isNotNull() & (F.col(f"from_{code}") != F.col(code)))
        .withColumn(year, F.year(date))
        .filter(F.col(year).isNotNull())
        .groupBy(*[f"from_{p}" for p in parts], *[F.col(p).alias(f"to_{p}") for p in parts], year)
        .agg(F.count(F.lit(1)).alias("flow_count"))
    )
    # The flows are far fewer than the moves and are needed in both directions.
    forward = durable(forward, "flows")
    back = forward.groupBy(
        F.col(f"to_{code}").alias(f"from_{code}"), F.col(f"from_{code}").alias(f"to_{code}"), F.col(year)
    ).agg(F.sum("flow_count").alias("return_flow_count"))
    return (
        forward.join(back, [f"from_{code}", f"to_{code}", year], "left")
        .fillna(0, subset=["return_flow_count"])
        .withColumn("net_flow", F.col("flow_count") - F.col("return_flow_count"))
    )
