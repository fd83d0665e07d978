"""Shards of near-equal bytes by sampled splitters.

Records are keyed by their text, so equal texts lie side by side.  A sample drawn in proportion
to load gives quantile splitters, records are range-partitioned by them, and ranges that turn out
overfull are subdivided by samples of their own until none is.  A record's load is its size and the mean size of all, so that a
range is bounded in bytes and in rows, however many empty texts there are.  The number of ranges follows the number of
rows.  What is known per range (a table of so many rows) then
fixes the shard borders; only a window inside one range is needed to number the records.

Groups of equal texts stay whole: a small group goes where it starts, a large one, in bytes or in rows, is placed
as a whole while it fits a shard; its records may lie in many ranges.  A group too large for a shard is cut record by record.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasse.settings import durable

SHARDS, RANGES, DRAWS = 8, 256, 32
RANGE_ROWS, ROUNDS = 200_000, 60  # rows of a range on average, from ``RANGES`` ranges on; rounds of subdividing before it is given up
LARGE = 100  # a group is large from 1 / LARGE of a shard on; there are at most SHARDS * LARGE of them
TOP = (1 << 63) - 1


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``, the text's key ``g`` and ``k``, which orders equal texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("g"), F.monotonically_increasing_id().alias("row"))
    return durable(rows.withColumn("k", F.xxhash64("doc_id", "row")), "shard-keys")


def _load(mean: float) -> Column:
    return F.col("size") + F.lit(max(1, round(mean)))


def _draw(rows: DataFrame, draws: int, total: int, salt: int) -> pd.DataFrame:
    """About ``draws`` keys, each record as often as its share of the ``total`` load calls for."""
    chance = (F.pmod(F.xxhash64("k", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30))
    times = F.floor(F.col("load") * (draws / total) + chance).cast("long")
    picked = rows.select("g", "k", times.alias("n")).where("n > 0").toPandas()
    return picked.sort_values(["g", "k"], ignore_index=True)


def _quantiles(sample: pd.DataFrame, parts: int) -> list[tuple[int, int]]:
    if sample.empty:
        return []
    share = np.cumsum(sample["n"].to_numpy()) / sample["n"].sum()
    at = np.minimum(np.searchsorted(share, np.arange(1, parts) / parts), len(sample) - 1)
    return sorted({(int(sample["g"][i]), int(sample["k"][i])) for i in at})


def range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters ``(g, k)`` below a record's key; a splitter belongs to the range it closes."""
    gs, ks = np.array([s[0] for s in splitters], np.int64), np.array([s[1] for s in splitters], np.int64)

    @F.pandas_udf("int")
    def place(g: pd.Series, k: pd.Series) -> pd.Series:
        g, k = g.to_numpy(), k.to_numpy()
        low, high = np.searchsorted(gs, g, "left"), np.searchsorted(gs, g, "right")
        out = low.copy()
        for own in np.unique(low[low < high]):
            mine = (low == own) & (low < high)
            out[mine] = own + np.searchsorted(ks[own : high[mine][0]], k[mine], "left")
        return pd.Series(out.astype(np.int32))

    return place("g", "k")


@dataclass
class Plan:
    """Splitters, and per range the bytes before it in its stream and what is done with it."""

    splitters: list[tuple[int, int]]
    table: list[tuple[int, int, int, bool]]  # range, placed shard or -1, stream bytes before it, cut by record
    borders: list[int]  # stream bytes at which the next shard begins


def plan_ranges(rows: DataFrame, shards: int, ranges: int | None, rounds: int = ROUNDS) -> Plan:
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    if not whole["rows"]:
        return Plan([], [], [])
    ranges = ranges or max(RANGES, -(-whole["rows"] // RANGE_ROWS))
    rows = rows.withColumn("load", _load(whole["bytes"] / whole["rows"]))
    share, load = whole["bytes"] / shards, whole["bytes"] + whole["rows"] * max(1, round(whole["bytes"] / whole["rows"]))
    sums = [F.sum("size").alias("bytes"), F.sum("load").alias("load")]
    groups = rows.groupBy("g").agg(*sums).where(F.col("load") > load / shards / LARGE).toPandas()  # at most shards * LARGE
    large = dict(zip(groups["g"].astype("int64").tolist(), groups["bytes"].astype("int64").tolist(), strict=True))

    def clean(found: list[tuple[int, int]]) -> set[tuple[int, int]]:
        """Splitters cut large groups only, others end after the group they fall into."""
        return {(g, k if g in large else TOP) for g, k in found}

    splitters = clean(_quantiles(_draw(rows, ranges * DRAWS, load, 0), ranges))
    for g in large:
        splitters |= {(g, TOP)} | ({(g - 1, TOP)} if g > -TOP else set())
    limit = 2 * load / ranges
    for salt in range(1, rounds + 1):
        ordered = sorted(splitters)
        placed = rows.withColumn("range", range_of(ordered))
        sizes = {r["range"]: r for r in placed.groupBy("range").agg(*sums, F.max("load").alias("most"), F.min("g").alias("low"), F.max("g").alias("high")).collect()}
        over = [n for n, r in sizes.items() if r["load"] > limit and r["load"] > 2 * r["most"] and (r["low"] != r["high"] or r["low"] in large)]
        if not over:
            break
        if salt == rounds:
            raise RuntimeError(f"{len(over)} ranges stay overfull after {rounds} rounds")
        # Each has over 2 / ranges of the load, so there are few; one sample serves them all.
        inside = _draw(placed.where(F.col("range").isin(over)), len(over) * 4 * DRAWS * (1 + salt // 8), sum(sizes[n]["load"] for n in over), salt)
        place = np.searchsorted(np.array([s[0] for s in ordered]), inside["g"].to_numpy(), "left")
        for n in np.unique(place):
            splitters |= clean(_quantiles(inside[place == n].reset_index(drop=True), 4))

    ordered = sorted(splitters)
    of = {n: r["low"] if r["low"] == r["high"] and r["low"] in large else None for n, r in sizes.items()}
    free = [share] * shards
    home: dict[int, int] = {}
    for g, size in sorted(large.items(), key=lambda x: (-x[1], x[0])):
        best = max(range(shards), key=lambda s: (free[s], -s))
        if size <= free[best]:
            home[g], free[best] = best, free[best] - size
    table, at = [], 0
    for n in sorted(sizes):
        placed_in = home.get(of[n], -1) if of[n] is not None else -1
        table.append((n, placed_in, at, of[n] is not None))
        at += 0 if placed_in >= 0 else sizes[n]["bytes"]
    borders = np.ceil(np.cumsum(free)).astype(np.int64).tolist()[:-1]
    return Plan(ordered, table, borders)


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``.

    Size is the UTF-8 bytes of the text plus 1 (null text: 1).  Slots count from 0 without a gap
    in each shard.  Null and repeated ids are records like any other.  Shard sizes differ by at
    most a small group (1 / LARGE of a shard) or the largest single record.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = keyed(docs, key, text)
    plan = plan_ranges(rows, shards, ranges)
    schema = "range int, placed int, before bigint, by_record boolean"
    known = F.broadcast(spark.createDataFrame(plan.table, schema))  # one row per range
    ordered = Window.partitionBy("range").orderBy("g", "k", "row")
    placed = rows.withColumn("range", range_of(plan.splitters)).join(known, "range")
    placed = placed.withColumn("start", F.sum("size").over(ordered) - F.col("size"))
    start = F.when(F.col("by_record"), F.col("start")).otherwise(F.min("start").over(Window.partitionBy("range", "g")))
    borders = plan.borders
    stream = F.lit(0)
    for b in borders:
        stream = stream + (F.col("before") + start >= b).cast("int")
    shard = F.when(F.col("placed") >= 0, F.col("placed")).otherwise(stream)
    numbered = placed.withColumn("shard", shard).withColumn(
        "nth", F.row_number().over(Window.partitionBy("range", "shard").orderBy("g", "k", "row")))
    numbered = durable(numbered.select("doc_id", "size", "text_crc32", "range", "shard", "nth"), "shard-rows")
    counts = numbered.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))  # at most ranges + shards rows
    first = counts.withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).drop("n")
    return numbered.join(F.broadcast(first), ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).alias("slot"))
