"""Upsert, full sync, conditional update and retention as frame transforms and table writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrasse.operators.rules import retain_recent, update_where
from terrasse.settings import durable, durable_counted, limit_of
from terrasse.sources import snapshots
from terrasse.sources.snapshots import PART

GONE = "__gone"

# Rows for which a new table gets one bucket.
BUCKET_ROWS = ("spark.terrasse.bucketRows", 2_000_000)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` replace rows with the same key; new ones are added.

    A NULL key never matches.  ``incoming`` must hold one row per key.
    """
    kept = target.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def full_sync(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after a merge that also deletes rows missing from the source.

    Columns only the target has are carried over for rows that stay.
    """
    extra = [c for c in target.columns if c not in source.columns]
    if not extra:
        return source
    carried = target.select(*keys, *extra)
    return source.join(carried, list(keys), "left")


def refuse_repeated_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows have one key; rows with a NULL in the key match nothing and may repeat."""
    if not df.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"several rows for one key ({', '.join(keys)}); reduce them first, for example with keys.latest_per_key")


def upsert_table(incoming: DataFrame, table: str, keys: Sequence[str], buckets: int | None = None) -> int:
    """Upsert into a snapshot table, creating it when missing; returns the version.

    Rows are dealt to ``buckets`` by a hash of the keys (by default as many as the first rows need); only buckets in which a
    row is new or differs are written again.  The history counts inserted and updated rows.  Repeated keys in
    ``incoming`` are refused.
    """
    spark = incoming.sparkSession
    incoming, n = durable_counted(incoming, "incoming")  # checked, and used on both sides of the merge
    refuse_repeated_keys(incoming, keys)
    if not snapshots.exists(spark, table):
        return snapshots.commit(incoming, table, "create", layout=_by_keys(spark, keys, n, buckets))
    if not _fits(spark, table, incoming, keys):
        target = snapshots.read_version(spark, table)
        return snapshots.commit(upsert(target, incoming, keys), table, "upsert", layout=_by_keys(spark, keys, n + target.count(), buckets))
    layout, schema = snapshots.layout_of(spark, table), _wider(snapshots.schema_of(spark, table), incoming.schema)
    incoming = _aligned(incoming, schema)
    reached = _parts_of(incoming.select(layout.part(incoming).alias(PART)))
    found, counts = _changes(_aligned(snapshots.read_parts(spark, table, reached), schema), incoming, keys, layout, deletes=False)
    touched = _parts_of(found.select(PART))
    kept = _aligned(snapshots.read_parts(spark, table, touched), schema).join(found.select(*keys), list(keys), "left_anti")
    return snapshots.commit_parts(kept.unionByName(found), table, "upsert", touched, counts)


def sync_table(source: DataFrame, table: str, keys: Sequence[str], partition_by: tuple[str, ...] = (), buckets: int | None = None) -> int:
    """Full sync of a snapshot table; a source with new columns replaces the schema.

    Buckets as in `upsert_table`; one in which all rows are as they were keeps its files.  With ``partition_by`` the
    whole table is written by those columns.  Repeated keys in the source are refused.
    """
    spark = source.sparkSession
    if partition_by:
        if not snapshots.exists(spark, table):
            return snapshots.commit(source, table, "create", partition_by)
        target = snapshots.read_version(spark, table)
        if not set(source.columns) <= set(target.columns):
            return snapshots.commit(source, table, "overwrite", partition_by)
        return snapshots.commit(full_sync(target, source, keys), table, "sync", partition_by)
    source, n = durable_counted(source, "source")
    refuse_repeated_keys(source, keys)
    if not snapshots.exists(spark, table):
        return snapshots.commit(source, table, "create", layout=_by_keys(spark, keys, n, buckets))
    target = snapshots.read_version(spark, table)
    if not set(source.columns) <= set(target.columns):
        return snapshots.commit(source, table, "overwrite", layout=_by_keys(spark, keys, n, buckets))
    if not _fits(spark, table, source, keys):
        return snapshots.commit(full_sync(target, source, keys), table, "sync", layout=_by_keys(spark, keys, n, buckets))
    wanted = full_sync(target, source, keys).select(*target.columns)
    found, counts = _changes(snapshots.read_parts(spark, table), wanted, keys, snapshots.layout_of(spark, table), deletes=True)
    touched = _parts_of(found.select(PART))
    old = snapshots.read_parts(spark, table, touched).dropna(subset=list(keys))
    kept = old.join(found.select(*keys), list(keys), "left_anti")
    return snapshots.commit_parts(kept.unionByName(found.filter(~F.col(GONE)).drop(GONE)), table, "sync", touched, counts)


def update_table(spark, table: str, condition: Column, changes: Mapping[str, Column]) -> int:
    """Conditional update; a table in parts writes only those with a row that meets the condition."""
    current, layout = snapshots.read_version(spark, table), snapshots.layout_of(spark, table)
    if layout is None or set(changes) & set(layout.by):
        met = current.filter(condition).count()
        return snapshots.commit(update_where(current, condition, changes), table, "update", layout=layout, counts={"inserted": 0, "updated": met, "deleted": 0})
    # One row per part comes back.
    parts = snapshots.read_parts(spark, table).filter(condition).groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()
    touched = [r[PART] for r in parts]
    rows = update_where(snapshots.read_parts(spark, table, touched), condition, changes)
    return snapshots.commit_parts(rows, table, "update", touched, {"inserted": 0, "updated": sum(r["n"] for r in parts), "deleted": 0})


def apply_retention(spark, table: str, column: str | None, days: int | None, as_of: Column, strategy: str = "delete",
                    keep_null: bool = False) -> int | None:
    """Write the retained rows as a new version; an incomplete policy changes nothing.

    A table in parts writes only parts of which some rows go and some stay: parts that lose all rows are no longer listed, parts
    that keep all are not touched.  With a layout by day of ``column`` that is the one day of the limit.
    """
    current = snapshots.read_version(spark, table)
    if not days or strategy != "delete" or not column or column not in current.columns:
        return None

    def kept(df: DataFrame) -> DataFrame:
        return retain_recent(df, column, days, as_of, strategy, keep_null)

    if snapshots.layout_of(spark, table) is None:
        return snapshots.commit(kept(current), table, "retention")
    # One pass over the date column; one row per part comes back.
    narrow = snapshots.read_parts(spark, table).select(column, PART)
    both = narrow.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).join(
        kept(narrow).groupBy(PART).agg(F.count(F.lit(1)).alias("kept")), PART, "left").na.fill(0, ["kept"]).filter("kept < n").collect()
    rows = kept(snapshots.read_parts(spark, table, [r[PART] for r in both if r["kept"]]))
    return snapshots.commit_parts(rows, table, "retention", [r[PART] for r in both], {"inserted": 0, "updated": 0, "deleted": sum(r["n"] - r["kept"] for r in both)})


def _by_keys(spark, keys: Sequence[str], rows: int, buckets: int | None) -> snapshots.Layout:
    return snapshots.Layout(tuple(keys), buckets or max(1, -(-rows // limit_of(spark, BUCKET_ROWS))))


def _fits(spark, table: str, incoming: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the table's parts can take the rows: dealt by the same keys, not outgrown, columns of the same types."""
    layout = snapshots.layout_of(spark, table)
    if layout is None or layout.by != tuple(keys) or layout.buckets is None:
        return False
    rows = snapshots.history(spark, table).first()["rows"]
    if rows > 4 * layout.buckets * limit_of(spark, BUCKET_ROWS):
        return False
    types = {f.name: f.dataType for f in snapshots.schema_of(spark, table)}
    return all(types.get(f.name, f.dataType) == f.dataType for f in incoming.schema)


def _wider(stored: StructType, incoming: StructType) -> StructType:
    return StructType([*stored.fields, *[f for f in incoming.fields if f.name not in stored.names]])


def _aligned(df: DataFrame, schema: StructType) -> DataFrame:
    kept = [PART] if PART in df.columns else []
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], *kept)


def _parts_of(parts: DataFrame) -> list[str]:
    """Distinct parts, as many as the layout has at most."""
    return [r[0] for r in parts.distinct().collect()]


def _changes(target: DataFrame, wanted: DataFrame, keys: Sequence[str], layout: snapshots.Layout, deletes: bool) -> tuple[DataFrame, dict[str, int]]:
    """Rows of ``wanted`` that are new or differ, stored with the part they go to, and the number of each kind of change.

    With ``deletes`` also target rows that ``wanted`` lacks, marked in a column.  Rows without a key match nothing: those
    of ``wanted`` are inserted, those of the target deleted.
    """
    columns, named = wanted.columns, [f"__{k}" for k in keys]
    old = target.select(F.struct(*columns).alias("old"), F.col(PART).alias("held"), *[F.col(k).alias(f"__{k}") for k in keys])
    new = wanted.select(F.struct(*columns).alias("new"), layout.part(wanted).alias("due"), *[F.col(k).alias(f"__{k}") for k in keys])
    both = old.join(new, named, "full" if deletes else "right")
    kind = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").when(~_same(wanted.schema), "updated")
    seen = Observation("merge")
    rows = both.select(F.coalesce("new", "old").alias("row"), F.coalesce("held", "due").alias(PART), kind.alias("kind")).filter(F.col("kind").isNotNull())
    rows = rows.observe(seen, *[F.count_if(F.col("kind") == c).alias(c) for c in snapshots.COUNTS])
    marked = [(F.col("kind") == "deleted").alias(GONE)] if deletes else []
    found = durable(rows.select("row.*", PART, *marked), "changes")
    return found, {c: seen.get[c] for c in snapshots.COUNTS}


def _same(schema: StructType) -> Column:
    """Whether old and new row agree in every column; columns that hold maps are compared as text."""
    def one(f) -> Column:
        a, b = F.col("old")[f.name], F.col("new")[f.name]
        return F.to_json(F.struct(a)).eqNullSafe(F.to_json(F.struct(b))) if "map" in f.dataType.simpleString() else a.eqNullSafe(b)

    return reduce(lambda a, b: a & b, [one(f) for f in schema.fields])
