"""Connected components of an edge table, by alternating stars, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terrasse.settings import fresh_path


def _write(edges: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """Store an edge set; also its size and checksum, taken while writing."""
    spark, path, seen = edges.sparkSession, fresh_path(edges.sparkSession, label), Observation(label)
    total = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).cast("string")
    edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum")).write.parquet(path)
    return spark.read.schema("u bigint, v bigint").parquet(path), (seen.get["n"], seen.get["sum"])


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the smallest node it reaches, itself included.

    Each round links the larger neighbours of every node to its smallest neighbour, then the
    smaller ones; minima combine on the map side and the join back is an inner equi-join that
    skew handling may split, so a hub costs no more than its edges.  Rounds are written to the
    shared folder.  An edge set that a round leaves as it was is a set of stars.  Raises after
    ``rounds`` rounds (logarithmic growth makes that unreachable in practice) rather than return
    unfinished components.  Edges with a null end and self links count for nothing.
    """
    u, v = F.col("u").cast("long"), F.col("v").cast("long")
    flat = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    flat, before = _write(flat, "edges")
    for _ in range(rounds):
        if not before[0]:
            break
        both = flat.unionByName(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = small.select("e.*").where("u <> v").distinct()
        flat, after = _write(small, "edges")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = flat.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return flat.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
